"""Generic operators, DataFrame in and DataFrame out, parametrised by column names."""
