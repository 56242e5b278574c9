"""Reading and writing: delimited feeds, dated snapshots, silver tables, served tables."""
