"""0/1 columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zero_one(condition: Column) -> Column:
    """1 where true; 0 where false or unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def flag_to_int(df: DataFrame, flags: Iterable[str], day_columns: Iterable[str] = ()) -> DataFrame:
    """Boolean ``flags`` as 0/1, and ``Day``/``Night`` text columns as 1 for day."""
    out = {c: zero_one(F.col(c)) for c in flags}
    out |= {c: zero_one(F.col(c) == "Day") for c in day_columns}
    return df.withColumns(out)


def binarize(value: Column, threshold) -> Column:
    """1 at or above ``threshold``, else 0; an unknown value counts as 0."""
    return zero_one(value >= threshold)
