"""Distinct counts, flag counts and shares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_count(
    id_col: str, unique_ids: bool = False, approx: bool = False, rsd: float = 0.01
) -> Column:
    """How many different ids.

    Exact by default. ``unique_ids`` states that no id repeats (``quality_report`` tells), so a
    plain count gives the same number without moving any id between executors. ``approx`` trades
    exactness for a fixed-size sketch per group.
    """
    if unique_ids:
        return F.count(id_col)
    if approx:
        return F.approx_count_distinct(id_col, rsd)
    return F.countDistinct(id_col)


def distinct_count_by(
    df: DataFrame, keys: Sequence[str | Column], id_col: str, out: str = "accident_count", **how
) -> DataFrame:
    """Distinct ids per group.

    Spark removes duplicates of (keys, id) map-side, spreads what is left by *both*, and counts
    partially before the small last exchange; a group holding most rows is still spread by id.
    """
    return df.groupBy(*keys).agg(distinct_count(id_col, **how).alias(out))


def flag_counts(df: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """One row: how many rows have each flag set; 0, not NULL, on empty input."""
    return df.agg(*[F.count_if(F.coalesce(F.col(c), F.lit(False))).alias(out) for c, out in flags.items()])


def flag_summary(
    df: DataFrame, flags: Mapping[str, str], id_col: str, total: str = "total_accidents", **how
) -> DataFrame:
    """Rows per flag beside the number of distinct ids.

    In one aggregate Spark would carry every flag counter through the exchange of the ids. The
    two parts read different columns, so they run apart: the flags need no exchange of rows, the
    ids travel alone, and the single totals meet as a scalar subquery.
    """
    ids = df.agg(distinct_count(id_col, **how)).scalar()
    return flag_counts(df, flags).withColumn(total, ids)


def share_of_total(
    counts: DataFrame, measure: str, out: str = "percentage", digits: int = 2
) -> DataFrame:
    """Each row's percentage of the measure's total over all rows of ``counts``.

    The total is a partial sum brought in as a scalar subquery, so ``counts`` is not gathered
    in one partition as a window over the whole result would do.
    """
    total = counts.agg(F.sum(measure).cast("decimal(20,0)")).scalar()
    share = F.col(measure).cast("decimal(20,0)") * F.lit(100) / total
    return counts.withColumn(out, F.round(share, digits).cast(f"decimal(27,{digits})"))
