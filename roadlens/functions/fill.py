"""Filling missing values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def known(col: str) -> Column:
    """The column as a double, with NaN read as missing."""
    return F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))


def column_means(df: DataFrame, cols: Sequence[str], weight: str | None = None) -> DataFrame:
    """One row holding the mean of every column, from a single aggregate over ``df``.

    ``weight`` names a column that says how many rows each row stands for.
    """
    if weight is None:
        return df.agg(*[F.avg(known(c)).alias(c) for c in cols])
    w = F.col(weight).cast("double")
    return df.agg(
        *[
            F.try_divide(F.sum(known(c) * w), F.sum(F.when(known(c).isNotNull(), w))).alias(c)
            for c in cols
        ]
    )


def fill_mean(
    df: DataFrame,
    cols: Sequence[str],
    means: DataFrame | None = None,
    fallback: float = 0.0,
    weight: str | None = None,
) -> DataFrame:
    """Replace NULL and NaN by the column mean, for all ``cols`` with one extra pass.

    ``means`` (one row, as from :func:`column_means`) may come from another frame, such as the
    training rows. A column without a single value gets ``fallback``. The means travel as one
    scalar subquery, so nothing is collected and the plan stays lazy.
    """
    if means is None:
        means = column_means(df, cols, weight)
    row = means.select(F.struct(*cols)).scalar()
    return df.withColumns(
        {c: F.coalesce(known(c), row.getField(c), F.lit(float(fallback))) for c in cols}
    )
