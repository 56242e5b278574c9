"""Joins on the record id, and aggregates over such joins that build no row pairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_on_id(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Inner equi-join; a NULL id matches nothing.

    Which side is broadcast, if any, is left to the statistics Spark has at run time. Where ids
    repeat on both sides this multiplies rows, as a join does: for aggregates over the join use
    :func:`joined_aggregates`, for its rows :func:`join_counted`.
    """
    return left.join(right, on, "inner")


def collapse(df: DataFrame, copies: str = "copies") -> DataFrame:
    """Equal rows as one row with their number; combined map-side before the exchange."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).cast("double").alias(copies))


def join_counted(left: DataFrame, right: DataFrame, on: str, copies: str = "copies") -> DataFrame:
    """The rows of the inner join, each different row once, with how often it occurs.

    Repeated deliveries of a record (n copies left, m right) come out as one row that stands for
    n*m rows, so their number never multiplies. What still pairs up are *different* versions of
    a record under one id; Spark splits such an id at run time, since both inputs of this join
    come straight out of an exchange.
    """
    both = collapse(left, "_left").join(collapse(right, "_right"), on, "inner")
    return both.withColumn(copies, F.col("_left") * F.col("_right")).drop("_left", "_right")


def _moments(cols: Mapping[str, str], side: str) -> list[Column]:
    """Number and sum of the values of each column."""
    out = []
    for name, col in cols.items():
        value = F.col(col).cast("double")
        out += [F.count(value).alias(f"{side}n_{name}"), F.sum(value).alias(f"{side}s_{name}")]
    return out


def _row_moments(cols: Mapping[str, str], side: str) -> list[Column]:
    """The same for a single row."""
    out = []
    for name, col in cols.items():
        value = F.col(col).cast("double")
        out += [value.isNotNull().cast("bigint").alias(f"{side}n_{name}"), value.alias(f"{side}s_{name}")]
    return out


def _joined_mean(name: str, side: str, other_rows: str) -> Column:
    times = F.col(other_rows).cast("double")
    return F.try_divide(
        F.sum(F.col(f"{side}s_{name}") * times), F.sum(F.col(f"{side}n_{name}") * times)
    ).alias(name)


def joined_aggregates(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str] = (),
    count: str | None = "accident_count",
    left_means: Mapping[str, str] | None = None,
    right_means: Mapping[str, str] | None = None,
    repeats: str = "any",
) -> DataFrame:
    """Distinct ids and means over ``left JOIN right ON on GROUP BY by``, ``by`` on the right.

    An id with m rows left and n rows right has m*n rows in the join, and one hot id would make
    that explode. But every joined row repeats its left values n times and its right values m
    times, so sums over the join follow from per-id counts and sums. The left side is reduced to
    one row per id, with map-side combine, so the join never has more rows than the right side.

    ``repeats`` says how often an id may occur on one side. ``any``: the right side is reduced to
    one row per id and group as well, so that an id holding a large part of it arrives as a few
    rows; counting what is left then counts ids. It takes one more exchange of the right side.
    ``few``: the right rows go straight to the join. ``none``: so do the left rows, since every
    id occurs once on each side. ``quality_report`` tells which holds.
    """
    if repeats not in ("any", "few", "none"):
        raise ValueError(f"repeats must be any, few or none, not {repeats}")
    left_means, right_means = left_means or {}, right_means or {}
    left, right = left.where(F.col(on).isNotNull()), right.where(F.col(on).isNotNull())
    if repeats == "none":
        l_side = left.select(on, F.lit(1).alias("l_rows"), *_row_moments(left_means, "l"))
    else:
        l_side = left.groupBy(on).agg(F.count(F.lit(1)).alias("l_rows"), *_moments(left_means, "l"))
    if repeats == "any":
        r_side = right.groupBy(on, *by).agg(
            F.count(F.lit(1)).alias("r_rows"), *_moments(right_means, "r")
        )
    else:
        r_side = right.select(on, *by, F.lit(1).alias("r_rows"), *_row_moments(right_means, "r"))
    ids = F.countDistinct(on) if repeats == "few" else F.count(F.lit(1))
    out = [ids.alias(count)] if count else []
    out += [_joined_mean(name, "l", "r_rows") for name in left_means]
    out += [_joined_mean(name, "r", "l_rows") for name in right_means]
    return l_side.join(r_side, on, "inner").groupBy(*by).agg(*out)


def joined_correlations(
    left: DataFrame, right: DataFrame, on: str, left_col: str, right_cols: Sequence[str]
) -> DataFrame:
    """Pearson correlation of ``left_col`` with each of ``right_cols`` over the join, as
    ``(column_name, correlation)``, again without building the join's rows.

    Values are centred on their plain means first, which leaves the correlation as it is and
    keeps the sums of squares from cancelling.
    """
    middle = left.agg(F.avg(left_col)).scalar()
    middles = right.agg(F.struct(*[F.avg(c).alias(c) for c in right_cols])).scalar()
    y = F.col(left_col)
    l_side = (
        left.where(F.col(on).isNotNull())
        .select(on, (F.col(left_col).cast("double") - middle).alias(left_col))
        .groupBy(on)
        .agg(F.count(y).alias("yn"), F.sum(y).alias("ys"), F.sum(y * y).alias("yy"))
    )
    sums = []
    for c in right_cols:
        x = F.col(c)
        sums += [
            F.count(x).alias(f"{c}_n"), F.sum(x).alias(f"{c}_s"), F.sum(x * x).alias(f"{c}_q"),
        ]
    centred = [(F.col(c).cast("double") - middles.getField(c)).alias(c) for c in right_cols]
    r_side = right.where(F.col(on).isNotNull()).select(on, *centred).groupBy(on).agg(*sums)
    totals = []
    for c in right_cols:
        n, s, q = (F.col(f"{c}_{k}").cast("double") for k in "nsq")
        totals.append(
            F.struct(
                F.sum(n * F.col("yn")).alias("n"),
                F.sum(s * F.col("yn")).alias("x"),
                F.sum(q * F.col("yn")).alias("xx"),
                F.sum(n * F.col("ys")).alias("y"),
                F.sum(n * F.col("yy")).alias("yy"),
                F.sum(s * F.col("ys")).alias("xy"),
            ).alias(c)
        )
    wide = l_side.join(r_side, on, "inner").agg(*totals)
    return wide.unpivot([], list(right_cols), "column_name", "t").select(
        "column_name",
        F.try_divide(
            F.col("t.n") * F.col("t.xy") - F.col("t.x") * F.col("t.y"),
            F.sqrt(F.col("t.n") * F.col("t.xx") - F.col("t.x") * F.col("t.x"))
            * F.sqrt(F.col("t.n") * F.col("t.yy") - F.col("t.y") * F.col("t.y")),
        ).alias("correlation"),
    )
