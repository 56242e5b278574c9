"""Association between columns of two tables over their join, without building the join's rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import materialize

#: Different values in a range of the order that ranks are found by.
RANGE_VALUES = 1_000_000


def joined_pairs(
    left: DataFrame, right: DataFrame, on: str, left_col: str, right_cols: Sequence[str]
) -> DataFrame:
    """``(column_name, x, y, n)``: rows of the join with value ``x`` in a right column and ``y`` in ``left_col``.

    Each side is first one row for an id and value, counted map-side, so an id that repeats on both
    sides costs its different pairs of values and not its pairs of rows. Rows with a null on either side
    of a pair are left out. The right columns are taken as one type (text for categories, double for readings).
    """
    ours = left.where(F.col(on).isNotNull() & F.col(left_col).isNotNull())
    ours = ours.groupBy(F.col(on).alias("id"), F.col(left_col).alias("y")).agg(F.count(F.lit(1)).alias("ours"))
    values = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("x")) for c in right_cols]
    theirs = right.where(F.col(on).isNotNull()).select(F.col(on).alias("id"), F.inline(F.array(*values)))
    theirs = theirs.where("x IS NOT NULL").groupBy("id", "column_name", "x").agg(F.count(F.lit(1)).alias("theirs"))
    return ours.join(theirs, "id").groupBy("column_name", "x", "y").agg(F.sum(F.col("ours") * F.col("theirs")).alias("n"))


def contingency(pairs: DataFrame) -> DataFrame:
    """``pairs`` with ``x_total``, ``y_total``, ``total`` and the count ``expected`` if columns were independent."""
    pairs = materialize(pairs, "pairs")

    def total(*keys: str, name: str) -> DataFrame:
        return pairs.groupBy("column_name", *keys).agg(F.sum("n").alias(name))

    joined = pairs.join(total("x", name="x_total"), ["column_name", "x"])
    joined = joined.join(total("y", name="y_total"), ["column_name", "y"]).join(total(name="total"), "column_name")
    expected = F.col("x_total").cast("double") * F.col("y_total") / F.col("total")
    return joined.select("column_name", "x", "y", "n", "x_total", "y_total", "total", expected.alias("expected"))


def chi_square(table: DataFrame) -> DataFrame:
    """``(column_name, rows, x_kinds, y_kinds, degrees, chi_square, cramers_v)`` of each column of a contingency table.

    Cells without a row count as well: the sum of n²/expected leaves them out without loss.
    Cramér's V is null where a side has one kind only.
    """
    sums = table.groupBy("column_name").agg(
        F.max("total").alias("rows"),
        F.countDistinct("x").alias("x_kinds"),
        F.countDistinct("y").alias("y_kinds"),
        F.sum(F.col("n").cast("double") * F.col("n") / F.col("expected")).alias("squares"),
    )
    chi = F.greatest(F.col("squares") - F.col("rows"), F.lit(0.0))
    fewer = F.least("x_kinds", "y_kinds") - 1
    return sums.select(
        "column_name",
        "rows",
        "x_kinds",
        "y_kinds",
        ((F.col("x_kinds") - 1) * (F.col("y_kinds") - 1)).alias("degrees"),
        chi.alias("chi_square"),
        F.sqrt(F.try_divide(chi, F.col("rows") * fewer)).alias("cramers_v"),
    )


def average_ranks(counts: DataFrame, by: Sequence[str], value: str, n: str) -> DataFrame:
    """``counts`` with ``rank``: the mean place of the rows of a value among all rows of its ``by``, from 1.

    ``counts`` has one row of each different value. Values are spread by range and written; the row
    totals of the ranges, one number for a range and ``by``, tell what lies before each, and a running
    sum inside a range does the rest, so no task holds the order of a whole column.
    """
    ranges = max(
        int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), counts.count() // RANGE_VALUES + 1
    )
    placed = counts.repartitionByRange(ranges, *by, value).withColumn("part", F.spark_partition_id())
    placed = materialize(placed, "ranks")
    totals = placed.groupBy(*by, "part").agg(F.sum(n).alias("in_part"))
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*by, "part", F.coalesce(F.sum("in_part").over(earlier), F.lit(0)).alias("before"))
    upto = F.sum(n).over(Window.partitionBy(*by, "part").orderBy(value))
    rank = F.col("before") + upto - (F.col(n) - 1) / F.lit(2.0)
    return placed.join(before, [*by, "part"]).withColumn("rank", rank).drop("part", "before")


def rank_correlation(pairs: DataFrame) -> DataFrame:
    """``(column_name, rows, correlation)``: Spearman's correlation of x and y, ties at their average rank.

    It is the Pearson correlation of the ranks, centred on their mean, which is known. Null where a side has one
    value only.
    """
    pairs = materialize(pairs, "pairs")

    def ranked(col: str) -> DataFrame:
        counts = pairs.groupBy("column_name", col).agg(F.sum("n").alias("rows"))
        ranks = average_ranks(counts, ["column_name"], col, "rows")
        return ranks.select("column_name", col, F.col("rank").alias(f"{col}_rank"))

    total = pairs.groupBy("column_name").agg(F.sum("n").alias("rows"))
    joined = reduce(
        lambda df, col: df.join(ranked(col), ["column_name", col]), ["x", "y"], pairs.join(total, "column_name")
    )
    middle = (F.col("rows") + 1) / F.lit(2.0)
    x, y, n = F.col("x_rank") - middle, F.col("y_rank") - middle, F.col("n")
    sums = joined.groupBy("column_name").agg(
        F.max("rows").alias("rows"), F.sum(n * x * y).alias("xy"), F.sum(n * x * x).alias("xx"), F.sum(n * y * y).alias("yy")
    )
    return sums.select(
        "column_name", "rows", F.try_divide(F.col("xy"), F.sqrt("xx") * F.sqrt("yy")).alias("correlation")
    )
