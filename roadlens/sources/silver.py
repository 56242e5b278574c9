"""Silver: the split halves as tables partitioned by calendar day."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import with_calendar
from ..operators.rows import latest_per_key, split_vertical
from ..schema import PARTITION_COLUMNS, SILVER_GROUPS, to_silver
from .storage import materialize
from .tables import replace_table, table_name

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def split_rejects(silver: DataFrame, col: str = "situation_date") -> tuple[DataFrame, DataFrame]:
    """Rows that can be filed under a day, and rows that cannot (no day or no such day)."""
    return silver.where(F.col(col).isNotNull()), silver.where(F.col(col).isNull())


def silver_tables(bronze: DataFrame, dedupe: bool = False, wide: bool = False) -> dict[str, DataFrame]:
    """Bronze records as the ``accidents`` and ``weather`` tables with their partition columns,
    and the ``rejects`` that have no usable day.

    ``dedupe`` keeps the newest record per id, compared as silver, where a day is a date and
    not a text. Whole records travel for that, so it is done once, in a written table from which
    the three are cut. ``wide`` adds the unsplit ``records``, which spare readers the join.
    """
    records = to_silver(bronze)
    if dedupe:
        records = materialize(latest_per_key(records, ["id"], ["situation_date"]), "records")
    good, rejects = split_rejects(records)
    halves = split_vertical(good, SILVER_GROUPS) | ({"records": good} if wide else {})
    tables = {name: with_calendar(df, "situation_date", fmt=None) for name, df in halves.items()}
    return tables | {"rejects": rejects}


def write_silver(
    df: DataFrame, table: str, path: str | None = None, mode: str = "overwrite"
) -> None:
    """Write a table partitioned by ``year, month, day``.

    The rebalance hint brings each day's rows together, so a day is a few files rather than one
    per task, and at run time splits a day that is too large for one task.

    ``overwrite`` replaces the table once all is written. ``overwrite_days`` replaces only the days found in ``df``
    and leaves the other partitions alone, which is what a daily run needs.
    """
    spark = df.sparkSession
    rebalanced = df.hint("rebalance", *PARTITION_COLUMNS)
    if mode == "overwrite_days" and spark.catalog.tableExists(table):
        # A table insert heeds this setting of the session only, so it goes through one of its own.
        own = spark.newSession()
        own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
        own.conf.set(_OVERWRITE_MODE, "dynamic")
        view = f"days_{uuid.uuid4().hex}"
        rebalanced.select(*spark.table(table).columns).createGlobalTempView(view)
        try:
            own.table(f"global_temp.{view}").write.insertInto(table, overwrite=True)
        finally:
            spark.catalog.dropGlobalTempView(view)
        # this session may remember the files of the old days
        spark.catalog.refreshTable(table)
        return
    if mode not in ("overwrite", "overwrite_days"):
        raise ValueError(f"mode must be overwrite or overwrite_days, not {mode}")
    replace_table(rebalanced, table, path, PARTITION_COLUMNS)


def replace_days(df: DataFrame, table: str, days: Sequence[date]) -> None:
    """Replace ``days`` of a table by the rows of ``df``; a day without a row there is emptied."""
    spark = df.sparkSession
    kept = {row[0] for row in df.select("situation_date").distinct().collect()}
    if kept:
        write_silver(df, table, mode="overwrite_days")
    nothing = spark.createDataFrame([], spark.table(table).drop(*PARTITION_COLUMNS).schema)
    for day in sorted(set(days) - kept):
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (year = {day.year}, month = {day.month}, day = {day.day}) "
            "SELECT * FROM {nothing}",
            nothing=nothing,
        )


def read_silver(
    spark: SparkSession,
    table: str,
    since: date | None = None,
    until: date | None = None,
    days: Sequence[date] | None = None,
) -> DataFrame:
    """A silver table, or the days from ``since`` to ``until`` of it (both included), or only ``days``.

    The bounds speak of partition columns only, so other days are never opened.
    """
    df = spark.table(table_name(spark, table))
    day = F.make_date("year", "month", "day")
    if since is not None:
        df = df.where((F.col("year") >= since.year) & (day >= F.lit(since)))
    if until is not None:
        df = df.where((F.col("year") <= until.year) & (day <= F.lit(until)))
    if days is not None:
        df = df.where(F.col("year").isin(sorted({d.year for d in days})) & day.isin(sorted(set(days))))
    return df
