"""Distinct incidents per day over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .ingest import read_store, stream_ingest

KEYS = ["accident_date", "id"]


def _timed(stream: DataFrame, id_col: str, ts: str) -> DataFrame:
    return stream.where(F.col(ts).isNotNull()).select(F.col(id_col).alias("id"), F.col(ts).alias("at"))


def stream_daily_counts(
    stream: DataFrame, store: str, checkpoint: str, id_col: str = "id", ts: str = "start_time",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the (day, id) pairs seen so far in ``store``; :func:`daily_counts` counts them.

    Exact however late a record comes, like the batch mart (but for its group without a time).
    """
    pairs = _timed(stream, id_col, ts).select(F.to_date("at").alias("accident_date"), "id")
    return stream_ingest(pairs, KEYS, [], store, checkpoint, trigger)


def daily_counts(spark, store: str) -> DataFrame:
    """Distinct ids per day from the store."""
    pairs = read_store(spark, store, "accident_date date, id string", KEYS)
    return pairs.groupBy("accident_date").agg(F.count("id").alias("accident_count"))


def daily_counts_closed(
    stream: DataFrame, late: str = "1 day", id_col: str = "id", ts: str = "start_time"
) -> DataFrame:
    """For a stream that runs for good: a day is emitted once no record of it can come any more.

    Two aggregates in a row, first per day and id, then per day. Both combine map-side, so the
    copies of a hot id leave each task as one row, which a streaming de-duplication would not do.
    State is bounded by ``late``; records later than that are dropped, which is the price of
    closing a day. Write it in append mode. Windows start at midnight UTC, so times without a
    zone are taken as UTC there, whatever the session's zone, and turned back at the end.
    """
    zone = F.current_timezone()
    instant = F.from_utc_timestamp(F.col("at").cast("timestamp"), zone)
    timed = _timed(stream, id_col, ts).withColumn("at", instant)
    ids = timed.withWatermark("at", late).groupBy(F.window("at", "1 day"), "id").agg(
        F.count(F.lit(1)).alias("copies")
    )
    days = ids.groupBy(F.window(F.window_time("window"), "1 day").alias("day")).agg(
        F.count("id").alias("accident_count")
    )
    start = F.to_utc_timestamp("day.start", zone)
    return days.select(F.to_date(start).alias("accident_date"), "accident_count")
