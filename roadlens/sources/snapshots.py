"""Bronze: one folder per day under a base path, and in it one folder per feed.

Two layouts. *Cumulative*: each day's folder also holds the history before that day, so it is
read alone. *Delta*: each folder holds that day's feeds only, and "as of a day" is the folders up
to it; history is then written once instead of once per day.

A feed is a part of its day, named after the feed, so feeds of one day stand side by side and the same feed
again replaces itself. Which folder holds a part is said by the commit log of the base path: a reader sees
the parts of one version, and a feed with all histories it is added to appears at once. Folders of days
that were put there by others are read as they are, and become parts when a feed is added to them.
"""

from __future__ import annotations

import re
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import NoSnapshotDate, UnknownTable
from ..functions.calendar import parse_day
from ..operators.rows import merge_by_name
from ..schema import SITUATION_FORMAT
from .commits import GRACE, CommitLog
from .storage import Folder

FEED, HISTORY, WHOLE = "feed-", "history", "whole"

_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")


def latest_situation_date(
    df: DataFrame, col: str = "situation_date", fmt: str = SITUATION_FORMAT
) -> DataFrame:
    """One row with the latest day as a date. Compared as days: as text, 31-01 beats 01-02."""
    return df.agg(F.max(parse_day(F.col(col), fmt)).alias("latest_date"))


def snapshot_date(
    df: DataFrame, col: str = "situation_date", fmt: str = SITUATION_FORMAT
) -> date:
    latest = latest_situation_date(df, col, fmt).first()["latest_date"]
    if latest is None:
        raise NoSnapshotDate(f"no parsable day in {col}")
    return latest


def _known(spark: SparkSession, base: str) -> dict[str, str]:
    """Folders by the names of their parts, ``day/part``: those of the log, and days it does not know."""
    _, parts = CommitLog(spark, base).current()
    return parts | _foreign(spark, base, parts)


def _foreign(spark: SparkSession, base: str, parts: dict[str, str]) -> dict[str, str]:
    """Parts of days that lie there as folders and that ``parts`` has nothing of."""
    out, days = {}, {name[:10] for name in parts}
    for day in Folder(spark, base).names():
        if _DAY.fullmatch(day) and day not in days:
            path = f"{base.rstrip('/')}/{day}"
            names = [n for n in Folder(spark, path).names() if n == HISTORY or n.startswith(FEED)]
            out |= {f"{day}/{n}": f"{path}/{n}" for n in names} or {f"{day}/{WHOLE}": path}
    return out


def snapshot_days(spark: SparkSession, base: str) -> list[date]:
    """Days that have a snapshot, oldest first."""
    return _days(_known(spark, base))


def _days(parts: dict[str, str]) -> list[date]:
    return sorted({date.fromisoformat(name[:10]) for name in parts})


def snapshot_path(base: str, day: date) -> str:
    return f"{base.rstrip('/')}/{day.isoformat()}"


def read_snapshot(spark: SparkSession, base: str, day: date | None = None) -> DataFrame:
    """The snapshot of ``day``, or the newest one."""
    parts = _known(spark, base)
    days = _days(parts)
    if not days or (day is not None and day not in days):
        raise UnknownTable(snapshot_path(base, day) if day else base)
    return _read_day(spark, parts, day or days[-1])


def _read_day(spark: SparkSession, parts: dict[str, str], day: date) -> DataFrame:
    return reduce(merge_by_name, [spark.read.parquet(path) for path in _paths(parts, day)])


def _paths(parts: dict[str, str], day: date) -> list[str]:
    """The folders that make up a day: its history and feeds."""
    return [parts[name] for name in sorted(parts) if name[:10] == day.isoformat()]


def read_as_of(
    spark: SparkSession,
    base: str,
    day: date | None = None,
    schema: str | None = None,
    since: date | None = None,
    version: int | None = None,
) -> DataFrame:
    """Delta layout: all days up to ``day``, or from ``since`` to it (both included), as one version
    of the log has them; a column a folder lacks is NULL there.

    Hand in the ``schema`` where it is known, as for records: without it the footers of all
    files are read to find the columns of all folders. ``version`` reads an earlier version, as long as it is kept.
    """
    parts = _known(spark, base) if version is None else CommitLog(spark, base).at(version)
    days = [d for d in _days(parts) if (day is None or d <= day) and (since is None or d >= since)]
    if not days:
        raise UnknownTable(base)
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    return reader.parquet(*[path for d in days for path in _paths(parts, d)])


def previous_snapshot(
    spark: SparkSession, base: str, day: date, lookback: str = "latest_before"
) -> DataFrame | None:
    """The history a feed of ``day`` builds on, or None if there is none yet.

    ``latest_before``: the newest folder before ``day``, so a day without a feed loses nothing.
    ``previous_day``: only the day just before. A folder that exists and cannot be read is an
    error in both, never an empty history.
    """
    return _previous(spark, _known(spark, base), day, lookback)


def _previous(spark: SparkSession, parts: dict[str, str], day: date, lookback: str) -> DataFrame | None:
    if lookback == "latest_before":
        earlier = [d for d in _days(parts) if d < day]
    elif lookback == "previous_day":
        earlier = [d for d in _days(parts) if d == day - timedelta(days=1)]
    else:
        raise ValueError(f"lookback must be latest_before or previous_day, not {lookback}")
    return _read_day(spark, parts, earlier[-1]) if earlier else None


def write_snapshot(df: DataFrame, base: str, day: date) -> str:
    """Make ``df`` the whole snapshot of ``day``; readers see the old one until the new one is complete."""
    log = CommitLog(df.sparkSession, base)
    staged = log.stage(df)

    def replace(parts: dict[str, str]) -> dict[str, str]:
        others = {name: path for name, path in parts.items() if name[:10] != day.isoformat()}
        return others | {f"{day.isoformat()}/{WHOLE}": staged}

    log.commit(replace)
    return snapshot_path(base, day)


def feed_id(df: DataFrame) -> str:
    """A name that follows from the rows of a feed, in whatever order."""
    # a hash leaves out NULLs, so they are marked
    row = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in df.columns])
    # sums of halves: a repeated row must not cancel out
    halves = F.sum(F.shiftrightunsigned(row, 32)), F.sum(row.bitwiseAND(F.lit(0xFFFFFFFF)))
    n, high, low = df.agg(F.count("*"), *halves).first()
    return f"{n:x}-{(high or 0) & (1 << 63) - 1:x}-{(low or 0) & (1 << 63) - 1:x}"


def _staged_feed(log: CommitLog, new: DataFrame, day: date | None, feed: str | None, col: str, fmt: str):
    """The day of a feed, the name of its part and the folder it was written to."""
    staged = log.stage(new)
    written = log.spark.read.schema(new.schema).parquet(staged)
    day = day or snapshot_date(written, col, fmt)
    name = re.sub(r"[^0-9A-Za-z._-]", "_", feed) if feed else feed_id(written)
    return day, f"{day.isoformat()}/{FEED}{name}", staged


def append_snapshot(
    new: DataFrame,
    base: str,
    col: str = "situation_date",
    lookback: str = "latest_before",
    day: date | None = None,
    feed: str | None = None,
    fmt: str = SITUATION_FORMAT,
) -> str:
    """Cumulative layout: history so far plus ``new``, filed under ``day`` or, without it, the
    latest day in ``new`` (found by reading that column of the staged feed).

    History is what lies before that day, so running a day again gives the same snapshot. A feed
    that comes late is also added to the history of every later day, in the same version. ``feed`` names the feed;
    without it its rows do, so a second feed of a day never replaces the first.
    """
    spark, log = new.sparkSession, CommitLog(new.sparkSession, base)
    day, name, staged = _staged_feed(log, new, day, feed, col, fmt)

    def file(parts: dict[str, str]) -> dict[str, str]:
        parts |= _foreign(spark, base, parts)
        parts[name] = staged
        for later in [d for d in _days(parts) if d >= day]:
            history = _previous(spark, parts, later, lookback)
            kept = f"{later.isoformat()}/{HISTORY}"
            parts.pop(kept, None)
            if history is not None:
                parts[kept] = log.stage(history)
        return parts

    log.commit(file)
    return snapshot_path(base, day)


def append_delta(
    new: DataFrame,
    base: str,
    col: str = "situation_date",
    fmt: str = SITUATION_FORMAT,
    feed: str | None = None,
) -> str:
    """Delta layout: ``new`` alone, filed under its latest day and its name (see :func:`append_snapshot`).

    Day and name are looked up in the staged folder, so that the feed itself is read once.
    """
    log = CommitLog(new.sparkSession, base)
    day, name, staged = _staged_feed(log, new, None, feed, col, fmt)
    log.commit(lambda parts: parts | _foreign(log.spark, base, parts) | {name: staged})
    return snapshot_path(base, day)


def sweep(spark: SparkSession, base: str, keep: int = 10, grace: float = GRACE) -> int:
    """Remove old versions and what only they name: see :meth:`~roadlens.sources.commits.CommitLog.sweep`."""
    return CommitLog(spark, base).sweep(keep, grace)
