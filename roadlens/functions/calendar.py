"""Dates, hours and seasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import SITUATION_FORMAT

# Both rush windows, hours inclusive; Sunday is day 1 and Saturday day 7.
RUSH_HOURS = ((7, 9), (17, 19))
WEEKEND = (1, 7)

# Meteorological seasons of the northern hemisphere.
SEASONS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Autumn": (9, 10, 11),
}


def parse_day(col: str | Column, fmt: str = SITUATION_FORMAT) -> Column:
    """A day from text; NULL, not an error, when the text is no such day."""
    return F.try_to_date(col, fmt)


def with_calendar(df: DataFrame, col: str, fmt: str | None = SITUATION_FORMAT) -> DataFrame:
    """Add ``year, month, day`` of a text day (``fmt``) or of a date column (``fmt=None``)."""
    day = F.col(col) if fmt is None else parse_day(F.col(col), fmt)
    return df.withColumns({"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})


def rush_hour(hour: Column) -> Column:
    first, second = (hour.between(lo, hi) for lo, hi in RUSH_HOURS)
    return F.coalesce((first | second).cast("int"), F.lit(0))


def weekend(day_of_week: Column) -> Column:
    return F.coalesce(day_of_week.isin(*WEEKEND).cast("int"), F.lit(0))


def time_features(df: DataFrame, ts: str) -> DataFrame:
    """Hour, weekday and month of ``ts`` with the 0/1 rush-hour and weekend marks."""
    at = F.col(ts)
    return df.withColumns(
        {
            "hour": F.hour(at),
            "day_of_week": F.dayofweek(at),
            "month": F.month(at),
            "is_rush_hour": rush_hour(F.hour(at)),
            "is_weekend": weekend(F.dayofweek(at)),
        }
    )


def season(month: Column) -> Column:
    named = None
    for name, months in SEASONS.items():
        hit = month.isin(*months)
        named = F.when(hit, name) if named is None else named.when(hit, name)
    return named
