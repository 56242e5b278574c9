"""The marts kept by change: what each day of silver adds to them, and the marts as sums over days.

Where every id is held once, as in silver written de-duplicated, a record counts in one day only, so all
counts and sums of the marts are sums over days. A state is a row for each day, mart and group. When days
of silver are formed anew, their states replace those before, which takes back what their records gave and adds
what they give now, also for a record that went to another day. Silver itself is read for those days only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import with_calendar
from ..operators.aggregate import share_of_total
from ..operators.joins import join_on_id
from ..operators.rows import not_null, top_k
from ..schema import ROAD_FLAGS
from .marts import HOTSPOTS, banded, with_condition

DAY = "situation_date"
TOTAL = "total_accidents"


def _rows(df: DataFrame, mart: str, keys: list[str], n: Column, first: str | None = None, second: str | None = None):
    """Group keys as text, the count, and number and sum of up to two measures."""
    out = [n.alias("n")]
    for place, col in ((1, first), (2, second)):
        value = F.col(col).cast("double") if col else F.lit(None).cast("double")
        out += [F.count(value).alias(f"n{place}"), F.sum(value).alias(f"s{place}")]
    names = [F.col(k).cast("string").alias(f"k{place}") for place, k in enumerate(keys, 1)]
    names += [F.lit(None).cast("string").alias("k2")] * (2 - len(keys))
    return df.groupBy(DAY, *keys).agg(*out).select(DAY, F.lit(mart).alias("mart"), *names, "n", "n1", "s1", "n2", "s2")


def day_states(accidents: DataFrame, weather: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """``(situation_date, mart, k1, k2, n, n1, s1, n2, s2, year, month, day)`` of silver halves that hold each id once.

    Hand in whole days. The halves of a record lie under the same day, so they are joined on day and id; unsplit
    ``records``, where given, stand for that join.
    """
    ids = F.count("id")
    timed = not_null(accidents, ["start_time"])
    hours = timed.select(DAY, "id", F.hour("start_time").alias("hour"), F.dayofweek("start_time").alias("weekday"))
    by_day = accidents.select(DAY, "id", F.to_date("start_time").alias("at"))
    flags = accidents.groupBy(DAY).agg(
        ids.alias(TOTAL), *[F.count_if(F.coalesce(F.col(c), F.lit(False))).alias(out) for c, out in ROAD_FLAGS.items()]
    )
    flags = flags.unpivot(DAY, [TOTAL, *ROAD_FLAGS.values()], "flag", "times")
    if records is None:
        both = join_on_id(accidents.select(DAY, "id", "severity"), weather, [DAY, "id"])
    else:
        both = not_null(records, ["id"])
    rows = F.count(F.lit(1))
    parts = [
        _rows(by_day, "top_accidents_by_day", ["at"], ids),
        _rows(not_null(accidents, ["severity"]), "accidents_by_severity", ["severity"], ids),
        _rows(not_null(accidents, ["state", "city"]), "accidents_by_location", ["state", "city"], ids),
        _rows(hours, "accidents_time_patterns", ["hour", "weekday"], ids),
        _rows(flags, "road_infrastructure_summary", ["flag"], F.sum("times")),
        _rows(with_condition(both), "accidents_by_weather", ["Weather_Condition"], rows, "severity"),
        _rows(
            banded(both, DAY, "severity", "wind_speed_mph"), "weather_impact_analysis",
            ["temperature_range", "visibility_condition"], rows, "severity", "wind_speed_mph",
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return with_calendar(out, DAY, fmt=None)


def marts_of(states: DataFrame) -> dict[str, DataFrame]:
    """The seven marts by their served names: columns, types, order and values of ``build_marts``."""

    def summed(mart: str, *keys: tuple[str, str, str]) -> DataFrame:
        """Sums by the keys, given as (column of the states, type, name)."""
        named = [F.col(k).cast(kind).alias(name) for k, kind, name in keys]
        own = states.where(F.col("mart") == mart).groupBy(*named)
        return own.agg(F.sum("n").alias("accident_count"), *[F.sum(c).alias(c) for c in ("n1", "s1", "n2", "s2")])

    def mean(place: int, name: str) -> Column:
        return F.try_divide(F.col(f"s{place}"), F.col(f"n{place}")).alias(name)

    measures = ["n1", "s1", "n2", "s2"]
    day = summed("top_accidents_by_day", ("k1", "date", "accident_date")).drop(*measures)
    severity = summed("accidents_by_severity", ("k1", "int", "Severity")).drop(*measures)
    place = summed("accidents_by_location", ("k1", "string", "State"), ("k2", "string", "City")).drop(*measures)
    time = summed("accidents_time_patterns", ("k1", "int", "hour_of_day"), ("k2", "int", "day_of_week")).drop(*measures)
    condition = summed("accidents_by_weather", ("k1", "string", "Weather_Condition"))
    bands = ("k1", "string", "temperature_range"), ("k2", "string", "visibility_condition")
    impact = summed("weather_impact_analysis", *bands)
    flag = states.where(F.col("mart") == "road_infrastructure_summary")
    flags = [
        F.coalesce(F.sum(F.when(F.col("k1") == name, F.col("n"))), F.lit(0)).alias(name)
        for name in (*ROAD_FLAGS.values(), TOTAL)
    ]
    busiest = F.desc("accident_count")
    return {
        "top_accidents_by_day": day.orderBy(busiest, "accident_date"),
        "accidents_by_severity": share_of_total(severity, "accident_count").orderBy("Severity"),
        "accidents_by_location": top_k(place, "accident_count", ["State", "City"], HOTSPOTS),
        "accidents_by_weather": condition.select("Weather_Condition", "accident_count", mean(1, "avg_severity")).orderBy(
            busiest, "Weather_Condition"
        ),
        "accidents_time_patterns": time.orderBy("hour_of_day", "day_of_week"),
        "road_infrastructure_summary": flag.agg(*flags),
        "weather_impact_analysis": impact.select(
            "temperature_range", "visibility_condition", "accident_count",
            mean(1, "avg_severity"), mean(2, "avg_wind_speed"),
        ).orderBy(busiest, "temperature_range", "visibility_condition"),
    }
