"""The marts: thin compositions of the operators over the silver halves.

Every mart takes silver frames (snake-case columns) and returns the served columns. ``how`` is
passed to the distinct count: ``unique_ids=True`` where no id repeats, ``approx=True`` for
sketches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import TEMPERATURE, VISIBILITY, band
from ..functions.calendar import season
from ..operators.aggregate import distinct_count, distinct_count_by, flag_summary, share_of_total
from ..operators.association import chi_square, contingency, joined_pairs, rank_correlation
from ..operators.joins import joined_aggregates, joined_correlations
from ..operators.rows import latest_per_key, not_null, top_k
from ..schema import ROAD_FLAGS
from ..sources.served import write_mart

HOTSPOTS = 50
CORRELATED = ["temperature_f", "humidity_pct", "visibility_mi", "wind_speed_mph", "precipitation_in"]


def mart_daily(accidents: DataFrame, **how) -> DataFrame:
    """Incidents per day, busiest first; incidents without a start time are a group of their own."""
    day = F.to_date("start_time").alias("accident_date")
    counts = distinct_count_by(accidents, [day], "id", **how)
    return counts.orderBy(F.desc("accident_count"), "accident_date")


def mart_severity(accidents: DataFrame, **how) -> DataFrame:
    """Incidents per severity with their share of the sum of these counts."""
    level = F.col("severity").alias("Severity")
    counts = distinct_count_by(not_null(accidents, ["severity"]), [level], "id", **how)
    return share_of_total(counts, "accident_count").orderBy("Severity")


def mart_location(accidents: DataFrame, n: int = HOTSPOTS, **how) -> DataFrame:
    """The ``n`` cities with most incidents."""
    keys = [F.col("state").alias("State"), F.col("city").alias("City")]
    counts = distinct_count_by(not_null(accidents, ["state", "city"]), keys, "id", **how)
    return top_k(counts, "accident_count", ["State", "City"], n)


def mart_time_patterns(accidents: DataFrame, **how) -> DataFrame:
    """Incidents per hour of day and day of week (Sunday is 1); empty cells are absent."""
    keys = [
        F.hour("start_time").alias("hour_of_day"),
        F.dayofweek("start_time").alias("day_of_week"),
    ]
    counts = distinct_count_by(not_null(accidents, ["start_time"]), keys, "id", **how)
    return counts.orderBy("hour_of_day", "day_of_week")


def mart_infrastructure(accidents: DataFrame, **how) -> DataFrame:
    """One row: records near each road feature (rows), and incidents in all (distinct ids)."""
    return flag_summary(accidents, ROAD_FLAGS, "id", **how)


def _newest(df: DataFrame, cols: list[str]) -> DataFrame:
    """The newest record per id, narrowed to what the mart needs before it is compared."""
    return latest_per_key(df.select("id", "situation_date", *cols), ["id"], ["situation_date"])


def with_condition(weather: DataFrame) -> DataFrame:
    """Rows with a weather condition, under its served name."""
    return not_null(weather, ["weather_condition"]).withColumnRenamed("weather_condition", "Weather_Condition")


def banded(weather: DataFrame, *cols: str) -> DataFrame:
    """Rows with both readings, as bands beside ``cols``."""
    return not_null(weather, ["temperature_f", "visibility_mi"]).select(
        *cols,
        band(F.col("temperature_f"), TEMPERATURE).alias("temperature_range"),
        band(F.col("visibility_mi"), VISIBILITY).alias("visibility_condition"),
    )


def mart_weather_condition(
    accidents: DataFrame, weather: DataFrame, dedupe: bool = False, repeats: str = "any"
) -> DataFrame:
    """Incidents and mean severity per weather condition.

    Means are over the rows of the join on ``id``, so an id delivered twice on both sides weighs
    four times. ``dedupe`` keeps the newest record per id first. ``repeats`` as in
    ``joined_aggregates``.
    """
    if dedupe:
        accidents = _newest(accidents, ["severity"])
        weather = _newest(weather, ["weather_condition"])
        repeats = "none"
    known = with_condition(weather)
    out = joined_aggregates(
        accidents,
        known,
        "id",
        by=["Weather_Condition"],
        left_means={"avg_severity": "severity"},
        repeats=repeats,
    )
    return out.orderBy(F.desc("accident_count"), "Weather_Condition")


def mart_weather_impact(
    accidents: DataFrame, weather: DataFrame, dedupe: bool = False, repeats: str = "any"
) -> DataFrame:
    """Incidents, mean severity and mean wind per temperature and visibility band."""
    if dedupe:
        accidents = _newest(accidents, ["severity"])
        weather = _newest(weather, ["temperature_f", "visibility_mi", "wind_speed_mph"])
        repeats = "none"
    out = joined_aggregates(
        accidents,
        banded(weather, "id", "wind_speed_mph"),
        "id",
        by=["temperature_range", "visibility_condition"],
        left_means={"avg_severity": "severity"},
        right_means={"avg_wind_speed": "wind_speed_mph"},
        repeats=repeats,
    )
    return out.orderBy(F.desc("accident_count"), "temperature_range", "visibility_condition")


def wide_weather_condition(records: DataFrame) -> DataFrame:
    """:func:`mart_weather_condition` over unsplit records that hold each id once: no join."""
    known = with_condition(not_null(records, ["id"]))
    out = known.groupBy("Weather_Condition").agg(
        F.count(F.lit(1)).alias("accident_count"), F.avg("severity").alias("avg_severity")
    )
    return out.orderBy(F.desc("accident_count"), "Weather_Condition")


def wide_weather_impact(records: DataFrame) -> DataFrame:
    """:func:`mart_weather_impact` over unsplit records that hold each id once: no join."""
    known = banded(not_null(records, ["id"]), "severity", "wind_speed_mph")
    out = known.groupBy("temperature_range", "visibility_condition").agg(
        F.count(F.lit(1)).alias("accident_count"),
        F.avg("severity").alias("avg_severity"),
        F.avg("wind_speed_mph").alias("avg_wind_speed"),
    )
    return out.orderBy(F.desc("accident_count"), "temperature_range", "visibility_condition")


def seasonal_counts(accidents: DataFrame, **how) -> DataFrame:
    named = season(F.month("start_time")).alias("season")
    counts = distinct_count_by(not_null(accidents, ["start_time"]), [named], "id", **how)
    return counts.orderBy("season")


def weather_severity_corr(accidents: DataFrame, weather: DataFrame) -> DataFrame:
    """Correlation of severity with each weather reading over the join on ``id``."""
    return joined_correlations(accidents, weather, "id", "severity", CORRELATED)


#: Categories of the weather half that are held against severity.
CONDITIONS = ["weather_condition", "wind_direction"]


def condition_association(accidents: DataFrame, weather: DataFrame) -> DataFrame:
    """Chi-square and Cramér's V of severity with each weather category over the join on ``id``."""
    return chi_square(contingency(joined_pairs(accidents, weather, "id", "severity", CONDITIONS)))


def condition_severity_table(accidents: DataFrame, weather: DataFrame) -> DataFrame:
    """Records of each weather category and severity beside the number that independence would give."""
    table = contingency(joined_pairs(accidents, weather, "id", "severity", CONDITIONS))
    return table.select("column_name", F.col("x").alias("value"), F.col("y").alias("severity"), "n", "expected")


def weather_rank_corr(accidents: DataFrame, weather: DataFrame) -> DataFrame:
    """Rank correlation of severity with each weather reading over the join on ``id``."""
    readings = weather.select("id", *[F.col(c).cast("double").alias(c) for c in CORRELATED])
    return rank_correlation(joined_pairs(accidents, readings, "id", "severity", CORRELATED))


def marts_one_pass(accidents: DataFrame) -> DataFrame:
    """Daily, severity, location and time-pattern counts from a single scan.

    Grouping sets over (day), (severity), (state, city) and (hour, weekday) share one read and
    one job: worth it where reading is dear (a join, a wide text source); over pruned columnar
    tables the separate marts move less. Rows carry ``mart`` and only their mart's key columns.
    Rows the single marts leave out for a NULL key are left out here too.
    """
    keyed = accidents.select(
        "id",
        F.to_date("start_time").alias("accident_date"),
        F.col("severity").alias("Severity"),
        F.col("state").alias("State"),
        F.col("city").alias("City"),
        F.hour("start_time").alias("hour_of_day"),
        F.dayofweek("start_time").alias("day_of_week"),
    )
    day, severity, *rest = ["accident_date", "Severity", "State", "City", "hour_of_day", "day_of_week"]
    keys = [day, severity, *rest]
    sets = {
        "daily": [day],
        "severity": [severity],
        "location": rest[:2],
        "time_patterns": rest[2:],
    }
    counts = keyed.groupingSets(list(sets.values()), *keys).agg(
        F.grouping_id(*keys).alias("_set"), distinct_count("id").alias("accident_count")
    )
    # grouping_id has a bit per key, first key highest, set where the key is grouped away.
    name = F.lit(None).cast("string")
    whole = F.lit(True)
    for mart, own in sets.items():
        bits = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in own)
        name = F.when(F.col("_set") == bits, mart).otherwise(name)
        if mart != "daily":
            for k in own:
                whole = whole & ((F.col("_set") != bits) | F.col(k).isNotNull())
    return counts.where(whole).select(name.alias("mart"), *keys, "accident_count")


def build_marts(
    accidents: DataFrame, weather: DataFrame, unique_ids: bool = False, records: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Every served table by name: the seven marts and copies of both silver halves.

    ``unique_ids`` states that no id repeats, as in silver written de-duplicated: then no mart
    moves ids between executors to count them. Unsplit ``records`` of unique ids, where given,
    stand for the join of the halves.
    """
    repeats = "none" if unique_ids else "any"
    if records is None:
        condition = mart_weather_condition(accidents, weather, repeats=repeats)
        impact = mart_weather_impact(accidents, weather, repeats=repeats)
    else:
        condition, impact = wide_weather_condition(records), wide_weather_impact(records)
    # Names of the served tables.
    return {
        "top_accidents_by_day": mart_daily(accidents, unique_ids=unique_ids),
        "accidents_by_severity": mart_severity(accidents, unique_ids=unique_ids),
        "accidents_by_location": mart_location(accidents, unique_ids=unique_ids),
        "accidents_by_weather": condition,
        "accidents_time_patterns": mart_time_patterns(accidents, unique_ids=unique_ids),
        "road_infrastructure_summary": mart_infrastructure(accidents, unique_ids=unique_ids),
        "weather_impact_analysis": impact,
        "accidents": accidents,
        "weather": weather,
    }


def write_marts(
    accidents: DataFrame,
    weather: DataFrame,
    sink=write_mart,
    prefix: str = "",
    unique_ids: bool = False,
    records: DataFrame | None = None,
) -> list[str]:
    """Write all served tables through ``sink(df, name)`` and give their names. A prefix keeps
    the copies apart from silver tables of the same name."""
    tables = build_marts(accidents, weather, unique_ids, records)
    for name, df in tables.items():
        sink(df, prefix + name)
    return [prefix + name for name in tables]
