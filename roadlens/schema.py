"""Declared columns of an incident record.

A raw record has 47 columns. Bronze keeps the source names; silver renames them to snake
case. Types are declared once here, so that no part file can drift through inference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

SITUATION_FORMAT = "dd-MM-yyyy"

# Fixed values: (source name, silver name, bronze type) of the accident half, in table order.
ACCIDENT_COLUMNS = [
    ("ID", "id", "string"),
    ("situation_date", "situation_date", "string"),
    ("Source", "source", "string"),
    ("Severity", "severity", "int"),
    ("Start_Time", "start_time", "timestamp_ntz"),
    ("End_Time", "end_time", "timestamp_ntz"),
    ("Start_Lat", "start_lat", "double"),
    ("Start_Lng", "start_lng", "double"),
    ("End_Lat", "end_lat", "double"),
    ("End_Lng", "end_lng", "double"),
    ("Distance(mi)", "distance_mi", "double"),
    ("Description", "description", "string"),
    ("Street", "street", "string"),
    ("City", "city", "string"),
    ("County", "county", "string"),
    ("State", "state", "string"),
    ("Zipcode", "zipcode", "string"),
    ("Country", "country", "string"),
    ("Timezone", "timezone", "string"),
    ("Airport_Code", "airport_code", "string"),
    ("Amenity", "amenity", "boolean"),
    ("Bump", "bump", "boolean"),
    ("Crossing", "crossing", "boolean"),
    ("Give_Way", "give_way", "boolean"),
    ("Junction", "junction", "boolean"),
    ("No_Exit", "no_exit", "boolean"),
    ("Railway", "railway", "boolean"),
    ("Roundabout", "roundabout", "boolean"),
    ("Station", "station", "boolean"),
    ("Stop", "stop", "boolean"),
    ("Traffic_Calming", "traffic_calming", "boolean"),
    ("Traffic_Signal", "traffic_signal", "boolean"),
    ("Turning_Loop", "turning_loop", "boolean"),
    ("Sunrise_Sunset", "sunrise_sunset", "string"),
    ("Civil_Twilight", "civil_twilight", "string"),
    ("Nautical_Twilight", "nautical_twilight", "string"),
    ("Astronomical_Twilight", "astronomical_twilight", "string"),
]

# The weather half, in table order.
WEATHER_COLUMNS = [
    ("ID", "id", "string"),
    ("situation_date", "situation_date", "string"),
    ("Weather_Timestamp", "weather_timestamp", "timestamp_ntz"),
    ("Temperature(F)", "temperature_f", "double"),
    ("Wind_Chill(F)", "wind_chill_f", "double"),
    ("Humidity(%)", "humidity_pct", "double"),
    ("Pressure(in)", "pressure_in", "double"),
    ("Visibility(mi)", "visibility_mi", "double"),
    ("Wind_Direction", "wind_direction", "string"),
    ("Wind_Speed(mph)", "wind_speed_mph", "double"),
    ("Precipitation(in)", "precipitation_in", "double"),
    ("Weather_Condition", "weather_condition", "string"),
]

_SHARED = {"ID", "situation_date"}
RECORD_COLUMNS = ACCIDENT_COLUMNS + [c for c in WEATHER_COLUMNS if c[0] not in _SHARED]

SILVER_GROUPS = {
    "accidents": [silver for _, silver, _ in ACCIDENT_COLUMNS],
    "weather": [silver for _, silver, _ in WEATHER_COLUMNS],
}
PARTITION_COLUMNS = ["year", "month", "day"]

# Road-feature flags and the summary column each one is counted under.
ROAD_FLAGS = {
    "traffic_signal": "traffic_signal_accidents",
    "stop": "stop_sign_accidents",
    "junction": "junction_accidents",
    "roundabout": "roundabout_accidents",
    "railway": "railway_accidents",
    "crossing": "crossing_accidents",
}

# Inputs of the severity model.
MODEL_FLAGS = ["traffic_signal", "stop", "junction", "bump", "roundabout", "railway", "crossing"]
MODEL_TWILIGHT = ["sunrise_sunset", "civil_twilight", "nautical_twilight", "astronomical_twilight"]
MODEL_WEATHER = {
    "temperature_f": "temperature",
    "humidity_pct": "humidity",
    "visibility_mi": "visibility",
    "wind_chill_f": "wind_chill",
    "precipitation_in": "precipitation",
    "wind_speed_mph": "wind_speed",
}
MODEL_CALENDAR = ["hour", "day_of_week", "month", "is_rush_hour", "is_weekend"]
MODEL_CATEGORIES = ["state", "weather_condition"]


def bronze_schema() -> str:
    """The bronze columns as a DDL string, as readers take it."""
    return ", ".join(f"`{name}` {kind}" for name, _, kind in RECORD_COLUMNS)


def silver_schema() -> str:
    """The silver columns of an unsplit record as a DDL string."""
    kinds = {"situation_date": "date"}
    return ", ".join(f"{silver} {kinds.get(name, kind)}" for name, silver, kind in RECORD_COLUMNS)


def to_silver(df: DataFrame, fmt: str = SITUATION_FORMAT) -> DataFrame:
    """Bronze to silver, narrow and row by row: snake-case names, real dates, NaN as NULL.

    A situation date that does not parse becomes NULL; ``sources.silver.split_rejects`` keeps
    those rows apart.
    """
    changed = {
        name: f"nanvl(`{name}`, double(null))" for name, _, kind in RECORD_COLUMNS if kind == "double"
    } | {"situation_date": f"try_to_date(situation_date, '{fmt}')"}
    present = set(df.columns)
    names = {name: silver for name, silver, _ in RECORD_COLUMNS if name in present}
    return df.selectExpr(
        *[f"{changed.get(name, f'`{name}`')} as {silver}" for name, silver in names.items()],
        *[f"`{c}`" for c in df.columns if c not in names],
    )


def to_source_names(df: DataFrame) -> DataFrame:
    """Silver under the original column names, for queries written against those."""
    names = {silver: name for name, silver, _ in RECORD_COLUMNS}
    return df.withColumnsRenamed({c: names[c] for c in df.columns if c in names})
