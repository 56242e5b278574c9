"""Incident records derived from a star schema with an event log.

Every event becomes one bronze record: its customer's nation and segment are the place, its
value and properties the weather and the road features. Events with a property below
``REPLAYED`` are delivered twice, as by two overlapping feeds, so that repeated ids occur on
both sides of the split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rows import split_vertical
from ..schema import RECORD_COLUMNS, SILVER_GROUPS, SITUATION_FORMAT, to_silver

REPLAYED = 2

# Declared columns of the tables, so that opening one starts no job.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
}

# The property ``k`` is a whole number from 0 to 99; a road feature is present
# where the divisor goes into it, and daylight lasts over the given hours.
FEATURE_DIVISORS = {
    "Traffic_Signal": 2,
    "Stop": 3,
    "Junction": 5,
    "Roundabout": 7,
    "Railway": 11,
    "Crossing": 13,
    "Bump": 17,
    "Amenity": 19,
    "Give_Way": 23,
    "No_Exit": 29,
    "Station": 31,
    "Traffic_Calming": 37,
}
DAYLIGHT = {
    "Sunrise_Sunset": (6, 17),
    "Civil_Twilight": (5, 18),
    "Nautical_Twilight": (5, 19),
    "Astronomical_Twilight": (4, 20),
}
FIELDS = {
    "ID": "'A-' || event_id",
    "situation_date": f"date_format(ts, '{SITUATION_FORMAT}')",
    "Source": "event_type",
    "Severity": "decode(event_type, 'error', 4, 'purchase', 3, 'click', 2, 'view', 1)",
    "Start_Time": "if(k % 25 != 24, ts, null)",
    "End_Time": "ts + make_dt_interval(0, 0, k)",
    "Start_Lat": "25 + k / 4",
    "Start_Lng": "-120 + user_id % 60",
    "Distance(mi)": "value",
    "Description": "props",
    "Street": "c_name",
    "City": "nullif(c_mktsegment, 'MACHINERY')",
    "County": "n_name || '/' || c_mktsegment",
    "State": "if(n_nationkey != 0, n_name, null)",
    "Zipcode": "lpad(user_id, 5, '0')",
    "Country": "'US'",
    "Turning_Loop": "false",
    "Weather_Timestamp": "date_trunc('hour', ts)",
    "Temperature(F)": "if(k % 10 != 9, value, null)",
    "Wind_Chill(F)": "if(k % 4 != 3, value - 5, null)",
    "Humidity(%)": "k",
    "Pressure(in)": "29 + k / 100",
    "Visibility(mi)": "if(k % 20 != 13, k / 10, null)",
    "Wind_Direction": "elt(k % 4 + 1, 'N', 'E', 'S', 'W')",
    "Wind_Speed(mph)": "user_id % 40",
    "Precipitation(in)": "if(k % 6 != 5, (k % 6) / 10, null)",
    "Weather_Condition": "decode(k % 6, 0, 'Clear', 1, 'Rain', 2, 'Snow', 3, 'Fog', 4, 'Cloudy')",
}
FIELDS |= {name: f"k % {divisor} = 0" for name, divisor in FEATURE_DIVISORS.items()}
FIELDS |= {
    name: f"if(hour(ts) between {first} and {last}, 'Day', 'Night')"
    for name, (first, last) in DAYLIGHT.items()
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def bronze_records(spark: SparkSession, folder: str) -> DataFrame:
    """All events as bronze records under the declared names and types."""
    customers = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey")
    )
    events = table(spark, folder, "events").join(customers, F.expr("user_id = c_custkey"))
    events = events.withColumn("k", F.expr("int(regexp_extract(props, '\"k\": ([0-9]+)', 1))"))
    return events.selectExpr(
        *[f"cast({FIELDS.get(name, 'null')} as {kind}) as `{name}`" for name, _, kind in RECORD_COLUMNS],
        f"explode(array_repeat(0, if(k < {REPLAYED}, 2, 1))) as _delivery",
    ).drop("_delivery")


def silver_records(spark: SparkSession, folder: str) -> DataFrame:
    return to_silver(bronze_records(spark, folder))


def silver_halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The accident half and the weather half."""
    halves = split_vertical(silver_records(spark, folder), SILVER_GROUPS)
    return halves["accidents"], halves["weather"]
