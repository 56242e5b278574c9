"""Edge values of the column functions."""

import math

import pytest
from pyspark.sql import functions as F

from roadlens.functions.bands import TEMPERATURE, VISIBILITY, band
from roadlens.functions.calendar import parse_day, season, time_features, with_calendar
from roadlens.functions.fill import column_means, fill_const, fill_mean
from roadlens.functions.flags import binarize, flag_to_int
from roadlens.schema import RECORD_COLUMNS, SILVER_GROUPS, bronze_schema, to_silver, to_source_names

NAN = float("nan")


def column(df, name):
    return [r[name] for r in df.collect()]


def test_temperature_edges(spark):
    values = [31.9, 32.0, 50.0, 50.1, 70.0, 70.1, 85.0, 85.1, NAN, None]
    df = spark.createDataFrame([(v,) for v in values], "t double")
    assert column(df.select(band(F.col("t"), TEMPERATURE).alias("b")), "b") == [
        "Freezing", "Cold", "Cold", "Moderate", "Moderate", "Warm", "Warm", "Hot", "Hot", None,
    ]


def test_visibility_edges_and_null_label(spark):
    df = spark.createDataFrame([(v,) for v in (0.99, 1.0, 5.0, 5.01, None)], "v double")
    named = df.select(band(F.col("v"), VISIBILITY, "Unknown").alias("b"))
    assert column(named, "b") == ["Poor", "Moderate", "Moderate", "Good", "Unknown"]


def test_days_parse_or_are_null(spark):
    df = spark.createDataFrame([("2025-13-40",), (None,), ("03-01-2025",)], "d string")
    rows = with_calendar(df, "d").select("year", "month", "day").collect()
    assert [tuple(r) for r in rows] == [(None,) * 3, (None,) * 3, (2025, 1, 3)]
    assert column(df.select(parse_day("d").alias("p")), "p")[0] is None


def test_weekday_and_rush_hour(spark):
    df = spark.sql(
        "select to_timestamp_ntz(t) t from values ('2024-01-07 06:59:59'), ('2024-01-06 07:00:00'), "
        "('2024-01-08 09:59:00'), ('2024-01-08 10:00:00'), ('2024-01-08 16:00:00'), "
        "('2024-01-08 17:00:00'), ('2024-01-08 19:30:00'), ('2024-01-08 20:00:00'), (null) as v(t)"
    )
    out = time_features(df, "t")
    assert column(out, "day_of_week")[:3] == [1, 7, 2]
    assert column(out, "is_weekend") == [1, 1, 0, 0, 0, 0, 0, 0, 0]
    assert column(out, "is_rush_hour") == [0, 1, 1, 0, 0, 1, 1, 0, 0]
    assert column(out, "hour")[-1] is None


def test_seasons(spark):
    out = spark.range(1, 13).select(season(F.col("id")).alias("s"))
    expected = ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]
    assert column(out, "s") == expected


def test_flags_and_twilight(spark):
    df = spark.createDataFrame([(True, "Day"), (False, "Night"), (None, None)], "f boolean, d string")
    out = flag_to_int(df, ["f"], ["d"])
    assert [tuple(r) for r in out.collect()] == [(1, 1), (0, 0), (0, 0)]


def test_binarize_null_is_low(spark):
    df = spark.createDataFrame([(2,), (3,), (None,)], "s int")
    assert column(df.select(binarize(F.col("s"), 3).alias("b")), "b") == [0, 1, 0]


def test_mean_fill(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (NAN, None), (3.0, None)], "a double, b double")
    out = fill_mean(df, ["a", "b"], fallback=-9.0)
    assert column(out, "a") == [1.0, 2.0, 2.0, 3.0]
    assert column(out, "b") == [-9.0] * 4


def test_mean_fill_from_other_rows_and_weights(spark):
    train = spark.createDataFrame([(1.0, 3.0), (5.0, 1.0), (None, 9.0)], "a double, w double")
    assert column(column_means(train, ["a"], "w"), "a") == [2.0]
    test = spark.createDataFrame([(None,), (7.0,)], "a double")
    assert column(fill_mean(test, ["a"], means=column_means(train, ["a"])), "a") == [3.0, 7.0]


def test_fill_const(spark):
    df = spark.createDataFrame([(None, "x"), ("y", None)], "a string, b string")
    assert [tuple(r) for r in fill_const(df, {"a": "Unknown"}).collect()] == [("Unknown", "x"), ("y", None)]


def test_silver_names_types_and_back(spark):
    assert len(RECORD_COLUMNS) == 47
    assert [len(SILVER_GROUPS[g]) for g in ("accidents", "weather")] == [37, 12]
    raw = spark.createDataFrame([("a", "01-02-2025", NAN), ("b", "oops", 5.0)],
                                "ID string, situation_date string, `Temperature(F)` double")
    silver = to_silver(raw)
    assert silver.columns == ["id", "situation_date", "temperature_f"]
    first, second = silver.collect()
    assert str(first["situation_date"]) == "2025-02-01" and first["temperature_f"] is None
    assert second["situation_date"] is None and not math.isnan(second["temperature_f"])
    assert to_source_names(silver).columns == raw.columns
    assert spark.createDataFrame([], bronze_schema()).columns[0] == "ID"


def test_extra_columns_survive_silver(spark):
    raw = spark.createDataFrame([("a", 1)], "ID string, extra int")
    assert to_silver(raw).columns == ["id", "extra"]


@pytest.mark.parametrize("hours", [(0, 0), (8, 1), (18, 1), (23, 0)])
def test_rush_hour_single(spark, hours):
    df = spark.sql(f"select timestamp_ntz'2024-01-08 {hours[0]:02d}:00:00' t")
    assert column(time_features(df, "t"), "is_rush_hour") == [hours[1]]
