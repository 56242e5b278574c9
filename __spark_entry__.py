"""Registered queries and the SQL each is checked against.

``entry`` is the flagship query, ``queries`` maps a name to ``(spark, folder) -> DataFrame``,
and ``oracle_sql`` maps the same name to SQL over the same tables.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.ml.functions import array_to_vector, vector_to_array  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from oracle_queries import ORACLE_SQL  # noqa: E402
from roadlens import jobs  # noqa: E402
from roadlens.functions.bands import TEMPERATURE, VISIBILITY, Bands, band  # noqa: E402
from roadlens.functions.calendar import time_features, with_calendar  # noqa: E402
from roadlens.functions.fill import fill_const, fill_mean  # noqa: E402
from roadlens.functions.flags import binarize, flag_to_int  # noqa: E402
from roadlens.operators import paging, rows  # noqa: E402
from roadlens.operators.aggregate import (  # noqa: E402
    distinct_count_by,
    flag_summary,
    share_of_total,
)
from roadlens.operators.joins import collapse, join_on_id, joined_aggregates  # noqa: E402
from roadlens.operators.quality import quality_report  # noqa: E402
from roadlens.plans import features, marts, model  # noqa: E402
from roadlens.schema import (  # noqa: E402
    MODEL_FLAGS,
    MODEL_TWILIGHT,
    MODEL_WEATHER,
    SILVER_GROUPS,
    SITUATION_FORMAT,
    bronze_schema,
    silver_schema,
    to_silver,
)
from roadlens.sources import served, silver, snapshots  # noqa: E402
from roadlens.sources.delimited import read_raw_csv  # noqa: E402
from roadlens.sources.star_schema import (  # noqa: E402
    bronze_records,
    silver_halves,
    silver_records,
    table,
)
from roadlens.sources.storage import scratch_path  # noqa: E402
from roadlens.streaming import daily, ingest  # noqa: E402
from roadlens.streaming import score as stream_scoring  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_FOLDER = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
QUANTITIES = Bands(("small", 10), (("medium", 25), ("large", 40)), "bulk")
READINGS = list(MODEL_WEATHER.values())

_REGISTERED: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Days and times as ISO text and decimals as doubles: the same on every engine."""
    out = []
    for name, kind in df.dtypes:
        col = F.col(f"`{name}`")
        if kind == "date":
            col = F.date_format(col, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind.startswith("decimal"):
            col = col.cast("double")
        out.append(col.alias(name))
    return df.select(*out)


def registered(query: Query) -> Query:
    _REGISTERED[query.__name__] = lambda spark, folder: _plain(query(spark, folder))
    return query


def _rounded(df: DataFrame, digits: int = 6, cols: list[str] | None = None) -> DataFrame:
    cols = cols or [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(c, digits) for c in cols})


# ---------------------------------------------------------------- marts


@registered
def mart_daily(spark, folder):
    return marts.mart_daily(silver_halves(spark, folder)[0])


@registered
def mart_severity(spark, folder):
    return marts.mart_severity(silver_halves(spark, folder)[0])


@registered
def mart_location(spark, folder):
    return marts.mart_location(silver_halves(spark, folder)[0])


@registered
def mart_time_patterns(spark, folder):
    return marts.mart_time_patterns(silver_halves(spark, folder)[0])


@registered
def mart_infrastructure(spark, folder):
    return marts.mart_infrastructure(silver_halves(spark, folder)[0])


@registered
def mart_weather_condition(spark, folder):
    return _rounded(marts.mart_weather_condition(*silver_halves(spark, folder)))


@registered
def mart_weather_impact(spark, folder):
    return _rounded(marts.mart_weather_impact(*silver_halves(spark, folder)))


@registered
def mart_weather_condition_dedupe(spark, folder):
    return _rounded(marts.mart_weather_condition(*silver_halves(spark, folder), dedupe=True))


@registered
def mart_weather_impact_dedupe(spark, folder):
    return _rounded(marts.mart_weather_impact(*silver_halves(spark, folder), dedupe=True))


def _newest_records(spark, folder):
    return rows.latest_per_key(silver_records(spark, folder), ["id"], ["situation_date"])


@registered
def mart_weather_condition_wide(spark, folder):
    return _rounded(marts.wide_weather_condition(_newest_records(spark, folder)))


@registered
def mart_weather_impact_wide(spark, folder):
    return _rounded(marts.wide_weather_impact(_newest_records(spark, folder)))


@registered
def marts_one_pass(spark, folder):
    return marts.marts_one_pass(silver_halves(spark, folder)[0])


@registered
def seasonal_counts(spark, folder):
    return marts.seasonal_counts(silver_halves(spark, folder)[0])


@registered
def weather_severity_corr(spark, folder):
    return _rounded(marts.weather_severity_corr(*silver_halves(spark, folder)))


@registered
def condition_association(spark, folder):
    return _rounded(marts.condition_association(*silver_halves(spark, folder)))


@registered
def condition_severity_table(spark, folder):
    return _rounded(marts.condition_severity_table(*silver_halves(spark, folder)))


@registered
def weather_rank_corr(spark, folder):
    return _rounded(marts.weather_rank_corr(*silver_halves(spark, folder)))


def _served_copy(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    served.write_mart(df, name, path=scratch_path(spark, name))
    return served.read_mart(spark, name)


@registered
def mart_copy_accidents(spark, folder):
    return _served_copy(spark, silver_halves(spark, folder)[0], "served_accidents")


@registered
def mart_copy_weather(spark, folder):
    return _served_copy(spark, silver_halves(spark, folder)[1], "served_weather")


@registered
def served_marts(spark, folder):
    """All nine served tables written and read back: their sizes."""
    accidents, weather = silver_halves(spark, folder)
    names = marts.write_marts(
        accidents, weather, lambda df, name: served.write_mart(df, name, scratch_path(spark, name)), "gold_"
    )
    return served.table_overview(spark, names)


# ---------------------------------------------------------------- bronze


@registered
def raw_csv_roundtrip(spark, folder):
    path = scratch_path(spark, "feed")
    stamp = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    bronze_records(spark, folder).write.option("header", True).option(
        "timestampNTZFormat", stamp
    ).csv(path)
    return read_raw_csv(spark, path).select(
        F.col("ID").alias("id"), "situation_date", F.col("Severity").alias("severity"),
        F.col("Start_Time").alias("start_time"), F.col("Temperature(F)").alias("temperature_f"),
        F.col("Description").alias("description"), F.col("Stop").alias("stop"),
        F.size("bad_fields").alias("bad_fields"),
    )


@registered
def raw_csv_bad_rows(spark, folder):
    """Rows with a field too few or too many, read back with their lines."""
    path = scratch_path(spark, "bad-rows")
    fields = [
        F.concat(F.lit("O-"), F.col("o_orderkey")), (F.col("o_orderkey") % 4 + 1).cast("string"), F.col("o_orderpriority")
    ]
    line = (
        F.when(F.col("o_orderkey") % 10 == 0, F.concat_ws(",", *fields[:2]))
        .when(F.col("o_orderkey") % 10 == 1, F.concat_ws(",", *fields, F.lit("more")))
        .otherwise(F.concat_ws(",", *fields))
    )
    lines = table(spark, folder, "orders").select(line.alias("ID,Severity,Description"))
    lines.write.option("header", True).option("sep", "\x01").option("quote", "").csv(path)
    return read_raw_csv(spark, path).select(
        F.col("ID").alias("id"), F.col("Severity").alias("severity"), F.col("Description").alias("description"), "bad_row"
    )


def _order_feeds(spark, folder):
    """The orders as three feeds of consecutive date ranges."""
    orders = table(spark, folder, "orders").withColumn(
        "situation_date", F.date_format("o_orderdate", SITUATION_FORMAT)
    )
    first, second = (F.lit(d).cast("timestamp_ntz") for d in ("1997-01-01", "1999-01-01"))
    day = F.col("o_orderdate")
    return [
        orders.where(day < first), orders.where((day >= first) & (day < second)),
        orders.where(day >= second),
    ]


def _order_columns(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", "o_custkey", "situation_date", "o_totalprice")


@registered
def snapshot_merge(spark, folder):
    base = scratch_path(spark, "bronze")
    for feed in _order_feeds(spark, folder):
        snapshots.append_snapshot(feed, base)
    return _order_columns(snapshots.read_snapshot(spark, base))


def _feeds_of_one_day(spark, folder):
    """The orders as three feeds that all end with the same day, the last one given twice."""
    orders = table(spark, folder, "orders").withColumn(
        "situation_date", F.when(F.col("o_orderkey") % 5 != 0, F.lit("31-12-2001"))
    )
    parts = [orders.where(F.col("o_orderkey") % 3 == n) for n in range(3)]
    return [*parts, parts[2]]


@registered
def feeds_same_day(spark, folder):
    """Every feed of a day stays; the same feed again replaces itself."""
    base = scratch_path(spark, "bronze")
    for feed in _feeds_of_one_day(spark, folder):
        snapshots.append_delta(feed, base)
    return _order_columns(snapshots.read_as_of(spark, base))


@registered
def feeds_late(spark, folder):
    """Cumulative folders where the second feed comes last."""
    base = scratch_path(spark, "bronze")
    first, second, third = _order_feeds(spark, folder)
    for feed in (first, third, second):
        snapshots.append_snapshot(feed, base)
    return _order_columns(snapshots.read_snapshot(spark, base))


@registered
def silver_versions(spark, folder):
    """A feed that replaces itself with more records: silver of the version before and of the one after."""
    base = scratch_path(spark, "bronze")
    records = bronze_records(spark, folder)
    for feed in (records.where("Severity IS NOT NULL"), records):
        snapshots.append_delta(feed, base, feed="daily")
    versions = [
        to_silver(snapshots.read_as_of(spark, base, schema=bronze_schema(), version=n)).select(
            F.lit(n).alias("version"), "id", "situation_date", "severity"
        )
        for n in (1, 2)
    ]
    return versions[0].unionByName(versions[1])


@registered
def snapshot_delta(spark, folder):
    """As of the second feed's day, from folders that hold one feed each."""
    base = scratch_path(spark, "bronze")
    for feed in _order_feeds(spark, folder):
        snapshots.append_delta(feed, base)
    day = snapshots.snapshot_days(spark, base)[1]
    return _order_columns(snapshots.read_as_of(spark, base, day))


@registered
def merge_feeds(spark, folder):
    first, second, third = _order_feeds(spark, folder)
    return _order_columns(rows.merge_by_name(rows.merge_by_name(first, second), third))


@registered
def latest_situation_date(spark, folder):
    orders = table(spark, folder, "orders")
    text = orders.select(F.date_format("o_orderdate", SITUATION_FORMAT).alias("situation_date"))
    return snapshots.latest_situation_date(text)


@registered
def dedupe_latest(spark, folder):
    orders = table(spark, folder, "orders")
    return rows.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


# ---------------------------------------------------------------- silver


@registered
def split_accidents(spark, folder):
    return rows.split_vertical(silver_records(spark, folder), SILVER_GROUPS)["accidents"]


@registered
def split_weather(spark, folder):
    return rows.split_vertical(silver_records(spark, folder), SILVER_GROUPS)["weather"]


@registered
def calendar_partitions(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", SITUATION_FORMAT).alias("situation_date")
    )
    return with_calendar(orders, "situation_date")


def _silver_table(spark, folder, name) -> str:
    tables = silver.silver_tables(bronze_records(spark, folder))
    target = f"silver_{name}"
    silver.write_silver(tables[name], target, path=scratch_path(spark, target))
    return target


@registered
def silver_roundtrip(spark, folder):
    weather = silver.read_silver(spark, _silver_table(spark, folder, "weather"))
    return weather.select("id", "situation_date", "temperature_f", "weather_condition", "year", "month", "day")


@registered
def silver_days(spark, folder):
    """A range of days, read through partition pruning."""
    name = _silver_table(spark, folder, "accidents")
    days = silver.read_silver(spark, name, date(2024, 1, 10), date(2024, 1, 19))
    return distinct_count_by(days, ["situation_date"], "id")


def _daily_runs(spark, folder):
    """Three daily runs; after each the days formed anew and the prefix of silver. The second feed moves records of
    the first to another day; the third moves all records of one day away and gives some of those that had no day one."""
    base, prefix = scratch_path(spark, "bronze"), f"daily_{uuid.uuid4().hex}_"
    records = bronze_records(spark, folder)
    first, second, moved = date(2024, 1, 10), date(2024, 1, 20), date(2024, 1, 3)
    day = F.to_date("situation_date", SITUATION_FORMAT)

    def version(which, when, severity):
        return records.where(which).withColumns({"situation_date": F.lit(when), "Severity": F.lit(severity)})

    no_day = F.when(F.col("`Humidity(%)`") == 50, "nowhen").otherwise(F.col("situation_date"))
    feeds = [
        records.where(day <= first).withColumn("situation_date", no_day),
        records.where((day > first) & (day <= second)).unionAll(
            version((day <= first) & (F.col("Severity") == 3), "15-01-2024", 1)
        ),
        records.where(day > second).unionAll(version(day == moved, "25-01-2024", 2)),
    ]
    for feed in feeds:
        filed = snapshots.append_delta(feed, base)
        since = date.fromisoformat(filed.rpartition("/")[2])
        yield jobs.refresh_silver(spark, base, since, dedupe=True, prefix=prefix), prefix


@registered
def silver_incremental(spark, folder):
    for _, prefix in _daily_runs(spark, folder):
        pass
    accidents, weather, rejects = (spark.table(prefix + name) for name in ("accidents", "weather", "rejects"))
    weather = weather.select("id", "situation_date", "temperature_f")
    whole = accidents.select("id", "situation_date", "severity").join(weather, ["id", "situation_date"], "full")
    return whole.unionByName(rejects.select(whole.columns))


@registered
def marts_incremental(spark, folder):
    """All marts after three daily runs that move records between days, kept by change; groups as text."""
    for days, prefix in _daily_runs(spark, folder):
        jobs.refresh_marts(spark, days or None, prefix + "gold_", silver_prefix=prefix)
    keys = {
        "top_accidents_by_day": ["accident_date"],
        "accidents_by_severity": ["Severity", "percentage"],
        "accidents_by_location": ["State", "City"],
        "accidents_time_patterns": ["hour_of_day", "day_of_week"],
        "accidents_by_weather": ["Weather_Condition"],
        "weather_impact_analysis": ["temperature_range", "visibility_condition"],
    }
    nothing = F.lit(None)
    parts = []
    for name, own in keys.items():
        df = served.read_mart(spark, f"{prefix}gold_{name}")
        if name == "accidents_by_severity":
            df = df.withColumn("percentage", F.col("percentage").cast("double"))
        means = [F.round(c, 6) if c in df.columns else nothing.cast("double") for c in ("avg_severity", "avg_wind_speed")]
        groups = [F.col(k).cast("string") for k in own] + [nothing.cast("string")] * (2 - len(own))
        parts.append(
            df.select(
                F.lit(name).alias("mart"), groups[0].alias("k1"), groups[1].alias("k2"), "accident_count",
                means[0].alias("avg_severity"), means[1].alias("avg_wind_speed"),
            )
        )
    flags = served.read_mart(spark, f"{prefix}gold_road_infrastructure_summary")
    flags = flags.unpivot([], flags.columns, "k1", "accident_count").withColumn("mart", F.lit("road_infrastructure_summary"))
    copies = [
        served.read_mart(spark, f"{prefix}gold_{name}").agg(F.count(F.lit(1)).alias("accident_count")).withColumn("mart", F.lit(name))
        for name in ("accidents", "weather")
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*parts, flags, *copies])


@registered
def silver_rejects(spark, folder):
    """Records whose day cannot be read: here those without a start time are sent without one."""
    bronze = bronze_records(spark, folder)
    broken = F.when(F.col("Start_Time").isNull(), "2024-13-40").otherwise(F.col("situation_date"))
    return silver.silver_tables(bronze.withColumn("situation_date", broken))["rejects"].select(
        "id", "severity", "situation_date"
    )


@registered
def quality(spark, folder):
    return quality_report(
        bronze_records(spark, folder),
        "ID",
        ["Severity", "Start_Time", "State", "City", "Temperature(F)", "Weather_Condition"],
        ranges={"Severity": (1, 3), "Visibility(mi)": (0, 9)},
    )


_REGISTERED["quality_report"] = _REGISTERED.pop("quality")


# ---------------------------------------------------------------- columns


@registered
def rename_select(spark, folder):
    return features.wide_inputs(silver_records(spark, folder)).select("id", "start_time", "city", *READINGS)


@registered
def not_null(spark, folder):
    return rows.not_null(silver_records(spark, folder), ["state", "city"]).select("id", "state", "city")


@registered
def band_temperature(spark, folder):
    named = band(F.col("temperature_f"), TEMPERATURE).alias("temperature_range")
    return silver_records(spark, folder).select("id", "temperature_f", named)


@registered
def band_visibility(spark, folder):
    named = band(F.col("visibility_mi"), VISIBILITY, "Unknown").alias("visibility_condition")
    return silver_records(spark, folder).select("id", "visibility_mi", named)


@registered
def flags_to_int(spark, folder):
    records = silver_records(spark, folder).select("id", *MODEL_FLAGS, *MODEL_TWILIGHT)
    return flag_to_int(records, MODEL_FLAGS, MODEL_TWILIGHT)


@registered
def time_features_query(spark, folder):
    return time_features(silver_records(spark, folder).select("id", "start_time"), "start_time")


_REGISTERED["time_features"] = _REGISTERED.pop("time_features_query")


@registered
def severity_binary(spark, folder):
    label = binarize(F.col("severity"), features.HIGH_SEVERITY).alias("severity_binary")
    return silver_records(spark, folder).select("id", "severity", label)


@registered
def fill_unknown(spark, folder):
    cols = ["weather_condition", "state", "city"]
    records = silver_records(spark, folder).select("id", *cols)
    return fill_const(records, {c: features.UNKNOWN for c in cols})


@registered
def mean_impute(spark, folder):
    inputs = features.wide_inputs(silver_records(spark, folder)).select("id", *READINGS)
    return _rounded(fill_mean(inputs, READINGS))


# ---------------------------------------------------------------- joins


@registered
def join_halves(spark, folder):
    """The plain join of the halves, one row per id on the weather side, so nothing multiplies."""
    accidents, weather = silver_halves(spark, folder)
    newest = rows.latest_per_key(weather, ["id"], ["situation_date"])
    return join_on_id(
        accidents.select("id", "severity", "state"),
        newest.select("id", "temperature_f", "weather_condition"),
        "id",
    )


@registered
def collapse_copies(spark, folder):
    return collapse(silver_records(spark, folder).select("id", "severity", "city"))


@registered
def band_join_summary(spark, folder):
    """Orders and their lines by quantity band and return flag."""
    orders = table(spark, folder, "orders").withColumnRenamed("o_orderkey", "orderkey")
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_returnflag", "l_quantity",
        band(F.col("l_quantity"), QUANTITIES).alias("quantity_band"),
    )
    out = joined_aggregates(
        orders, lines, "orderkey", by=["quantity_band", "l_returnflag"], count="order_count",
        left_means={"avg_price": "o_totalprice"}, right_means={"avg_quantity": "l_quantity"},
    )
    return _rounded(out)


# ---------------------------------------------------------------- star-schema tables


@registered
def daily_distinct_orders(spark, folder):
    day = F.to_date("o_orderdate").alias("order_date")
    return distinct_count_by(table(spark, folder, "orders"), [day], "o_custkey", "customer_count")


@registered
def share_by_priority(spark, folder):
    orders = table(spark, folder, "orders")
    counts = distinct_count_by(orders, ["o_orderpriority"], "o_orderkey", "order_count")
    return share_of_total(counts, "order_count")


@registered
def topk_nation_segment(spark, folder):
    customers = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    counts = distinct_count_by(customers, ["n_name", "c_mktsegment"], "c_custkey", "customer_count")
    return rows.top_k(counts, "customer_count", ["n_name", "c_mktsegment"], 50)


@registered
def heatmap_month_dow(spark, folder):
    keys = [F.month("o_orderdate").alias("month"), F.dayofweek("o_orderdate").alias("day_of_week")]
    return distinct_count_by(table(spark, folder, "orders"), keys, "o_custkey", "customer_count")


@registered
def flag_counts_lineitem(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        (F.col("l_returnflag") == "R").alias("returned"),
        (F.col("l_linestatus") == "O").alias("open"),
        (F.col("l_discount") > 0.05).alias("discounted"),
    )
    flags = {"returned": "returned_lines", "open": "open_lines", "discounted": "discounted_lines"}
    return flag_summary(lines, flags, "l_orderkey", total="total_orders")


# ---------------------------------------------------------------- serving


@registered
def catalog_tables(spark, folder):
    views = {f"driver_{name}": name for name in TABLES}
    for view, name in views.items():
        table(spark, folder, name).createOrReplaceTempView(view)
    found = served.list_tables(spark, "driver_*")
    return served.table_overview(spark, found)


@registered
def describe_orders(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("driver_orders")
    return served.describe_table(spark, "driver_orders")


@registered
def source_view_sql(spark, folder):
    """A statement of one's own against the original table and column names."""
    served.register_views(*silver_halves(spark, folder), prefix="own_")
    return spark.sql(
        """
        select a.County as county, w.Wind_Direction as wind_direction, max(w.`Wind_Speed(mph)`) as max_wind,
               count(distinct a.ID) as accident_count
        from own_accidents a join own_weather w on a.ID = w.ID
        where a.Stop = true and w.`Humidity(%)` >= 40
        group by all
        """
    )


@registered
def sort_orders(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return rows.sort_table(orders, "o_totalprice", "desc", ["o_orderkey"])


@registered
def page_customers(spark, folder):
    customers = table(spark, folder, "customer")
    return paging.page(customers, ["c_custkey"], limit=25, offset=40, sort_by="c_acctbal", order="desc")


@registered
def page_deep(spark, folder):
    """A page far down the line items, found by position."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return paging.deep_page(
        lines, ["l_orderkey", "l_linenumber"], limit=500, offset=4000, sort_by="l_extendedprice", order="desc"
    )


@registered
def page_union(spark, folder):
    """All pages over a key that repeats, from one index: every row once."""
    orders = table(spark, folder, "orders").select("o_orderpriority", "o_custkey", "o_orderkey")
    index = paging.PageIndex(orders, ["o_orderpriority"])
    return index.pages(paging.MAX_LIMIT).drop("page")


@registered
def page_info(spark, folder):
    return paging.page_info(table(spark, folder, "customer"), limit=25, offset=40)


@registered
def search_parts(spark, folder):
    return rows.search_table(table(spark, folder, "part"), "bRaNd#1", ["p_name", "p_brand", "p_type"])


# ---------------------------------------------------------------- model


@registered
def feature_table(spark, folder):
    return _rounded(features.feature_table(*silver_halves(spark, folder)))


@registered
def feature_rows(spark, folder):
    return _rounded(features.feature_rows(silver_records(spark, folder)))


@registered
def train_test_split(spark, folder):
    return features.with_split(silver_records(spark, folder).select("id", "severity"))


@registered
def category_index(spark, folder):
    """Index of every state and weather condition, most frequent first."""
    records = fill_const(
        silver_records(spark, folder).select("state", "weather_condition"),
        {"state": features.UNKNOWN, "weather_condition": features.UNKNOWN},
    )
    indexed = model.index_categories().fit(records).transform(records)
    pairs = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("category"), F.col(c).alias("label"),
                    F.col(f"{c}_indexed").cast("int").alias("index"),
                )
                for c in ("state", "weather_condition")
            ]
        )
    )
    return indexed.select(pairs).groupBy("category", "label", "index").agg(F.count(F.lit(1)).alias("n"))


def _prepared(spark, folder):
    return features.feature_rows(silver_records(spark, folder), impute=False)


@registered
def assemble_scale(spark, folder):
    """The pipeline up to the scaler: three scaled slots and the one-hot parts."""
    rows_ = model.ready(_prepared(spark, folder))
    pipeline = model.severity_pipeline()
    pipeline.setStages(pipeline.getStages()[:-1])
    scaled = vector_to_array("scaled_features")
    state, weather = vector_to_array("state_encoded"), vector_to_array("weather_condition_encoded")
    out = pipeline.fit(rows_).transform(rows_).select(
        "id",
        scaled[1].alias("scaled_lat"),
        scaled[2].alias("scaled_temperature"),
        scaled[8].alias("scaled_hour"),
        F.size(scaled).alias("slots"),
        (F.array_position(state, 1.0) - 1).cast("int").alias("state_slot"),
        (F.array_position(weather, 1.0) - 1).cast("int").alias("weather_slot"),
    )
    return _rounded(out)


_FITTED: dict[tuple[str, str], tuple] = {}


def _fitted(spark, folder):
    """One forest per session and folder, trained on a written feature table."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _FITTED:
        table_ = model.feature_store(_prepared(spark, folder))
        train, test = features.split_train_test(table_)
        path = scratch_path(spark, "model")
        model.save_model(model.train_classifier(train), path)
        _FITTED[key] = (model.load_model(path), test)
    return _FITTED[key]


@registered
def score_batch(spark, folder):
    fitted, test = _fitted(spark, folder)
    return model.score(fitted, test).select("id", "severity", "severity_binary", "prediction")


@registered
def confusion_matrix(spark, folder):
    fitted, test = _fitted(spark, folder)
    return model.confusion_matrix(model.score(fitted, test))


@registered
def evaluate_model(spark, folder):
    fitted, test = _fitted(spark, folder)
    return model.evaluate(model.confusion_matrix(model.score(fitted, test)))


@registered
def top_predictions(spark, folder):
    fitted, test = _fitted(spark, folder)
    return model.top_predictions(model.score(fitted, test))


@registered
def feature_importance(spark, folder):
    fitted, test = _fitted(spark, folder)
    return model.feature_importance(fitted, model.score(fitted, test))


def _by_rule(spark, folder):
    """Records with a prediction that a statement can make: high above 60 degrees."""
    records = silver_records(spark, folder).select("id", "severity", "temperature_f")
    warmth = F.coalesce(F.col("temperature_f"), F.lit(0.0)) / 1000
    return records.select(
        "id",
        "severity",
        binarize(F.col("severity"), features.HIGH_SEVERITY).alias(features.LABEL),
        F.when(F.col("temperature_f") > 60, 1.0).otherwise(0.0).alias("prediction"),
        array_to_vector(F.array(1 - warmth, warmth)).alias("probability"),
    )


@registered
def confusion_by_rule(spark, folder):
    return model.confusion_matrix(_by_rule(spark, folder))


@registered
def metrics_by_rule(spark, folder):
    return _rounded(model.evaluate(model.confusion_matrix(_by_rule(spark, folder))))


@registered
def top_by_rule(spark, folder):
    return _rounded(model.top_predictions(_by_rule(spark, folder)))


# ---------------------------------------------------------------- streams


def _feeds(spark, folder) -> list[DataFrame]:
    """The bronze records as two deliveries whose days overlap."""
    records = bronze_records(spark, folder)
    day = F.to_date("situation_date", SITUATION_FORMAT)
    return [records.where(day <= F.lit(date(2024, 1, 20))), records.where(day >= F.lit(date(2024, 1, 10)))]


def _deliver(spark: SparkSession, feeds: list[DataFrame], start) -> None:
    """Put one feed after the other into a landing folder and run the stream after each, as a
    daily job does: the second run takes up where the first stopped."""
    landing, offsets = scratch_path(spark, "landing"), scratch_path(spark, "offsets")
    for feed in feeds:
        feed.write.mode("append").parquet(landing)
        start(ingest.feed(spark, landing, bronze_schema()), offsets).awaitTermination()


@registered
def stream_ingest(spark, folder):
    store = scratch_path(spark, "store")
    _deliver(
        spark,
        _feeds(spark, folder),
        lambda stream, at: ingest.stream_ingest(
            to_silver(stream), ["id"], ["situation_date"], store, at
        ),
    )
    return ingest.read_store(spark, store, silver_schema(), ["id"], ["situation_date"]).select(
        "id", "situation_date", "severity", "start_time", "city", "temperature_f"
    )


@registered
def stream_versions(spark, folder):
    """A second delivery with other severities, on a later day, under a checkpoint of its own."""
    store = scratch_path(spark, "store")
    records = bronze_records(spark, folder)
    newer = records.where("Severity is not null").withColumns(
        {"Severity": F.lit(5) - F.col("Severity"), "situation_date": F.lit("31-12-2024")}
    )
    for feed in (newer, records):
        _deliver(
            spark,
            [feed],
            lambda stream, at: ingest.stream_ingest(to_silver(stream), ["id"], ["situation_date"], store, at),
        )
    return ingest.read_store(spark, store, silver_schema(), ["id"], ["situation_date"]).select(
        "id", "situation_date", "severity"
    )


@registered
def stream_daily_counts(spark, folder):
    store = scratch_path(spark, "days")
    _deliver(
        spark,
        _feeds(spark, folder),
        lambda stream, at: daily.stream_daily_counts(to_silver(stream), store, at),
    )
    return daily.daily_counts(spark, store)


@registered
def stream_daily_closed(spark, folder):
    """Only days that can get no more records: those that ended a day before the newest one."""
    out = scratch_path(spark, "closed")

    def start(stream, at):
        closed = daily.daily_counts_closed(to_silver(stream))
        writer = closed.writeStream.format("parquet").option("path", out).outputMode("append")
        return writer.option("checkpointLocation", at).trigger(availableNow=True).start()

    _deliver(spark, _feeds(spark, folder), start)
    return spark.read.schema("accident_date date, accident_count bigint").parquet(out)


@registered
def stream_score(spark, folder):
    fitted, _ = _fitted(spark, folder)
    out = scratch_path(spark, "scored")
    _deliver(
        spark,
        [bronze_records(spark, folder)],
        lambda stream, at: stream_scoring.stream_score(fitted, to_silver(stream), out, at),
    )
    return spark.read.schema(stream_scoring.SCORED).parquet(out)


# ---------------------------------------------------------------- contract


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: weather impact on severity, over the join of both halves."""
    return queries()["mart_weather_impact"](spark, SMOKE_FOLDER)


def _text_operators() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the subpackage ``llm`` and the pipeline; none where they are not installed."""
    try:
        import corpus_pipeline
        from roadlens.llm import queries as text
    except ModuleNotFoundError as missing:
        if (missing.name or "").startswith(("corpus_pipeline", "roadlens.llm")):
            return {}, {}
        raise
    sql = text.oracle_sql()
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**text.queries(), "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Query]:
    return _REGISTERED | _text_operators()[0]


def oracle_sql() -> dict[str, str]:
    return ORACLE_SQL | _text_operators()[1]
