"""The daily jobs one after the other, from delimited parts to a saved model."""

import glob
from datetime import date

import pytest
from pyspark.sql import functions as F

from roadlens import jobs
from roadlens.errors import RepeatedIds
from roadlens.operators.quality import require_unique
from roadlens.plans import features, marts
from roadlens.schema import bronze_schema
from roadlens.sources.tables import table_folder
from roadlens.sources import served, silver, snapshots
from roadlens.sources.star_schema import bronze_records, silver_halves

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("parts")
    records = bronze_records(spark, FOLDER)
    day = F.to_date("situation_date", "dd-MM-yyyy")
    out = []
    for name, keep in (("1", day <= "2024-01-12"), ("2", day > "2024-01-12")):
        records.where(keep).write.option("header", True).option(
            "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"
        ).csv(f"{folder}/{name}")
        out.append(f"{folder}/{name}")
    return out


@pytest.mark.parametrize("layout", ["delta", "cumulative"])
def test_from_parts_to_marts(spark, parts, folder, layout):
    base = folder + "/bronze"
    written = jobs.ingest(spark, parts, base, layout)
    assert [p.path.rpartition("/")[2] for p in written] == ["2024-01-12", "2024-01-30"]
    jobs.build_silver(spark, jobs.read_bronze(spark, base, layout=layout), folder=folder)
    expected = bronze_records(spark, FOLDER).count()
    assert silver.read_silver(spark, "accidents").count() == expected
    assert glob.glob(folder + "/accidents/year=2024/month=1/day=12/*.parquet")
    jobs.build_marts(spark, folder=folder)
    accidents, weather = silver_halves(spark, FOLDER)
    for name in ("accidents_by_severity", "accidents_by_location", "weather_impact_analysis"):
        direct = marts.build_marts(accidents, weather)[name]
        assert sorted(map(str, served.read_mart(spark, "gold_" + name).collect())) == sorted(
            map(str, direct.collect())
        )
    assert served.read_mart(spark, "gold_accidents").count() == expected
    for table in served.list_tables(spark):
        if table.startswith("gold_") or table in ("accidents", "weather", "rejects"):
            spark.sql(f"drop table if exists {table}")


def test_deduped_silver_trains_a_model(spark, parts, folder):
    base = folder + "/bronze"
    jobs.ingest(spark, parts, base)
    jobs.build_silver(spark, jobs.read_bronze(spark, base), dedupe=True, folder=folder, wide=True)
    accidents = silver.read_silver(spark, "accidents")
    assert accidents.count() == accidents.select("id").distinct().count()
    jobs.build_marts(spark, "once_", folder=folder + "/once", unique_ids=True)
    total = served.read_mart(spark, "once_road_infrastructure_summary").first()["total_accidents"]
    assert total == accidents.count()
    jobs.build_marts(spark, "wide_", folder=folder + "/wide", unique_ids=True, wide=True)
    for name in ("accidents_by_weather", "weather_impact_analysis"):
        joined, wide = (served.read_mart(spark, kind + name) for kind in ("once_", "wide_"))
        doubles = [F.round(c, 9) if kind == "double" else F.col(c) for c, kind in joined.dtypes]
        assert sorted(map(str, joined.select(doubles).collect())) == sorted(map(str, wide.select(doubles).collect()))
    for table in [*served.list_tables(spark, "once_*"), *served.list_tables(spark, "wide_*")]:
        spark.sql(f"drop table {table}")
    fitted, reports = jobs.train(spark, folder + "/model", unique_ids=True, num_trees=3, max_depth=3)
    assert 0.3 < reports["metrics"].first()["accuracy"] <= 1.0
    assert reports["importance"].count() == 10
    assert reports["confusion"].agg(F.sum("n")).first()[0] == reports["metrics"].first()["n"]
    halves = [silver.read_silver(spark, name) for name in ("accidents", "weather")]
    apart, whole = (
        sorted(map(str, df.select(sorted(df.columns)).collect()))
        for df in (
            features.feature_table(*halves, impute=False, unique_ids=True),
            features.feature_rows(silver.read_silver(spark, "records"), impute=False),
        )
    )
    assert apart == whole
    for table in ("accidents", "weather", "rejects", "records"):
        spark.sql(f"drop table if exists {table}")


def test_arguments_are_checked():
    with pytest.raises(SystemExit):
        jobs.main(["ingest", "--layout", "other", "--base", "x", "p"])
    with pytest.raises(SystemExit):
        jobs.main([])


def test_ingest_counts_and_files_misfits(spark, folder):
    one = f"{folder}/one.csv"
    with open(one, "w") as out:
        out.write("ID,Severity,situation_date\nA,2,01-01-2025\nB,oops,01-01-2025\nC,1\n")
    done = jobs.ingest(spark, [one], folder + "/bronze")
    assert [d[1:] for d in done] == [(3, 1, 1)]
    kept = spark.read.parquet(glob.glob(folder + "/bronze-misfits/*")[0])
    assert {r["ID"]: (r["bad_fields"], r["bad_row"]) for r in kept.collect()} == {"B": (["Severity"], None), "C": ([], "C,1")}


def test_daily_silver_keeps_earlier_rejects_and_the_session_as_it_is(spark, folder):
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    records = bronze_records(spark, FOLDER).limit(20)
    for day in ("nowhen", "someday"):
        part = records.withColumn("situation_date", F.when(F.col("ID").isNotNull() & (F.hash("ID") % 2 == 0), F.lit(day)).otherwise(F.lit("05-01-2024")))
        jobs.build_silver(spark, part.withColumn("City", F.lit(day)), mode="overwrite_days", folder=folder)
    assert {r["city"] for r in spark.table("rejects").collect()} == {"nowhen", "someday"}
    assert {r["city"] for r in spark.table("accidents").collect()} == {"someday"}
    assert spark.conf.get(setting) == before
    for table in ("accidents", "weather", "rejects"):
        spark.sql(f"drop table if exists {table}")


def test_refreshed_silver_equals_a_full_build(spark, folder):
    base, columns = folder + "/bronze", "ID string, Severity int, City string, situation_date string"
    feeds = [
        [("A", 1, "x", "01-01-2025"), ("B", 1, "x", "02-01-2025"), ("C", 1, "x", "02-01-2025"), ("D", 1, "x", "no day"),
         (None, 1, "x", "01-01-2025"), ("E", 1, "x", "none")],
        [("A", 2, "y", "03-01-2025"), ("C", 2, "y", "no day"), ("D", 2, "y", "02-01-2025"), ("E", 2, "y", "no day")],
        [("B", 3, "z", "04-01-2025"), ("C", 3, "z", "04-01-2025"), ("D", 3, "z", "04-01-2025"), ("F", 3, "z", "no day")],
    ]
    declared = spark.createDataFrame([], bronze_schema())
    touched = []
    for number, rows in enumerate(feeds):
        feed = declared.unionByName(spark.createDataFrame(rows, columns), allowMissingColumns=True)
        at = snapshots.append_delta(feed, base, feed=str(number))
        for _ in range(2):
            since = date.fromisoformat(at.rpartition("/")[2])
            days = jobs.refresh_silver(spark, base, since, True, folder + "/daily", "daily_", True)
            touched.append([d.day for d in days])
            if len(touched) % 2:
                # one run over the halves, one over the unsplit records
                written = jobs.refresh_marts(spark, days or None, "kept_", folder + "/kept", "daily_", wide=number == 2)
    assert touched == [[], [1, 2], [1, 2, 3], [2, 3], [2, 4], [4]]
    jobs.build_silver(spark, jobs.read_bronze(spark, base), True, folder=folder + "/full", prefix="full_", wide=True)
    for name in ("accidents", "weather", "records", "rejects"):
        daily, full = (sorted(map(str, spark.table(kind + name).collect())) for kind in ("daily_", "full_"))
        assert daily == full
        assert sorted(map(str, spark.read.schema(spark.table("daily_" + name).schema).parquet(table_folder(spark, "daily_" + name)).collect())) == full
    assert not glob.glob(folder + "/daily/daily_accidents/year=2025/month=1/day=2/*.parquet")
    fresh = marts.build_marts(spark.table("daily_accidents"), spark.table("daily_weather"), unique_ids=True)
    assert written == ["kept_" + name for name in fresh]
    for name, df in fresh.items():
        kept = spark.table("kept_" + name)
        assert kept.dtypes == df.dtypes
        assert sorted(map(str, kept.collect())) == sorted(map(str, df.collect()))
    states = spark.table("kept_" + jobs.STATES)
    assert {r[0].day for r in states.select("situation_date").distinct().collect()} == {1, 3, 4}
    plan = silver.read_silver(spark, "daily_accidents", days=[date(2025, 1, 3)])._jdf.queryExecution().executedPlan().toString()
    assert "make_date" in plan.partition("PartitionFilters: [")[2].partition("]")[0]
    for name in [*written, "kept_" + jobs.STATES]:
        spark.sql(f"drop table {name}")
    for name in ("accidents", "weather", "records", "rejects"):
        spark.sql(f"drop table daily_{name}")
        spark.sql(f"drop table full_{name}")


def test_repeated_ids_are_not_taken_for_unique(spark):
    require_unique(spark.createDataFrame([("a",), (None,), (None,)], "id string"), "id")
    with pytest.raises(RepeatedIds, match="1 ids .* b"):
        require_unique(spark.createDataFrame([("a",), ("b",), ("b",)], "id string"), "id")


def test_silver_since_needs_the_delta_layout():
    with pytest.raises(SystemExit):
        jobs.main(["silver", "--base", "x", "--since", "2025-01-01", "--layout", "cumulative"])
