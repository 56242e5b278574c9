"""Marts on small frames, invariants on the whole tables, plans, model and streams."""

from datetime import date, datetime

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

import __spark_entry__ as contract
from roadlens.functions.fill import column_means
from roadlens.plans import features, marts, model
from roadlens.schema import MODEL_CATEGORIES, bronze_schema, silver_schema, to_silver
from roadlens.sources.star_schema import bronze_records, silver_halves, silver_records
from roadlens.sources.storage import scratch_path
from roadlens.streaming import daily, ingest
from roadlens.streaming import score as scoring

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def halves(spark):
    return tuple(df.cache() for df in silver_halves(spark, FOLDER))


def test_dedupe_changes_the_average_as_stated(spark):
    a = spark.createDataFrame(
        [("a", date(2025, 1, 1), 1), ("a", date(2025, 1, 1), 1), ("b", date(2025, 1, 1), 4)],
        "id string, situation_date date, severity int",
    )
    w = spark.createDataFrame(
        [("a", date(2025, 1, 1), "Rain")] * 2 + [("b", date(2025, 1, 1), "Rain")],
        "id string, situation_date date, weather_condition string",
    )
    raw = marts.mart_weather_condition(a, w).first()
    clean = marts.mart_weather_condition(a, w, dedupe=True).first()
    assert (raw.accident_count, raw.avg_severity) == (2, 1.6)
    assert (clean.accident_count, clean.avg_severity) == (2, 2.5)


def test_wide_impact_equals_the_join(spark):
    rows = [("a", date(2025, 1, 1), 1, 20.0, 0.5, 3.0), ("b", date(2025, 1, 1), 4, 25.0, 0.2, None),
            ("c", date(2025, 1, 2), 2, 90.0, 9.0, 8.0), ("d", date(2025, 1, 2), 2, None, 9.0, 8.0), (None, None, 3, 90.0, 9.0, 1.0)]
    records = spark.createDataFrame(
        rows, "id string, situation_date date, severity int, temperature_f double, visibility_mi double, wind_speed_mph double"
    )
    joined, wide = marts.mart_weather_impact(records.drop(*records.columns[3:]), records.drop("severity")), marts.wide_weather_impact(records)
    assert wide.columns == joined.columns and wide.collect() == joined.collect()
    assert [tuple(r) for r in wide.collect()] == [("Freezing", "Poor", 2, 2.5, 3.0), ("Hot", "Good", 1, 2.0, 8.0)]


def test_invariants(halves):
    accidents, _ = halves
    timed = accidents.where("start_time is not null").agg(F.countDistinct("id")).first()[0]
    assert marts.mart_time_patterns(accidents).agg(F.sum("accident_count")).first()[0] == timed
    shares = marts.mart_severity(accidents).agg(F.sum("percentage")).first()[0]
    assert abs(float(shares) - 100) <= 0.05


def test_one_pass_equals_the_single_marts(halves):
    accidents, _ = halves
    together = marts.marts_one_pass(accidents).cache()
    for name, single, keys in (
        ("daily", marts.mart_daily(accidents), ["accident_date"]),
        ("severity", marts.mart_severity(accidents), ["Severity"]),
        ("location", marts.mart_location(accidents, n=1000), ["State", "City"]),
        ("time_patterns", marts.mart_time_patterns(accidents), ["hour_of_day", "day_of_week"]),
    ):
        cols = [*keys, "accident_count"]
        part = together.where(F.col("mart") == name).select(*cols)
        assert sorted(map(str, part.collect())) == sorted(map(str, single.select(*cols).collect()))


def test_unique_ids_give_the_same_marts(halves):
    once = [df.dropDuplicates(["id"]).cache() for df in halves]
    careful, quick = marts.build_marts(*once), marts.build_marts(*once, unique_ids=True)
    for name in careful:
        if name not in ("accidents", "weather"):
            got = [sorted(map(str, tables[name].collect())) for tables in (careful, quick)]
            assert got[0] == got[1], name


def test_empty_input_gives_empty_marts(halves):
    a, w = (df.limit(0) for df in halves)
    for name, df in marts.build_marts(a, w).items():
        assert df.count() == (1 if name == "road_infrastructure_summary" else 0), name


@pytest.mark.parametrize("name", ["mart_daily", "mart_location", "mart_weather_impact", "feature_rows", "quality_report"])
def test_no_python_in_the_plan(spark, name):
    text = contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert node not in text


def test_marts_read_only_their_columns(spark, folder, halves):
    halves[0].write.parquet(folder + "/a")
    text = marts.mart_severity(spark.read.parquet(folder + "/a"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string,severity:int>" in text
    assert "PushedFilters: [IsNotNull(severity)]" in text


# ---------------------------------------------------------------- model


def separable(spark, n=400):
    return spark.range(n).select(
        F.concat(F.lit("r"), "id").alias("id"),
        F.when(F.col("id") % 2 == 0, 4).otherwise(1).alias("severity"),
        F.lit(datetime(2025, 1, 1, 8)).cast("timestamp_ntz").alias("start_time"),
        F.lit(1.0).alias("start_lng"), F.lit(2.0).alias("start_lat"),
        F.when(F.col("id") % 2 == 0, "X").otherwise("Y").alias("state"), F.lit("c").alias("city"),
        *[(F.col("id") % 3 == 0).alias(c) for c in features.MODEL_FLAGS],
        *[F.lit("Day").alias(c) for c in features.MODEL_TWILIGHT],
        *[F.when(F.col("id") % 5 > 0, F.col("id") % 7).cast("double").alias(c) for c in features.MODEL_WEATHER],
        F.lit("Rain").alias("weather_condition"),
    )


@pytest.fixture(scope="module")
def fitted(spark):
    rows = features.feature_rows(separable(spark), impute=False).cache()
    train, test = features.split_train_test(rows)
    return model.train_classifier(train, num_trees=5, max_depth=3), train, test


def test_split_is_by_id_and_whole(spark, fitted):
    _, train, test = fitted
    assert train.count() + test.count() == 400
    assert train.join(test, "id").count() == 0
    assert 0.7 < train.count() / 400 < 0.9


def test_model_learns_and_measures_agree(spark, fitted):
    trained, train, test = fitted
    predictions = model.score(trained, test)
    measured = model.evaluate(model.confusion_matrix(predictions)).first()
    assert measured["accuracy"] > 0.95 and measured["n"] == test.count()
    weak = model.score(trained, test).withColumn(
        "prediction", F.when(F.col("humidity") > 3, 1.0 - F.col("prediction")).otherwise(F.col("prediction"))
    )
    ours = model.evaluate(model.confusion_matrix(weak)).first()
    for metric in ("accuracy", "f1"):
        theirs = MulticlassClassificationEvaluator(labelCol="severity_binary", metricName=metric).evaluate(weak)
        assert ours[metric] == pytest.approx(theirs)


def test_same_seed_same_matrix(spark, fitted):
    trained, train, test = fitted
    again = model.train_classifier(train, num_trees=5, max_depth=3)
    matrices = [sorted(map(tuple, model.confusion_matrix(model.score(m, test)).collect())) for m in (trained, again)]
    assert matrices[0] == matrices[1]


def test_importance_is_named_and_sorted(spark, fitted):
    trained, _, test = fitted
    rows = model.feature_importance(trained, model.score(trained, test), k=5).collect()
    assert len(rows) == 5 and rows[0]["feature"].startswith("state_encoded")
    values = [r["importance"] for r in rows]
    assert values == sorted(values, reverse=True)


def test_unseen_category_and_missing_time_score(spark, fitted, folder):
    trained, _, test = fitted
    odd = test.limit(1).withColumns({
        "state": F.lit("never seen"), "hour": F.lit(None).cast("int"),
        "day_of_week": F.lit(None).cast("int"), "month": F.lit(None).cast("int"),
        "start_lat": F.lit(None).cast("double"),
    })
    row = model.score(trained, odd).first()
    assert row["prediction"] in (0.0, 1.0)
    assert row["state_indexed"] == 2.0 and row["state_encoded"].numNonzeros() == 0
    path = folder + "/model"
    model.save_model(trained, path)
    model.save_model(trained, path)
    loaded = model.load_model(path)
    assert model.score(loaded, odd).first()["prediction"] == row["prediction"]


def test_top_predictions(fitted):
    trained, _, test = fitted
    rows = model.top_predictions(model.score(trained, test), 7).collect()
    assert len(rows) == 7 and all(r["prediction"] == 1.0 for r in rows)


def test_copies_weigh_in_training(spark):
    rows = features.feature_rows(separable(spark, 100), impute=False).withColumn("copies", F.lit(2.0))
    assert model.train_classifier(rows, num_trees=2, max_depth=2).stages[-1].getOrDefault("weightCol") == "copies"


def test_rows_that_stand_for_several_weigh_the_same_as_their_copies(spark):
    counted = features.feature_rows(separable(spark, 60), impute=False).withColumn(
        "copies", (F.abs(F.hash("id")) % 4 + 1).cast("bigint")
    )
    plain = counted.withColumn("c", F.explode(F.expr("sequence(1, copies)"))).drop("c", "copies")
    ready, plain_ready = model.ready(counted), model.ready(plain)
    index = [one.labels for one in model.weighted_index(ready)]
    for name, ours, theirs in zip(MODEL_CATEGORIES, index, model.index_categories().fit(plain_ready).labelsArray):
        n = {r[0]: r["count"] for r in plain_ready.groupBy(name).count().collect()}
        assert [n[label] for label in ours] == [n[label] for label in theirs] and set(ours) == set(theirs)
    means = column_means(plain_ready, model.READINGS).first()
    filled = model.weighted_means(ready).transform(ready.limit(1).withColumns({c: F.lit(None).cast("double") for c in model.READINGS})).first()
    assert all(filled[f"{c}_filled"] == pytest.approx(means[c] or 0.0) for c in model.READINGS)
    rule = (F.hash("id", "state") % 2 == 0).cast("double").alias("prediction")
    matrices = [sorted(map(tuple, model.confusion_matrix(df.select("*", rule)).collect())) for df in (counted, plain)]
    assert matrices[0] == matrices[1]


def test_unlabelled_rows_are_not_measured(spark):
    rows = spark.createDataFrame([(1, 1, 1.0), (None, 0, 1.0), (2, 0, 0.0)], "severity int, severity_binary int, prediction double")
    assert sum(r["n"] for r in model.confusion_matrix(rows).collect()) == 2


def test_tune(spark, fitted):
    _, train, _ = fitted
    best = model.tune(train, num_trees=[2], max_depth=[1, 3], folds=2)
    assert len(best.avgMetrics) == 2


# ---------------------------------------------------------------- streams


def record(spark, *rows):
    made = spark.createDataFrame(list(rows), "ID string, situation_date string, at string, Severity int")
    names = {"Start_Time": F.col("at").cast("timestamp_ntz")}
    from roadlens.schema import RECORD_COLUMNS

    return made.select(*[
        (names.get(n) if n in names else F.col(n) if n in made.columns else F.lit(None)).cast(kind).alias(n)
        for n, _, kind in RECORD_COLUMNS
    ])


def test_ingest_lands_each_id_once_over_restarts(spark, folder):
    landing, store, offsets = (f"{folder}/{n}" for n in ("in", "store", "offsets"))
    batches = [
        [("a", "31-01-2025", None, 1), ("a", "01-02-2025", None, 2), (None, "01-01-2025", None, 7)],
        [("a", "03-02-2025", None, 3), ("b", "03-02-2025", None, 4), (None, "01-01-2025", None, 7)],
    ]
    for rows in batches:
        record(spark, *rows).write.mode("append").parquet(landing)
        stream = to_silver(ingest.feed(spark, landing, bronze_schema()))
        ingest.stream_ingest(stream, ["id"], ["situation_date"], store, offsets).awaitTermination()
    expected = sorted(map(str, [("a", 3), ("b", 4), (None, 7), (None, 7)]))  # the newest, as the batch has it

    def got():
        rows = ingest.read_store(spark, store, silver_schema(), ["id"], ["situation_date"]).collect()
        return sorted(str((r["id"], r["severity"])) for r in rows)

    assert got() == expected
    ingest.compact_store(spark, store, silver_schema(), ["id"], ["situation_date"])
    assert got() == expected


def test_a_new_checkpoint_with_a_new_feed_keeps_what_has_landed(spark, folder):
    store = f"{folder}/store"
    for name in ("a", "b", "c"):
        landing = f"{folder}/in-{name}"
        record(spark, (name, "01-01-2025", None, 1)).write.parquet(landing)
        stream = to_silver(ingest.feed(spark, landing, bronze_schema()))
        ingest.stream_ingest(stream, ["id"], [], store, f"{folder}/offsets-{name}").awaitTermination()
    assert sorted(r["id"] for r in ingest.read_store(spark, store, silver_schema()).collect()) == ["a", "b", "c"]


def test_ingest_repeats_a_batch_without_doubling(spark, folder):
    landing, store = f"{folder}/in", f"{folder}/store"
    record(spark, ("a", "01-01-2025", None, 1)).write.parquet(landing)
    for offsets in ("first", "lost_and_started_again"):
        stream = to_silver(ingest.feed(spark, landing, bronze_schema()))
        ingest.stream_ingest(stream, ["id"], [], store, f"{folder}/{offsets}").awaitTermination()
    assert ingest.read_store(spark, store, silver_schema()).count() == 1


def test_empty_store_reads_empty(spark, folder):
    assert ingest.read_store(spark, folder + "/none", "id string").count() == 0


def test_daily_counts_equal_the_batch_mart(spark, folder):
    landing = scratch_path(spark, "landing")
    bronze_records(spark, FOLDER).write.parquet(landing)
    stream = to_silver(ingest.feed(spark, landing, bronze_schema(), files_per_trigger=1))
    daily.stream_daily_counts(stream, folder + "/days", folder + "/offsets").awaitTermination()
    got = {tuple(r) for r in daily.daily_counts(spark, folder + "/days").collect()}
    batch = marts.mart_daily(silver_records(spark, FOLDER)).where("accident_date is not null")
    assert got == {tuple(r) for r in batch.collect()}


def test_closed_days_drop_late_records(spark, folder):
    landing, out, offsets = (f"{folder}/{n}" for n in ("in", "out", "offsets"))
    batches = [
        [("a", "x", "2025-01-01 10:00:00", 1), ("a", "x", "2025-01-01 10:00:00", 1),
         ("b", "x", "2025-01-01 11:00:00", 1), ("c", "x", "2025-01-04 00:00:00", 1)],
        [("late", "x", "2025-01-01 12:00:00", 1), ("d", "x", "2025-01-07 00:00:00", 1)],
    ]
    for rows in batches:
        record(spark, *rows).write.mode("append").parquet(landing)
        closed = daily.daily_counts_closed(to_silver(ingest.feed(spark, landing, bronze_schema())))
        writer = closed.writeStream.format("parquet").option("path", out).outputMode("append")
        writer.option("checkpointLocation", offsets).trigger(availableNow=True).start().awaitTermination()
    got = {(str(r[0]), r[1]) for r in spark.read.parquet(out).collect()}
    assert got == {("2025-01-01", 2), ("2025-01-04", 1)}


def test_large_feature_tables_are_dealt_out_and_small_ones_kept(spark, monkeypatch):
    rows = spark.range(0, 3000, 1, 1).withColumn("v", F.col("id") * 2)
    assert model.feature_store(rows).rdd.getNumPartitions() == 1
    monkeypatch.setattr(model, "ROWS_AT_ONCE", 100)
    dealt = model.feature_store(rows)
    sizes = [r[0] for r in dealt.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).select("n").collect()]
    assert len(sizes) >= 30 and max(sizes) <= 110
    assert sorted(map(tuple, dealt.collect())) == [(i, 2 * i) for i in range(3000)]


def test_forest_keeps_the_place_of_rows_between_levels(spark):
    forest = model.severity_pipeline().getStages()[-1]
    assert forest.getCacheNodeIds() and (forest.getNumTrees(), forest.getMaxDepth()) == (100, 10)


def test_stream_is_scored_in_more_tasks_than_files(spark, folder, fitted):
    trained, _, _ = fitted
    bronze_records(spark, FOLDER).coalesce(1).write.parquet(folder + "/in")
    stream = to_silver(ingest.feed(spark, folder + "/in", bronze_schema()))
    query = scoring.stream_score(trained, stream, folder + "/out", folder + "/offsets")
    query.awaitTermination()
    assert spark.read.parquet(folder + "/out").groupBy(F.input_file_name()).count().count() > 1


def test_stream_scores_equal_batch_scores(spark, folder, fitted):
    trained, _, _ = fitted
    landing = folder + "/in"
    bronze_records(spark, FOLDER).write.parquet(landing)
    stream = to_silver(ingest.feed(spark, landing, bronze_schema()))
    scoring.stream_score(trained, stream, folder + "/out", folder + "/offsets").awaitTermination()
    streamed = spark.read.schema(scoring.SCORED).parquet(folder + "/out")
    batch = scoring.scored(trained, silver_records(spark, FOLDER))
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))
