"""Feeds, snapshots, silver and served tables."""

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from roadlens.errors import CommitConflict, NoSharedFolder, NoSnapshotDate, UnknownTable
from roadlens.sources import served, silver, snapshots, tables
from roadlens.sources.commits import CommitLog
from roadlens.sources.delimited import read_raw_csv
from roadlens.sources.storage import Folder, materialize, scratch_path, shared_folder
from roadlens.schema import PARTITION_COLUMNS


def feed(spark, *pairs):
    return spark.createDataFrame(list(pairs), "ID string, situation_date string")


def ids(df):
    return sorted(r["ID"] for r in df.collect())


# ---------------------------------------------------------------- delimited


def write(folder, name, text):
    path = f"{folder}/{name}"
    with open(path, "w") as out:
        out.write(text)
    return path


def test_csv_parts_match_by_name_and_keep_declared_types(spark, folder):
    one = write(folder, "1.csv", "ID,Severity,Zipcode,Start_Time\nA-1,3,43065,2016-02-08 05:46:00\n")
    two = write(
        folder, "2.csv",
        "Zipcode,ID,Severity,Start_Time\n43065-1234,A-2,oops,2016-02-08 06:07:59.000000000\n",
    )
    df = read_raw_csv(spark, [one, two])
    assert dict(df.dtypes)["Zipcode"] == "string" and dict(df.dtypes)["Severity"] == "int"
    first, second = df.orderBy("ID").collect()
    assert (first["Zipcode"], first["Severity"], first["bad_fields"]) == ("43065", 3, [])
    assert (second["Zipcode"], second["Severity"]) == ("43065-1234", None)
    assert second["bad_fields"] == ["Severity"]
    assert str(second["Start_Time"]) == "2016-02-08 06:07:59"
    assert first["Temperature(F)"] is None
    with pytest.raises(PySparkException):
        read_raw_csv(spark, [one, two], mode="failfast").collect()


def test_a_part_with_another_header_is_an_error(spark, folder):
    write(folder, "a.csv", "ID,Severity\nA-1,3\n")
    write(folder, "b.csv", "Severity,ID\n3,A-2\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_raw_csv(spark, folder).collect()


def test_rows_of_another_length_are_named_and_fail_fast(spark, folder):
    path = write(
        folder, "c.csv",
        'ID,Severity,Street,City\nA-1,3,Main,X\nshort,2\nlong,1,Elm,Y,more\nA-4,4,"two\nlines",Z\n',
    )
    found = {r["ID"]: r["bad_row"] for r in read_raw_csv(spark, path).collect()}
    assert found["A-1"] is None and found["short"] == "short,2" and found["long"] == "long,1,Elm,Y,more"
    assert sum(v is not None for v in found.values()) == 4
    whole = {r["ID"]: (r["Street"], r["bad_row"]) for r in read_raw_csv(spark, path, multi_line=True).collect()}
    assert whole["A-4"] == ("two\nlines", None) and set(whole) == {"A-1", "short", "long", "A-4"}
    for bad in ("ID,Severity\nA-1\n", "ID,Severity\nA-1,2,3\n"):
        with pytest.raises(Exception, match="MALFORMED"):
            read_raw_csv(spark, write(folder, "d.csv", bad), mode="failfast").collect()


# ---------------------------------------------------------------- snapshots


@pytest.mark.parametrize("append", [snapshots.append_delta, snapshots.append_snapshot])
def test_feeds_of_one_day_and_late_feeds_are_all_kept(spark, folder, append):
    base = folder + "/bronze"
    feeds = [
        feed(spark, ("a", "01-01-2025"), ("b", "03-01-2025")),
        feed(spark, ("c", "03-01-2025")),
        feed(spark, ("d", "04-01-2025"), ("d", "04-01-2025")),
        feed(spark, ("late", "02-01-2025")),
        feed(spark, ("c", "03-01-2025")),
    ]
    for one in feeds:
        append(one, base)
    append(feed(spark, ("named", "03-01-2025")), base, feed="part/1.csv")
    append(feed(spark, ("named again", "03-01-2025")), base, feed="part/1.csv")
    read = snapshots.read_as_of if append is snapshots.append_delta else snapshots.read_snapshot
    assert ids(read(spark, base)) == ["a", "b", "c", "d", "d", "late", "named again"]
    assert ids(read(spark, base, date(2025, 1, 3))) == ["a", "b", "c", "late", "named again"]


def test_a_reader_at_any_step_sees_one_whole_version(spark, folder, monkeypatch):
    """A feed of three rows replaced by five while someone reads before and after each step."""
    base = folder + "/bronze"
    snapshots.append_delta(feed(spark, *[(f"old{i}", "01-01-2025") for i in range(3)]), base, feed="f1")
    seen = []

    def watched(name):
        step = getattr(CommitLog, name)

        def run(*args):
            seen.append(ids(snapshots.read_as_of(spark, base)))
            out = step(*args)
            seen.append(ids(snapshots.read_as_of(spark, base)))
            return out

        monkeypatch.setattr(CommitLog, name, run)

    for name in ("stage", "put"):
        watched(name)
    held = snapshots.read_as_of(spark, base)
    snapshots.append_delta(feed(spark, *[(f"new{i}", "01-01-2025") for i in range(5)]), base, feed="f1")
    old, new = [f"old{i}" for i in range(3)], [f"new{i}" for i in range(5)]
    assert seen == [old, old, old, new]
    assert ids(held) == old  # the folders of a version stay
    assert snapshots.sweep(spark, base, keep=1, grace=0) == 1
    assert ids(snapshots.read_as_of(spark, base)) == new


@pytest.mark.parametrize("step", ["stage", "put"])
def test_a_writer_that_breaks_off_loses_nothing(spark, folder, monkeypatch, step):
    base = folder + "/bronze"
    for append, day in ((snapshots.append_snapshot, 1), (snapshots.append_snapshot, 3)):
        append(feed(spark, (f"d{day}", f"0{day}-01-2025")), base)
    plain, calls = getattr(CommitLog, step), []

    def broken(self, *args):
        calls.append(1)
        if len(calls) == (1 if step == "put" else 2):
            raise OSError("gone")
        return plain(self, *args)

    monkeypatch.setattr(CommitLog, step, broken)
    with pytest.raises(OSError, match="gone"):
        snapshots.append_snapshot(feed(spark, ("late", "02-01-2025")), base)
    monkeypatch.setattr(CommitLog, step, plain)
    assert ids(snapshots.read_snapshot(spark, base)) == ["d1", "d3"]
    snapshots.append_snapshot(feed(spark, ("late", "02-01-2025")), base)
    assert ids(snapshots.read_snapshot(spark, base)) == ["d1", "d3", "late"]
    assert ids(snapshots.read_snapshot(spark, base, date(2025, 1, 2))) == ["d1", "late"]
    assert snapshots.sweep(spark, base) == 0  # young folders stay


def test_writers_side_by_side_lose_no_feed(spark, folder, monkeypatch):
    base, plain, others = folder + "/bronze", CommitLog.put, []

    def overtaken(self, number, parts):
        if not others:
            others.append(1)
            snapshots.append_delta(feed(spark, ("other", "01-01-2025")), base)
        return plain(self, number, parts)

    monkeypatch.setattr(CommitLog, "put", overtaken)
    snapshots.append_delta(feed(spark, ("own", "01-01-2025")), base)
    assert ids(snapshots.read_as_of(spark, base)) == ["other", "own"]
    assert CommitLog(spark, base).numbers() == [1, 2]
    assert not CommitLog(spark, base).put(2, {})
    monkeypatch.setattr(CommitLog, "put", lambda *_: False)
    with pytest.raises(CommitConflict):
        snapshots.append_delta(feed(spark, ("never", "01-01-2025")), base)


def test_folders_of_days_put_there_by_others_are_read(spark, folder):
    base = folder + "/bronze"
    feed(spark, ("a", "01-01-2025")).write.parquet(base + "/2025-01-01")
    feed(spark, ("b", "02-01-2025")).write.parquet(base + "/2025-01-02/feed-x")
    assert ids(snapshots.read_as_of(spark, base)) == ["a", "b"]
    snapshots.append_delta(feed(spark, ("c", "01-01-2025")), base)
    assert ids(snapshots.read_as_of(spark, base)) == ["a", "b", "c"]
    snapshots.append_delta(feed(spark, ("d", "02-01-2025")), base, feed="x")
    assert ids(snapshots.read_as_of(spark, base)) == ["a", "c", "d"]


def test_latest_day_is_not_the_largest_text(spark):
    df = feed(spark, ("a", "31-01-2025"), ("b", "01-02-2025"), ("c", "2025-13-40"), ("d", None))
    assert snapshots.latest_situation_date(df).first()[0] == date(2025, 2, 1)
    with pytest.raises(NoSnapshotDate):
        snapshots.snapshot_date(feed(spark, ("a", "soon")))


def test_cumulative_snapshots_bridge_a_gap(spark, folder):
    base = folder + "/bronze"
    assert snapshots.previous_snapshot(spark, base, date(2025, 1, 1)) is None
    snapshots.append_snapshot(feed(spark, ("a", "01-01-2025")), base)
    later = feed(spark, ("b", "04-01-2025"))
    path = snapshots.append_snapshot(later, base)
    assert path.endswith("/2025-01-04")
    assert ids(snapshots.read_snapshot(spark, base)) == ["a", "b"]
    snapshots.append_snapshot(later, base)  # the same day again
    assert ids(snapshots.read_snapshot(spark, base)) == ["a", "b"]
    snapshots.append_snapshot(later, base, lookback="previous_day")
    assert ids(snapshots.read_snapshot(spark, base)) == ["b"]
    assert ids(snapshots.read_snapshot(spark, base, date(2025, 1, 1))) == ["a"]
    assert [d.day for d in snapshots.snapshot_days(spark, base)] == [1, 4]
    assert not [n for n in Folder(spark, base).names() if n.startswith("_staged")]


def test_a_snapshot_contains_the_one_before(spark, folder):
    base = folder + "/bronze"
    for day in range(1, 4):
        snapshots.append_snapshot(feed(spark, (f"r{day}", f"0{day}-01-2025")), base)
    sizes = [snapshots.read_snapshot(spark, base, date(2025, 1, d)).count() for d in (1, 2, 3)]
    assert sizes == [1, 2, 3]


def test_an_unreadable_history_is_not_an_empty_one(spark, folder):
    base = folder + "/bronze"
    _folder_with_junk(base + "/2025-01-01")
    with pytest.raises(Exception, match="CANNOT_READ_FILE|not a Parquet file"):
        snapshots.append_snapshot(feed(spark, ("b", "02-01-2025")), base)


def _folder_with_junk(folder):
    import os

    os.makedirs(folder)
    write(folder, "part-0.parquet", "not parquet")


def test_new_columns_and_orders_are_matched_by_name(spark, folder):
    base = folder + "/bronze"
    snapshots.append_snapshot(feed(spark, ("a", "01-01-2025")), base)
    wider = spark.createDataFrame([("02-01-2025", "b", 1)], "situation_date string, ID string, n int")
    snapshots.append_snapshot(wider, base)
    rows = {r["ID"]: r["n"] for r in snapshots.read_snapshot(spark, base).collect()}
    assert rows == {"a": None, "b": 1}


def test_delta_snapshots(spark, folder):
    base = folder + "/delta"
    snapshots.append_delta(feed(spark, ("a", "31-01-2025")), base)
    snapshots.append_delta(feed(spark, ("b", "01-02-2025"), ("x", "bad")), base)
    wider = spark.createDataFrame([("c", "03-02-2025", 1)], "ID string, situation_date string, n int")
    snapshots.append_delta(wider, base)
    assert ids(snapshots.read_as_of(spark, base, date(2025, 1, 31))) == ["a"]
    assert ids(snapshots.read_as_of(spark, base, date(2025, 2, 2))) == ["a", "b", "x"]
    everything = snapshots.read_as_of(spark, base)
    assert ids(everything) == ["a", "b", "c", "x"] and "n" in everything.columns
    assert snapshots.read_as_of(spark, base, schema="ID string").columns == ["ID"]
    with pytest.raises(NoSnapshotDate):
        snapshots.append_delta(feed(spark, ("z", "bad")), base)
    with pytest.raises(UnknownTable):
        snapshots.read_as_of(spark, base, date(2020, 1, 1))
    with pytest.raises(UnknownTable):
        snapshots.read_snapshot(spark, base, date(2020, 1, 1))


# ---------------------------------------------------------------- silver


def bronze(spark):
    return spark.createDataFrame(
        [("a", "31-01-2025", 3, 40.0), ("b", "01-02-2025", 2, None), ("c", "2025-13-40", 1, 1.0),
         ("d", None, 1, 1.0)],
        "ID string, situation_date string, Severity int, `Temperature(F)` double",
    )


def wide_bronze(spark):
    from roadlens.schema import RECORD_COLUMNS

    df = bronze(spark)
    for name, _, kind in RECORD_COLUMNS:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def test_silver_tables_and_rejects(spark):
    tables = silver.silver_tables(wide_bronze(spark))
    assert sorted(r.id for r in tables["rejects"].collect()) == ["c", "d"]
    for name, width in (("accidents", 40), ("weather", 15)):
        assert len(tables[name].columns) == width
        assert tables[name].columns[-3:] == PARTITION_COLUMNS
    whole = tables["accidents"].join(tables["weather"].select("id", "temperature_f"), "id")
    got = {r.id: (r.severity, r.temperature_f, r.month) for r in whole.collect()}
    assert got == {"a": (3, 40.0, 1), "b": (2, None, 2)}


def test_dedupe_goes_by_day_not_by_text(spark):
    twice = wide_bronze(spark).withColumn("ID", F.lit("same"))
    rows = silver.silver_tables(twice, dedupe=True)
    assert [r.severity for r in rows["accidents"].collect()] == [2]  # 01-02-2025 after 31-01-2025
    assert rows["rejects"].count() == 0


def test_write_read_and_prune(spark, folder):
    tables = silver.silver_tables(wide_bronze(spark))
    silver.write_silver(tables["weather"], "t_weather", path=folder + "/w")
    assert silver.read_silver(spark, "t_weather").count() == 2
    some = silver.read_silver(spark, "t_weather", since=date(2025, 2, 1))
    assert [r.id for r in some.collect()] == ["b"]
    text = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text and "make_date" in text
    assert silver.read_silver(spark, "t_weather", until=date(2025, 1, 31)).first().id == "a"
    with pytest.raises(UnknownTable):
        silver.read_silver(spark, "t_absent")


def test_a_hot_day_is_split_over_files(spark, folder):
    import glob

    many = spark.range(400_000, numPartitions=8).select(
        F.uuid().alias("id"), F.lit(2025).alias("year"), F.lit(1).alias("month"), F.lit(31).alias("day")
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1MB")
    try:
        silver.write_silver(many, "t_hot", path=folder + "/h")
    finally:
        spark.conf.set(size, before)
    assert len(glob.glob(folder + "/h/year=2025/month=1/day=31/*.parquet")) > 1


def test_overwrite_days_leaves_other_days(spark, folder):
    weather = silver.silver_tables(wide_bronze(spark))["weather"]
    silver.write_silver(weather, "t_days", path=folder + "/w", mode="overwrite_days")
    silver.write_silver(
        weather.where("id = 'b'").withColumn("id", F.lit("b2")), "t_days", mode="overwrite_days"
    )
    assert sorted(r.id for r in silver.read_silver(spark, "t_days").collect()) == ["a", "b2"]


def test_a_day_is_written_in_few_files(spark, folder):
    import glob

    weather = silver.silver_tables(wide_bronze(spark))["weather"].repartition(20)
    silver.write_silver(weather, "t_files", path=folder + "/w")
    assert len(glob.glob(folder + "/w/year=*/month=*/day=*/*.parquet")) == 2


# ---------------------------------------------------------------- served


def failing(df):
    """``df`` in a frame that fails in a task."""
    return df.withColumn("k", F.when(F.col("k") >= 0, F.raise_error(F.lit("broken"))).otherwise(F.col("k")).cast("int"))


@pytest.mark.parametrize("placed", [True, False])
def test_a_write_that_fails_leaves_the_table(spark, folder, placed):
    name = f"kept_{placed}".lower()
    path = f"{folder}/kept" if placed else None
    df = spark.createDataFrame([(i, 2025, 1, 1 + i % 2) for i in range(10)], "k int, year int, month int, day int")
    for write in (served.write_mart, silver.write_silver):
        write(df, name, path)
        with pytest.raises(PySparkException, match="broken"):
            write(failing(df), name, path)
        assert served.read_mart(spark, name).count() == 10
        write(df.where("k < 3"), name, path)
        assert sorted(r.k for r in served.read_mart(spark, name).collect()) == [0, 1, 2]
    assert silver.read_silver(spark, name, since=date(2025, 1, 2)).count() == 1


def test_a_switch_that_broke_off_is_read_and_finished(spark, folder, monkeypatch):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    served.write_mart(df, "switched", folder + "/s")
    held = served.read_mart(spark, "switched")
    plain = tables._switch

    def broken(spark, name):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        raise OSError("gone")

    monkeypatch.setattr(tables, "_switch", broken)
    with pytest.raises(OSError, match="gone"):
        served.write_mart(df.where("k = 2"), "switched", folder + "/s")
    monkeypatch.setattr(tables, "_switch", plain)
    assert [r.k for r in served.read_mart(spark, "switched").collect()] == [2]
    assert not [n for n in served.list_tables(spark) if n.startswith("switched__")]
    with pytest.raises(PySparkException, match="broken"):
        served.write_mart(failing(df), "switched", folder + "/s")
    assert [r.k for r in served.read_mart(spark, "switched").collect()] == [2]
    assert sorted(r.k for r in held.collect()) == [1, 2]  # the folder stays for who reads it
    tables.replace_table(df, "switched", folder + "/s", grace=0)
    tables.replace_table(df, "switched", folder + "/s", grace=0)
    assert len([n for n in Folder(spark, folder).names() if n.startswith("s-")]) == 2


def test_served_table_page_describe_list(spark, folder):
    df = spark.createDataFrame([(i, f"n{i}") for i in range(7)], "k int, v string")
    served.write_mart(df, "served_small", folder + "/s")
    served.write_mart(df, "served_small", folder + "/s")
    assert "served_small" in served.list_tables(spark)
    page, info = served.table_page(spark, "served_small", ["k"], limit=2, offset=4, sort_by="k", order="desc")
    assert [r.k for r in page.collect()] == [2, 1]
    assert info.first().has_more is True
    payload = served.page_payload(spark, "served_small", keys=["k"], limit=2, offset=6)
    assert payload["data"] == [{"k": 6, "v": "n6"}]
    assert payload["pagination"]["returned_rows"] == 1 and not payload["pagination"]["has_more"]
    rows = served.describe_table(spark, "served_small").orderBy("position").collect()
    assert [(r["column"], r["type"]) for r in rows] == [("k", "int"), ("v", "string")]
    assert {(r["row_count"], r["column_count"]) for r in rows} == {(7, 2)}
    assert served.search_table(spark, "served_small", "N3").count() == 1
    with pytest.raises(UnknownTable):
        served.table_page(spark, "served_absent")


def test_jdbc_options_of_a_partitioned_read():
    plain = served.jdbc_options("jdbc:x:y", "t", {"user": "u"})
    assert plain == {"url": "jdbc:x:y", "dbtable": "t", "user": "u"}
    split = served.jdbc_options("jdbc:x:y", "t", {}, "id", 0, 100, 8)
    assert (split["partitionColumn"], split["lowerBound"], split["numPartitions"]) == ("id", "0", "8")
    with pytest.raises(ValueError):
        served.jdbc_options("jdbc:x:y", "t", {}, "id")


# ---------------------------------------------------------------- folders


def test_scratch_is_the_session_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    df = spark.range(5)
    copy = materialize(df, "copy")
    assert copy.count() == 5 and "LogicalRDD" not in copy._jdf.queryExecution().toString()


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(NoSharedFolder):
        shared_folder(Session())
