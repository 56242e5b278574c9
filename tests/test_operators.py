"""Small cases of the generic operators, brute force where they re-arrange work, and plans."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from roadlens.errors import BadPage, UnknownColumn
from roadlens.operators import paging, rows
from roadlens.operators.aggregate import (
    distinct_count_by,
    flag_counts,
    flag_summary,
    share_of_total,
)
from roadlens.operators.joins import (
    collapse,
    join_counted,
    join_on_id,
    joined_aggregates,
    joined_correlations,
)
from roadlens.operators.quality import quality_report


def tuples(df):
    return [tuple(r) for r in df.collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ids(spark, pairs):
    return spark.createDataFrame(pairs, "k int, id string")


@pytest.mark.parametrize("pairs,expected", [
    ([(1, "a"), (1, "b"), (2, "c"), (2, "c")], [(1, 2, 66.67), (2, 1, 33.33)]),
    ([(1, "a"), (2, "a")], [(1, 1, 50.0), (2, 1, 50.0)]),
])
def test_share(spark, pairs, expected):
    counts = distinct_count_by(ids(spark, pairs), ["k"], "id", "n")
    out = share_of_total(counts, "n").orderBy("k")
    assert [(k, n, float(p)) for k, n, p in tuples(out)] == expected
    assert dict(out.dtypes)["percentage"] == "decimal(27,2)"


def test_share_reads_its_input_once(spark, folder):
    ids(spark, [(1, "a"), (2, "b")]).write.parquet(folder + "/t")
    out = share_of_total(distinct_count_by(spark.read.parquet(folder + "/t"), ["k"], "id", "n"), "n")
    out.collect()
    assert "ReusedExchange" in plan(out)


def test_distinct_count_variants(spark):
    df = ids(spark, [(1, "a"), (1, "b"), (2, "c")])
    exact = sorted(tuples(distinct_count_by(df, ["k"], "id")))
    assert exact == sorted(tuples(distinct_count_by(df, ["k"], "id", unique_ids=True)))
    assert exact == sorted(tuples(distinct_count_by(df, ["k"], "id", approx=True)))


def test_distinct_count_spreads_a_hot_group_by_id(spark):
    out = plan(distinct_count_by(ids(spark, [(1, "a")]), ["k"], "id"))
    assert re.search(r"Exchange hashpartitioning\(k#\d+, id#\d+", out)
    assert "Expand" not in out
    unique = plan(distinct_count_by(ids(spark, [(1, "a")]), ["k"], "id", unique_ids=True))
    assert len(re.findall(r"Exchange hashpartitioning", unique)) == 1


def test_flags(spark):
    schema = "id string, f boolean, g boolean"
    df = spark.createDataFrame([("a", True, None), ("a", True, False), ("b", None, True)], schema)
    flags = {"f": "nf", "g": "ng"}
    assert tuples(flag_summary(df, flags, "id", "total")) == [(2, 1, 2)]
    empty = spark.createDataFrame([], schema)
    assert tuples(flag_summary(empty, flags, "id", "total")) == [(0, 0, 0)]
    assert "Exchange hashpartitioning" not in plan(flag_counts(df, flags))


def fan_out(spark):
    left = spark.createDataFrame([("a", 1), ("a", 1), ("b", 4)], "id string, severity int")
    right = spark.createDataFrame([("a", "Rain"), ("a", "Rain"), ("b", "Rain")], "id string, c string")
    return left, right


@pytest.mark.parametrize("repeats", ["any", "few"])
def test_fan_out_average(spark, repeats):
    left, right = fan_out(spark)
    assert join_on_id(left, right, "id").count() == 5
    out = joined_aggregates(left, right, "id", ["c"], left_means={"avg": "severity"}, repeats=repeats)
    assert tuples(out) == [("Rain", 2, 1.6)]


def random_halves(seed):
    rng = random.Random(seed)
    maybe = lambda v: None if rng.random() < 0.2 else v
    keys = ["hot"] * 30 + [f"k{i}" for i in range(12)] + [None] * 3
    left = [(rng.choice(keys), maybe(rng.randint(1, 4))) for _ in range(80)]
    right = [(rng.choice(keys), maybe(rng.choice("xyz")), maybe(float(rng.randint(0, 9)))) for _ in range(90)]
    return left, right


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("repeats", ["any", "few", "none"])
def test_joined_aggregates_against_brute_force(spark, seed, repeats):
    left, right = random_halves(seed)
    if repeats == "none":
        left, right = (list({r[0]: r for r in rows_}.values()) for rows_ in (left, right))
    groups = defaultdict(lambda: (set(), [], []))
    for lid, severity in left:
        for rid, c, wind in right:
            if lid is not None and lid == rid:
                seen, severities, winds = groups[c]
                seen.add(lid)
                severities += [severity] if severity is not None else []
                winds += [wind] if wind is not None else []
    mean = lambda xs: sum(xs) / len(xs) if xs else None
    expected = {c: (len(s), mean(a), mean(b)) for c, (s, a, b) in groups.items()}
    out = joined_aggregates(
        spark.createDataFrame(left, "id string, severity int"),
        spark.createDataFrame(right, "id string, c string, wind double"),
        "id", ["c"], "n", {"sev": "severity"}, {"wnd": "wind"}, repeats=repeats,
    )
    got = {c: (n, s, w) for c, n, s, w in tuples(out)}
    assert got.keys() == expected.keys()
    for c, values in expected.items():
        assert got[c] == pytest.approx(values)


@pytest.mark.parametrize("seed", range(2))
def test_correlation_and_counted_join_against_the_plain_join(spark, seed):
    left, right = random_halves(seed)
    a = spark.createDataFrame(left, "id string, severity int")
    w = spark.createDataFrame(right, "id string, c string, wind double")
    joined = join_on_id(a, w, "id")
    plain = joined.where("severity is not null and wind is not null")
    expected = plain.agg(F.corr(F.col("severity").cast("double"), "wind")).first()[0]
    got = joined_correlations(a, w, "id", "severity", ["wind"]).first()
    assert got["column_name"] == "wind" and got["correlation"] == pytest.approx(expected)
    counted = join_counted(a, w, "id")
    grouped = joined.groupBy(*joined.columns).agg(F.count(F.lit(1)).cast("double").alias("copies"))
    assert sorted(map(str, tuples(counted))) == sorted(map(str, tuples(grouped)))


def test_joined_aggregates_never_join_raw_rows(spark):
    left, right = fan_out(spark)
    text = plan(joined_aggregates(left, right, "id", ["c"], left_means={"avg": "severity"}))
    before_join = text[text.index("Join"):]
    assert before_join.count("partial_count") >= 2


def test_joined_aggregates_ask_how_ids_repeat(spark):
    with pytest.raises(ValueError):
        joined_aggregates(*fan_out(spark), "id", ["c"], repeats="often")


def test_collapse(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0)], "id string, v double")
    assert sorted(map(str, tuples(collapse(df)))) == ["('a', None, 2.0)", "('b', 1.0, 1.0)"]


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "x"), ("a", 2, "y"), ("b", None, "z"), (None, 5, "p"), (None, 5, "p")],
        "id string, at int, v string",
    )
    out = rows.latest_per_key(df, ["id"], ["at"])
    assert out.columns == df.columns
    assert sorted(map(str, tuples(out))) == sorted(
        map(str, [("a", 2, "y"), ("b", None, "z"), (None, 5, "p"), (None, 5, "p")])
    )
    only_keys = rows.latest_per_key(df.select("id"), ["id"], [])
    assert only_keys.count() == 4


def test_top_k_cuts_ties_by_key(spark):
    df = spark.range(60).select(F.format_string("s%02d", F.col("id")).alias("s"), F.lit(7).alias("n"))
    out = rows.top_k(df, "n", ["s"], 50)
    assert [s for s, _ in tuples(out)] == [f"s{i:02d}" for i in range(50)]
    assert "TakeOrderedAndProject" in plan(out)


def test_merge_by_name(spark):
    old = spark.createDataFrame([("1", "a")], "zip string, id string")
    new = spark.createDataFrame([("b", "43065-1234", 1)], "id string, zip string, extra int")
    out = rows.merge_by_name(old, new)
    assert tuples(out) == [("1", "a", None), ("43065-1234", "b", 1)]
    assert tuples(rows.merge_by_name(old, old)) == [("1", "a")] * 2


def test_not_null_keeps_nan(spark):
    df = spark.createDataFrame([(float("nan"), 1), (None, 2), (1.0, None)], "a double, b int")
    assert rows.not_null(df, ["a", "b"]).count() == 1


def test_sort_places_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "a")], "k int, v string")
    assert [k for k, _ in tuples(rows.sort_table(df, "v", "asc", ["k"]))] == [1, 3, 2]
    assert [k for k, _ in tuples(rows.sort_table(df, "v", "desc", ["k"]))] == [2, 3, 1]
    with pytest.raises(UnknownColumn):
        rows.sort_table(df, "nope")


def test_paging(spark):
    df = spark.range(10)
    assert [r.id for r in paging.page(df, ["id"], 2, 3).collect()] == [3, 4]
    assert paging.page_info(df, 2, 3).first().has_more is True
    last = paging.page_info(df, 2, 8).first()
    assert (last.has_more, last.returned_rows, last.total_rows) == (False, 2, 10)
    assert paging.page_info(df, 5, 20).first().returned_rows == 0
    for limit, offset in ((0, 0), (1001, 0), (1, -1)):
        with pytest.raises(BadPage):
            paging.page(df, ["id"], limit, offset)


@pytest.mark.parametrize("order", ["asc", "desc"])
def test_pages_cover_the_table_and_deep_pages_agree(spark, order):
    rng = random.Random(5)
    data = [(i, rng.choice([None, "p", "q", "r"])) for i in range(57)]
    df = spark.createDataFrame(data, "k int, v string").repartition(5)
    seen = []
    for offset in range(0, 60, 13):
        shallow = tuples(paging.page(df, ["k"], 13, offset, "v", order))
        assert tuples(paging.deep_page(df, ["k"], 13, offset, "v", order)) == shallow
        seen += shallow
    assert sorted(map(str, seen)) == sorted(map(str, data))
    assert paging.deep_page(df, ["k"], 13, 60, "v", order).count() == 0


def test_deep_page_through_equal_rows(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 20 + [("c",)] * 2, "v string").repartition(4)
    assert [r.v for r in paging.deep_page(df, [], 6, 20).collect()] == ["b"] * 3 + ["c"] * 2
    assert [r.v for r in paging.deep_page(df, [], 4, 1).collect()] == ["a", "a", "b", "b"]


@pytest.mark.parametrize("near", [0, 3, 10_000])
def test_pages_over_keys_that_repeat_serve_every_row_once(spark, monkeypatch, near):
    """Whichever way a page is found, it holds the same rows."""
    monkeypatch.setattr(paging, "NEAR_ROWS", near)
    rng = random.Random(9)
    data = [(rng.choice([1, 2, None]), rng.choice(["x", None, "y"]), i) for i in range(200)]
    df = spark.createDataFrame(data, "k int, v string, w int").repartition(7)
    order = sorted(data, key=lambda r: tuple((c is not None, c or 0) if i != 1 else (c is not None, c or "") for i, c in enumerate(r)))
    served = []
    for offset in range(0, 200, 35):
        served += tuples(paging.page(df, ["k"], 35, offset))
    assert served == [(k, v, w) for k, v, w in order]


def test_one_index_serves_all_pages_and_is_removed(spark, folder):
    import os

    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    index = paging.PageIndex(df, ["k"])
    written = index._path.removeprefix("file:")
    assert os.path.exists(written)
    rows = [r for offset in range(0, 100, 30) for r in tuples(index.page(30, offset))]
    assert rows == sorted((i % 3, i) for i in range(100))
    index.remove()
    assert not os.path.exists(written)


@pytest.mark.parametrize("order", ["asc", "desc"])
def test_all_pages_at_once_equal_page_by_page(spark, order):
    """One plan, whose size does not follow the number of pages; keys, nulls and whole rows repeat."""
    rng = random.Random(4)
    data = [(rng.choice([1, 2, None]), rng.choice(["x", None]), rng.randrange(9)) for _ in range(60)] + [(2, "x", 4)] * 40
    df = spark.createDataFrame(data, "k int, v string, w int").repartition(5)
    index = paging.PageIndex(df, ["k"], order=order)
    got = tuples(index.pages(7))
    for n in range(15):
        assert [r[:3] for r in got if r[3] == n] == tuples(index.page(7, 7 * n))
    assert len(got) == 100 and max(r[3] for r in got) == 14
    plans = [index.pages(limit)._jdf.queryExecution().optimizedPlan().toString() for limit in (1, 100)]
    assert len({len(plan.splitlines()) for plan in plans}) == 1
    assert tuples(paging.PageIndex(df.limit(0), ["k"]).pages(7)) == []
    with pytest.raises(BadPage):
        paging.PageIndex(df.withColumn("m", F.create_map("w", "k")), ["k"]).pages(7)


def test_far_page_takes_the_deep_way(spark, monkeypatch):
    monkeypatch.setattr(paging, "NEAR_ROWS", 5)
    assert [r.id for r in paging.page(spark.range(30), ["id"], 4, 11).collect()] == [11, 12, 13, 14]


def test_search(spark):
    df = spark.createDataFrame([("Main ST", 5), (None, 15), ("x_%", 7)], "street string, `n(o)` int")
    assert rows.search_table(df, "main st").count() == 1
    assert rows.search_table(df, "5").count() == 2
    assert rows.search_table(df, "_%", ["street"]).count() == 1
    with pytest.raises(UnknownColumn):
        rows.search_table(df, "x", ["nope"])


def test_quality_report(spark):
    df = spark.createDataFrame(
        [("a", 1, "01-02-2025"), ("a", 9, "2025-13-40"), ("b", None, None)],
        "id string, s int, situation_date string",
    )
    report = quality_report(df, "id", ["s", "situation_date"], {"s": (1, 4)})
    assert {(r, c): v for r, c, v in tuples(report)} == {
        ("not_null", "s"): 1, ("not_null", "situation_date"): 1, ("in_range", "s"): 1,
        ("parsable_date", "situation_date"): 1, ("unique_id", "id"): 1,
    }
    empty = quality_report(df.limit(0), "id", ["s"])
    assert all(v == 0 for _, _, v in tuples(empty))


def test_newest_rows_take_one_scan_and_keep_rows_without_a_key(spark, folder):
    data = [("a", 1, 5), ("a", 2, 1), (None, 1, 1), (None, 1, 1), ("b", None, 3)]
    spark.createDataFrame(data, "k string, at int, v int").write.parquet(folder + "/t")
    df = spark.read.parquet(folder + "/t")
    newest = rows.latest_per_key(df, ["k"], ["at"])
    assert sorted(map(str, tuples(newest))) == sorted(map(str, [("a", 2, 1), (None, 1, 1), (None, 1, 1), ("b", None, 3)]))
    assert newest._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 2  # the initial and the final plan
    assert rows.latest_per_key(df.select("k"), ["k"], []).count() == 4
