"""Association over a join against plain Python on the join's rows."""

import math
from collections import Counter

import pytest

from roadlens.operators import association


def halves(spark):
    left = [("a", 1), ("a", 1), ("b", 2), ("c", None), ("d", 4), (None, 3), ("e", 4), ("e", 2)]
    right = [("a", "x", 1.0), ("a", "y", 5.0), ("b", None, 2.0), ("b", "x", 2.0), ("c", "x", 9.0), ("d", "z", 2.0), ("e", "z", None), ("e", "x", 7.0), (None, "z", 1.0)]
    ours = spark.createDataFrame(left, "id string, y int")
    theirs = spark.createDataFrame(right, "id string, kind string, reading double")
    return ours, theirs, [(b, c, d) for i, b in left for j, c, d in right if i is not None and i == j and b is not None]


def test_contingency_and_chi_square_equal_the_joined_rows(spark):
    ours, theirs, joined = halves(spark)
    cells = Counter((x, y) for y, x, _ in joined if x is not None)
    total, xs, ys = sum(cells.values()), Counter(), Counter()
    for (x, y), n in cells.items():
        xs[x] += n
        ys[y] += n
    table = association.contingency(association.joined_pairs(ours, theirs, "id", "y", ["kind"]))
    got = {(r["x"], r["y"]): (r["n"], r["expected"]) for r in table.collect()}
    assert got == {(x, y): (n, xs[x] * ys[y] / total) for (x, y), n in cells.items()}
    chi = sum((cells[x, y] - xs[x] * ys[y] / total) ** 2 / (xs[x] * ys[y] / total) for x in xs for y in ys)
    (row,) = association.chi_square(table).collect()
    assert (row["rows"], row["x_kinds"], row["y_kinds"], row["degrees"]) == (total, len(xs), len(ys), (len(xs) - 1) * (len(ys) - 1))
    assert math.isclose(row["chi_square"], chi)
    assert math.isclose(row["cramers_v"], math.sqrt(chi / (total * (min(len(xs), len(ys)) - 1))))


@pytest.mark.parametrize("range_values", [1, 1_000_000])
def test_rank_correlation_equals_the_joined_rows(spark, monkeypatch, range_values):
    monkeypatch.setattr(association, "RANGE_VALUES", range_values)
    ours, theirs, joined = halves(spark)
    pairs = [(d, y) for y, _, d in joined if d is not None]

    def ranks(values):
        order = sorted(values)
        return [order.index(v) + (order.count(v) + 1) / 2 for v in values]

    x, y = (ranks(v) for v in zip(*pairs))
    mean = (len(pairs) + 1) / 2
    xy, xx, yy = (sum((a - mean) * (b - mean) for a, b in zip(p, q)) for p, q in ((x, y), (x, x), (y, y)))
    (row,) = association.rank_correlation(association.joined_pairs(ours, theirs, "id", "y", ["reading"])).collect()
    assert row["rows"] == len(pairs)
    assert math.isclose(row["correlation"], xy / math.sqrt(xx * yy))


def test_one_kind_or_no_rows_have_no_measure(spark):
    ours = spark.createDataFrame([("a", 1), ("b", 1)], "id string, y int")
    theirs = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 2.0)], "id string, kind string, reading double")
    pairs = association.joined_pairs(ours, theirs, "id", "y", ["kind"])
    assert association.chi_square(association.contingency(pairs)).first()["cramers_v"] is None
    readings = association.joined_pairs(ours, theirs, "id", "y", ["reading"])
    assert association.rank_correlation(readings).first()["correlation"] is None
    none = association.joined_pairs(ours.limit(0), theirs, "id", "y", ["kind"])
    assert association.chi_square(association.contingency(none)).collect() == []
