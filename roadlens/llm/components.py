"""Connected components of links, without a group or a table in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialize


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)`` for every node that has a link: the label is the smallest node it reaches.

    Alternating large-star and small-star steps: every node points at the smallest node it
    knows of until nothing changes, in a number of rounds that grows with the logarithm of the
    size. Minima are combined before they are shuffled, so a hub costs a row per task. Each
    round is written to the shared folder, which also cuts the plan.

    Links to oneself, repeated links and null ends are allowed and add nothing; no links give no
    rows.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    edges = links.where(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v")).distinct()
    edges = materialize(edges, "links")
    before = _fingerprint(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = materialize(small.where("u != v").distinct(), "links")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return labels.unionByName(roots)
