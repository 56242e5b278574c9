"""Pairs of similar sets among the members of buckets, with bounded tasks and no rows for pairs.

Members of a bucket are dealt to blocks of bounded size. A task compares the signatures of its
members, stops early for pairs that are almost surely below the threshold, and confirms the rest
on the full sets. What leaves a task are links that join two groups not yet joined in it: at
most one fewer than its members.

A bucket larger than a block first has each block compared within itself and with a few members
of the first block, so that copies of one thing are joined at a cost in proportion to their
number; only blocks of what is then still apart are compared with each other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialize
from .bits import bit_map, may_hold
from .components import connected_components
from .words import mix

PAIRS_AT_ONCE = 1 << 16
#: Members counted before their buckets leave a task, and entries of a span that one task counts, about.
KEYS_AT_ONCE, SPAN_KEYS = 1 << 18, 1 << 18
#: Bytes of members whose sets are held at once, or those of one task.
SETS_AT_ONCE = 1 << 20
TASK = ["bucket", "low", "high"]


@dataclass(frozen=True)
class Similarity:
    """Jaccard similarity of at least ``percent`` / 100, told from MinHash signatures of ``width`` bytes a value.

    ``bands`` bands of ``rows`` values give the candidates. ``looks`` says after how many values a
    pair is judged, and ``miss`` is the posterior probability of a similarity at or over the
    threshold under which a pair is given up. ``sized`` says that nodes come with the sizes of their sets, by which
    pairs are given up as well, and not only with bounds of them.
    """

    percent: int
    hashes: int
    bands: int
    looks: tuple[int, ...]
    miss: float = 1e-6
    rows: int = 4
    width: int = 2
    sized: bool = True

    def least_matches(self) -> list[int]:
        """For each look: with fewer equal values than this, a pair is given up.

        The prior is even; after m of n values agree the similarity has a Beta(m + 1, n - m + 1)
        posterior, whose mass above t is the chance of at most m successes in n + 1 trials. Two
        different values agree in 16 bits once in 65,536 times, which only raises m.
        """
        t = self.percent / 100
        out = []
        for n in self.looks:
            below, m = 0.0, 0
            while m <= n:
                below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
                if below >= self.miss:
                    break
                m += 1
            out.append(m)
        return out


def _buckets(batch: pa.RecordBatch, similarity: Similarity) -> np.ndarray:
    """The bucket of each row in each band, with the band in the last six bits."""
    values = np.frombuffer(b"".join(batch.column(2).to_pylist()), f"u{similarity.width}")
    keys = _band_keys(values.reshape(batch.num_rows, similarity.hashes), similarity)
    return (mix(keys) & ~np.uint64(63)) | np.arange(similarity.bands, dtype=np.uint64)


def _bucket_rows(similarity: Similarity, wanted):
    """Node and size in each bucket of its signature that may be wanted."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = _buckets(batch, similarity)
            row, band = np.nonzero(may_hold(wanted.value, keys >> np.uint64(6)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[row, band].view(np.int64)), *[batch.column(k).take(pa.array(row)) for k in (0, 1)]],
                ["bucket", "node", "size"],
            )

    return run


PACKED = "span int, buckets binary, members binary, items binary"


def _summed(buckets: np.ndarray, members: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each bucket once, in order, with its sums."""
    order = np.argsort(buckets)
    buckets = buckets[order]
    begins = np.flatnonzero(np.concatenate((np.ones(min(len(buckets), 1), bool), buckets[1:] != buckets[:-1])))
    return buckets[begins], *[np.add.reduceat(x[order], begins) if len(begins) else x for x in (members, items)]


def _packed_counts(similarity: Similarity, spans: int):
    """Buckets with their numbers of members and items, as arrays by span of the bucket range.

    Buckets are counted over ``KEYS_AT_ONCE`` members before they leave a task, so a bucket that holds
    most nodes is a few entries, and an entry is moved as bytes, not as a row.
    """

    def packed(held):
        keys, sizes = (np.concatenate(x) for x in zip(*held))
        buckets, members, items = _summed(keys, np.ones(len(keys), np.int64), sizes)
        span = ((buckets >> np.uint64(32)) * np.uint64(spans) >> np.uint64(32)).astype(np.int32)
        cuts = np.flatnonzero(np.diff(span, prepend=-1))
        ends = np.append(cuts[1:], len(span))
        arrays = [[x[i:j].tobytes() for i, j in zip(cuts.tolist(), ends.tolist())] for x in (buckets, members, items)]
        return pa.RecordBatch.from_arrays(
            [pa.array(span[cuts]), *[pa.array(x, pa.binary()) for x in arrays]], ["span", "buckets", "members", "items"]
        )

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = _buckets(batch, similarity)
            held.append((keys.ravel(), np.repeat(batch.column(1).to_numpy(), similarity.bands)))
            n += keys.size
            if n >= KEYS_AT_ONCE:
                yield packed(held)
                held, n = [], 0
        if held:
            yield packed(held)

    return run


def _shared(table: pa.Table) -> pa.Table:
    """The buckets of a span that have several members."""
    columns = [np.frombuffer(b"".join(table[k].to_pylist()), kind) for k, kind in zip((1, 2, 3), (np.uint64, np.int64, np.int64))]
    buckets, members, items = _summed(*columns)
    several = members > 1
    return pa.table(
        {"bucket": buckets[several].view(np.int64), "members": members[several], "items": items[several]}
    )


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by task, cut so that every task is whole."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        edges = _edges(batch)
        first = tuple(batch.column(k)[0].as_py() for k in range(len(TASK)))
        if held and last != first:
            yield pa.Table.from_batches(held)
            held = []
        if len(edges) > 2:
            yield pa.Table.from_batches([*held, batch.slice(0, edges[-2])])
            held = []
            batch = batch.slice(edges[-2])
        held.append(batch)
        last = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in range(len(TASK)))
    if held:
        yield pa.Table.from_batches(held)


def _edges(rows) -> np.ndarray:
    """Where tasks begin, and the end."""
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for k in range(len(TASK)):
        column = rows.column(k).to_numpy() if isinstance(rows, pa.Table) else rows.column(k).to_numpy(zero_copy_only=False)
        new[1:] |= column[1:] != column[:-1]
    return np.append(np.flatnonzero(new), rows.num_rows)


def _pairs(edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs within groups, some at a time."""
    ends = np.repeat(edges[1:], np.diff(edges))
    counts = ends - np.arange(len(ends)) - 1
    upto = np.concatenate(([0], np.cumsum(counts)))
    low = 0
    while low < len(counts):
        high = max(low + 1, int(np.searchsorted(upto, upto[low] + PAIRS_AT_ONCE, "right")) - 1)
        own = counts[low:high]
        a = np.repeat(np.arange(low, high), own)
        yield a, a + 1 + np.arange(len(a)) - np.repeat(upto[low:high] - upto[low], own)
        low = high


def _band_keys(values: np.ndarray, similarity: Similarity) -> np.ndarray:
    """64 bits of each row and band."""
    banded = np.ascontiguousarray(values[:, : similarity.bands * similarity.rows])
    if similarity.rows * similarity.width == 8:
        return banded.view(np.uint64)
    parts = banded.reshape(len(values), similarity.bands, similarity.rows)
    out = np.zeros(parts.shape[:2], np.uint64)
    for k in range(similarity.rows):
        out = mix(out ^ parts[:, :, k])
    return out


def _survivors(table: pa.Table, similarity: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of a task that stay likely after every look, each in the first band it shares."""
    size = table["size"].to_numpy()
    label, band = table["label"].to_numpy(), table["bucket"].to_numpy() & 63
    joined = b"".join(table["signature"].to_pylist())
    values = np.frombuffer(joined, f"u{similarity.width}").reshape(-1, similarity.hashes)
    keys = _band_keys(values, similarity)
    least = similarity.least_matches()
    kept_a, kept_b = [], []
    for a, b in _pairs(_edges(table)):
        near = label[a] != label[b]
        if similarity.sized:
            small, large = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
            near &= 100 * small >= similarity.percent * large
        a, b = a[near], b[near]
        same = keys[a] == keys[b]
        own = same.any(1) & (same.argmax(1) == band[a]) if len(a) else np.zeros(0, bool)
        a, b = a[own], b[own]
        matches, done = np.zeros(len(a), np.int64), 0
        for look, enough in zip(similarity.looks, least):
            matches += (values[a, done:look] == values[b, done:look]).sum(1)
            on = matches >= enough
            a, b, matches, done = a[on], b[on], matches[on], look
        kept_a.append(a)
        kept_b.append(b)
    return np.concatenate(kept_a), np.concatenate(kept_b)


LIKELY = "bucket long, low int, high int, node long, label long, partners binary"


def _likely(similarity: Similarity):
    """Per task and member with a likely partner: its partners that come later in the task."""

    def run(batches):
        for table in whole_groups(batches):
            a, b = _survivors(table, similarity)
            order = np.argsort(a, kind="stable")
            a, b = a[order], b[order]
            rows = np.union1d(a, b)
            node = table["node"].to_numpy()
            cuts = np.searchsorted(a, rows), np.searchsorted(a, rows, "right")
            partners = [node[b[i:j]].astype(np.int64).tobytes() for i, j in zip(*cuts)]
            chosen = table.select([*TASK, "node", "label"]).take(pa.array(rows))
            yield from chosen.append_column("partners", pa.array(partners, pa.binary())).to_batches()

    return run


class _Joined:
    """Which members of a task are known to be in one component."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = up.setdefault(y, y)
            x = up[x]
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.root(x)] = self.root(y)


def _confirmed(percent: int, sets_of: Callable[[pa.Array], list[np.ndarray]]):
    """Links between members of a task whose full sets are similar enough."""

    def run(batches):
        for table in whole_groups(batches):
            payload = table["payload"].combine_chunks()
            nodes, labels = table["node"].to_pylist(), table["label"].to_pylist()
            partners = table["partners"].to_pylist()
            edges = _edges(table)
            upto = np.concatenate(([0], np.cumsum(np.asarray(pc.fill_null(pc.binary_length(payload), 0), np.int64))))[edges]
            found, done = [], 0
            while done < len(edges) - 1:
                then = max(done + 1, int(np.searchsorted(upto, upto[done] + SETS_AT_ONCE, "right")) - 1)
                begin = int(edges[done])
                sets = sets_of(payload.slice(begin, int(edges[then]) - begin))
                for low, high in zip(edges[done:then].tolist(), edges[done + 1 : then + 1].tolist()):
                    at = dict(zip(nodes[low:high], range(low, high)))
                    joined = _Joined()
                    for row in range(low, high):
                        own = sets[row - begin]
                        for other in np.frombuffer(partners[row] or b"", np.int64).tolist():
                            # members joined in an earlier round share a label
                            if other not in at or joined.root(labels[row]) == joined.root(labels[at[other]]):
                                continue
                            theirs = sets[at[other] - begin]
                            place = np.searchsorted(own, theirs)
                            place[place == len(own)] = 0
                            both = int((own[place] == theirs).sum()) if len(own) else 0
                            if both and 100 * both >= percent * (len(own) + len(theirs) - both):
                                joined.join(labels[row], labels[at[other]])
                                found.append((nodes[row], other))
                done = then
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _compare(tasks: DataFrame, nodes: DataFrame, fetch, sets_of, similarity: Similarity) -> DataFrame:
    """Links found in ``tasks`` (task, node, label)."""
    described = tasks.drop("size").join(nodes.select("node", "size", "signature"), "node")
    columns = [*TASK, "node", "label", "size", "signature"]
    grouped = described.select(columns).repartition(*TASK).sortWithinPartitions(*TASK, "node")
    likely = materialize(grouped.mapInArrow(_likely(similarity), LIKELY), "likely")
    payload = fetch(likely.select("node").distinct())
    full = likely.join(payload, "node").select(*TASK, "node", "label", "partners", "payload")
    full = full.repartition(*TASK).sortWithinPartitions(*TASK, "node")
    return materialize(full.mapInArrow(_confirmed(similarity.percent, sets_of), "a long, b long"), "links")


def similar_components(
    nodes: DataFrame,
    similarity: Similarity,
    fetch: Callable[[DataFrame], DataFrame],
    sets_of: Callable[[pa.Array], list[np.ndarray]],
    block_members: int = 2048,
    block_items: int = 4_000_000,
    ambassadors: int = 32,
) -> DataFrame:
    """``(node, label)`` of the nodes linked with another one, directly or through others.

    ``nodes``: ``node`` long (different in every row), ``size`` long (items of its set),
    ``signature`` binary (``similarity.hashes`` values). ``fetch`` gives ``(node,
    payload)`` for a table of nodes, and ``sets_of`` the sorted distinct hashes of each payload.

    A task holds at most about ``block_members`` members and ``block_items`` items, or one
    member that is larger by itself.
    """
    signed = nodes.select("node", "size", "signature")
    bucket_rows = "bucket long, node long, size long"
    blocks = F.greatest(
        F.ceil(F.col("members") / block_members), F.ceil(F.col("items") / block_items)
    ).cast("int")
    spans = nodes.count() * similarity.bands // SPAN_KEYS + 1
    packed = signed.mapInArrow(_packed_counts(similarity, spans), PACKED)
    buckets = packed.groupBy("span").applyInArrow(_shared, "bucket long, members long, items long")
    buckets = materialize(buckets.select("bucket", blocks.alias("blocks")), "shared-buckets")
    # most buckets have one member: a bit map keeps nearly all of those from being moved again
    wanted = nodes.sparkSession.sparkContext.broadcast(bit_map(buckets, F.shiftrightunsigned("bucket", 6)))
    rows = signed.mapInArrow(_bucket_rows(similarity, wanted), bucket_rows)
    shared = materialize(rows.join(buckets, "bucket"), "buckets")

    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = shared.withColumn("block", own)
    envoys = placed.where(
        (F.col("blocks") > 1) & (F.col("block") == 0) & (F.pmod(F.hash("node"), F.lit(block_members)) < ambassadors)
    ).withColumn("block", F.explode(F.expr("sequence(1, blocks - 1)")))
    first = placed.unionByName(envoys).select(
        "bucket", F.col("block").alias("low"), F.col("block").alias("high"), "node", F.col("node").alias("label")
    )
    links = _compare(first, nodes, fetch, sets_of, similarity)
    wide = shared.where("blocks > 1")
    if wide.isEmpty():
        return connected_components(links)
    apart = _apart(wide, connected_components(links), block_members, block_items)
    return connected_components(links.unionByName(_compare(apart, nodes, fetch, sets_of, similarity)))


def _apart(wide: DataFrame, components: DataFrame, block_members: int, block_items: int) -> DataFrame:
    """Tasks for the pairs of wide buckets that the first tasks left in different components.

    In each bucket the largest component's members are compared with all others and the others
    with each other, never the largest component with itself.
    """
    held = wide.join(components, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sizes = held.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.sum("size").alias("items"))
    main = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "items", "label")).alias("top"),
        F.sum("n").alias("members"),
        F.sum("items").alias("items"),
    )

    def blocks(members, items):
        # a task has two blocks
        return F.ceil(F.greatest(members / block_members, items / block_items) * 2).cast("int")

    main = main.where("members > top.n").select(
        "bucket",
        F.col("top.label").alias("main"),
        blocks(F.col("top.n"), F.col("top.items")).alias("main_blocks"),
        blocks(F.col("members") - F.col("top.n"), F.col("items") - F.col("top.items")).alias("other_blocks"),
    )
    held = held.join(main, "bucket").withColumn("in_main", F.col("label") == F.col("main"))
    # other blocks are numbered from 0, those of the main component follow
    block = F.when(
        F.col("in_main"), F.col("other_blocks") + F.pmod(F.xxhash64("node"), F.col("main_blocks"))
    ).otherwise(F.pmod(F.xxhash64("node"), F.col("other_blocks")))
    held = held.withColumn("block", block.cast("int"))
    against = F.when(F.col("in_main"), F.expr("sequence(0, other_blocks - 1)")).otherwise(
        F.expr("sequence(0, other_blocks + main_blocks - 1)")
    )
    held = held.withColumn("against", F.explode(against))
    return held.select(
        "bucket",
        F.least("block", "against").alias("low"),
        F.greatest("block", "against").alias("high"),
        "node",
        "label",
    )
