"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact confirmation."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialize
from .bits import bit_map, may_hold
from .links import Similarity, similar_components
from .row_keys import PARTS, keyed, named, one_of_each, row_key
from .words import SPACED_LOWER, Block, blocks, distinct, find_words, gram_hashes, mix, word_hashes

SIMILARITY = Similarity(percent=75, hashes=256, bands=32, looks=(32, 64, 96, 128, 192, 256))


def shingle_sets(block: Block, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text: runs of ``size`` words, or all words if fewer."""
    words = find_words(block, SPACED_LOWER)
    hashes = word_hashes(block, words, SPACED_LOWER)
    grams = gram_hashes(hashes, size)
    out = []
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if high - low >= size:
            out.append(distinct(grams[low : high - size + 1]))
        else:
            out.append(gram_hashes(hashes[low:high], high - low) if high > low else hashes[:0])
    return out


def signatures(sets: list[np.ndarray], hashes: int) -> np.ndarray:
    """16 bits of the least value of each of ``hashes`` hash functions; the sets are not empty."""
    seeds = mix(np.arange(1, 2 * hashes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.empty((len(sets), hashes), np.uint16)
    if not sets:
        return out
    items = np.concatenate(sets)
    begins = np.concatenate(([0], np.cumsum([len(s) for s in sets[:-1]]))).astype(np.int64)
    for k in range(hashes):
        values = (items ^ seeds[2 * k]) * (seeds[2 * k + 1] | np.uint64(1))
        out[:, k] = np.minimum.reduceat(values, begins) >> np.uint64(16) & np.uint64(0xFFFF)
    return out


def set_key(items: np.ndarray) -> bytes:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def _described(words: int, hashes: int):
    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1)):
                sets = shingle_sets(block, words)
                some = [i for i, s in enumerate(sets) if len(s)]
                values = signatures([sets[i] for i in some], hashes)
                signature: list = [None] * len(sets)
                for i, row in zip(some, values):
                    signature[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(k).slice(block.first, len(block)) for k in (0, 2, 3)],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_key(s) for s in sets], pa.binary()),
                        pa.array(signature, pa.binary()),
                    ],
                    ["id", *PARTS, "size", "key", "signature"],
                )

    return run


def _chosen(words: int, wanted):
    """Texts of the ids that may be wanted, with the key of their set."""

    def run(batches):
        for batch in batches:
            rows = np.flatnonzero(may_hold(wanted.value, batch.column(2).to_numpy(zero_copy_only=False)))
            if len(rows):
                some = batch.take(pa.array(rows))
                keys = [set_key(s) for b in blocks(some.column(1)) for s in shingle_sets(b, words)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(keys, pa.binary()), some.column(1).cast(pa.string())],
                    ["id", "key", "payload"],
                )

    return run


def _judged(docs: DataFrame, id_col: str, text_col: str, words: int, similarity: Similarity) -> DataFrame:
    """Each row's id and key, shingles, and the first row of its component (null where it has no shingle)."""
    spark = docs.sparkSession
    source = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *row_key(id_col, text_col)
    )
    schema = "id long, ka long, kb long, size long, key binary, signature binary"
    rows = source.mapInArrow(_described(words, similarity.hashes), schema)
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "signatures")

    # rows with an id come before those without
    place = F.struct(F.col("id").isNull().alias("nameless"), "id", *PARTS)
    classes = rows.where("size > 0").groupBy("key").agg(F.min("row").alias("node"), F.min(place).alias("first"))
    described = rows.select(F.col("row").alias("node"), "id", "size", "signature")
    nodes = materialize(classes.join(described, "node"), "classes")

    def fetch(wanted: DataFrame) -> DataFrame:
        at = nodes.select("node", "id", "key").join(wanted, "node", "left_semi")
        likely = spark.sparkContext.broadcast(bit_map(at, F.xxhash64("id")))
        texts = source.select("id", "text", F.xxhash64("id").alias("hash"))
        texts = texts.mapInArrow(_chosen(words, likely), "id long, key binary, payload string")
        found = at.join(texts, at["id"].eqNullSafe(texts["id"]) & (at["key"] == texts["key"]))
        return found.select("node", "payload").dropDuplicates(["node"])

    def sets_of(payload: pa.Array) -> list[np.ndarray]:
        return [s for block in blocks(payload) for s in shingle_sets(block, words)]

    labels = similar_components(nodes, similarity, fetch, sets_of)
    classes = nodes.select("key", "node", "first").join(labels, "node", "left")
    classes = classes.select("key", "first", F.coalesce("label", "node").alias("label"))
    least = classes.groupBy("label").agg(F.min("first").alias("keeper"))
    component = classes.join(least, "label").select("key", "keeper")
    return rows.select("id", *PARTS, "size", "key").join(component, "key", "left")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    similarity: Similarity = SIMILARITY,
) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)``, a row for every row of ``docs``.

    Two documents are linked if the Jaccard similarity of their sets of ``words``-word shingles
    (A-Z lower-cased, words between white space) is at least the threshold; a shorter text is one
    shingle. ``component_id`` is the smallest id reachable over links, ``kept`` says that the row
    has that id.

    Documents of one set are one node, so copies cost a row each and no pair. Candidates agree
    in a band; those whose posterior similarity is too small are given up after a few hash
    values (``Similarity.miss``), all others are confirmed on their full sets (see ``links``).

    Null and empty texts have no shingle and are linked with nothing. Rows that repeat an id are
    kept or dropped by the same rule, each by its own text. A null id is never the smallest; a
    component without any id has a null ``component_id`` and is kept. Other columns are ignored,
    and no rows give no rows.
    """
    judged = _judged(docs, id_col, text_col, words, similarity)
    component = F.when(F.col("keeper").isNull(), F.col("id")).otherwise(F.col("keeper.id"))
    return judged.select(
        F.col("id").alias(id_col),
        F.col("size").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    similarity: Similarity = SIMILARITY,
) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each component: one of its smallest id.

    Rows are judged by id and text, so a text stays whatever other texts have its id, and of equal
    rows one stays. Where texts of one component share the smallest id, the one whose hash is least
    stays. Rows without a shingle all stay.
    """
    judged = _judged(docs, id_col, text_col, words, similarity).where(F.col("keeper").isNotNull())
    own = F.struct(F.col("id").isNull().alias("nameless"), "id", *PARTS).eqNullSafe(F.col("keeper"))
    judged = materialize(judged.select(*PARTS, own.alias("first")), "judged")
    rows, name = keyed(docs, id_col, text_col)
    dropped = named(judged.where("not first").distinct(), name)
    again = judged.where("first").groupBy(*PARTS).count().where("count > 1")
    kept = rows.join(dropped, name, "left_anti")
    return one_of_each(kept, name, again).select(*docs.columns)
