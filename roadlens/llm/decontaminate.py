"""Passages of benchmark items in documents, found by winnowing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialize
from .bits import bit_map, may_hold
from .row_keys import PARTS, keyed, named, row_key
from .words import ALPHANUMERIC_LOWER, Block, Words, blocks, find_words, gram_hashes, mix, whole_grams, word_hashes

WINDOW = 10
GRAM = 5


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` over each run of ``size`` values."""
    n = max(len(values) - size + 1, 0)
    out = values[:n].copy()
    for j in range(1, size):
        pick(out, values[j : j + n], out=out)
    return out


def winnow(hashes: np.ndarray, words: Words, gram: int, window: int) -> np.ndarray:
    """Places whose ``gram``-word hash is the least of some run of hashes that a ``window``-word span holds.

    Equal least hashes are all taken, so whether a place is taken depends on the words around it
    only: two texts that share a span of ``window`` words share a taken hash within it.
    """
    if len(hashes) < window:
        return np.zeros(0, np.int64)
    grams = gram_hashes(hashes, gram)
    run = window - gram + 1
    least = _sliding(grams, run, np.minimum)
    # spans that leave their text take nothing
    least[~whole_grams(words, window)[: len(least)]] = 0
    padded = np.zeros(len(grams) + run - 1, np.uint64)
    padded[run - 1 : run - 1 + len(least)] = least
    return np.flatnonzero(_sliding(padded, run, np.maximum) == grams)


def _around(hashes: np.ndarray, words: Words, owner: np.ndarray, places: np.ndarray, span: range) -> np.ndarray:
    """The words around each place, 0 beyond the ends of its text."""
    at = places[:, None] + np.array(span)
    text = owner[places][:, None]
    inside = (at >= words.first[text]) & (at < words.first[text + 1])
    return np.where(inside, hashes[np.clip(at, 0, max(len(hashes) - 1, 0))], np.uint64(0))


def _print_hash(hashes: np.ndarray, size: int, gram: int) -> np.ndarray:
    """A fingerprint tells which length of window it stands for."""
    return mix(gram_hashes(hashes, gram) + np.uint64(size))


def _fingerprints(block: Block, sizes: list[int], window: int, gram: int, wanted=None):
    """``(words, text, window size, place, fingerprint, words around)`` of each fingerprint that may be wanted.

    ``sizes``: for documents, the lengths of items; ``None`` takes each text for an item, which
    is a window by itself if it has fewer than ``window`` words.
    """
    words = find_words(block, ALPHANUMERIC_LOWER)
    hashes = word_hashes(block, words, ALPHANUMERIC_LOWER)
    owner = words.text_of()
    found = []
    for size in range(1, window + 1) if sizes is None else sizes:
        if size == window:
            places = winnow(hashes, words, gram, window)
            prints, span = _print_hash(hashes, size, gram), range(gram - window, window)
        else:
            places = np.flatnonzero(whole_grams(words, size))
            if sizes is None:
                places = words.first[:-1][words.counts == size]
            prints, span = _print_hash(hashes, size, size), range(size)
        prints = prints[places]
        if wanted is not None:
            likely = may_hold(wanted, prints)
            places, prints = places[likely], prints[likely]
        around = _around(hashes, words, owner, places, span)
        found.append((owner[places], size, places - words.first[owner[places]], prints, around))
    return words, found


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _lists(values: list[np.ndarray], width: int) -> pa.Array:
    flat = np.concatenate(values).astype(np.uint64).view(np.int64) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, width, dtype=np.int32)), pa.array(flat))


ITEM_PRINTS = "id long, size int, fingerprint long, around array<long>"


def _item_prints(window: int, gram: int):
    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1)):
                _, found = _fingerprints(block, None, window, gram)
                for owner, size, _, prints, around in found:
                    if len(owner):
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(pa.array(owner + block.first)),
                                pa.array(np.full(len(owner), size, np.int32)),
                                _longs(prints),
                                _lists([around.ravel()], around.shape[1]),
                            ],
                            ["id", "size", "fingerprint", "around"],
                        )

    return run


HITS = "array<struct<size: int, place: int, fingerprint: long, around: array<long>>>"
_HIT = pa.struct(
    [("size", pa.int32()), ("place", pa.int32()), ("fingerprint", pa.int64()), ("around", pa.list_(pa.int64()))]
)


def _document_prints(sizes: list[int], window: int, gram: int, wanted):
    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1)):
                words, found = _fingerprints(block, sizes, window, gram, wanted.value)
                hits: list[list] = [[] for _ in range(len(block))]
                for owner, size, places, prints, around in found:
                    rows = zip(owner.tolist(), places.tolist(), prints.view(np.int64).tolist(), around.view(np.int64).tolist())
                    for text, place, fingerprint, near in rows:
                        hits[text].append((size, place, fingerprint, near))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(k).slice(block.first, len(block)) for k in (0, 2, 3)],
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(
                            [[dict(zip(("size", "place", "fingerprint", "around"), h)) for h in own] for own in hits],
                            pa.list_(_HIT),
                        ),
                    ],
                    ["id", *PARTS, "n_words", "hits"],
                )

    return run


def contaminated_spans(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """``(id_col, n_words, n_hit, items, spans)``, a row for every row of ``docs``.

    A window is ``window`` consecutive words of an item (A-Z lower-cased), or all words of an
    item that has fewer. A document word inside any occurrence of a window is hit: ``n_hit``
    counts them, ``items`` lists the ids of the items with windows there, sorted as texts, and
    ``spans`` the hit runs of words as (first, past the last).

    Both sides keep the least ``gram``-word hash of every run that a window holds; documents
    keep only those that a bit map of the items' says may be among them. The rest is joined on
    the hash and extended word by word to both sides. Items below ``window`` words are their own
    fingerprint. A pair of a document and an item that share a passage costs a row for each
    fingerprint there; nothing is joined otherwise.

    Null and empty texts have no words, are not hit and hit nothing. Each row of a repeated id
    counts by itself; repeated items count once, items with a null id hit but are not listed.
    Other columns are ignored. Without items nothing is hit; no documents give no rows.
    """
    found = _spans(docs, items, id_col, text_col, item_id_col, item_text_col, window, gram)
    return found.select(F.col("id").alias(id_col), "n_words", "n_hit", "items", "spans")


def _spans(docs, items, id_col, text_col, item_id_col, item_text_col, window, gram) -> DataFrame:
    """The columns of :func:`contaminated_spans` and the row's key."""
    spark = docs.sparkSession
    texts = items.select(F.col(item_id_col).cast("long").alias("id"), F.col(item_text_col).alias("text"))
    prints = texts.mapInArrow(_item_prints(window, gram), ITEM_PRINTS).distinct()
    prints = materialize(prints, "item-prints")
    sizes = sorted(row[0] for row in prints.select("size").distinct().collect())
    wanted = spark.sparkContext.broadcast(bit_map(prints, F.col("fingerprint")))

    source = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *row_key(id_col, text_col)
    )
    rows = source.mapInArrow(
        _document_prints(sizes, window, gram, wanted), f"id long, ka long, kb long, n_words long, hits {HITS}"
    )
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "document-prints")

    hits = rows.where(F.size("hits") > 0).select("row", F.inline("hits"))
    theirs = prints.select(F.col("id").alias("item"), "size", "fingerprint", F.col("around").alias("theirs"))
    both = hits.join(theirs, ["size", "fingerprint"])
    # words that agree to the left and to the right of the fingerprint, as far as a window reaches
    reach = window - gram
    left = _agreeing([reach - 1 - j for j in range(reach)])
    right = _agreeing([reach + gram + j for j in range(reach)])
    middle = F.slice("around", reach + 1, gram) == F.slice("theirs", reach + 1, gram)
    long = F.col("size") == window
    both = both.select(
        "row",
        "item",
        F.when(long, F.col("place") - left).otherwise(F.col("place")).alias("first"),
        F.when(long, F.col("place") + gram + right).otherwise(F.col("place") + F.col("size")).alias("past"),
        F.when(long, middle).otherwise(F.col("around") == F.col("theirs")).alias("same"),
        "size",
    ).where("same AND past - first >= size")
    spans = both.groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("first", "past"))).alias("spans"),
        F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"),
    )
    merged = F.expr(
        "aggregate(spans, cast(array() as array<struct<first: int, past: int>>), (done, s) -> "
        "CASE WHEN size(done) > 0 AND s.first <= element_at(done, -1).past THEN "
        "concat(slice(done, 1, size(done) - 1), array(named_struct('first', element_at(done, -1).first, "
        "'past', greatest(element_at(done, -1).past, s.past)))) "
        "ELSE concat(done, array(named_struct('first', s.first, 'past', s.past))) END)"
    )
    spans = spans.select("row", "items", merged.alias("spans"))
    out = rows.select("row", "id", *PARTS, "n_words").join(spans, "row", "left")
    no_spans = F.expr("cast(array() as array<struct<first: int, past: int>>)")
    out = out.withColumn("spans", F.coalesce("spans", no_spans))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["past"] - s["first"])
    return out.select(
        "id",
        *PARTS,
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        "spans",
    )


def _agreeing(places: list[int]):
    """How many of these words agree before the first that doesn't; 0 stands for no word."""
    count = F.lit(len(places))
    for n, place in reversed(list(enumerate(places))):
        ours, theirs = F.get("around", F.lit(place)), F.get("theirs", F.lit(place))
        count = F.when((ours != theirs) | (ours == 0), F.lit(n)).otherwise(count)
    return count


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """The rows of ``docs``, all columns, without those with a hit word: each row of a repeated id by its own text."""
    hit = _spans(docs, items, id_col, text_col, item_id_col, item_text_col, window, gram).where("n_hit > 0")
    rows, name = keyed(docs, id_col, text_col)
    return rows.join(named(hit.select(*PARTS).distinct(), name), name, "left_anti").select(*docs.columns)
