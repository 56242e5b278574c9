"""Importance resampling towards a target distribution, by hashed n-grams."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialize
from .words import ALPHANUMERIC_LOWER, Block, Words, blocks, find_words

BUCKETS = 10_000
MIN_WORDS = 20
#: Bytes from the end of a span that the position table covers; longer spans are folded in blocks of so many.
REACH = 64
ROWS_A_RANGE = 1_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _position_table() -> np.ndarray:
    """``[d, b]``: what byte b adds to a checksum when d bytes follow it."""
    out = np.zeros((REACH, 256), np.uint32)
    for d in range(REACH):
        zeros, tail = zlib.crc32(bytes(d + 1)), bytes(d)
        out[d] = [zlib.crc32(bytes([b]) + tail) ^ zeros for b in range(256)]
    return out


_ADDS = _position_table()


def _moved(value: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Checksums moved past some bytes; ``by[k]`` says it of a checksum's byte k."""
    out = by[0][value & 0xFF]
    for k in range(1, 4):
        out = out ^ by[k][(value >> np.uint32(8 * k)) & 0xFF]
    return out


def _block_move() -> np.ndarray:
    by = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32)[:, None] * np.uint32(8))
    for _ in range(REACH):
        by = (by >> np.uint32(8)) ^ _ADDS[0][by & 0xFF]
    return by


def _of_zeros(length: np.ndarray) -> np.ndarray:
    """The checksum of that many zero bytes: the part that depends on the length alone."""
    sizes, which = np.unique(length, return_inverse=True)
    return np.array([zlib.crc32(bytes(int(n))) for n in sizes], np.uint32)[which]


def span_crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``zlib.crc32`` of each ``data[start:end]``; spans may overlap and are not empty.

    A checksum is the exclusive or of what each byte adds at its distance from the end, and of a
    constant of the length. Spans longer than the table are cut into blocks from the end; the
    blocks' sums are joined two by two, each left one moved past its right neighbour.
    """
    if not len(starts):
        return np.zeros(0, np.uint32)
    length = ends - starts
    many = -(-length // REACH)
    span = np.repeat(np.arange(len(starts)), many)
    from_end = np.arange(len(span)) - np.repeat(np.cumsum(many) - many, many)
    high = ends[span] - REACH * from_end
    low = np.maximum(starts[span], high - REACH)
    size = high - low
    first = np.cumsum(size) - size
    place = np.arange(size.sum()) + np.repeat(low - first, size)
    value = np.bitwise_xor.reduceat(_ADDS[np.repeat(high, size) - 1 - place, data[place]], first)
    by = _block_move() if many.max() > 1 else None
    while len(span) > len(starts):
        right = np.flatnonzero(from_end % 2 == 0)
        joined = value[right]
        has_left = np.append(span[1:] == span[:-1], False)[right]
        joined[has_left] ^= _moved(value[right[has_left] + 1], by)
        span, from_end, value = span[right], from_end[right] // 2, joined
        by = _moved(by, by)
    return value ^ _of_zeros(length)


def features(block: Block, low: int, high: int) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of each text, checksums of its runs of ``low`` to ``high`` words, and the text of each."""
    words = find_words(block, ALPHANUMERIC_LOWER)
    data, starts, ends, owner = _LOWER[block.data], words.starts, words.ends, words.text_of()
    if high > 1 and len(starts):
        # words in a row with one space after each, so that a run of words is a run of bytes
        size = ends - starts + 1
        past = np.cumsum(size)
        place = np.arange(past[-1]) - np.repeat(past - size - starts, size)
        spaced = data[np.minimum(place, len(data) - 1)]
        spaced[past - 1] = 32
        data, starts, ends = spaced, past - size, past - 1
    sums, owners = [], []
    for k in range(low, high + 1):
        first = np.flatnonzero(np.arange(len(starts)) + k <= np.repeat(words.first[1:], words.counts))
        sums.append(span_crc32(data, starts[first], ends[first + k - 1]))
        owners.append(owner[first])
    return words, np.concatenate(sums), np.concatenate(owners)


def bucket_counts(texts: DataFrame, text_col: str, buckets: int, low: int, high: int) -> np.ndarray:
    """Features of all texts by bucket: one row of each bucket and task is shuffled, ``buckets`` are collected."""

    def run(batches):
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for block in blocks(batch.column(0)):
                _, sums, _ = features(block, low, high)
                n += np.bincount(sums % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"bucket": held.astype(np.int64), "n": n[held]})

    source = texts.select(F.col(text_col).alias("text"))
    rows = source.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for row in rows:
        out[row["bucket"]] = row["n"]
    return out


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight, in thousandths, from smoothed frequencies."""
    kinds = len(target)
    total_target, total_source = int(target.sum()) + kinds, int(source.sum()) + kinds
    return np.array(
        [
            math.floor(1000 * math.log((float(t + 1) * total_source) / (float(s + 1) * total_target)))
            for t, s in zip(target.tolist(), source.tolist())
        ],
        np.int64,
    )


def _weighing(gain: np.ndarray, low: int, high: int):
    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1)):
                words, sums, owner = features(block, low, high)
                weight = np.zeros(len(block), np.int64)
                np.add.at(weight, owner, gain[sums % np.uint32(len(gain))])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, len(block)),
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(np.bincount(owner, minlength=len(block)).astype(np.int64)),
                        pa.array(weight),
                    ],
                    ["id", "n_words", "n_features", "weight"],
                )

    return run


def gumbel(id_col: Column, seed: int) -> Column:
    """Gumbel noise of an id in thousandths: the same for equal ids, whatever the partitioning."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    head = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((head + 0.5) / F.lit(4294967296.0))))


def _numbered(batches):
    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        place = np.arange(n, n + batch.num_rows, dtype=np.int64)
        n += batch.num_rows
        columns = [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int64)), pa.array(place)]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "part", "place"])


def ranked(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` with ``rank`` 1, 2, 3, ... in that order, which must be total.

    Rows are spread by range and numbered where they lie; what is collected is the number of rows of
    each range, of which there is one for about ``ROWS_A_RANGE`` rows.
    """
    spark = df.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.count() // ROWS_A_RANGE + 1)
    placed = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    schema = placed.withColumns({"part": F.lit(0).cast("long"), "place": F.lit(0).cast("long")}).schema
    placed = materialize(placed.mapInArrow(_numbered, schema), "ranked")
    before, rows = 0, []
    for part, n in sorted(placed.groupBy("part").count().collect()):
        rows.append((part, before))
        before += n
    offsets = spark.createDataFrame(rows, "part long, before long")
    numbered = placed.join(F.broadcast(offsets), "part")
    return numbered.withColumn("rank", F.col("before") + F.col("place") + 1).drop("part", "place", "before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    seed: int = 2024,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    ngrams: tuple[int, int] = (1, 1),
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """``(id_col, n_features, weight, score, rank)``, a row for every row of ``docs``, all but the id of type long.

    Features of a text are its runs of ``ngrams[0]`` to ``ngrams[1]`` words (A-Z lower-cased), joined by a
    space, repeats counted; a feature's bucket is its CRC-32 modulo ``buckets``. A weight is the sum over a
    text's features of how much more frequent their buckets are in ``target`` than in ``docs``, in thousandths
    of a natural logarithm; a score is the weight and Gumbel noise of the id. Of the N texts with at least
    ``min_words`` words the ``floor(percent * N / 100)`` of the highest scores are drawn, which is a sample without
    replacement by those weights; ``rank`` counts them and is null elsewhere.

    Texts are read twice, for counts and for weights, and not shuffled; the rows that are ordered hold numbers only.
    The driver gets two counts for each bucket and a row for each range of the order.

    A null or empty text has no features and weight 0. A null id has the noise of the empty id and comes
    after others in ties; rows that repeat an id are texts of their own, in the order of the table where
    score and id are the same. Other columns are ignored; without target every frequency there is that of
    smoothing; no rows give no rows.
    """
    low, high = ngrams
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    gain = gains(
        bucket_counts(target, target_text_col, buckets, low, high),
        bucket_counts(source, "text", buckets, low, high),
    )
    schema = source.select("id").schema.add("n_words", "long").add("n_features", "long").add("weight", "long")
    weighed = source.mapInArrow(_weighing(gain, low, high), schema)
    scored = weighed.withColumns(
        {"score": F.col("weight") + gumbel(F.col("id"), seed), "row": F.monotonically_increasing_id()}
    )
    scored = materialize(scored, "scored")
    enough = F.col("n_words") >= min_words
    drawn = scored.where(enough).count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    inside = ranked(scored.where(enough), order)
    inside = inside.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    outside = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score", "rank"]
    return inside.select(*columns).unionByName(outside.select(*columns))
