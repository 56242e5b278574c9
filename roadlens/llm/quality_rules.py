"""Quality rules: fixed limits, then a calibrated logistic regression on hashed n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialize
from .labelled import label_sample
from .text_counts import base_counts
from .words import Block, Words, blocks, code_points, gram_hashes, mix

BUCKETS = 1 << 15
SCALE = 100.0
SAMPLE = 8_000
KEEP_FROM = 0.5
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30


def _grams(block: Block, words: Words, hashes: np.ndarray, buckets: int):
    """Hashed words, pairs of words and triples of characters: ``(bucket, where each text's begin)`` of each kind."""
    mask = np.uint64(buckets - 1)
    yield (hashes & mask).astype(np.int64), words.first
    pairs = (gram_hashes(hashes, 2) & mask).astype(np.int64) + buckets
    last = words.first[1:][words.counts > 0] - 1
    inside = np.ones(len(hashes), bool)
    inside[last] = False
    upto = np.concatenate(([0], np.cumsum(inside)))
    yield pairs[inside[: len(pairs)]], upto[words.first]
    codes, begins = code_points(block)
    codes = codes.astype(np.uint64)
    triples = mix(codes[:-2] << np.uint64(42) | codes[1:-1] << np.uint64(21) | codes[2:]) if len(codes) > 2 else codes[:0]
    inside = np.ones(len(codes), bool)
    for back in (1, 2):
        ends = begins[1:] - back
        inside[ends[(ends >= begins[:-1])]] = False
    upto = np.concatenate(([0], np.cumsum(inside)))
    yield (triples & mask).astype(np.int64)[inside[: len(triples)]] + 2 * buckets, upto[begins]


def _features(buckets: int):
    """Shares of the n-grams of each kind, as a sparse vector a text."""

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1)):
                words, hashes, _ = base_counts(block)
                parts = list(_grams(block, words, hashes, buckets))
                index, value = [], []
                for i in range(len(block)):
                    own_index, own_value = [], []
                    for bucket, first in parts:
                        own, n = np.unique(bucket[first[i] : first[i + 1]], return_counts=True)
                        own_index.append(own)
                        own_value.append(n * (SCALE / max(n.sum(), 1)))
                    index.append(np.concatenate(own_index).astype(np.int32))
                    value.append(np.concatenate(own_value))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, len(block)),
                        batch.column(2).slice(block.first, len(block)),
                        pa.array(index, pa.list_(pa.int32())),
                        pa.array(value, pa.list_(pa.float64())),
                    ],
                    ["id", "label", "at", "value"],
                )

    return run


def _judged(block: Block, m: dict, buckets: int):
    """The words of the block's texts, their counts, and the probability of label 1."""
    words, hashes, counts = base_counts(block)
    margin = np.full(len(block), m["intercept"])
    if m["weights"] is not None:
        for bucket, first in _grams(block, words, hashes, buckets):
            sums = np.diff(np.concatenate(([0.0], np.cumsum(m["weights"][bucket])))[first])
            margin += SCALE * sums / np.maximum(np.diff(first), 1)
    return words, counts, 1 / (1 + np.exp(-np.clip(m["slope"] * margin + m["shift"], -500, 500)))


def _scored(model, buckets: int):
    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1)):
                _, counts, score = _judged(block, model.value, buckets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, len(block)),
                        *(pa.array(c.astype(np.int64)) for c in counts.values()),
                        pa.array(score),
                    ],
                    ["id", *counts, "score"],
                )

    return run


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
    buckets: int = BUCKETS,
) -> dict:
    """Weights of the hashed n-grams and of the calibration, from at most ``sample`` labelled rows.

    A fifth of the rows (by hash of the id) is left out of the regression and fits the slope and
    shift that turn its margin into a probability (Platt). With labels of one kind only, or none,
    every text gets the share of 1 among them (1 without labels).
    """
    spark = docs.sparkSession
    chosen = label_sample(labels, id_col, label_col, sample)
    # at most ``sample`` pairs of numbers
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = source.join(F.broadcast(chosen), F.col("id") == F.col("label_id")).select("id", "text", "label")
    rows = rows.mapInArrow(_features(buckets), "id long, label int, at array<int>, value array<double>")
    rows = materialize(rows, "features").dropDuplicates(["id"])
    vector = F.udf(lambda at, value: SparseVector(3 * buckets, at, value), VectorUDT())
    rows = rows.select(
        F.col("label").cast("double").alias("label"),
        vector("at", "value").alias("features"),
        (F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(5)) == 0).alias("left_out"),
    ).repartition(spark.sparkContext.defaultParallelism).persist()
    try:
        kinds = {(r["label"], r["left_out"]): r["count"] for r in rows.groupBy("label", "left_out").count().collect()}
        seen = sum(kinds.values())
        good = sum(n for (label, _), n in kinds.items() if label > 0)
        if len({label for label, left_out in kinds if not left_out}) < 2:
            share = (good + 1) / (seen + 1)
            # a margin of 0 for all texts
            return {"weights": None, "intercept": 0.0, "slope": 0.0, "shift": float(np.log(share / max(1 - share, 1e-9)))}
        learner = LogisticRegression(maxIter=40, regParam=1e-4, standardization=False)
        fitted = learner.fit(rows.where("not left_out"))
        out = {
            "weights": fitted.coefficients.toArray(),
            "intercept": float(fitted.intercept),
            "slope": 1.0,
            "shift": 0.0,
        }
        if len({label for label, left_out in kinds if left_out}) == 2:
            fitted.setRawPredictionCol("margin")
            margin = fitted.transform(rows.where("left_out")).select(
                "label", F.array(vector_to_array("margin")[1]).alias("margin")
            )
            one = F.udf(lambda m: SparseVector(1, [0], m), VectorUDT())
            platt = LogisticRegression(maxIter=50, regParam=1e-3).fit(margin.select("label", one("margin").alias("features")))
            out |= {"slope": float(platt.coefficients[0]), "shift": float(platt.intercept)}
        return out
    finally:
        rows.unpersist()


def quality_verdicts(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    keep_from: float = KEEP_FROM,
    sample: int = SAMPLE,
    buckets: int = BUCKETS,
) -> DataFrame:
    r"""``(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept)``.

    A row for every row of ``docs``. Words are split at white space. ``word_chars`` counts
    characters in words, ``n_symbols`` those of ``#*$%&|<>``, ``n_dup_lines`` lines (split at \n)
    with a word that equal an earlier one, ``n_repeat_words`` words in 8-word windows that the text
    has twice or more. ``base_failed``: fewer than 20 words, or over 30 % of them repeated.

    ``score`` is the calibrated probability of label 1: a logistic regression on shares of hashed
    words, pairs of words and triples of characters, over whole texts; ``kept`` asks for
    ``keep_from`` and no failed base rule. It is fitted on at most ``sample`` labelled rows and
    applied in Arrow batches without a shuffle.

    Null and empty texts count 0 and fail the base rules. Rows that repeat an id are judged each
    by itself (of those labelled, one is learned from). Other columns are ignored, and no rows
    give no rows.
    """
    model = fit_quality(docs, labels, id_col, text_col, label_col, sample, buckets)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = "id long, " + ", ".join(f"{name} long" for name in names) + ", score double"
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = source.mapInArrow(_scored(sent, buckets), schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (F.col("score") >= keep_from)
    return out.select(F.col("id").alias(id_col), *names, "base_failed", "score", kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that ``quality_verdicts`` keeps; each is judged by itself, in one pass."""
    keep_from, buckets = options.pop("keep_from", KEEP_FROM), options.get("buckets", BUCKETS)
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, id_col, text_col, **options))
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(at)):
                _, counts, score = _judged(block, model.value, buckets)
                n, repeated = counts["n_words"], counts["n_repeat_words"]
                kept = (n >= MIN_WORDS) & (100 * repeated <= MAX_REPEATED_PERCENT * n) & (score >= keep_from)
                yield batch.slice(block.first, len(block)).filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
