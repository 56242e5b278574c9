"""A kernel classifier of quality: random Fourier features, ridge regression, isotonic calibration."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialize
from .labelled import label_sample
from .text_counts import SYMBOLS, base_counts, within
from .words import Block, blocks

FEATURES = 256
BANDWIDTH = 2.0
RIDGE = 1e-2
SAMPLE = 100_000
PARTS = 32
POSITIVE_FROM = 0.3


def _bytes(chars: bytes) -> np.ndarray:
    return np.isin(np.arange(256), np.frombuffer(chars, np.uint8))


UPPER = _bytes(bytes(range(65, 91)))
LETTER = UPPER | _bytes(bytes(range(97, 123))) | (np.arange(256) >= 0xC0)
DIGIT = _bytes(b"0123456789")
STOP = _bytes(b".!?")
MARK = _bytes(b"!")
PAUSE = _bytes(b",;:")
OTHER = _bytes(b"@/\\_=~^{}[]()\"'`+-")
WIDE = np.arange(256) >= 0xC0
BREAK = _bytes(b"\n")

STATISTICS = 20


def statistics(block: Block) -> np.ndarray:
    """Of each text, numbers about its length, characters, words, lines and repetition."""
    words, hashes, counts = base_counts(block)
    n = counts["n_words"]
    chars = np.maximum(counts["word_chars"], 1)
    some = np.maximum(n, 1)
    share = {name: within(mask[block.data], block.bounds) for name, mask in (
        ("upper", UPPER), ("letter", LETTER), ("digit", DIGIT), ("stop", STOP), ("mark", MARK),
        ("pause", PAUSE), ("other", OTHER), ("wide", WIDE), ("break", BREAK), ("symbol", SYMBOLS),
    )}
    length = words.ends - words.starts
    first = block.data[words.starts]
    keys = words.text_of().astype(np.uint64) << np.uint64(48) | hashes >> np.uint64(16)
    ordered = np.sort(keys)
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    kinds = within(new, words.first)
    lines = share["break"] + 1
    long_words = within(length > 15, words.first)
    columns = [
        np.log1p(n),
        np.log1p(n / lines),
        counts["word_chars"] / some,
        np.sqrt(kinds / some),
        kinds / np.sqrt(some),
        np.sqrt(counts["n_repeat_words"] / some),
        np.sqrt(counts["n_dup_lines"] / lines),
        np.sqrt(share["upper"] / np.maximum(share["letter"], 1)),
        np.sqrt(within(UPPER[first], words.first) / some),
        np.sqrt(share["symbol"] / chars),
        np.sqrt(share["mark"] / chars),
        np.sqrt(share["digit"] / chars),
        np.sqrt(share["stop"] / chars),
        np.sqrt(share["pause"] / chars),
        np.sqrt(share["other"] / chars),
        np.sqrt(share["wide"] / chars),
        np.sqrt(long_words / some),
        np.sqrt(within(length <= 3, words.first) / some),
        np.log1p(n / (share["stop"] + 1)),
        np.log1p(lines),
    ]
    return np.stack(columns, 1).astype(float)


def _measured():
    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(2)):
                rows = statistics(block)
                flat = pa.array(rows.ravel())
                edges = pa.array(np.arange(0, rows.size + 1, STATISTICS, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, len(block)),
                        batch.column(1).slice(block.first, len(block)),
                        pa.ListArray.from_arrays(edges, flat),
                    ],
                    ["id", "held_out", "statistics"],
                )

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS)


class Kernel:
    """Random features whose products approximate a Gaussian kernel of standardised statistics."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int, bandwidth: float):
        random = np.random.default_rng(9)
        self.mean, self.spread = mean, spread
        self.directions = random.normal(size=(STATISTICS, features)) / bandwidth
        self.phases = random.uniform(0, 2 * np.pi, features)

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        near = np.clip((rows - self.mean) / self.spread, -8, 8)
        waves = np.cos(near @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate((waves, near, np.ones((len(rows), 1))), 1)


def _normal_equations(kernel):
    """The sums of a partition: products of its features, and features times label."""

    def run(batches):
        features, size = Kernel(*kernel.value), None
        for batch in batches:
            z = features(_matrix(batch.column(1)))
            y = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
            if size is None:
                size = z.shape[1]
                products, with_label = np.zeros((size, size)), np.zeros(size)
            products += z.T @ z
            with_label += z.T @ y
        if size is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([products.tobytes()], pa.binary()), pa.array([with_label.tobytes()], pa.binary())],
                ["products", "with_label"],
            )

    return run


def _raw(kernel, weights):
    def run(batches):
        features = Kernel(*kernel.value)
        for batch in batches:
            raw = features(_matrix(batch.column(1))) @ weights
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw)], ["label", "raw"])

    return run


def _scored(model):
    def run(batches):
        m = model.value
        features = Kernel(*m["kernel"]) if m["kernel"] else None
        for batch in batches:
            if features is None:
                score = np.full(batch.num_rows, m["share"])
            else:
                raw = features(_matrix(batch.column(2))) @ m["weights"]
                score = np.interp(raw, m["raw"], m["score"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.clip(score, 0, 1))], ["id", "held_out", "score"]
            )

    return run


def kernel_scores(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
    features: int = FEATURES,
    positive_from: float = POSITIVE_FROM,
) -> DataFrame:
    """``(id_col, held_out, score, predicted)``, a row for every row of ``docs``.

    ``score`` is the probability of label 1 from statistics of the whole text alone. Random
    Fourier features approximate a Gaussian kernel over the statistics; each partition sums its
    normal equations, at most ``PARTS`` such sums are added up and solved with a ridge, and an
    isotonic regression on a fourth of the labelled rows, left out before, turns the result into
    a probability. At most ``sample`` labelled rows where ``held_out`` is false are learned from.

    Labels join the statistics, not the texts. Null and empty texts have the statistics of no
    words. Rows that repeat an id are scored each by itself and learned from once. With labels
    of one kind only every text gets their share of 1, without labels 1. Other columns are
    ignored, and no rows give no rows.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    schema = "id long, held_out boolean, statistics array<double>"
    rows = materialize(source.mapInArrow(_measured(), schema), "statistics")
    chosen = label_sample(labels, id_col, label_col, sample)
    learned = rows.where("not held_out").join(chosen, F.col("id") == F.col("label_id")).dropDuplicates(["id"])
    fold = F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(4))
    learned = learned.select("label", "statistics", (fold == 0).alias("calibrates"))
    learned = materialize(learned.repartition(PARTS), "learned")

    each = [F.get("statistics", F.lit(i)) for i in range(STATISTICS)]
    counted = learned.where("not calibrates").agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("label"), F.lit(0)).alias("good"),
        F.array(*[F.avg(c) for c in each]).alias("mean"),
        F.array(*[F.stddev_pop(c) for c in each]).alias("spread"),
    ).first()
    if counted["good"] in (0, counted["n"]):
        model = {"kernel": None, "share": counted["good"] / counted["n"] if counted["n"] else 1.0}
    else:
        spread = np.array(counted["spread"])
        kernel = (np.array(counted["mean"]), np.where(spread > 1e-9, spread, 1.0), features, BANDWIDTH)
        sent = spark.sparkContext.broadcast(kernel)
        parts = learned.where("not calibrates").select("label", "statistics").mapInArrow(
            _normal_equations(sent), "products binary, with_label binary"
        ).collect()
        size = features + STATISTICS + 1
        products = sum(np.frombuffer(p["products"]).reshape(size, size) for p in parts)
        with_label = sum(np.frombuffer(p["with_label"]) for p in parts)
        weights = np.linalg.solve(products + RIDGE * np.eye(size), with_label)
        # raw results to a thousandth: as many steps at most
        raw = learned.where("calibrates").select("label", "statistics").mapInArrow(_raw(sent, weights), "label int, raw double")
        raw = raw.select(F.col("label").cast("double").alias("label"), F.round("raw", 3).alias("features"))
        if raw.isEmpty():
            steps, values = [0.0, 1.0], [0.0, 1.0]
        else:
            steps, values = _isotonic(raw)
        model = {"kernel": kernel, "weights": weights, "raw": np.array(steps), "score": np.array(values)}
    scored = rows.mapInArrow(_scored(spark.sparkContext.broadcast(model)), "id long, held_out boolean, score double")
    return scored.select(
        F.col("id").alias(id_col),
        "held_out",
        "score",
        F.when(F.col("score") >= positive_from, 1).otherwise(0).alias("predicted"),
    )


def _isotonic(raw: DataFrame) -> tuple[list[float], list[float]]:
    fitted = IsotonicRegression().fit(raw)
    return list(fitted.boundaries), list(fitted.predictions)
