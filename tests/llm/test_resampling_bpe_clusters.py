"""Resampling, byte-level BPE and heap clustering against plain Python."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from roadlens.llm import byte_bpe, heap_kmeans, queries, resampling
from tests.llm import brute
from tests.llm.test_operators import ODD, frame, small_documents

RANKS = public_tokenizers.path(queries.BYTE_RANKS)
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows(spark):
    return small_documents(spark) + ODD


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows)


@pytest.fixture(scope="module")
def none(spark, docs):
    return spark.createDataFrame([], docs.schema)


# ---------------------------------------------------------------- 11


def test_checksums_of_spans():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 30_000).astype(np.uint8)
    size = np.concatenate((np.arange(1, 300), [1024, 4096, 20_000, 64, 128]))
    starts = rng.integers(0, len(data) - size)
    found = resampling.span_crc32(data, starts, starts + size)
    assert found.tolist() == [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts, size)]
    assert len(resampling.span_crc32(data, starts[:0], starts[:0])) == 0


def brute_resample(rows, target, percent, min_words, buckets, low, high, seed=2024):
    def found(text):
        words = brute.alphanumeric(text)
        return [" ".join(words[i : i + k]) for k in range(low, high + 1) for i in range(len(words) - k + 1)]

    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    s = Counter(bucket(f) for _, text in rows for f in found(text))
    t = Counter(bucket(f) for text in target for f in found(text))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in s}
    out = []
    for i, (doc_id, text) in enumerate(rows):
        features = found(text)
        weight = sum(gain[bucket(f)] for f in features)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, len(features), weight, score, len(brute.alphanumeric(text)) >= min_words))
    inside = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = len(inside) * percent // 100
    ranks = [(*r[:4], n if n <= drawn else None) for n, r in enumerate(inside, 1)]
    return sorted(map(str, ranks + [(*r[:4], None) for r in out if not r[4]]))


@pytest.mark.parametrize("percent, ngrams, buckets", [(10, (1, 1), 10_000), (50, (1, 3), 97), (100, (2, 2), 1000)])
def test_resampling_equals_brute_force(spark, rows, docs, percent, ngrams, buckets):
    target = [t for _, t in rows[:40:4]] + [None, "", "solo"]
    table = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    found = resampling.resample(docs, table, percent, ngrams=ngrams, buckets=buckets)
    got = sorted(str(tuple(r)) for r in found.collect())
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert got == brute_resample(rows, target, percent, 20, buckets, *ngrams)


def test_resampling_without_rows_or_target(docs, none):
    assert resampling.resample(none, docs).collect() == []
    drawn = resampling.resample(docs, none).where("rank IS NOT NULL")
    assert [r["rank"] for r in drawn.orderBy("rank").collect()] == list(range(1, drawn.count() + 1))


def test_resampling_of_one_row_many_times(spark):
    """Nothing but the place tells rows of a hot id apart; they are spread by it."""
    text = " ".join(f"w{i}" for i in range(25))
    same = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    found = resampling.resample(same, same.limit(1)).where("rank IS NOT NULL")
    assert sorted(r["rank"] for r in found.collect()) == list(range(1, 301))


# ---------------------------------------------------------------- 12


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_equals_the_library(docs, rows, reference):
    coded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "n_tokens", "ids"]
    back = byte_bpe.decode(coded, RANKS)
    assert back.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    got = sorted((str(r[0]), r[1], np.frombuffer(r[2], "<u4").tolist(), bytes(r[3])) for r in back.collect())
    ids = [(i, reference.encode_ordinary(t or "")) for i, t in rows]
    assert got == sorted((str(i), len(x), x, reference.decode_bytes(x)) for i, x in ids)
    assert sorted(x[3] for x in got) == sorted((t or "").encode() for _, t in rows)
    both = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, decoded_col="text")
    assert both.columns == ["doc_id", "n_tokens", "ids", "text"]
    assert sorted(str(tuple(r)) for r in both.collect()) == sorted(str(tuple(r)) for r in back.collect())


def test_words_of_any_length(reference):
    with open(RANKS) as file:
        coder = byte_bpe.ByteBpe(file.read())
    rng = random.Random(1)
    kinds = ["a", "ab", "acgt", "abcdefghijklmnopqrstuvwxyz", "的是我日本語あいう", "абвгде", "=-", "🙂é", " "]
    sizes = [1, 2, 3, 7, 40, byte_bpe.LONG_WORD - 1, byte_bpe.LONG_WORD, byte_bpe.LONG_WORD + 1, 700]
    words = list(dict.fromkeys("".join(rng.choice(k) for _ in range(n)) for k in kinds for n in sizes))
    words += ["a" * 20_000, "".join(rng.choice("acgt") for _ in range(4000))]
    for known in (False, True):
        ids, counts = coder.encode(words)
        parts = [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]
        assert parts == [reference._core_bpe.encode_single_piece(w.encode()) for w in words], known
    assert coder.decode(ids, counts) == [w.encode() for w in words]


def test_spaces_marks_and_every_kind_of_break(spark, reference):
    texts = ["  a  b\n\n c \t\n", "it's we'll I'D", "x y z ​ \u0085", "١٢٣ ½ ²", "\x00\x1c\x1f", "a" * 5000 + " b"]
    texts += [f"a{chr(c)}1 {chr(c)}{chr(c)} b" for c in range(0x80, 0x3100, 7)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = byte_bpe.encode(table, RANKS, public_tokenizers.PATTERN).orderBy("doc_id").collect()
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in found] == [reference.encode_ordinary(t) for t in texts]


def test_text_longer_than_a_block(spark, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK", 64)
    monkeypatch.setattr(byte_bpe, "WORDS_AT_ONCE", 5)
    monkeypatch.setattr(byte_bpe, "IDS_AT_ONCE", 7)
    monkeypatch.setattr(byte_bpe, "KNOWN_WORDS", 3)
    texts = ["many words stand in this text, too many of them " * 4, "few", "", None]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = byte_bpe.decode(byte_bpe.encode(table, RANKS, public_tokenizers.PATTERN), RANKS).orderBy("doc_id")
    found = coded.collect()
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in found] == [reference.encode_ordinary(t or "") for t in texts]
    assert [bytes(r["decoded"]).decode() for r in found] == [t or "" for t in texts]


def test_coding_nothing_and_ids_without_a_token(spark, none):
    assert byte_bpe.encode(none, RANKS, public_tokenizers.PATTERN).collect() == []
    table = spark.createDataFrame([(1, None, "x"), (2, bytearray(b"\xff\xff\xff\x7f"), "y")], "n int, ids binary, decoded string")
    assert [(r["n"], bytes(r["decoded"])) for r in byte_bpe.decode(table, RANKS).collect()] == [(1, b""), (2, b"")]


# ---------------------------------------------------------------- 13


def brute_clusters(rows, k, rounds, dims, seed=1):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = [(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    centroids = [v for _, v in sorted(named)[:k]]

    def assign():
        squares = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids] for _, v in kept]
        return [(s.index(min(s)), min(s)) for s in squares]

    for _ in range(rounds):
        own = assign()
        for c in range(len(centroids)):
            members = [v for (_, v), (a, _) in zip(kept, own) if a == c]
            if members:
                centroids[c] = [sum(x) // len(members) for x in zip(*members)]
    own = assign() if centroids else []
    inertia = Counter()
    for c, d in own:
        inertia[c] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(str((i, c, d, inertia[c], sum(inertia.values()), names[c])) for (i, _), (c, d) in zip(kept, own))


VECTORS = "vec_id long, embedding array<float>, cluster string, distance int, id int"


def vectors(kind):
    rng = np.random.default_rng(3)
    if kind == "spread":
        rows = [(i, rng.normal(i % 7, 0.4, 8).astype(np.float32).tolist()) for i in range(600)]
        odd = [None, [], [1.0] * 7, [1.0] * 9, [1.0] * 7 + [None], [math.nan] * 8, [math.inf] * 8, [-math.inf] + [0.0] * 7]
        return rows + [(1000 + i, v) for i, v in enumerate(odd)] + [(None, [0.5] * 8), (5, [0.25] * 8), (5, [0.25] * 8)]
    if kind == "ties":
        return [(i, rng.integers(-1, 2, 8).astype(float).tolist()) for i in range(400)]
    if kind == "copies":
        return [(i, [1.0] * 8 if i % 3 else rng.normal(0, 1, 8).astype(np.float32).tolist()) for i in range(500)]
    if kind == "few":
        return [(i, [float(i)] * 8) for i in range(3)]
    if kind == "one":
        return [(i, [float(i % 4)] * 8) for i in range(20)]
    return [(i, (rng.normal(0, 3e5, 8)).astype(np.float32).tolist()) for i in range(200)]


@pytest.mark.parametrize("kind, k, rounds", [("spread", 6, 3), ("spread", 16, 8), ("ties", 5, 6), ("copies", 7, 4), ("few", 5, 3), ("one", 1, 2), ("large", 9, 3)])
def test_clusters_equal_plain_rounds(spark, monkeypatch, kind, k, rounds):
    monkeypatch.setattr(heap_kmeans, "BLOCK_VECTORS", 64)
    rows = vectors(kind)
    table = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], VECTORS).repartition(3)
    found = heap_kmeans.heap_kmeans(table, k, rounds, dims=8)
    assert sorted(str(tuple(r)) for r in found.collect()) == brute_clusters(rows, k, rounds, 8)


def test_no_vectors(spark):
    table = spark.createDataFrame([(1, None, "x", 1, 2)], VECTORS)
    found = heap_kmeans.heap_kmeans(table, dims=8)
    assert found.collect() == []
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_components_out_of_range_are_held(spark):
    table = spark.createDataFrame([(1, [3e38] * 64, "x", 1, 2), (2, [-3e38] * 64, "x", 1, 2)], VECTORS)
    found = heap_kmeans.heap_kmeans(table, 1, 0).collect()
    assert sorted(r["distance"] for r in found) == [0, 64 * (2 * heap_kmeans.LARGEST) ** 2]


def test_only_vectors_whose_gap_is_used_up_are_compared(monkeypatch):
    rng = np.random.default_rng(5)
    held = np.concatenate([rng.normal(c * 4000, 40, (500, 8)) for c in range(4)]).astype(np.int64)
    centroids = held[::500] + 1
    block = heap_kmeans._Block.first_assigned(np.arange(len(held)), held, centroids)
    seen = []
    plain = heap_kmeans.nearest
    monkeypatch.setattr(heap_kmeans, "nearest", lambda v, c: seen.append(len(v)) or plain(v, c))
    drift = np.zeros(4)
    for step in range(3):
        moved = centroids + 30 * (step + 1)
        way = np.sqrt(((moved - centroids) ** 2).sum(1))
        drift = drift + 2 * way * (1 + heap_kmeans.SLACK)
        centroids = moved
        block.move(centroids, drift)
        assert (block.cluster == plain(held, centroids)[0]).all()
    assert sum(seen) < len(held) // 10
