"""Text operators against plain Python, on small tables with odd rows."""

import hashlib
import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadlens.llm import class_lm, decontaminate, fourier_quality, licenses, line_dedup, near_dedup, packing
from roadlens.llm import links, quality_rules, queries, sharding, url_rules
from roadlens.llm.components import connected_components
from roadlens.llm.links import Similarity, similar_components
from roadlens.llm.words import blocks, mix
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, id long, label string, node long, `key` string"

LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
ODD = [
    (1, PASSAGE + " one two three four five six seven eight nine ten"),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b\x0c\r "),
    (5, "Word"),
    (6, "word"),
    (7, PASSAGE.upper() + " one two three four five six seven eight nine TEN"),
    (8, LONG),
    (9, LONG + " tail"),
    (10, "a a a a a a a a a a a a a a a a a a a a a a a a"),
    (10, "a a a a a a a a a a a a a a a a a a a a a a a a"),
    (None, "nameless " * 30),
    (None, None),
    (11, "Été naïve — ‘quoted’ 日本語 🙂🙂 don't it's 3.14 x2 <|endoftext|>"),
    (12, "line one is here\nline one is here\n\n \nLINE  one is here\nanother line of text\n"),
    (13, "ends with break\n"),
    (14, "four words right here"),
    (15, "Four WORDS right here"),
    (-7, PASSAGE + " one two three four five six seven eight nine eleven"),
    (16, "released under the MIT License.\nCC BY, cc-by; the apache license apache license\x00mit license"),
]


def small_documents(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return [(r["doc_id"] + 1000, r["text"]) for r in rows]


def frame(spark, rows):
    """With columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 5, "x", 7, "k") for i, t in rows], DOCS).repartition(3)


@pytest.fixture(scope="module")
def rows(spark):
    return small_documents(spark) + ODD


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark, rows):
    quality = [(i, int(not brute.quality_counts(t)[5]), 0, "x") for i, t in rows if i is not None and i >= 1000]
    more = [(1000, 0, 0, "x"), (None, 1, 0, "x"), (1, None, 0, "x"), (99_999, 1, 0, "x")]
    return spark.createDataFrame(quality + more, "doc_id long, quality int, toxic int, text string")


# ---------------------------------------------------------------- 1


ITEMS = [(1, PASSAGE), (2, "Word"), (3, None), (4, ""), (5, "a a a a a a a a a a a a"), (6, "four words right"), (12, PASSAGE), (None, "line one is here")]


def test_contamination_equals_brute_force(spark, rows, docs):
    items = ITEMS + [(100 + i, " ".join(brute.alphanumeric(t)[40:75])) for i, t in rows[:60:6]]
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id long")
    found = decontaminate.contaminated_spans(docs, table).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in found)
    assert got == sorted((str(i), *brute.contamination(t, items)) for i, t in rows)
    assert all(sum(s["past"] - s["first"] for s in r["spans"]) == r["n_hit"] for r in found)


def test_contamination_without_items_or_documents(spark, docs, none, rows):
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated_spans(docs, no_items).where("n_hit = 0").count() == len(rows)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contaminated_spans(none, items).collect() == []
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns
    clean = [i for i, t in rows if not brute.contamination(t, ITEMS)[1] and i is not None]
    assert sorted(r[0] for r in left.where("doc_id is not null").select("doc_id").collect()) == sorted(clean)


# ---------------------------------------------------------------- 2


def test_quality_counts_equal_brute_force(docs, rows, labels):
    found = quality_rules.quality_verdicts(docs, labels).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = sorted((str(r["doc_id"]), *(r[n] for n in names)) for r in found)
    assert got == sorted((str(i), *brute.quality_counts(t)) for i, t in rows)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert all(r["kept"] == (not r["base_failed"] and r["score"] >= 0.5) for r in found)


def test_quality_filter_keeps_what_the_verdict_keeps(docs, none, labels):
    verdicts = quality_rules.quality_verdicts(docs, labels)
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = lambda df: sorted(str(r["doc_id"]) for r in df.select("doc_id").collect())
    assert ids(kept) == ids(verdicts.where("kept"))
    assert quality_rules.keep_good(none, labels).collect() == []


@pytest.mark.parametrize("kind", ["none", "one"])
def test_quality_with_labels_of_one_kind(spark, docs, labels, kind):
    few = labels.where("quality = 1" if kind == "one" else "false")
    found = quality_rules.quality_verdicts(docs, few)
    assert found.where("kept = base_failed").count() == 0


def test_quality_of_documents_left_out(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = quality_rules.quality_verdicts(documents, labels.where(~out)).join(labels.where(out), "doc_id")
    good = found.where("quality = 1 and not base_failed")
    assert good.where("kept").count() >= 0.97 * good.count()
    bad = found.where("quality = 0")
    assert bad.where("kept").count() <= 0.2 * bad.count()


# ---------------------------------------------------------------- 3


def test_near_duplicates_equal_brute_force(docs, rows):
    found = near_dedup.near_duplicates(docs).collect()
    sets = [brute.shingles(t) for _, t in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if brute.similar(sets[a], sets[b], 75)]
    root = brute.components(range(len(rows)), linked)
    least = defaultdict(list)
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[root[n]].append(i)
    expected = []
    for n, (i, _) in enumerate(rows):
        component = (min(least[root[n]]) if least[root[n]] else None) if sets[n] else i
        expected.append((str(i), len(sets[n]), str(component), component == i))
    got = [(str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in found]
    assert sorted(got) == sorted(expected)


def test_near_duplicates_of_nothing(spark, none, docs):
    assert near_dedup.near_duplicates(none).collect() == []
    assert near_dedup.drop_near_duplicates(none).columns == docs.columns


@pytest.mark.parametrize("block", [3, 8, 1000])
def test_similar_components_with_blocks_of_any_size(spark, block):
    """A chain of overlapping sets, copies and strangers that share buckets, in blocks much smaller than a bucket."""
    random.seed(block)
    base = [random.getrandbits(62) for _ in range(40)]
    sets = [set(base[:30])]
    for _ in range(60):
        own = set(random.choice(sets))
        for x in random.sample(sorted(own), random.randint(0, 6)):
            own.remove(x)
            own.add(random.choice(base) if random.random() < 0.7 else random.getrandbits(62))
        sets.append(own)
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    similarity = Similarity(percent=75, hashes=64, bands=16, looks=(64,), miss=1e-12)
    rows = [
        (n, len(a), bytearray(s.tobytes()), bytearray(a.tobytes()))
        for n, (a, s) in enumerate(zip(arrays, near_dedup.signatures(arrays, 64)))
    ]
    nodes = spark.createDataFrame(rows, "node long, size long, signature binary, payload binary")
    found = similar_components(
        nodes,
        similarity,
        lambda wanted: nodes.select("node", "payload").join(wanted, "node"),
        lambda payload: [np.frombuffer(p, np.uint64) for p in payload.to_pylist()],
        block_members=block,
        ambassadors=2,
    )
    share = lambda a, b: any(
        rows[a][2][8 * i : 8 * i + 8] == rows[b][2][8 * i : 8 * i + 8] for i in range(16)
    )
    linked = [
        (a, b) for a in range(len(sets)) for b in range(a) if brute.similar(sets[a], sets[b], 75) and share(a, b)
    ]
    root = brute.components(range(len(sets)), linked)
    got = {r["node"]: r["label"] for r in found.collect()}
    assert got == {n: r for n, r in root.items() if list(root.values()).count(r) > 1}


def test_components_of_chains_hubs_and_loops(spark):
    random.seed(2)
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(60)] + [(200, 201), (201, 200), (300, 300)]
    links += [(random.randrange(400, 450), random.randrange(400, 450)) for _ in range(40)]
    root = brute.components({n for link in links for n in link}, links)
    found = connected_components(spark.createDataFrame(links + [(None, 1)], "a long, b long")).collect()
    got = {r["node"]: r["label"] for r in found}
    assert len(found) == len(got)
    assert got == {n: r for n, r in root.items() if list(root.values()).count(r) > 1}


def test_least_matches_follow_the_posterior():
    """With the least number of matches the mass above the threshold is at least the miss, with one fewer below it."""
    similarity = Similarity(percent=75, hashes=64, bands=16, looks=(16, 32, 64), miss=1e-4)

    def mass(m, n, t=0.75, steps=20_000):
        x = (np.arange(steps) + 0.5) / steps
        density = x**m * (1 - x) ** (n - m)
        return density[x >= t].sum() / density.sum()

    for n, m in zip(similarity.looks, similarity.least_matches()):
        assert mass(m, n) >= 0.9e-4
        assert mass(m - 1, n) <= 1.1e-4


# ---------------------------------------------------------------- 4


def test_shards(spark, docs, rows, none):
    found = sharding.shard(docs, 24, rows_a_chunk=3).collect()
    expected = [
        (str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), brute.jump(i or 0, 24), brute.jump(i or 0, 25))
        for i, t in rows
    ]
    got = [(str(r["doc_id"]), r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in found]
    assert sorted(got) == sorted(expected)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(r["grown_shard"] in (r["shard"], 24) for r in found)
    assert sharding.shard(none, 24).collect() == []


def test_jump_hash_moves_the_least_share(spark):
    keys = spark.range(-3000, 3000).select(
        *[sharding.jump_hash(F.col("id"), n).alias(str(n)) for n in (1, 2, 24, 25)]
    ).toPandas()
    assert set(keys["1"]) == {0}
    moved = keys[keys["24"] != keys["25"]]
    assert set(moved["25"]) == {24} and 0.03 < len(moved) / len(keys) < 0.05
    assert keys["24"].value_counts().between(190, 310).all()


# ---------------------------------------------------------------- 5


def test_packing_round_trip(spark, docs, rows, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    found = packing.pack(docs, queries.tokenizer_path()).toPandas()
    expected = sorted((*tokenizer.encode(t or "", add_special_tokens=False).ids, 2) for _, t in rows)
    found["ids"] = [np.frombuffer(x, "<u4").tolist() for x in found["ids"]]
    assert (found["ids"].map(len) == found["length"]).all()
    texts, open_text, last = [], [], None
    order = found.sort_values(["sequence_id", "offset"])
    for piece in order.itertuples():
        assert piece.start == len(open_text)
        open_text += piece.ids
        if len(open_text) == piece.doc_tokens:
            texts.append(tuple(open_text))
            open_text = []
    assert sorted(texts) == expected
    filled = found.groupby("sequence_id")["length"].sum()
    assert filled.max() <= 4096
    for _, pieces in order.groupby("sequence_id"):
        assert (pieces["offset"].to_numpy() == np.concatenate(([0], np.cumsum(pieces["length"])[:-1]))).all()
    # three partitions may end short
    assert 4096 * (len(filled) - 3) - filled.sum() <= 0.03 * filled.sum()
    assert packing.pack(none, queries.tokenizer_path()).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_best_cuts_cost_least(seed):
    random.seed(seed)
    places = sorted(random.sample(range(1, 120), 25))
    cost = [random.choice([0, 3, 9]) for _ in places]
    size = max(np.diff([0, *places]).max(), 20)

    def total(cuts):
        ends = [0, *cuts]
        return sum(size - (b - a) + cost[places.index(b)] for a, b in zip(ends, ends[1:]))

    best = {0: 0}
    for j, b in enumerate(places):
        best[b] = min(best[a] + size - (b - a) + cost[j] for a in best if b - a <= size)
    cuts = packing.best_cuts(places, cost, size, final=True)
    assert cuts[-1] == places[-1] and total(cuts) == best[places[-1]]
    assert all(b - a <= size for a, b in zip([0, *cuts], cuts))


# ---------------------------------------------------------------- 6


def test_licenses_equal_brute_force(docs, rows, none):
    found = licenses.scan_licenses(docs).collect()
    templates = licenses._templates(licenses.TEMPLATES, licenses.CONTAINMENT)
    expected = []
    for i, text in rows:
        words = brute.alphanumeric(text)
        places, base, more, best = [], set(), set(), 0.0
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            at = [k for k in range(len(words)) if words[k : k + len(p)] == p]
            places += at
            base |= {label} if at else set()
        for _, label, theirs, least, reach in templates:
            starts = [k for k, word in enumerate(words) if word in theirs]
            most = max((len(set(words[k : k + reach]) & set(theirs)) for k in starts), default=0)
            if most >= least:
                more.add(label)
                best = max(best, most / len(theirs))
        ends = (str(min(places)), str(max(places))) if places else ("None", "None")
        score = 1.0 if places else best
        expected.append((str(i), len(words), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(base | more)), score))
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    got = []
    for r in found:
        n_words, n_base, first, last, *rest = (r[n] for n in names)
        got.append((str(r["doc_id"]), n_words, n_base, str(first), str(last), *rest))
    assert sorted(got) == sorted(expected)
    assert any(r["blocks"] for r in found)
    assert licenses.scan_licenses(none).collect() == []


WRAPPED = {
    "bsd-notice": "Redistribution and use in source and binary forms, with or without\n{}modification, are permitted provided that",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify\n{}it under the terms of the GNU\n{}General Public License as published",
    "apache-notice": "you may not use this file\n{}except in compliance\n{}with the License.",
    "mit-notice": "Permission is hereby granted, free of\n{}charge, to any person obtaining a copy\n{}of this software",
}


@pytest.mark.parametrize("mark", ["", " * ", "# "])
def test_wrapped_notices_are_found(spark, mark):
    rows = [(i, f"first line\n{mark}" + text.format(mark, mark) + "\nlast") for i, text in enumerate(WRAPPED.values())]
    rows += [(9, WRAPPED["bsd-notice"].replace("\n", "\n\n").format(mark))]
    found = {r["doc_id"]: r for r in licenses.scan_licenses(frame(spark, rows)).collect()}
    for i, label in enumerate(WRAPPED):
        assert found[i]["labels"].split(",") == sorted({label} | set(filter(None, found[i]["base_labels"].split(","))))
        assert found[i]["score"] == 1
        assert 2 in {b["word"] for b in found[i]["blocks"]}
    assert (found[9]["labels"], found[9]["score"]) == ("bsd-notice", 1)


def test_words_far_from_each_other_make_no_notice(spark):
    """Words of several lines that a template has all of, without a run that holds enough of them."""
    filler = "wir fahren heute mit dem rad und nicht mit der bahn in die stadt hinein"
    rows = [
        (1, f"{filler}\n{filler}\nLicensed under the Apache License"),
        (2, "released here\nunder that\n" + "other words stand here\n" * 3 + "the mit\nlicense"),
        (3, "released under\n\nthe MIT\n\nlicense, released under the mit license; " + "x " * 50 + "under the mit license"),
    ]
    found = {r["doc_id"]: r for r in licenses.scan_licenses(frame(spark, rows)).collect()}
    assert [found[i]["labels"] for i in (1, 2, 3)] == ["apache", "mit", "mit,mit-notice"]
    mit = list(licenses.TEMPLATES).index("released under the mit license")
    assert [tuple(b) for b in found[3]["blocks"] if b["template"] == mit] == [(0, mit, 1.0), (60, mit, 0.8)]


def test_licenses_of_long_texts_in_time_that_grows_with_them(spark):
    def seconds(n):
        table = frame(spark, [(1, "mit license and apache license " * n)])
        began = time.time()
        (row,) = licenses.scan_licenses(table).collect()
        assert (row["n_base"], row["first_word"], row["last_word"]) == (2 * n, 0, 5 * n - 2)
        return time.time() - began

    seconds(100)
    assert seconds(16_000) < 4 * seconds(4_000) + 4


# ---------------------------------------------------------------- 7


def test_base_scores_equal_brute_force(docs, rows):
    some = [(i, t) for i, t in rows if i is not None and i != 10]
    found = class_lm.class_scores(
        docs.where("doc_id is not null and doc_id != 10"), queries._id_remainder("doc_id") == 1, held_words=50
    ).collect()
    expected = brute.unigram_scores(some)
    assert len(found) == len(expected)
    for r in found:
        n, known, total, score = expected[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["held_out"] == brute.held_out(r["doc_id"], 1)
        assert math.isclose(r["base_score"], score, rel_tol=1e-9)


def test_class_model_beats_single_tokens_on_texts_left_out(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scored = class_lm.class_scores(documents, queries._id_remainder("doc_id") == 1)
    sums = scored.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


def test_transitions_are_distributions():
    table = np.random.default_rng(1).poisson(0.7, (9, 9)).astype(float)
    table[4] = 0
    assert np.allclose((10 ** class_lm.transition_scores(table)).sum(1), 1)


def test_exchange_never_lowers_the_likelihood():
    random = np.random.default_rng(3)
    bigrams = random.poisson(1.0, (24, 24)).astype(float)
    bigrams[:8, 8:16] += 6
    bigrams[8:16, :8] += 6

    def likelihood(of):
        member = np.zeros((24, of.max() + 1))
        member[np.arange(24), of] = 1
        table = member.T @ bigrams @ member
        x = class_lm._xlogx
        return x(table).sum() - x(table.sum(0)).sum() - x(table.sum(1)).sum()

    values = [likelihood(class_lm.exchange_classes(bigrams, 20, 3, sweeps)) for sweeps in (0, 1, 2, 8)]
    assert values == sorted(values) and values[-1] > values[0]


def _words_of(spark, texts, **options):
    training = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = training.mapInArrow(class_lm._counted(), "word long, shape int, n long")
    counts = counts.groupBy("word", "shape").agg(F.sum("n").alias("n")).cache()
    return training, counts, class_lm.word_classes(training, counts, **options)


def test_every_training_word_gets_a_class_also_where_frequencies_tie(spark):
    texts = [f"{a}{i} {b}{i}" for i in range(150) for a, b in (("left", "right"), ("right", "left"))]
    _, counts, (assigned, own, table) = _words_of(spark, texts, classes=4, clustered_words=16, held_words=40)
    found = assigned.collect()
    assert len({r["word"] for r in found}) == len(found) == counts.where("shape >= 0").count() == 300
    assert all(0 <= r["class"] < 4 for r in found)
    assert own["core"].sum() == 16  # all words are equally frequent
    tokens = sum(r["n"] for r in found) + len(texts)
    assert table.sum() == tokens  # each token follows one


@pytest.mark.parametrize("held", [0, 60, 1 << 18])
def test_words_beyond_the_core_are_clustered_by_their_neighbours(spark, held):
    random = np.random.default_rng(4)
    nouns, verbs = [f"x{i}" for i in range(60)], [f"x{i}" for i in range(60, 120)]
    texts = [" ".join(f"{random.choice(nouns)} {random.choice(verbs)}" for _ in range(8)) for _ in range(200)]
    texts += [" ".join(["x5"] * 40), "x200 x200 x201 x202"]
    training, counts, (assigned, _, table) = _words_of(spark, texts, classes=4, clustered_words=10, held_words=held)
    of = {r["word"]: r["class"] for r in assigned.collect()}
    hashes = [np.concatenate(([class_lm.END], class_lm.tokens_of(b)[1])) for b in class_lm.blocks(class_lm.pa.array(texts))]
    by_hand = np.zeros((5, 5))
    for tokens in hashes:
        kinds = [of.get(int(t), 4) for t in tokens.view(np.int64)]
        np.add.at(by_hand, (kinds[:-1], kinds[1:]), 1)
    assert (table == by_hand).all()
    names = {n: int(class_lm.tokens_of(next(iter(class_lm.blocks(class_lm.pa.array([n])))))[1].view(np.int64)[0]) for n in nouns + verbs}
    agree = sum(of[names[a]] != of[names[b]] for a in nouns[10:] for b in verbs[10:])
    assert agree >= 0.95 * 50 * 50


def test_best_classes_are_those_of_the_likeliest_text():
    random = np.random.default_rng(5)
    units, kinds, classes = 40, 7, 5
    bigrams = random.poisson(0.6, (units, units)).astype(float)
    of = np.concatenate((random.integers(0, kinds - 1, units - 1), [kinds - 1]))
    of[:3] = kinds - 2

    def likelihood(of):
        member = np.zeros((units, kinds))
        member[np.arange(units), of] = 1
        table = member.T @ bigrams @ member
        x = class_lm._xlogx
        return table, x(table).sum() - x(bigrams.sum(1) @ member).sum() - x(bigrams.sum(0) @ member).sum()

    table = likelihood(of)[0]
    rows = []
    for w in range(units - 1):
        for kind in range(kinds):
            others = (of == kind) & (np.arange(units) != w)
            rows += [(w, kind, bigrams[w, others].sum()), (w, kinds + kind, bigrams[others, w].sum())]
        rows.append((w, 2 * kinds, bigrams[w, w]))
    word, code, n = (np.array(x) for x in zip(*sorted(r for r in rows if r[2])))
    found = class_lm.best_classes(table, classes, of[:-1], word, code, n)
    for w in range(units - 1):
        values = []
        for c in range(classes):
            moved = of.copy()
            moved[w] = c
            values.append(likelihood(moved)[1])
        assert math.isclose(values[found[w]], max(values), abs_tol=1e-6)


def test_neighbours_of_words_travel_as_spans_not_as_rows(spark):
    texts = spark.createDataFrame([(" ".join(f"w{i}" for i in range(k, k + 4000)),) for k in range(0, 12000, 2000)], "text string")
    training, counts, _ = _words_of(spark, [r["text"] for r in texts.collect()], classes=4, clustered_words=10)
    core = counts.where("shape >= 0").limit(10).toPandas()["word"].to_numpy(np.int64).view(np.uint64)
    known, classes = class_lm.lookup(core, np.arange(10) % 4 + class_lm.CORE, -1)
    kinds, bits = 4 + class_lm.SHAPES + 1, 5
    sent = {"known": known, "classes": classes, "kinds": kinds, "shapes": 4, "bits": bits}
    rows = training.coalesce(1).mapInArrow(class_lm._neighbours(spark.sparkContext.broadcast(sent), True), class_lm.NEIGHBOURS)
    rows = rows.where(F.col("part") == class_lm.WORD).orderBy("span").collect()
    assert len(rows) <= 1 << bits  # there are 14,000 words, each with a class before and one after
    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[x] for r in rows]) for x in class_lm._SPAN_COLUMNS], class_lm._SPAN_COLUMNS
    )
    found = Counter()
    for word, code, n in class_lm._grouped(iter([batch.slice(0, 7), batch.slice(7, 0), batch.slice(7)])):
        for w, c, k in zip(word.tolist(), code.tolist(), n.tolist()):
            assert (w, c) not in found
            found[w, c] = k
    expected = Counter()
    for block in blocks(pa.array([r["text"] for r in training.collect()])):
        _, hashes, shapes, _ = class_lm.tokens_of(block)
        of = dict(zip(known[0].tolist(), (classes - class_lm.CORE).tolist()))
        kind = [of.get(h, kinds - 1 if h == int(class_lm.END) else 4 + s) for h, s in zip(hashes.tolist(), shapes.tolist())]
        inner = [h not in of and h != int(class_lm.END) for h in hashes.tolist()]
        for i, h in enumerate(hashes.tolist()):
            if inner[i]:
                expected[h, kinds + (kind[i - 1] if i else kinds - 1)] += 1
                expected[h, kind[i + 1]] += 1
    assert found == expected


@pytest.mark.parametrize("size", [0, 1, 2, 5000])
def test_words_are_found_where_many_hashes_begin_alike(size):
    random = np.random.default_rng(6)
    words = random.integers(0, 1 << 64, size, np.uint64)
    words[size // 2 :] >>= np.uint64(40)  # all these begin with the same bits
    words = np.unique(words)
    values = random.integers(0, 9, len(words))
    held, found = class_lm.lookup(words, values, -1)
    asked = np.concatenate((words[::-1], words + np.uint64(1), random.integers(0, 1 << 64, 500, np.uint64), [np.uint64(0), ~np.uint64(0)]))
    of = dict(zip(words.tolist(), values.tolist()))
    assert found[class_lm.places(held, asked)].tolist() == [of.get(w, -1) for w in asked.tolist()]


def test_rows_of_words_are_dealt_by_span_and_summed():
    random = np.random.default_rng(7)
    word, code, n = random.integers(-(1 << 62), 1 << 62, 300)[random.integers(0, 300, 4000)], random.integers(-1, 9, 4000), random.integers(1, 1 << 40, 4000)
    rows = [pa.RecordBatch.from_arrays([pa.array(x[a : a + 999]) for x in (word, code, n)], ["word", "code", "n"]) for a in range(0, 4000, 999)]
    spans = pa.Table.from_batches(class_lm._spanned(4)(iter(rows))).sort_by("span").to_batches()
    expected = Counter()
    for w, c, k in zip(word.view(np.uint64).tolist(), code.tolist(), n.tolist()):
        expected[w, c] += k
    found = [(w, c, k) for group in class_lm._grouped(iter(spans)) for w, c, k in zip(*(x.tolist() for x in group))]
    assert found == sorted((w, c, k) for (w, c), k in expected.items())


def test_scores_do_not_depend_on_how_many_words_are_sent(docs):
    def scores(**options):
        found = class_lm.class_scores(docs, queries._id_remainder("doc_id") == 1, clustered_words=30, classes=6, **options)
        return sorted((r["doc_id"] or 0, r["n_tokens"], r["n_known"], round(r["score"], 3)) for r in found.collect())

    assert scores(held_words=20) == scores(held_words=1 << 18)


@pytest.mark.parametrize("training", ["none", "all"])
def test_scores_without_training_or_held_out_rows(docs, none, rows, training):
    found = class_lm.class_scores(docs, F.lit(training == "none"))
    assert found.count() == len(rows)
    assert found.where("score > 1e-9 or isnan(score) or score is null or base_score is null").count() == 0
    assert class_lm.class_scores(none, F.lit(False)).collect() == []


# ---------------------------------------------------------------- 8


def test_line_components_equal_brute_force(docs, rows, none):
    found = line_dedup.line_components(docs).collect()
    lines = [
        (i, n, line)
        for i, t in rows
        for n, line in enumerate((t or "").split("\n"))
        if brute.SPACED.search(line)
    ]
    kinds = {}
    for i, n, line in lines:
        at = (-math.inf if i is None else i, n)
        name = " ".join(brute.spaced(line))
        kinds[name] = min(kinds.get(name, at), at)
    names = sorted(kinds)
    sets = [brute.line_shingles(name) for name in names]
    holders = defaultdict(list)
    for k, own in enumerate(sets):
        for x in own:
            holders[x].append(k)
    pairs = {(a, b) for own in holders.values() if len(own) > 1 for a in own for b in own if a < b}
    root = brute.components(range(len(names)), [(a, b) for a, b in pairs if brute.similar(sets[a], sets[b], 80)])
    first = {}
    for k, name in enumerate(names):
        first[root[k]] = min(first.get(root[k], kinds[name]), kinds[name])
    keeper = {name: first[root[k]] for k, name in enumerate(names)}
    expected = []
    for i, n, line in lines:
        at = keeper[" ".join(brute.spaced(line))]
        kept = at == (-math.inf if i is None else i, n)
        expected.append((str(i), n, "None" if at[0] == -math.inf else str(at[0]), at[1], kept))
    got = [(str(r["doc_id"]), r["line"], str(r["kept_id"]), r["kept_line"], r["kept"]) for r in found]
    assert sorted(got) == sorted(expected)
    assert line_dedup.line_components(none).collect() == []


def test_lines_of_one_set_are_linked_whatever_repeats(spark, none):
    lines = ["-" * 40, "-" * 60, "buy now " * 10, "buy now " * 20, "Contents " + "." * 30 + " 7", "Contents " + "." * 70 + " 7", "alone in its kind"]
    table = frame(spark, list(enumerate(lines)))
    test_line_components_equal_brute_force(table, list(enumerate(lines)), none)
    kept = line_dedup.line_components(table).where("kept").collect()
    assert {r["doc_id"] for r in kept} == {0, 2, 4, 6}


def test_lines_with_one_letter_or_word_changed_are_linked(spark):
    random = np.random.default_rng(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows, pairs = [], []

    def pair(line, changed):
        pairs.append((len(rows), len(rows) + 1))
        rows.extend([(len(rows), line), (len(rows) + 1, changed)])

    for length in range(50, 260, 5):
        line = "".join(random.choice(list(letters), length))
        at = length // 2
        pair(line, line[:at] + "Z0"[length % 2] + line[at + 1 :])
        if length >= 95:
            pair(line[::-1], line[::-1][:at] + "123456" + line[::-1][at + 6 :])
    kept = {r["doc_id"]: r["kept_id"] for r in line_dedup.line_components(frame(spark, rows)).collect()}
    linked = [kept[b] == a for a, b in pairs]
    assert np.mean(linked) >= 0.9  # the bands miss some at the threshold
    assert all(kept[a] == a for a, _ in pairs)


def test_signatures_follow_from_the_set_alone():
    """Neither the lines that stand beside a line nor repeats of its shingles change its signature."""
    random = np.random.default_rng(6)
    lines = [mix(random.integers(0, n, n).astype(np.uint64)) for n in random.integers(1, 60, 200)]
    lines += [mix(np.arange(50, dtype=np.uint64)), mix(np.zeros(9, np.uint64))]
    first = np.concatenate(([0], np.cumsum([len(x) for x in lines])))
    signatures = line_dedup.one_permutation(np.concatenate(lines), first, 55)
    for place, line in enumerate(lines):
        alone = np.concatenate((line[::-1], line[:3]))
        assert (line_dedup.one_permutation(alone, np.array([0, len(alone)]), 55)[0] == signatures[place]).all()
    assert line_dedup.one_permutation(np.zeros(0, np.uint64), np.zeros(1, np.int64), 55).shape == (0, 55)


def test_packed_counts_are_those_of_rows(spark, monkeypatch):
    """Buckets counted as arrays over several batches, tasks and spans, and plainly."""
    random, similarity = np.random.default_rng(13), line_dedup.SIMILARITY
    # a third of the nodes is one set
    signed = [(i, int(random.integers(1, 99)), bytes(55) if i % 3 == 0 else random.bytes(55)) for i in range(900)]
    signed += [(900 + i, 5, signed[i + 1][2][:20] + random.bytes(35)) for i in range(300)]
    expected = defaultdict(lambda: [0, 0])
    for batch in pa.table({"node": [r[0] for r in signed], "size": [r[1] for r in signed], "signature": [r[2] for r in signed]}).to_batches():
        for row, keys in zip(signed, links._buckets(batch, similarity).view(np.int64).tolist()):
            for key in keys:
                expected[key][0] += 1
                expected[key][1] += row[1]
    monkeypatch.setattr(links, "KEYS_AT_ONCE", 1000)
    nodes = spark.createDataFrame(signed, "node long, size long, signature binary").repartition(5)
    for spans in (1, 7):
        packed = nodes.mapInArrow(links._packed_counts(similarity, spans), links.PACKED)
        found = packed.groupBy("span").applyInArrow(links._shared, "bucket long, members long, items long")
        assert {r[0]: [r[1], r[2]] for r in found.collect()} == {k: v for k, v in expected.items() if v[0] > 1}


def test_lines_are_normalised_as_text_is():
    random = np.random.default_rng(12)
    texts = ["".join(random.choice(list("aB\u00c4 \t\r\x0b\n\u00a0"), n)) for n in random.integers(0, 40, 300)]
    for block in blocks(pa.array(texts)):
        owner, number, starts, ends = line_dedup.lines_of(block)
        found = line_dedup.normalised(block, starts, ends)
        for text, line, value in zip(owner.tolist(), number.tolist(), found):
            raw = texts[block.first + text].split("\n")[line].encode()
            assert value == b" ".join(raw.lower().split())


def test_similar_lines_are_cut_from_texts(spark, none):
    line = "the quick brown fox jumps over the lazy dog and runs away from all of the other animals here"
    rows = [
        (1, f"{line}\nsecond line\n\nlast"),
        (2, f"own line\n  {line.upper()} \nSecond  Line"),
        (3, line.replace("here", "hare")),
        (4, None),
        (5, ""),
        (6, "second line"),
        (7, "own line\nfresh"),
    ]
    docs = frame(spark, rows)
    left = line_dedup.drop_similar_lines(docs)
    assert left.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in left.collect()}
    assert got == {1: f"{line}\nsecond line\n\nlast", 2: "own line", 4: None, 5: "", 7: "fresh"}
    assert line_dedup.drop_similar_lines(none).collect() == []


def test_filters_hand_on_columns_of_any_name(spark, labels):
    names = ["lost", "lost_id", "lines", "line", "lines left", "hit_id", "dropped_id", "component_id", "kept", "n_words", "row"]
    texts = [(1, PASSAGE + " " + LONG), (2, PASSAGE + " " + LONG + "\nmore"), (3, LONG + "\nmore"), (4, "no line of another\nMORE"), (None, None)]
    schema = ", ".join(["text string", *(f"`{n}` string" for n in names), "doc_id long"])
    table = spark.createDataFrame([(t, *names, i) for i, t in texts], schema)
    items = spark.createDataFrame([(9, PASSAGE)], "item_id long, text string")
    kept = {
        "lines": line_dedup.drop_similar_lines(table),
        "near": near_dedup.drop_near_duplicates(table),
        "clean": decontaminate.drop_contaminated(table, items),
        "good": quality_rules.keep_good(table, labels),
    }
    for df in kept.values():
        assert df.columns == table.columns
        assert all([r[n] for n in names] == names for r in df.collect())
    ids = {name: {r["doc_id"] for r in df.collect()} for name, df in kept.items()}
    assert ids["near"] == {1, 4, None} and ids["clean"] == {3, 4, None}
    texts_left = {r["doc_id"]: r["text"] for r in kept["lines"].collect()}
    assert texts_left == {1: texts[0][1], 2: "more", 4: "no line of another", None: None}


def test_lines_go_in_time_that_grows_with_the_text(spark):
    many = "\n".join(hashlib.md5(b"%d" % i).hexdigest() for i in range(40_000))
    table = spark.createDataFrame([(1, "first of all"), (2, many), (3, many + "\nfirst of all\nanother end"), (3, ""), (3, None)], "doc_id long, text string")
    left = line_dedup.drop_similar_lines(table)
    assert sorted(left.collect(), key=str) == sorted([(1, "first of all"), (2, many), (3, "another end"), (3, ""), (3, None)], key=str)


def test_bands_find_pairs_at_the_threshold():
    """Of pairs right at 0.8, and just over it for small sets, at least 0.985 share a band."""
    random, similarity = np.random.default_rng(11), line_dedup.SIMILARITY
    for size in (20, 60, 300):
        lines, n = [], 400
        for _ in range(n):
            items = mix(random.integers(0, 1 << 62, 2 * size).astype(np.uint64))
            extra = size // 4
            lines += [items[:size], items[: size + extra]]
        assert size / (size + extra) == 0.8
        first = np.concatenate(([0], np.cumsum([len(x) for x in lines])))
        signature = line_dedup.one_permutation(np.concatenate(lines), first, similarity.hashes)
        keys = links._band_keys(signature, similarity)
        assert (keys[::2] == keys[1::2]).any(1).mean() >= 0.985


def test_rows_of_one_id_are_judged_by_their_own_texts(spark, none):
    """Copies and different texts under one id, in the stages of the pipeline that drop."""
    other = "a text that is like nothing else in this table of rows " * 2
    item = "zulu yankee xray whiskey victor uniform tango sierra romeo quebec papa"
    copies = "golf hotel india juliet kilo lima mike november oscar foxtrot"
    rows = [(1, PASSAGE), (2, PASSAGE), (2, other), (3, copies), (3, copies)]
    rows += [(4, item), (4, "clean of it"), (5, None), (5, None), (6, "x"), (6, "y")]
    table = frame(spark, rows)
    near = [(r["doc_id"], r["text"]) for r in near_dedup.drop_near_duplicates(table).collect()]
    expected = [rows[0], rows[2], rows[3], *rows[5:]]
    assert sorted(near, key=str) == sorted(expected, key=str)
    lines = [(r["doc_id"], r["text"]) for r in line_dedup.drop_similar_lines(table).collect()]
    assert sorted(lines, key=str) == sorted(expected, key=str)
    clean = decontaminate.drop_contaminated(table, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted([(r["doc_id"], r["text"]) for r in clean.collect()], key=str) == sorted(rows[:5] + rows[6:], key=str)
    several = [(7, "line of one\nshared by both"), (7, "line of two\nshared by both"), (8, "shared by both\nonly in eight")]
    left = [(r["doc_id"], r["text"]) for r in line_dedup.drop_similar_lines(frame(spark, several)).collect()]
    assert sorted("\n".join(t for _, t in left).split("\n")) == ["line of one", "line of two", "only in eight", "shared by both"]


def test_signatures_agree_as_often_as_sets_do():
    random = np.random.default_rng(5)
    items = mix(np.arange(4000, dtype=np.uint64))
    agree = []
    for n in range(300):
        both = random.permutation(items)[:100]
        values, first = np.concatenate((both[:80], both[:60], both[80:])), np.array([0, 80, 180])
        values = np.concatenate((both[:80], np.concatenate((both[:70], both[80:90]))))
        signature = line_dedup.one_permutation(values, np.array([0, 80, 160]), 32)
        agree.append((signature[0] == signature[1]).mean())
    assert abs(np.mean(agree) - 70 / 90) < 0.03


# ---------------------------------------------------------------- 9


def test_kernel_scores_of_documents_left_out(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = queries.op9_kernel_quality(spark, "/root/testdata/sf0.01")
    assert found.count() == documents.count()
    judged = found.where("held_out").join(labels, "doc_id")
    assert judged.where("predicted = quality").count() >= 0.95 * judged.count()
    assert found.where("score < 0 or score > 1 or (predicted = 1) != (score >= 0.3)").count() == 0


@pytest.mark.parametrize("which", ["true", "quality = 1", "false"])
def test_kernel_scores_of_odd_rows(docs, none, rows, labels, which):
    few = labels.where(which)
    found = fourier_quality.kernel_scores(docs, few, F.lit(False))
    assert found.count() == len(rows)
    assert found.where("score is null or isnan(score) or score < 0 or score > 1").count() == 0
    assert fourier_quality.kernel_scores(none, few, F.lit(False)).collect() == []


# ---------------------------------------------------------------- 10


URLS = [
    "http://a.example.org/es/1", "https://EXAMPLE.ORG/en/12?x=/es/", "http://example.org/ES/1", "http://example.org",
    "http://x.com/fr/a#b", "http://com/de/", "http://xcom/de/", "http://notexample.org/es/", "http://a.com/?q=/fr/",
    "org/", None, "", "://", "ftp://user@x.com:80/de/1", "http://ads-track.example.com/en/", "http://m.spam-farm.net/",
    "http://spam-farm.example.org/x", "http://spam-farming.net/", "a://b://c.org/", "http://exämple.org/é/",
]


def test_url_rules_equal_brute_force(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    expected = []
    for url in URLS * 2:
        rest = (url or "").partition("://")[2]
        host = rest
        for c in "/?#":
            host = host.partition(c)[0]
        path = rest[len(host) :]
        for c in "?#":
            path = path.partition(c)[0]
        host = host.translate(brute.LOWER)
        fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
        own = "block" if {"spam-farm", "ads-track"} & set(host.split(".")) else "allow"
        expected.append((host, path, str(best and best[0] + best[1]), best[2] if best else own))
    pages = spark.createDataFrame([(1, u, "x", "y") for u in URLS * 2], "page_id long, url string, host string, word string")
    found = url_rules.judge_urls(pages, queries.URL_RULES + queries.OWN_URL_RULES).collect()
    named = {r.name for r in queries.URL_RULES}
    got = [(r["host"], r["path"], str(r["rule"] if r["rule"] in named else None), r["verdict"]) for r in found]
    assert sorted(got) == sorted(expected)
    assert url_rules.judge_urls(pages.limit(0), queries.URL_RULES).collect() == []
    assert url_rules.judge_urls(pages, []).where("verdict = 'allow' and rule is null").count() == len(URLS) * 2
