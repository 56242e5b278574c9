"""License texts in documents: phrases, and an exact set-similarity join with templates, in SQL functions only."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import materialize

#: Phrases that name a licence, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Texts whose words, in whatever order, make a block of text a licence notice, and their labels.
TEMPLATES = {
    "this work is licensed under the gnu general public license version 3": "gpl-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the "
    "gnu general public license": "gpl-notice",
    "licensed under the apache license version 2 0": "apache-notice",
    "you may not use this file except in compliance with the license": "apache-notice",
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-notice",
    "licensed under cc by nc 4 0": "cc-notice",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-notice",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd-notice",
    "all rights reserved no part of this may be reproduced without permission": "reserved",
}
CONTAINMENT = 0.8
#: Words of a block for each word of a template.
STRETCH = 1.5
#: Of all templates together; they are sent to every task.
MOST_WORDS = 10_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _spaced(text: Column) -> Column:
    """The words of a text, lower-cased, each between single spaces; one space if it has none."""
    lowered = F.translate(F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" ")), _UPPER, _LOWER)
    return F.regexp_replace(lowered, _BETWEEN, " ")


def _n_words(spaced: Column) -> Column:
    return (F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))) - 1).cast("long")


def _phrase_places(spaced: Column, phrase: str) -> Column:
    """``(n, first, last)``: at how many words a phrase begins, and the numbers of the first and last; null without one."""
    cuts = F.split(spaced, f" {phrase}(?= )")
    length = phrase.count(" ") + 1
    # each part before an occurrence begins with a space for every word it has
    spaces = F.transform(
        F.slice(cuts, 1, F.size(cuts) - 1), lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    )
    start = F.expr("named_struct('n', 0L, 'first', cast(null as bigint), 'last', cast(null as bigint), 'next', 0L)")

    def step(done: Column, n: Column) -> Column:
        at = done["next"] + n
        return F.struct(
            (done["n"] + 1).alias("n"),
            F.coalesce(done["first"], at).alias("first"),
            at.alias("last"),
            (at + length).alias("next"),
        )

    return F.when(F.contains(spaced, F.lit(f" {phrase} ")), F.aggregate(spaces, start, step))


def _templates(templates: dict[str, str], containment: float) -> list[tuple]:
    """``(number, label, different words, fewest of them that meet the threshold, words of a block)``."""
    rows = []
    for number, (text, label) in enumerate(templates.items()):
        words = list(dict.fromkeys(text.lower().split()))
        # a millionth less, so that a threshold met exactly is met
        least = max(1, math.ceil(containment * len(words) - 1e-6))
        rows.append((number, label, words, least, math.ceil(STRETCH * len(text.split()) - 1e-6)))
    return rows


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.expr("cast(array() as array<string>)")


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    r"""``(id_col, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks)``.

    A row for every row of ``docs``. Words are runs of a-z, 0-9 and characters beyond ASCII after
    A-Z is lower-cased. ``n_base`` counts the places where the words of a phrase stand one after
    the other, ``first_word`` and ``last_word`` are the first and last such place (null without
    one; no phrase may overlap itself), ``base_labels`` the labels found, sorted and comma-joined; ``labels`` has those of
    templates as well. ``score`` is 1 with a phrase, else the largest containment found, else 0.

    A block is a run of words of the text, wherever its lines end, ``STRETCH`` times as long as the
    template it is held against. It meets the template if it has at least ``containment`` of the template's
    different words. Blocks that meet and overlap are one; ``blocks`` lists (its first word, template, largest
    containment), sorted.

    Words that no template has cannot count, so texts are reduced to the templates' words, ordered by how many of
    all texts have each, rarest first. A text and a template whose overlap can reach the least
    needed share one of the first (length - least + 1) words of both; they are joined on these, a
    pair at its first shared word only, and pairs go on where lengths and positions allow the
    overlap. Only the texts of such pairs are taken apart into places, and in a window over the
    places of a template's words blocks are counted in full, in time that grows with the text. The templates, at
    most ``MOST_WORDS`` words in all, are sent to every task.

    Null and empty texts have no words. Rows that repeat an id are scanned each by itself. Other
    columns are ignored, and no rows give no rows.
    """
    spark = docs.sparkSession
    described = _templates(templates, containment)
    if sum(len(words) for _, _, words, *_ in described) > MOST_WORDS:
        raise ValueError(f"templates may have at most {MOST_WORDS} words")
    known = spark.createDataFrame(described, "template int, label string, words array<string>, least int, reach int")
    in_vocabulary = _strings(list(dict.fromkeys(w for _, _, words, *_ in described for w in words)))
    fewest = min((least for *_, least, _ in described), default=1)

    spaced = docs.select(F.col(id_col).alias("id"), _spaced(F.col(text_col)).alias("spaced"))
    held = F.array_intersect(F.split("spaced", " "), in_vocabulary)
    places = F.array_compact(F.array(*[_phrase_places(F.col("spaced"), p) for p in phrases]))
    labels = F.array_sort(
        F.array_distinct(
            F.array_compact(
                F.array(*[F.when(F.contains("spaced", F.lit(f" {p} ")), F.lit(label)) for p, label in phrases.items()])
            )
        )
    )
    reachable = [F.size(F.array_intersect("held", _strings(words))) >= least for _, _, words, least, _ in described]
    rows = spaced.withColumn("held", held).select(
        "id",
        _n_words(F.col("spaced")).alias("n_words"),
        places.alias("places"),
        labels.alias("base"),
        "held",
        # the texts that some template may be in
        F.when(reduce(Column.__or__, reachable, F.lit(False)), F.col("spaced")).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = materialize(rows, "license-texts")

    often = rows.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    order = known.select(F.explode("words").alias("word")).distinct().join(often, "word", "left")
    order = [r["word"] for r in order.orderBy(F.coalesce("n", F.lit(0)), "word").collect()]
    # the templates' words, rarest first
    ranked = _strings(order)
    texts = rows.where("text IS NOT NULL").select("row", F.array_intersect(ranked, F.col("held")).alias("words"))
    theirs = known.select("template", "least", F.array_intersect(ranked, F.col("words")).alias("theirs"))

    prefix = F.slice("words", 1, F.size("words") - fewest + 1)
    ours = texts.where(F.size("words") >= fewest).select("row", "words", F.posexplode(prefix).alias("at", "word"))
    their_prefix = F.slice("theirs", 1, F.size("theirs") - F.col("least") + 1)
    indexed = theirs.select("*", F.posexplode(their_prefix).alias("their_at", "word"))
    # a row for each word of a template at most; the templates are held by the driver
    pairs = ours.join(F.broadcast(indexed), "word").where(
        # length; the prefix of this template; the words left after this place on either side
        "size(words) >= least AND at <= size(words) - least "
        "AND least(size(words) - at, size(theirs) - their_at) >= least "
        # the first word that both have
        "AND NOT arrays_overlap(slice(words, 1, at), slice(theirs, 1, their_at))"
    )
    pairs = pairs.where(F.size(F.array_intersect("words", "theirs")) >= F.col("least"))
    pairs = materialize(pairs.select("row", "template"), "license-pairs")

    wanted = pairs.groupBy("row").agg(F.collect_set("template").alias("wanted"))
    apart = rows.where("text IS NOT NULL").select("row", "text").join(wanted, "row")
    apart = apart.select("row", "wanted", F.posexplode(F.split(F.trim("text"), " ")).alias("place", "word"))
    of_template = known.select("template", "least", "reach", F.size("words").alias("size"), F.explode("words").alias("word"))
    marks = apart.join(F.broadcast(of_template), "word").where("array_contains(wanted, template)")
    # the template's words from this one on; a template's reach is at most that of the longest one
    farthest = max((reach for *_, reach in described), default=1)
    ahead = Window.partitionBy("row", "template").orderBy("place").rangeBetween(0, farthest - 1)
    block = F.collect_list(F.struct("place", "word")).over(ahead)
    near = F.transform(F.filter("block", lambda x: x["place"] < F.col("place") + F.col("reach")), lambda x: x["word"])
    met = marks.withColumn("block", block).withColumn("overlap", F.size(F.array_distinct(near)))
    met = met.where("overlap >= least").select(
        "row", "template", "place", "reach", (F.col("overlap") / F.col("size")).alias("containment")
    )
    turn = Window.partitionBy("row", "template").orderBy("place")
    begins = F.coalesce(F.col("place") - F.lag("place").over(turn) >= F.col("reach"), F.lit(True))
    met = met.withColumn("begins", begins.cast("int")).withColumn("block", F.sum("begins").over(turn))
    met = met.groupBy("row", "template", "block").agg(
        F.min("place").alias("word"), F.max("containment").alias("containment")
    )
    found = met.join(F.broadcast(known.select("template", "label")), "template").groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("word", "template", "containment"))).alias("blocks"),
        F.collect_set("label").alias("more"),
        F.max("containment").alias("best"),
    )
    out = rows.select("row", "id", "n_words", "places", "base").join(found, "row", "left")
    based = F.size("places") > 0
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        F.aggregate("places", F.lit(0).cast("long"), lambda n, p: n + p["n"]).alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["last"])).alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", _strings([])))), ",").alias("labels"),
        F.when(based, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("blocks", F.expr("cast(array() as array<struct<word: int, template: int, containment: double>>)")).alias("blocks"),
    )
