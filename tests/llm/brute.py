"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile("[^\x20\x09-\x0d]+")
ALPHANUMERIC = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def spaced(text, lower=True):
    text = text or ""
    return SPACED.findall(text.translate(LOWER) if lower else text)


def alphanumeric(text):
    return ALPHANUMERIC.findall((text or "").translate(LOWER))


def components(nodes, linked):
    """The smallest node each reaches."""
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in linked:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


def similar(a: set, b: set, percent: int) -> bool:
    return bool(a and b) and 100 * len(a & b) >= percent * len(a | b)


def contamination(text, items, window=10):
    words = alphanumeric(text)
    hit, found = set(), set()
    for item, item_text in items:
        theirs = alphanumeric(item_text)
        size = min(window, len(theirs))
        grams = {tuple(theirs[i : i + size]) for i in range(len(theirs) - size + 1)} if theirs else set()
        for i in range(len(words) - size + 1) if size else ():
            if tuple(words[i : i + size]) in grams:
                hit.update(range(i, i + size))
                if item is not None:
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def quality_counts(text):
    text = text or ""
    words = spaced(text, lower=False)
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {i + j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(8)}
    lines, seen = 0, set()
    for line in text.split("\n"):
        if SPACED.search(line):
            lines += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        lines,
        len(repeated),
        failed,
    )


def shingles(text, size=5):
    words = spaced(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def line_shingles(line, size=5):
    line = " ".join(spaced(line))
    return {line[i : i + size] for i in range(max(len(line) - size + 1, 1))}


def jump(key: int, shards: int) -> int:
    key &= (1 << 64) - 1
    shard, following = -1, 0
    while following < shards:
        shard = following
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        following = int((shard + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return shard


def held_out(doc_id, remainder: int) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == remainder


def unigram_scores(rows, remainder=1):
    """``{doc_id: (tokens, known, train tokens, base score)}``."""
    counts = Counter()
    for doc_id, text in rows:
        if not held_out(doc_id, remainder):
            counts.update([*spaced(text), None])
    total, kinds = sum(counts.values()), len(counts)
    out = {}
    for doc_id, text in rows:
        tokens = [*spaced(text), None]
        score = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (kinds + 1))) for t in tokens)
        out[doc_id] = len(tokens), sum(counts[t] > 0 for t in tokens), total, score
    return out
