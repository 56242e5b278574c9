"""Counts over whole texts that quality operators share."""

from __future__ import annotations

import numpy as np

from .line_dedup import lines_of
from .words import SPACED, Block, Words, distinct, find_words, gram_hashes, mix, whole_grams, word_hashes

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
CONTINUES = (np.arange(256) & 0xC0) == 0x80


def within(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many are true in each ``bounds[i]:bounds[i + 1]``."""
    return np.diff(np.concatenate(([0], np.cumsum(mask)))[bounds])


def word_chars(block: Block, words: Words) -> np.ndarray:
    """Characters in the words of each text."""
    begins = ~CONTINUES[block.data]
    upto = np.concatenate(([0], np.cumsum(begins)))
    each = upto[words.ends] - upto[words.starts]
    return np.diff(np.concatenate(([0], np.cumsum(each)))[words.first])


def duplicate_lines(block: Block) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    owner, _, starts, ends = lines_of(block)
    held = block.data.tobytes()
    out = np.zeros(len(block), np.int64)
    text, seen = -1, set()
    for i, a, b in zip(owner.tolist(), starts.tolist(), ends.tolist()):
        if i != text:
            text, seen = i, set()
        line = held[a:b]
        if line in seen:
            out[i] += 1
        seen.add(line)
    return out


def repeated_words(words: Words, hashes: np.ndarray, size: int) -> np.ndarray:
    """Words in a ``size``-word window that its text has twice or more, first ones included."""
    grams = gram_hashes(hashes, size)
    whole = np.flatnonzero(whole_grams(words, size)[: len(grams)])
    keys = mix(grams[whole] ^ mix(words.text_of()[whole].astype(np.uint64) + np.uint64(1)))
    ordered = np.sort(keys)
    twice = distinct(ordered[1:][ordered[1:] == ordered[:-1]])
    out = np.zeros(len(hashes) + 1, np.int64)
    if len(twice):
        at = np.searchsorted(twice, keys)
        at[at == len(twice)] = 0
        places = whole[twice[at] == keys]
        np.add.at(out, places, 1)
        np.add.at(out, places + size, -1)
    return within(np.cumsum(out[:-1]) > 0, words.first)


def base_counts(block: Block) -> tuple[Words, np.ndarray, dict[str, np.ndarray]]:
    words = find_words(block, SPACED)
    hashes = word_hashes(block, words, SPACED)
    return words, hashes, {
        "n_words": words.counts,
        "word_chars": word_chars(block, words),
        "n_symbols": within(SYMBOLS[block.data], block.bounds),
        "n_dup_lines": duplicate_lines(block),
        "n_repeat_words": repeated_words(words, hashes, 8),
    }
