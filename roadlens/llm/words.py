"""Words of a batch of texts as arrays of positions and 64-bit hashes.

A batch is worked on as one run of UTF-8 bytes; both kinds of words are told from their bytes
alone, because every byte of a character beyond ASCII is at least 0x80. Hashes depend on the
word only, so they can be compared between batches, tasks and runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
BLOCK_TEXTS = 1 << 15

_ODD = 0x9E3779B97F4A7C13
_INVERSE = pow(_ODD, -1, 1 << 64)
_GRAM = np.uint64(0xD6E8FEB86659FD93)

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``; one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def distinct(x: np.ndarray) -> np.ndarray:
    """The different values, sorted."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return x[new]


def _byte_values(lower: bool) -> np.ndarray:
    code = np.arange(256, dtype=np.uint64)
    if lower:
        code[65:91] += np.uint64(32)
    return mix((code + np.uint64(1)) * np.uint64(_ODD))


def _members(separators) -> np.ndarray:
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    return inside


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, BLOCK_BYTES + 1024)
        _powers = np.full(size, _ODD, np.uint64)
        _inverses = np.full(size, _INVERSE, np.uint64)
        _powers[0] = _inverses[0] = 1
        np.multiply.accumulate(_powers, out=_powers)
        np.multiply.accumulate(_inverses, out=_inverses)
    return _powers, _inverses


@dataclass(frozen=True)
class Alphabet:
    """Which bytes make words, and whether A-Z counts as a-z."""

    inside: np.ndarray
    values: np.ndarray


#: ``[^\x20\x09-\x0D]+`` of the text as it is, and of the text with A-Z lower-cased.
SPACED = Alphabet(_members([0x20, *range(0x09, 0x0E)]), _byte_values(False))
SPACED_LOWER = Alphabet(SPACED.inside, _byte_values(True))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the lower-cased text: A-Z are inside.
ALPHANUMERIC_LOWER = Alphabet(
    _members(
        [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
    ),
    _byte_values(True),
)


@dataclass
class Block:
    """Some texts in a row: ``data`` holds their bytes, text i at ``bounds[i]:bounds[i + 1]``."""

    first: int
    bounds: np.ndarray
    data: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Words:
    """Word j is ``data[starts[j]:ends[j]]``; text i has words ``first[i]:first[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a column, null as empty, in runs of at most ``limit`` bytes or one larger text."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    bounds = np.frombuffer(column.buffers()[1], np.int64)
    bounds = bounds[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(bounds, bounds[low] + limit, "right")) - 1
        high = min(max(high, low + 1), low + BLOCK_TEXTS, len(column))
        yield Block(low, bounds[low : high + 1] - bounds[low], data[bounds[low] : bounds[high]])
        low = high


def find_words(block: Block, alphabet: Alphabet) -> Words:
    inside = alphabet.inside[block.data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = block.bounds[(block.bounds > 0) & (block.bounds < len(inside))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(opens)
    return Words(starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, block.bounds))


def span_hashes(data: np.ndarray, starts, ends, values: np.ndarray) -> np.ndarray:
    """A hash of each non-empty ``data[start:end]``; ``values`` maps a byte to 64 bits."""
    powers, inverses = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts])


def word_hashes(block: Block, words: Words, alphabet: Alphabet) -> np.ndarray:
    return span_hashes(block.data, words.starts, words.ends, alphabet.values)


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Of each run of ``size`` words that begins at a word; the caller drops those past a text's end."""
    n = max(len(hashes) - size + 1, 0)
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out = out * _GRAM + hashes[j : j + n]
    return mix(out)


def whole_grams(words: Words, size: int) -> np.ndarray:
    """True where a run of ``size`` words from that word stays within its text."""
    last = np.repeat(words.first[1:], words.counts)
    return np.arange(len(words.starts)) + size <= last


def code_points(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The characters of the block, and where each text begins among them.

    Where the bytes are no UTF-8, each byte counts as a character.
    """
    try:
        characters = block.data.tobytes().decode("utf-8")
    except UnicodeDecodeError:
        return block.data.astype(np.uint32), block.bounds
    codes = np.frombuffer(characters.encode("utf-32-le"), np.uint32)
    if len(codes) == len(block.data):
        return codes, block.bounds
    before = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum((block.data & 0xC0) != 0x80, out=before[1:])
    return codes, before[block.bounds]
