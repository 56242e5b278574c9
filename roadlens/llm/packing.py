"""Documents packed in order into sequences, cut where padding and truncation cost least."""

from __future__ import annotations

from bisect import bisect_left
from collections import deque
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import SPACED, SPACED_LOWER, Block, Words, blocks, distinct, find_words, word_hashes

SEQUENCE = 4096
END_ID = 2
#: What a cut costs, in tokens of padding: at a document's end, a sentence's end, elsewhere.
AT_DOCUMENT, AT_SENTENCE, ELSEWHERE = 0, 4, 16
#: Longest run of tokens without a place to cut.
STRIDE = 64
KNOWN_WORDS = 1 << 20


_ASCII_LETTER = np.isin(np.arange(256) | 0x20, np.arange(97, 123)) & (np.arange(256) < 0x80)
#: ASCII marks, without the apostrophe, which can begin a token of letters.
_MARK = np.isin(np.arange(256), np.frombuffer(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8))


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes that surely belong to letters: of ASCII, and of U+00C0 to U+00FF but for the two signs there."""
    sure = _ASCII_LETTER[data]
    if len(data) > 1:
        second = (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        pair = (data[:-1] == 0xC3) & second
        sure[:-1] |= pair
        sure[1:] |= pair
    return sure


def find_units(block: Block) -> tuple[Words, np.ndarray]:
    """Runs without white space, cut further between a letter and a mark, and which are of one kind only.

    The tokenizer never takes letters and marks into one token, so it gives the units of a text
    the ids that it gives them in the text. A unit of letters only or marks only is one word to it.
    """
    data = block.data
    words = find_words(block, SPACED)
    letters, marks = _letters(data), _MARK[data]
    cut = np.flatnonzero((letters[:-1] & marks[1:]) | (marks[:-1] & letters[1:])) + 1
    between = np.zeros(len(data) + 1, bool)
    between[block.bounds] = True
    cut = cut[~between[cut]]
    starts = np.sort(np.concatenate((words.starts, cut)), kind="stable")
    ends = np.sort(np.concatenate((words.ends, cut)), kind="stable")
    length = ends - starts
    upto = np.concatenate(([0], np.cumsum(letters)))
    plain = upto[ends] - upto[starts] == length
    upto = np.concatenate(([0], np.cumsum(marks)))
    plain |= upto[ends] - upto[starts] == length
    return Words(starts, ends, np.searchsorted(starts, block.bounds)), plain


class WordIds:
    """Ids of units, each told apart by its hash and tokenized once.

    At most ``KNOWN_WORDS`` units and those of a block are held.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        special = tokenizer.get_added_tokens_decoder()
        self.special = [token.content.lower().encode() for token in special.values()]
        self.mark_id, mark = min(special.items(), default=(None, None), key=lambda x: x[0])
        self.mark = mark.content if mark else ""
        self.closes = np.zeros(tokenizer.get_vocab_size() + 1, bool)
        for token, number in tokenizer.get_vocab().items():
            self.closes[number] = token.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, units: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the units in a row, and how many each has.

        Plain units are told apart by the tokens that close a word, others by a special token
        between them; where these do not come out one by one, each unit is tokenized alone.
        """
        if not units:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if plain:
            ids = self._ids(" ".join(units))
            closing = np.flatnonzero(self.closes[ids])
            if len(closing) == len(units) and closing[-1] == len(ids) - 1:
                return ids, np.diff(closing, prepend=-1)
        elif self.mark:
            ids = self._ids(self.mark.join(units))
            marks = np.flatnonzero(ids == self.mark_id)
            if len(marks) == len(units) - 1:
                edges = np.concatenate(([-1], marks, [len(ids)]))
                return ids[ids != self.mark_id], np.diff(edges) - 1
        each = [e.ids for e in self.tokenizer.encode_batch(units, add_special_tokens=False)]
        return np.array([i for ids in each for i in ids], np.uint32), np.array([len(ids) for ids in each], np.int64)

    def places(self, block: Block, units: Words, plain: np.ndarray) -> np.ndarray:
        """For each unit of the block, where its ids are told of in ``begins`` and ``counts``."""
        # the tokenizer lower-cases, so units that differ in A-Z only are one
        hashes = word_hashes(block, units, SPACED_LOWER)
        if len(self.hashes) > KNOWN_WORDS:
            self.forget()
        different, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, different)
        known = np.zeros(len(different), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == different[inside]
        if not known.all():
            held, fresh = block.data.tobytes(), np.flatnonzero(~known)
            fresh = fresh[np.argsort(~plain[first[fresh]], kind="stable")]
            new = first[fresh]
            texts = [
                held[a:b].decode("utf-8", "replace")
                for a, b in zip(units.starts[new].tolist(), units.ends[new].tolist())
            ]
            n = int(plain[new].sum())
            parts = [self.encode(texts[:n], True), self.encode(texts[n:], False)]
            counts = np.concatenate([c for _, c in parts])
            begins = len(self.ids) + np.concatenate(([0], np.cumsum(counts[:-1])))
            self.ids = np.concatenate((self.ids, *[i for i, _ in parts]))
            order = np.argsort(fresh)
            self.hashes = np.insert(self.hashes, at[~known], different[~known])
            self.begins = np.insert(self.begins, at[~known], begins[order])
            self.counts = np.insert(self.counts, at[~known], counts[order])
            at = np.searchsorted(self.hashes, different)
        return at[inverse]


def token_stream(block: Block, vocabulary: WordIds, end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(ids, ends of documents, ends of sentences)`` of the block's texts, each closed by ``end_id``."""
    held = block.data.tobytes()
    if any(token in held.lower() for token in vocabulary.special):
        # a special token's own text: its case counts and it is taken as a whole
        texts = [held[a:b].decode("utf-8", "replace") for a, b in zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist())]
        each = [
            np.array([*e.ids, end_id], np.uint32)
            for e in vocabulary.tokenizer.encode_batch(texts, add_special_tokens=False)
        ]
        return np.concatenate(each), np.cumsum([len(ids) for ids in each]), np.zeros(0, np.int64)
    units, plain = find_units(block)
    at = vocabulary.places(block, units, plain) if len(units.starts) else np.zeros(0, np.int64)
    # the closing id of a text counts as a unit of its own, placed after its units
    slots = np.arange(len(at)) + units.text_of()
    closing = units.first[1:] + np.arange(len(block))
    counts = np.ones(len(at) + len(block), np.int64)
    begins = np.full(len(counts), len(vocabulary.ids), np.int64)
    counts[slots], begins[slots] = vocabulary.counts[at], vocabulary.begins[at]
    upto = np.concatenate(([0], np.cumsum(counts)))
    source = np.repeat(begins - upto[:-1], counts) + np.arange(upto[-1])
    ids = np.append(vocabulary.ids, np.uint32(end_id))[source]
    last = block.data[units.ends - 1]
    following = np.append(block.data, np.uint8(10))[units.ends]
    closes = (last == ord(".")) | (last == ord("!")) | (last == ord("?"))
    closes = (closes & ~SPACED.inside[following]) | (following == 10)
    return ids, upto[closing + 1], upto[slots[closes] + 1]


def cut_places(ends: np.ndarray, sentences: np.ndarray, total: int, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Places at which a window may end, in order, and what a cut there costs."""
    places = distinct(np.concatenate((ends, sentences, [total])))
    gaps = np.diff(np.concatenate(([0], places)))
    more = np.maximum((gaps - 1) // stride, 0)
    begins = np.repeat(places - gaps, more)
    nth = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
    extra = begins + nth * stride
    cost = np.full(len(places), AT_SENTENCE)
    cost[np.searchsorted(places, ends)] = AT_DOCUMENT
    places, cost = np.concatenate((places, extra)), np.concatenate((cost, np.full(len(extra), ELSEWHERE)))
    order = np.argsort(places, kind="stable")
    return places[order], cost[order]


def best_cuts(places: list[int], cost: list[int], size: int, final: bool) -> list[int]:
    """Ends of the windows that make padding plus costs of cuts least.

    ``best[j]`` is the least cost of windows that end at ``places[j]``. A window from i to j pads
    ``size - (places[j] - places[i])``, so ``best[j] + places[j]`` is ``size``, the cost of the
    cut, and the least ``best[i] + places[i]`` with i in reach: the front of a queue whose values
    rise. Unless ``final``, the last window is left open: of the places within reach of the end, the
    cuts lead to the one with the least cost so far.
    """
    at = [0, *places]
    value, back = [0] * len(at), [0] * len(at)
    queue: deque[int] = deque([0])
    for j in range(1, len(at)):
        reach = at[j] - size
        while at[queue[0]] < reach:
            queue.popleft()
        back[j] = i = queue[0]
        value[j] = v = size + cost[j - 1] + value[i]
        while queue and value[queue[-1]] > v:
            queue.pop()
        queue.append(j)
    j = len(at) - 1
    if not final:
        j = min(range(bisect_left(at, at[-1] - size), len(at)), key=lambda k: value[k] - at[k])
    cuts = []
    while j:
        cuts.append(at[j])
        j = back[j]
    return cuts[::-1]


@dataclass
class _Open:
    """Tokens not yet in a sequence, and the documents they are of."""

    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    skipped: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    tokens: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    names: list = field(default_factory=list)
    sentences: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def add(self, names, ids, ends, sentences) -> None:
        held = len(self.ids)
        self.ids = np.concatenate((self.ids, ids))
        self.starts = np.concatenate((self.starts, held + np.concatenate(([0], ends[:-1]))))
        self.skipped = np.concatenate((self.skipped, np.zeros(len(ends), np.int64)))
        self.tokens = np.concatenate((self.tokens, np.diff(np.concatenate(([0], ends)))))
        self.names = self.names + names
        self.sentences = np.concatenate((self.sentences, held + sentences))

    def take(self, cuts: list[int], sequence: int):
        """The pieces of the sequences that end at ``cuts``; what follows stays."""
        past = cuts[-1]
        begins = distinct(np.concatenate((self.starts[self.starts < past], [0], cuts[:-1]))).astype(np.int64)
        ends = np.append(begins[1:], past)
        owner = np.searchsorted(self.starts, begins, "right") - 1
        number = np.searchsorted(cuts, begins, "right")
        window = np.concatenate(([0], cuts))[number]
        pieces = pa.RecordBatch.from_arrays(
            [
                pa.array([self.names[i] for i in owner.tolist()], pa.int64()),
                pa.array(begins - self.starts[owner] + self.skipped[owner]),
                pa.array(ends - begins),
                pa.array(self.tokens[owner]),
                pa.array(sequence + number),
                pa.array(begins - window),
                pa.array(
                    [self.ids[a:b].astype("<u4").tobytes() for a, b in zip(begins.tolist(), ends.tolist())],
                    pa.binary(),
                ),
            ],
            ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
        )
        ends_of = self.starts + self.tokens - self.skipped
        left = ends_of > past
        self.skipped = (self.skipped + np.maximum(past - self.starts, 0))[left]
        self.starts = np.maximum(self.starts - past, 0)[left]
        self.tokens = self.tokens[left]
        self.names = [n for n, stays in zip(self.names, left.tolist()) if stays]
        self.ids = self.ids[past:].copy()
        self.sentences = self.sentences[self.sentences > past] - past
        return pieces

    def places(self, stride: int) -> tuple[list[int], list[int]]:
        ends = self.starts + self.tokens - self.skipped
        places, cost = cut_places(ends, self.sentences, len(self.ids), stride)
        return places.tolist(), cost.tolist()


PIECES = "id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _packed(tokenizer, size: int, end_id: int, stride: int):
    def run(batches):
        from tokenizers import Tokenizer

        # a worker process loads this once and keeps it, so its tasks share the units seen so far
        own = tokenizer.value
        if "units" not in own:
            own["units"] = WordIds(Tokenizer.from_str(own["json"]))
        vocabulary = own["units"]
        sequence = TaskContext.get().partitionId() << 40
        held = _Open()
        for batch in batches:
            for block in blocks(batch.column(1)):
                ids, ends, sentences = token_stream(block, vocabulary, end_id)
                held.add(batch.column(0).slice(block.first, len(block)).to_pylist(), ids, ends, sentences)
                cuts = best_cuts(*held.places(stride), size, final=False)
                if cuts:
                    yield held.take(cuts, sequence)
                    sequence += len(cuts)
        if len(held.ids):
            yield held.take(best_cuts(*held.places(stride), size, final=True), sequence)

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SEQUENCE,
    end_id: int = END_ID,
    stride: int = STRIDE,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``size`` tokens.

    ``(id_col, start, length, doc_tokens, sequence_id, offset, ids)``: ``ids`` holds the piece's
    token ids as little-endian 32-bit values. A document is its text's ids and then ``end_id``;
    the pieces of a sequence follow each other without a gap, and every id is in one piece.

    Documents stay in the order of the table. In each partition, windows are cut where padding
    plus the costs of cuts inside documents is least, by dynamic programming over the ends of
    documents and sentences (and every ``stride`` tokens of a longer run) with a monotone queue. It is
    solved for some megabytes of text at a time; the window open at their end goes on into the
    next ones, so only the last sequence of a partition may be short. No rows are shuffled, and
    a task holds one block of texts and one open window.

    The tokenizer must lower-case, drop white space and take letters and marks apart (it is read
    from ``tokenizer_path`` on the driver and sent as text). Null and empty texts are ``end_id`` alone. Rows that repeat an id
    are documents of their own; other columns are ignored, and no rows give no rows.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = docs.sparkSession.sparkContext.broadcast({"json": file.read()})
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    pieces = source.mapInArrow(_packed(tokenizer, size, end_id, min(stride, size)), PIECES)
    return pieces.withColumnRenamed("id", id_col)
