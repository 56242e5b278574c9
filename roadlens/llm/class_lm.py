"""A class-based bigram model of the corpus: exchange clustering and smoothed scores of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialize
from .words import SPACED_LOWER, Block, Words, blocks, find_words, mix, word_hashes

CLASSES = 64
CLUSTERED_WORDS = 1 << 10
HELD_WORDS = 1 << 18
SWEEPS = 6
#: Sweeps over the words outside the core, all at once in each. A second one fits words seen once or twice to their few
#: neighbours: training likelihood rises, that of texts left out falls.
REST_SWEEPS = 1
#: Words outside the core begin in groups by their length and last character.
SHAPES = 16
END = np.uint64(0x0E0E0E0E0E0E0E0E)
FLUSH = 1 << 20
ENTRIES_AT_ONCE = 1 << 14
#: Added to the class of a core word, whose class is settled.
CORE = 1 << 8
#: What a row of a pass over neighbours is: of the table of classes, of a word, or of a pair to be looked up.
TABLE, WORD, PAIR = 0, 1, 2


def tokens_of(block: Block) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and shapes of each text's words and the end after them, and where each text begins."""
    words = find_words(block, SPACED_LOWER)
    slots = np.arange(len(words.starts)) + words.text_of()
    hashes = np.full(len(words.starts) + len(block), END, np.uint64)
    hashes[slots] = word_hashes(block, words, SPACED_LOWER)
    length = words.ends - words.starts
    last = block.data[words.ends - 1]
    bare = (last >= 0x80) | ((last | 0x20) - 97 < 26) | ((last >= 48) & (last < 58))
    shapes = np.full(len(hashes), -1, np.int64)
    shapes[slots] = np.minimum((length - 1) // 2, 7) * 2 + bare
    return words, hashes, shapes, words.first + np.arange(len(block) + 1)


def _counted():
    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for block in blocks(batch.column(0)):
                _, hashes, shapes, _ = tokens_of(block)
                different, first, n = np.unique(hashes, return_index=True, return_counts=True)
                held.append((different, shapes[first], n))
                size += len(different)
                if size > 2 * FLUSH:
                    held = [_summed(held)]
                    size = len(held[0][0])
                    if size > FLUSH:
                        yield _count_rows(held.pop())
                        size = 0
        if held:
            yield _count_rows(_summed(held))

    return run


def _summed(held):
    hashes = np.concatenate([h[0] for h in held])
    different, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    n = np.bincount(inverse, np.concatenate([h[2] for h in held])).astype(np.int64)
    return different, np.concatenate([h[1] for h in held])[first], n


def _count_rows(summed) -> pa.RecordBatch:
    hashes, shapes, n = summed
    return pa.RecordBatch.from_arrays(
        [pa.array(hashes.view(np.int64)), pa.array(shapes.astype(np.int32)), pa.array(n.astype(np.int64))],
        ["word", "shape", "n"],
    )


#: Words in order, and for each value of their first bits where such words begin.
Lookup = tuple[np.ndarray, np.ndarray]
PROBES = 8


def lookup(words: np.ndarray, values: np.ndarray, default) -> tuple[Lookup, np.ndarray]:
    """Words to find, and their values by ``places``; the last one is for words not found."""
    order = np.argsort(words)
    words = words[order]
    bits = len(words).bit_length() + 1
    first = np.searchsorted(words, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    return (words, np.append(first, len(words)).astype(np.int32)), np.append(values[order], default)


def places(held: Lookup, words: np.ndarray) -> np.ndarray:
    """Where each word is among the known ones; their number if it is not."""
    known, first = held
    if not len(known):
        return np.zeros(len(words), np.int64)
    bits = (len(first) - 1).bit_length() - 1
    at = first[words >> np.uint64(64 - bits)].astype(np.int64)
    left = np.flatnonzero(known[np.minimum(at, len(known) - 1)] != words)
    # few words share their first bits
    for _ in range(PROBES):
        at[left] += 1
        inside = at[left] < first[(words[left] >> np.uint64(64 - bits)) + np.uint64(1)]
        at[left[~inside]] = len(known)
        left = left[inside]
        left = left[known[at[left]] != words[left]]
        if not len(left):
            return at
    found = np.searchsorted(known, words[left])
    same = known[np.minimum(found, len(known) - 1)] == words[left]
    at[left] = np.where(same, found, len(known))
    return at


def _units(hashes: np.ndarray, shapes: np.ndarray, clustered, size: int) -> np.ndarray:
    """Clustered words are units 0 to ``size - 1``, then come the shapes and the end."""
    known, values = clustered
    units = values[places(known, hashes)]
    units = np.where(units < 0, size + shapes, units)
    units[hashes == END] = size + SHAPES
    return units


def _bigrams(clustered, size: int):
    """Counts of neighbouring units; a text begins after an end."""

    def run(batches):
        units_all = size + SHAPES + 1
        codes, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []
        waiting = 0

        def merged():
            code, count = np.unique(np.concatenate(held), return_counts=True)
            every, inverse = np.unique(np.concatenate((codes, code)), return_inverse=True)
            return every, np.bincount(inverse, np.concatenate((n, count))).astype(np.int64)

        for batch in batches:
            for block in blocks(batch.column(0)):
                _, hashes, shapes, _ = tokens_of(block)
                units = _units(hashes, shapes, clustered.value, size)
                before = np.concatenate(([size + SHAPES], units[:-1]))
                held.append(before * units_all + units)
                waiting += len(units)
                if waiting > FLUSH:
                    codes, n = merged()
                    held, waiting = [], 0
        if held:
            codes, n = merged()
        if len(codes):
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], ["pair", "n"])

    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange_classes(bigrams: np.ndarray, words: int, classes: int, sweeps: int) -> np.ndarray:
    """The class of each unit: words are moved one by one to the class that makes the text likeliest.

    ``bigrams`` counts neighbouring units; units from ``words`` on keep a class of their own, after
    the ``classes``. A move changes the mutual information of neighbouring classes; sweeps end
    when no word moves.
    """
    units = len(bigrams)
    fixed = units - words
    of = np.concatenate((np.arange(words) % classes, classes + np.arange(fixed)))
    total = classes + fixed
    member = np.zeros((units, total))
    member[np.arange(units), of] = 1
    table = member.T @ bigrams @ member
    for _ in range(sweeps):
        moved = 0
        for w in range(words):
            after, before, own = bigrams[w] @ member, bigrams[:, w] @ member, bigrams[w, w]
            old = of[w]
            after[old] -= own
            before[old] -= own
            table[old] -= after
            table[:, old] -= before
            table[old, old] -= own
            member[w, old] = 0
            rows, columns = table[:classes], table[:, :classes].T
            gain = (_xlogx(rows + after) - _xlogx(rows)).sum(1) + (_xlogx(columns + before) - _xlogx(columns)).sum(1)
            # the cell of a class with itself gets both and the word with itself
            c = np.arange(classes)
            cell = table[c, c]
            gain += _xlogx(cell + after[c] + before[c] + own) + _xlogx(cell)
            gain -= _xlogx(cell + after[c]) + _xlogx(cell + before[c])
            left, right = table.sum(1)[:classes], table.sum(0)[:classes]
            n_after, n_before = after.sum() + own, before.sum() + own
            gain -= _xlogx(left + n_after) - _xlogx(left) + _xlogx(right + n_before) - _xlogx(right)
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            moved += new != old
            of[w] = new
            member[w, new] = 1
            table[new] += after
            table[:, new] += before
            table[new, new] += own
        if not moved:
            break
    return of


def _once(word, code, n=None):
    """Each (word, code) once, in order, with its sum of ``n``, or its number of rows."""
    order = np.lexsort((code, word))
    word, code = word[order], code[order]
    new = np.ones(len(word), bool)
    new[1:] = (word[1:] != word[:-1]) | (code[1:] != code[:-1])
    starts = np.flatnonzero(new)
    if n is None:
        n = np.diff(np.append(starts, len(word)))
    elif len(starts):
        n = np.add.reduceat(n[order], starts)
    return word[starts], code[starts], n


#: The counts of neighbours of all words whose hashes begin with the same bits (``span``): 64-bit words, 16-bit
#: codes and 64-bit counts as bytes.
SPANS = "span int, words binary, codes binary, counts binary"
_SPAN_COLUMNS = ["span", "words", "codes", "counts"]
_SPANNED = (np.dtype(np.uint64), np.dtype(np.int16), np.dtype(np.int64))
#: Entries of neighbours for a task, counted before copies are summed, and bits of the spans among which they are.
TASK_ENTRIES = 1 << 21
SPAN_BITS = 3


def _span_arrays(word: np.ndarray, code: np.ndarray, n: np.ndarray, bits: int) -> list[pa.Array]:
    """Columns of ``SPANS``; the words come in order."""
    span = (word >> np.uint64(64 - bits)).astype(np.int32)
    starts = np.flatnonzero(np.append(True, span[1:] != span[:-1])) if len(span) else np.zeros(0, np.int64)
    bounds = np.append(starts, len(span))
    columns = [pa.array(span[starts])]
    for x, kind in zip((word, code, n), _SPANNED):
        offsets, data = (bounds * kind.itemsize).astype(np.int32), np.ascontiguousarray(x.astype(kind))
        columns.append(pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]))
    return columns


def _spanned(bits: int):
    """Rows ``(word, code, n)`` by span."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append([batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)])
            size += batch.num_rows
            if size > FLUSH:
                yield rows(held)
                held, size = [], 0
        if size:
            yield rows(held)

    def rows(held):
        word, code, n = (np.concatenate(x) for x in zip(*held))
        word = word.view(np.uint64)
        order = np.argsort(word)
        return pa.RecordBatch.from_arrays(_span_arrays(word[order], code[order], n[order], bits), _SPAN_COLUMNS)

    return run


def _grouped(batches):
    """``(word, code, n)`` of whole spans, each word and code once and in order; rows come sorted by span."""
    held, size, last = [], 0, None
    for batch in batches:
        spans = batch.column(0).to_numpy(zero_copy_only=False)
        if not len(spans):
            continue
        columns = []
        for k, kind in enumerate(_SPANNED, 1):
            column = batch.column(k).cast(pa.large_binary())
            bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
            columns.append(data.copy().view(kind))
        at = (bounds - bounds[0]) // kind.itemsize
        starts = np.flatnonzero(np.append(True, spans[1:] != spans[:-1]))
        for low, high in zip(starts, np.append(starts[1:], len(spans))):
            if held and spans[low] != last:
                yield _once(*(np.concatenate(x) for x in zip(*held)))
                held, size = [], 0
            last = spans[low]
            held.append([x[at[low] : at[high]] for x in columns])
            size += at[high] - at[low]
            if size > 4 * FLUSH and len(held) > 1:
                held = [_once(*(np.concatenate(x) for x in zip(*held)))]
                size = len(held[0][0])
    if held:
        yield _once(*(np.concatenate(x) for x in zip(*held)))


def best_classes(table: np.ndarray, classes: int, old: np.ndarray, word: np.ndarray, code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each word the class of the first ``classes`` that makes the text likeliest, the others staying.

    ``table`` counts neighbouring classes, ``old`` is each word's class in it. The counts ``n`` are of
    the word (a number, sorted) and the class after it (``code``), before it (``code`` less the number of
    kinds) or the word itself after it (twice that number). A word that gains nothing stays.
    """
    kinds, c = len(table), np.arange(classes)
    counts = np.zeros((len(old), 2 * kinds + 1))
    counts[word, code] = n
    own = counts[:, -1:]
    sides = counts[:, :kinds], counts[:, kinds:-1]
    here = c == old[:, None]
    gain = np.zeros((len(old), classes))
    for side, (mine, others, cells) in enumerate(((sides[0], sides[1], table.T), (sides[1], sides[0], table))):
        at = code // kinds == side
        w, k, x = word[at], code[at] - side * kinds, n[at, None].astype(float)
        if not len(w):
            continue
        # the cells without the word
        base = cells[k, :classes] - here[w] * x
        inside = np.flatnonzero(k == old[w])
        base[inside] -= others[w[inside], :classes] + here[w[inside]] * own[w[inside]]
        starts = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
        gain[w[starts]] += np.add.reduceat(_xlogx(base + x) - _xlogx(base), starts)
    after, before = sides[0][:, :classes], sides[1][:, :classes]
    cell = table[c, c] - here * (after + before + own)
    gain += _xlogx(cell + after + before + own) + _xlogx(cell) - _xlogx(cell + after) - _xlogx(cell + before)
    for side, total in zip(sides, (table.sum(1)[c], table.sum(0)[c])):
        of_word = side.sum(1, keepdims=True) + own
        left = total - here * of_word
        gain -= _xlogx(left + of_word) - _xlogx(left)
    new = gain.argmax(1)
    each = np.arange(len(old))
    stays = (old < classes) & (gain[each, new] <= gain[each, np.minimum(old, classes - 1)] + 1e-9)
    return np.where(stays, old, new)


ASSIGNED = "word long, n long, shape int, class int"


def _assign(sent, classes: int):
    """New classes of words; the row of a word with code -1 packs its count, shape and class."""

    def run(batches):
        table = sent.value
        for word, code, n in _grouped(batches):
            word, code = word.view(np.int64), code.astype(np.int64)
            first = np.flatnonzero(code == -1)
            upto = np.append(first, len(word))
            low = 0
            while low < len(first):
                high = max(low + 1, int(np.searchsorted(upto, upto[low] + ENTRIES_AT_ONCE, "right")) - 1)
                a, b = upto[low], upto[high]
                about = n[first[low:high]]
                of = np.repeat(np.arange(high - low), np.diff(upto[low : high + 1]))
                counted = code[a:b] >= 0
                new = best_classes(table, classes, about & 255, of[counted], code[a:b][counted], n[a:b][counted])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(word[first[low:high]]),
                        pa.array(about >> 16),
                        pa.array((about >> 8 & 255).astype(np.int32)),
                        pa.array(new.astype(np.int32)),
                    ],
                    ["word", "n", "shape", "class"],
                )
                low = high

    return run


_NEIGHBOURS = ["part", "word", "a", "other", "b", "n", *_SPAN_COLUMNS]
NEIGHBOURS = f"part int, word long, a int, other long, b int, n long, {SPANS}"


def _word_rows(word, code, n, bits: int) -> pa.RecordBatch:
    spans = _span_arrays(word, code, n, bits)
    rows = [pa.array(np.full(len(spans[0]), WORD, np.int32))]
    rows += [pa.nulls(len(spans[0]), x) for x in (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())]
    return pa.RecordBatch.from_arrays(rows + spans, _NEIGHBOURS)


def _neighbour_rows(part: int, word, a, other, b, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(n), part, np.int32)),
            pa.array(np.ascontiguousarray(word).view(np.int64)),
            pa.array(a.astype(np.int32)),
            pa.array(np.ascontiguousarray(other).view(np.int64)),
            pa.array(b.astype(np.int32)),
            pa.array(n.astype(np.int64)),
            pa.nulls(len(n), pa.int32()),
            *(pa.nulls(len(n), pa.binary()) for _ in _SPANNED),
        ],
        _NEIGHBOURS,
    )


def _neighbours(sent, by_word: bool):
    """Neighbouring classes, and with ``by_word`` those of each word outside the core.

    Classes are those of the words sent, or of the shape if the sent ones say so. ``TABLE`` rows
    count classes (a, b); ``WORD`` rows words and codes by span, as ``best_classes`` takes them; ``PAIR``
    rows are pairs (word, other) of which one was not sent (class -1). Classes of core words are
    ``CORE`` more.
    """

    def run(batches):
        m = sent.value
        kinds = m["kinds"]
        table = np.zeros(kinds * kinds, np.int64)
        held: list = []
        size = 0
        for batch in batches:
            for block in blocks(batch.column(0)):
                _, hashes, shapes, _ = tokens_of(block)
                found = m["classes"][places(m["known"], hashes)]
                if m["shapes"] is not None:
                    found = np.where(found < 0, m["shapes"] + shapes, found)
                found[hashes == END] = CORE + kinds - 1
                left, right = np.concatenate(([END], hashes[:-1])), hashes
                a, b = np.concatenate(([CORE + kinds - 1], found[:-1])), found
                a_class, b_class = a & CORE - 1, b & CORE - 1
                known = (a >= 0) & (b >= 0)
                both = a_class * kinds + b_class
                some = np.flatnonzero(~known)
                table += np.bincount(both[known] if len(some) else both, minlength=kinds * kinds)
                if len(some):
                    yield _neighbour_rows(PAIR, left[some], a[some], right[some], b[some], np.ones(len(some), np.int64))
                if not by_word:
                    continue
                own = left == right
                after, before = known & (a < CORE) & ~own, known & (b < CORE) & ~own
                own &= known & (a < CORE)
                code = (b_class[after], kinds + a_class[before], np.full(own.sum(), 2 * kinds))
                held.append((np.concatenate((left[after], right[before], left[own])), np.concatenate(code).astype(np.int16)))
                size += len(held[-1][0])
                if size > FLUSH:
                    yield _word_rows(*_once(*(np.concatenate(x) for x in zip(*held))), m["bits"])
                    held, size = [], 0
        if size:
            yield _word_rows(*_once(*(np.concatenate(x) for x in zip(*held))), m["bits"])
        pairs = np.flatnonzero(table)
        none = np.zeros(len(pairs), np.int64)
        yield _neighbour_rows(TABLE, none, pairs // kinds, none, pairs % kinds, table[pairs])

    return run


def _resolved(pairs: DataFrame, assigned: DataFrame) -> DataFrame:
    """Pairs with the classes of both words; the classes of core words are ``CORE`` more."""
    of = assigned.select(F.col("word").alias("w"), F.col("class").alias("c"))
    pairs = pairs.groupBy("word", "a", "other", "b").agg(F.sum("n").alias("n"))

    def joined(rows: DataFrame, word: str, a: str) -> DataFrame:
        found = rows.where(F.col(a) < 0).join(of, F.col(word) == F.col("w")).withColumn(a, F.col("c")).drop("w", "c")
        return found.unionByName(rows.where(F.col(a) >= 0))

    return joined(joined(pairs, "word", "a"), "other", "b")


def _class_table(rows: DataFrame, resolved: DataFrame, kinds: int) -> np.ndarray:
    counted = rows.where(F.col("part") == TABLE).select("a", "b", "n")
    counted = counted.unionByName(resolved.select((F.col("a") % CORE).alias("a"), (F.col("b") % CORE).alias("b"), "n"))
    counted = counted.groupBy("a", "b").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((kinds, kinds))
    table[counted["a"].to_numpy(np.int64), counted["b"].to_numpy(np.int64)] = counted["n"].to_numpy(float)
    return table


def transition_scores(table: np.ndarray) -> np.ndarray:
    """log10 of P(class | class before), smoothed by the share of each class (Witten and Bell)."""
    total, kinds = table.sum(), len(table)
    share = (table.sum(0) + 1) / (total + kinds)
    follow = np.maximum((table > 0).sum(1, keepdims=True), 1)
    return np.log10((table + follow * share) / (table.sum(1, keepdims=True) + follow))


SCORED = (
    "id long, held_out boolean, n_tokens long, n_known long, base double, model double, "
    "rare array<struct<word: long, shape: int, before: int, prior: long, prior_shape: int, after: int, times: long>>"
)
_RARE = pa.struct(
    [
        ("word", pa.int64()),
        ("shape", pa.int32()),
        ("before", pa.int32()),
        ("prior", pa.int64()),
        ("prior_shape", pa.int32()),
        ("after", pa.int32()),
        ("times", pa.int64()),
    ]
)


def _scored(model):
    """Scores without the steps to and from words that were not sent, which are listed.

    Each such word has the class before it and after it: -1 if that is such a word as well, which
    ``prior`` names if it comes before. The step between two of them is of the second.
    """

    def run(batches):
        m = model.value
        kinds = len(m["transitions"])
        for batch in batches:
            for block in blocks(batch.column(2)):
                _, hashes, shapes, first = tokens_of(block)
                at = places(m["known"], hashes)
                classes = m["classes"][at]
                before = np.concatenate(([kinds - 1], classes[:-1]))
                after = np.concatenate((classes[1:], [-1]))
                held = classes >= 0
                known = m["counted"][at]
                # the last row and column are for words that were not sent
                step = m["emitted"][at] + m["steps"][before, classes]
                sums = lambda x: np.diff(np.concatenate(([0.0], np.cumsum(x)))[first])
                n = np.diff(first)
                rare = np.flatnonzero(~held)
                text = np.repeat(np.arange(len(block)), n)[rare]
                alone = before[rare] >= 0
                prior = np.where(alone, hashes[rare], hashes[rare - 1])
                prior_shape = np.where(alone, -1, shapes[rare - 1])
                fields = [hashes[rare].view(np.int64), shapes[rare], before[rare], prior.view(np.int64), prior_shape, after[rare]]
                order = np.lexsort((*fields, text))
                text, fields = text[order], [x[order] for x in fields]
                new = np.ones(len(text), bool)
                new[1:] = np.any([x[1:] != x[:-1] for x in (text, *fields)], axis=0)
                starts = np.flatnonzero(new)
                fields = [x[starts] for x in fields] + [np.diff(np.append(starts, len(text)))]
                lists = np.searchsorted(text[starts], np.arange(len(block) + 1)).astype(np.int32)
                rows = pa.StructArray.from_arrays([pa.array(x).cast(f.type) for x, f in zip(fields, _RARE)], fields=list(_RARE))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, len(block)),
                        batch.column(1).slice(block.first, len(block)),
                        pa.array(n.astype(np.int64)),
                        pa.array(sums(m["seen"][at]).round().astype(np.int64)),
                        pa.array(sums(known) - n * m["base_below"]),
                        pa.array(sums(step)),
                        pa.ListArray.from_arrays(pa.array(lists), rows),
                    ],
                    ["id", "held_out", "n_tokens", "n_known", "base", "model", "rare"],
                )

    return run


def _rare_steps(model):
    """What the listed words add to each row; ``class`` and ``prior_class`` are -1 for words never seen."""

    def run(batches):
        m = model.value
        transitions, below, of_shape = m["transitions"], m["below"], m["of_shape"]
        for batch in batches:
            x = {name: batch.column(k).to_numpy(zero_copy_only=False) for k, name in enumerate(batch.schema.names)}
            own = np.where(x["class"] >= 0, x["class"], of_shape[x["shape"]])
            prior = np.where(x["prior_class"] >= 0, x["prior_class"], of_shape[x["prior_shape"]])
            before = np.where(x["before"] >= 0, x["before"], prior)
            count = np.log10(x["n"] + 0.5)
            step = count - below[own] + transitions[before, own]
            step += np.where(x["after"] >= 0, transitions[own, x["after"]], 0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(x["times"] * count),
                    pa.array(x["times"] * step),
                    pa.array(np.where(x["n"] > 0, x["times"], 0)),
                ],
                ["row", "base", "model", "known"],
            )

    return run


def word_classes(
    training: DataFrame,
    counts: DataFrame,
    classes: int = CLASSES,
    clustered_words: int = CLUSTERED_WORDS,
    held_words: int = HELD_WORDS,
    sweeps: int = SWEEPS,
    rest_sweeps: int = REST_SWEEPS,
) -> tuple[DataFrame, dict, np.ndarray]:
    """``(word, n, shape, class)`` of all words of ``counts``; arrays of the most frequent ones; neighbouring classes.

    ``counts`` has (word, shape, n). The ``clustered_words`` most frequent words, ties by their hash, are
    the core. The others are moved against it and each other: a sweep counts the classes before and after
    each of them, and moves all of them at once, each as if the others stayed.
    """
    if not 0 < classes <= CORE - SHAPES - 1:
        raise ValueError(f"classes must be 1 to {CORE - SHAPES - 1}")
    spark = training.sparkSession
    counts = counts.where("shape >= 0")
    octave = F.floor(F.log2("n") * 8).cast("int")
    sizes = counts.groupBy(octave.alias("octave")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()
    top = counts.orderBy(F.desc("n"), "word").limit(clustered_words).select("word", "n", "shape").toPandas()
    size = len(top)
    # a word outside the core is counted with both its neighbours
    bits = SPAN_BITS + (2 * (sum(r["n"] for r in sizes) - int(top["n"].sum())) // TASK_ENTRIES).bit_length()
    core_words = top["word"].to_numpy(np.int64).view(np.uint64)

    units = size + SHAPES + 1
    sent = spark.sparkContext.broadcast(lookup(core_words, np.arange(size), -1))
    pairs = training.mapInArrow(_bigrams(sent, size), "pair long, n long")
    pairs = pairs.groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(units * units)
    table[pairs["pair"].to_numpy(np.int64)] = pairs["n"].to_numpy(float)
    table = table.reshape(units, units)
    of = exchange_classes(table, size, classes, sweeps)
    kinds = classes + SHAPES + 1
    member = np.zeros((units, kinds))
    member[np.arange(units), of] = 1
    table = member.T @ table @ member

    core = top.assign(**{"class": of[:size]})
    core = spark.createDataFrame(core[["word", "n", "shape", "class"]].values.tolist(), ASSIGNED)
    core = materialize(core, "core-classes")
    # the most frequent others, as many whole steps of frequency as fit: their classes need no shuffle
    taken, least = 0, None
    for row in sorted(sizes, key=lambda r: -r["octave"]):
        taken += row["words"]
        if taken > held_words:
            break
        least = row["octave"]

    def known(assigned: DataFrame) -> dict:
        often = octave >= F.lit(least) if least is not None else F.lit(False)
        held = assigned.where(often).select("word", "n", "class").toPandas()
        return {
            "words": np.append(core_words, held["word"].to_numpy(np.int64).view(np.uint64)),
            "n": np.append(top["n"].to_numpy(np.int64), held["n"].to_numpy(np.int64)),
            "class": np.append(of[:size], held["class"].to_numpy(np.int64)),
            "core": np.arange(size + len(held)) < size,
        }

    def passed(own: dict, shapes, by_word: bool) -> DataFrame:
        words, of_words = lookup(own["words"], own["class"] + CORE * own["core"], -1)
        model = {"known": words, "classes": of_words, "kinds": kinds, "shapes": shapes, "bits": bits}
        model = spark.sparkContext.broadcast(model)
        return training.mapInArrow(_neighbours(model, by_word), NEIGHBOURS)

    def moved(assigned: DataFrame, rows: DataFrame) -> DataFrame:
        about = F.expr("shiftleft(n, 16) + shape * 256 + class")
        abouts = assigned.select("word", F.lit(-1).alias("code"), about.alias("n")).mapInArrow(_spanned(bits), SPANS)
        rows = abouts.union(rows).repartition(1 << bits >> SPAN_BITS, "span").sortWithinPartitions("span")
        return materialize(rows.mapInArrow(_assign(spark.sparkContext.broadcast(table), classes), ASSIGNED), "classes")

    rest = counts.join(core.select("word"), "word", "left_anti")
    rest = rest.select("word", "n", "shape", (F.col("shape") + classes).alias("class"))
    own = known(rest.limit(0))
    if sum(r["words"] for r in sizes) > size:
        rows = passed(own, classes, True)
        rest = moved(rest, rows.where(F.col("part") == WORD).select(_SPAN_COLUMNS))
        for sweep in range(1, rest_sweeps + 1):
            # after the last one the table alone is counted
            own = known(rest)
            rows = materialize(passed(own, None, sweep < rest_sweeps), "neighbours")
            pairs = rows.where(F.col("part") == PAIR).select("word", "a", "other", "b", "n")
            pairs = materialize(_resolved(pairs, rest), "pairs")
            table = _class_table(rows, pairs, kinds)
            if sweep < rest_sweeps:
                same = F.col("word") == F.col("other")
                after = pairs.where((F.col("a") < CORE) & ~same).select("word", (F.col("b") % CORE).alias("code"), "n")
                before = pairs.where((F.col("b") < CORE) & ~same)
                before = before.select(F.col("other").alias("word"), (F.col("a") % CORE + kinds).alias("code"), "n")
                itself = pairs.where(same & (F.col("a") < CORE)).select("word", F.lit(2 * kinds).alias("code"), "n")
                pairs = after.unionByName(before).unionByName(itself).mapInArrow(_spanned(bits), SPANS)
                rest = moved(rest, rows.where(F.col("part") == WORD).select(_SPAN_COLUMNS).union(pairs))
    used = np.append(np.arange(classes), kinds - 1)  # no word is left in a shape
    return core.unionByName(rest), own, table[np.ix_(used, used)]


def class_scores(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    classes: int = CLASSES,
    clustered_words: int = CLUSTERED_WORDS,
    held_words: int = HELD_WORDS,
    sweeps: int = SWEEPS,
    rest_sweeps: int = REST_SWEEPS,
) -> DataFrame:
    """``(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score)``, a row for every row.

    Tokens are the words of the text (A-Z lower-cased, split at white space) and an end. The
    model learns from rows where ``held_out`` is false or null. ``base_score`` is the log10
    probability by counts of single tokens with 0.5 added to each; ``score`` is the sum of
    log10 P(class | class before) and log10 P(token | class). ``perplexity`` turns either into one.

    Every word of the training rows is put into one of ``classes`` classes by exchange clustering, and
    the end is its own. The ``clustered_words`` most frequent words (ties by their hash) are moved one by
    one on the driver, over a table of ``(clustered_words + SHAPES + 1)`` squared counts at most; all
    others are moved in tasks, ``rest_sweeps`` times, by the classes before and after all their places.
    The driver also gets the classes and counts of at most ``held_words`` frequent words and sends
    them to the tasks. Those of rarer words are written and joined to the texts and neighbours that
    have them, by word. Words never seen take the class that most words seen once of their length and
    last character have.

    Null and empty texts are an end alone. Rows that repeat an id are scored each by itself.
    Without training rows every token is unknown. Other columns are ignored, no rows give no rows.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    training = source.where("not held_out").select("text")
    counts = training.mapInArrow(_counted(), "word long, shape int, n long")
    counts = materialize(counts.groupBy("word", "shape").agg(F.sum("n").alias("n")), "word-counts")
    assigned, own, table = word_classes(training, counts, classes, clustered_words, held_words, sweeps, rest_sweeps)

    ends = counts.where("shape < 0").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    once = F.sum(F.when(F.col("n") == 1, 1).otherwise(0))
    total = assigned.groupBy("shape", "class").agg(F.sum("n").alias("n"), F.count("*").alias("words"), once.alias("once"))
    total = total.orderBy("shape", "class").collect()
    kinds = classes + 1
    tokens_in, words_in = np.zeros(kinds), np.zeros(kinds)
    shaped = np.zeros((SHAPES, classes))
    for r in total:
        tokens_in[r["class"]] += r["n"]
        words_in[r["class"]] += r["words"]
        # words seen once come first, then all of the shape
        shaped[r["shape"], r["class"]] = r["once"] + r["words"] * 1e-12
    tokens_in[-1], words_in[-1] = ends, ends > 0
    of_shape = np.where(shaped.any(1), shaped.argmax(1), shaped.sum(0).argmax())
    open_ended = np.isin(np.arange(kinds), of_shape)  # such a class also holds words never seen
    tokens, words = int(tokens_in.sum()), int(words_in.sum())
    transitions = transition_scores(table)
    below = np.log10(np.maximum(tokens_in + 0.5 * (words_in + open_ended), 0.5))
    sent = np.append(own["words"], END)
    known, class_of = lookup(sent, np.append(own["class"], kinds - 1), -1)
    count_of = lookup(sent, np.append(own["n"], ends), 0)[1]
    counted = np.log10(count_of + 0.5)
    counted[-1] = 0
    emitted = counted - below[class_of]
    emitted[-1] = 0
    model = {
        "known": known,
        "classes": class_of,
        "counted": counted,
        "emitted": emitted,
        "seen": (count_of > 0).astype(float),
        "steps": np.pad(transitions, (0, 1)),
        "transitions": transitions,
        "below": below,
        "base_below": float(np.log10(tokens + 0.5 * (words + 1))),
        "of_shape": of_shape,
    }
    model = spark.sparkContext.broadcast(model)
    rows = source.mapInArrow(_scored(model), SCORED)
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "scores")

    rare = rows.select("row", F.inline("rare"))
    rare = rare.join(assigned.select("word", "n", "class"), "word", "left")
    prior = assigned.select(F.col("word").alias("prior"), F.col("class").alias("prior_class"))
    rare = rare.join(prior, "prior", "left").select(
        "row",
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        F.coalesce("class", F.lit(-1)).alias("class"),
        F.coalesce("prior_class", F.lit(-1)).alias("prior_class"),
        *("shape", "before", "prior_shape", "after", "times"),
    )
    rare = rare.mapInArrow(_rare_steps(model), "row long, base double, model double, known long").groupBy("row")
    rare = rare.agg(
        F.sum("base").alias("rare_base"), F.sum("model").alias("rare_model"), F.sum("known").alias("rare_known")
    )
    out = rows.drop("rare").join(rare, "row", "left")
    more = lambda name: F.coalesce(name, F.lit(0))
    return out.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + more("rare_known")).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more("rare_base")).alias("base_score"),
        (F.col("model") + more("rare_model")).alias("score"),
    )


def perplexity(score: Column, n_tokens: Column) -> Column:
    return F.pow(F.lit(10.0), -score / n_tokens)
