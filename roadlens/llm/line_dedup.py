"""Fuzzy line de-duplication: one line stays of each component of similar lines."""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialize
from .bits import bit_map, may_hold
from .components import connected_components
from .links import Similarity, similar_components
from .row_keys import PARTS, keyed, one_of_each, row_key
from .words import SPACED, Block, _tables, blocks, code_points, distinct, find_words, mix

SIMILARITY = Similarity(percent=80, hashes=55, bands=11, looks=(20, 40, 55), miss=1e-4, rows=5, width=1, sized=False)
#: Characters of a shingle, for lines of any length.
SHINGLE = 5
NEWLINE = 10
WORD = re.compile("[^\x20\x09-\x0D]")
_WHITE = ~SPACED.inside
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def lines_of(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each line with a word: its text, its number there, its first byte and its end."""
    data, bounds = block.data, block.bounds
    breaks = np.flatnonzero(data == NEWLINE)
    text = np.searchsorted(bounds, breaks, "right") - 1
    owner = np.concatenate((np.arange(len(block)), text))
    starts = np.concatenate((bounds[:-1], breaks + 1))
    ends = np.concatenate((bounds[1:], breaks))
    starts = starts[np.lexsort((starts, owner))]
    ends = ends[np.lexsort((ends, owner))]
    owner = np.sort(owner)
    number = np.arange(len(owner)) - np.searchsorted(owner, owner)
    words = find_words(block, SPACED)
    some = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    return owner[some], number[some], starts[some], ends[some]


def normalised(block: Block, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Lines with A-Z lower-cased (UTF-8 bytes beyond ASCII stay), runs of white space one space, none at the ends."""
    white = _WHITE[block.data]
    data = np.where(white, np.uint8(32), _LOWER[block.data])
    extra = np.flatnonzero(white[1:] & white[:-1]) + 1
    if len(extra):
        data = np.delete(data, extra)
        starts, ends = (at - np.searchsorted(extra, at) for at in (starts, ends))
    held = data.tobytes()
    # a line may still begin or end with one space
    return [held[a:b].strip(b" ") for a, b in zip(starts.tolist(), ends.tolist())]


def line_key(line: bytes) -> bytes:
    return hashlib.blake2b(line, digest_size=16).digest()


_LOW = mix(np.arange(1, 1 << 12, dtype=np.uint64))


def _character_values(codes: np.ndarray) -> np.ndarray:
    """64 bits of each character; the first few thousand are looked up."""
    if not len(codes) or codes.max() < len(_LOW):
        return _LOW[codes]
    return mix(codes + np.uint64(1))


def shingle_hashes(lines: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` characters of each line, and where each line's begin.

    A shorter line is one shingle.
    """
    bounds = np.concatenate(([0], np.cumsum([len(line) for line in lines]))).astype(np.int64)
    codes, begins = code_points(Block(0, bounds, np.frombuffer(b"".join(lines), np.uint8)))
    powers, inverses = _tables(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_character_values(codes) * powers[: len(codes)], out=sums[1:])
    length = np.diff(begins)
    first = np.concatenate(([0], np.cumsum(np.maximum(length - size + 1, 1))))
    # every place of the block at once, then without those that run over a line's end
    n = max(len(codes) - size + 1, 0)
    every = (sums[size:] - sums[:n]) * inverses[:n]
    inside = np.ones(len(codes), bool)
    for back in range(1, size):
        ends = begins[1:] - back
        inside[ends[ends >= begins[:-1]]] = False
    short = np.flatnonzero(length < size)
    out = np.empty(first[-1], np.uint64)
    whole = np.ones(len(out), bool)
    whole[first[short]] = False
    out[whole] = every[inside[:n]]
    out[first[short]] = (sums[begins[short + 1]] - sums[begins[short]]) * inverses[begins[short]]
    return mix(out), first


def one_permutation(hashes: np.ndarray, first: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation MinHash: a byte of the least hash in each of ``bins`` parts of the hash range.

    An empty part takes the value of another one of the same line, chosen by a fixed sequence of
    parts (optimal densification), so equal sets have equal signatures.
    """
    lines = len(first) - 1
    empty = np.uint64((1 << 64) - 1)
    least = np.full(lines * bins, empty, np.uint64)
    part = ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    part += np.repeat(np.arange(lines) * bins, np.diff(first))
    np.minimum.at(least, part, hashes)
    # the byte stands in the middle: the part and being the least one decide the bits far above it
    out = np.where(least == empty, 256, least >> np.uint64(32) & np.uint64(255)).astype(np.uint16)
    return _filled(out.reshape(lines, bins), np.uint16(256)).astype(np.uint8)


def _filled(out: np.ndarray, empty) -> np.ndarray:
    bins = out.shape[1]
    missing = out == empty
    parts = np.arange(bins, dtype=np.uint64)
    open_lines = np.flatnonzero(missing.any(1))
    least, rest = out[open_lines], missing[open_lines]
    for attempt in range(1, 8 * bins):
        if not len(open_lines):
            break
        source = (mix(parts + np.uint64(attempt << 16)) % np.uint64(bins)).astype(np.int64)
        found = least[:, source]
        filled = rest & (found != empty)
        out[open_lines] = np.where(filled, found, out[open_lines])
        rest &= ~filled
        still = rest.any(1)
        open_lines, least, rest = open_lines[still], least[still], rest[still]
    # what is left after that many steps takes the line's least value
    out[open_lines] = np.where(rest, least.min(1, keepdims=True), out[open_lines])
    return out


def _described(shingle: int, bins: int):
    """A row per line with a word; sizes and signatures are given once for equal lines of a block."""

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1)):
                owner, number, starts, ends = lines_of(block)
                lines = normalised(block, starts, ends)
                places: dict[bytes, int] = {}
                for place, line in enumerate(lines):
                    places.setdefault(line, place)
                hashes, first = shingle_hashes(list(places), shingle)
                signature: list = [None] * len(lines)
                size: list = [None] * len(lines)
                # the shingles with repeats, which bound the set
                for at, n, values in zip(places.values(), np.diff(first).tolist(), one_permutation(hashes, first, bins)):
                    signature[at], size[at] = values.tobytes(), n
                begins = np.ones(len(owner), bool)
                begins[1:] = owner[1:] != owner[:-1]
                text = pa.array(owner + block.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(k).take(text) for k in (0, 2, 3)],
                        pa.array(number.astype(np.int32)),
                        pa.array(begins),
                        pa.array([line_key(line) for line in lines], pa.binary()),
                        pa.array(size, pa.int64()),
                        pa.array(signature, pa.binary()),
                    ],
                    ["id", *PARTS, "line", "begins", "key", "size", "signature"],
                )

    return run


def _chosen(wanted):
    """Key and normalised text of the lines of documents that may have a wanted one."""

    def run(batches):
        for batch in batches:
            rows = np.flatnonzero(may_hold(wanted.value, batch.column(0).to_numpy(zero_copy_only=False)))
            if not len(rows):
                continue
            for block in blocks(batch.column(1).take(pa.array(rows))):
                _, _, starts, ends = lines_of(block)
                lines = list(set(normalised(block, starts, ends)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([line_key(line) for line in lines], pa.binary()),
                        pa.array(lines, pa.binary()),
                    ],
                    ["key", "payload"],
                )

    return run


def _marked(wanted, inside: bool):
    """Rows whose hash, the last column, may be wanted, or those for which it is not; without that column."""

    def run(batches):
        for batch in batches:
            may = may_hold(wanted.value, batch.columns[-1].to_numpy(zero_copy_only=False))
            kept = batch.filter(pa.array(may if inside else ~may))
            yield pa.RecordBatch.from_arrays(kept.columns[:-1], batch.schema.names[:-1])

    return run


def _kept_lines(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: Similarity
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lines that have or may have a like one, with their place, the row's key and the place that is kept for them;
    the other lines, which are their own; keys of rows that repeat."""
    spark = docs.sparkSession
    source = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *row_key(id_col, text_col)
    )
    schema = "id long, ka long, kb long, line int, begins boolean, key binary, size long, signature binary"
    rows = materialize(source.mapInArrow(_described(shingle, similarity.hashes), schema), "lines")

    place = F.struct("id", "line", *PARTS)
    nodes = rows.groupBy("key").agg(
        F.min(place).alias("at"),
        F.count(F.lit(1)).alias("copies"),
        *[F.first(c, ignorenulls=True).alias(c) for c in ("size", "signature")],
    )
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "line-classes")

    def fetch(wanted: DataFrame) -> DataFrame:
        at = nodes.select("node", "key", "at.id").join(wanted, "node", "left_semi")
        likely = spark.sparkContext.broadcast(bit_map(at, F.xxhash64("id")))
        texts = source.select(F.xxhash64("id").alias("hash"), "text")
        texts = texts.mapInArrow(_chosen(likely), "key binary, payload binary")
        return at.join(texts, "key").select("node", "payload").dropDuplicates(["node"])

    def sets_of(payload: pa.Array) -> list[np.ndarray]:
        hashes, first = shingle_hashes(payload.to_pylist(), shingle)
        return [distinct(hashes[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]

    labels = similar_components(nodes, similarity, fetch, sets_of)
    linked = nodes.select("node", "at").join(labels, "node")
    firsts = linked.groupBy("label").agg(F.min("at").alias("keeper"))
    # lines without a similar one keep the first of their copies
    keepers = nodes.select("key", "node", "at", "copies").join(
        linked.join(firsts, "label").select("node", "keeper"), "node", "left"
    )
    keepers = keepers.where("copies > 1 OR keeper IS NOT NULL").select("key", F.coalesce("keeper", "at").alias("keeper"))
    # written, so that the rows of a very common line can be joined with it in several tasks
    keepers = materialize(keepers, "line-keepers")
    again = rows.where("begins").groupBy(*PARTS).count().where("count > 1").select(*PARTS)
    # most lines are like no other and need not be moved
    likely = spark.sparkContext.broadcast(bit_map(keepers, F.xxhash64("key")))
    lines = rows.select("id", *PARTS, "line", "key", F.xxhash64("key").alias("hash"))
    schema = "id long, ka long, kb long, line int, key binary"
    found = lines.mapInArrow(_marked(likely, True), schema).join(keepers, "key", "left")
    own = lines.drop("key").mapInArrow(_marked(likely, False), "id long, ka long, kb long, line int")
    return found.withColumn("keeper", F.coalesce("keeper", place)), own.withColumn("keeper", place), again


def line_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similarity: Similarity = SIMILARITY,
) -> DataFrame:
    r"""``(id_col, line, kept_id, kept_line, kept)``, a row for each line of each row of ``docs``.

    Lines are split at \n and counted from 0; a line without a word (only white space) is none.
    Two lines are linked if they are equal after A-Z is lower-cased and white space collapsed,
    or if the sets of their runs of ``shingle`` characters have a Jaccard similarity of at least the threshold.
    With runs of five, lines of 49 characters on are linked with one letter changed, of 94 on with a word of
    six letters changed. Of each component of linked lines the first stays: the smallest id, then the
    smallest line number. ``kept_id`` and ``kept_line`` name it.

    Equal lines are one node. Candidates agree in one of the bands of a one-permutation MinHash
    signature; unlikely ones are given up early and the rest is confirmed on the full sets. The
    eleven bands of five miss 1.3 % of the pairs right at the threshold and 5e-5 of those at 0.9;
    a component needs only some of its links (see ``links`` for the bounds of tasks).

    Null and empty texts have no line. Of rows that repeat an id with other texts one has the kept line;
    rows equal in id and text are one place: they stay or go together. A null id sorts first. Other columns are
    ignored, and no rows give no rows.
    """
    found, own, _ = _kept_lines(docs, id_col, text_col, shingle, similarity)
    return found.drop("key").unionByName(own).select(
        F.col("id").alias(id_col),
        "line",
        F.col("keeper.id").alias("kept_id"),
        F.col("keeper.line").alias("kept_line"),
        (F.struct("id", "line", *PARTS).eqNullSafe(F.col("keeper"))).alias("kept"),
    )


def _cut(at: int):
    """Rows without the lines of the text whose numbers are in the last column, and without that column."""

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(at)):
                part = batch.slice(block.first, len(block))
                columns, lost = part.columns[:-1], part.column(part.num_columns - 1)
                touched = lost.is_valid().to_numpy(zero_copy_only=False) & columns[at].is_valid().to_numpy(zero_copy_only=False)
                kept, left = np.ones(len(part), bool), []
                for row in np.flatnonzero(touched).tolist():
                    text, gone = columns[at][row].as_py(), set(lost[row].as_py())
                    left.append("\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone))
                    kept[row] = WORD.search(left[-1]) is not None or WORD.search(text) is None
                if left:
                    columns[at] = pc.replace_with_mask(columns[at], pa.array(touched), pa.array(left, columns[at].type))
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1]).filter(pa.array(kept))

    return run


def drop_similar_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similarity: Similarity = SIMILARITY,
) -> DataFrame:
    """The rows of ``docs`` with all columns; of each component of lines, all but the first are cut from the texts.

    A text that loses no line stays as it is; a row whose text had words and has none left is
    dropped. Null and empty texts stay. Rows that repeat an id lose lines by their own texts; of rows
    equal in id and text, with words, one stays. Texts are cut in Arrow batches, in time that grows with
    their length, however many lines go.
    """
    lines, _, again = _kept_lines(docs, id_col, text_col, shingle, similarity)
    gone = lines.where(~F.struct("id", "line", *PARTS).eqNullSafe(F.col("keeper")))
    rows, name = keyed(docs, id_col, text_col)
    rows = one_of_each(rows, name, again)
    lost = uuid.uuid4().hex
    gone = gone.groupBy(F.struct(*PARTS).alias(name)).agg(F.collect_set("line").alias(lost))
    joined = rows.join(gone, name, "left").select(*docs.columns, lost)
    return joined.mapInArrow(_cut(docs.columns.index(text_col)), docs.schema)
