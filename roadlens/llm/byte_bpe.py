"""Byte-level BPE by recursive queries: a DuckDB database inside each worker encodes and decodes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import blocks

#: Text of a block, words found at a time in a longer text, and ids decoded at a time.
BLOCK = 4 << 20
WORDS_AT_ONCE = 1 << 19
IDS_AT_ONCE = 1 << 18
#: Words, and bytes of them, that a worker keeps with their ids.
KNOWN_WORDS = 1 << 20
KNOWN_BYTES = 1 << 25
#: Bytes of new words in one query, rows of all its steps, and bytes from which a word is long.
QUERY_BYTES = 1 << 18
QUERY_ROWS = 1 << 22
LONG_WORD = 160

_VOCABULARY = """
CREATE TABLE vocabulary AS SELECT id, hex(from_base64(token)) AS bytes FROM ranks;
-- reach: bytes of the longest token up to this rank
CREATE TABLE merges AS
SELECT l.id AS a, r.id AS b, t.id AS merged, t.reach
FROM (
    SELECT id, bytes, reach, unnest(range(2, length(bytes), 2)) AS cut
    FROM (SELECT id, bytes, max(length(bytes) // 2) OVER (ORDER BY id) AS reach FROM vocabulary)
) t
JOIN vocabulary l ON l.bytes = t.bytes[: cut] JOIN vocabulary r ON r.bytes = t.bytes[cut + 1 :];
-- tokens that begin or end another one of a smaller rank
CREATE TABLE early AS
SELECT DISTINCT s.id
FROM (
    SELECT id, unnest([bytes[: cut], bytes[cut + 1 :]]) AS part
    FROM (SELECT id, bytes, unnest(range(2, length(bytes), 2)) AS cut FROM vocabulary)
) t JOIN vocabulary s ON s.bytes = part AND s.id > t.id;
"""

#: Token ``id`` of word w begins at byte p; ``next_id`` follows it at byte q; ``pair`` is the rank of both together and
#: their places (a word is shorter than 256 bytes here). A step joins neighbours with the merge table and
#: contracts each word's leftmost pair of least rank; a word without a pair is done.
_CONTRACT = """
WITH RECURSIVE state(step, done, w, p, id, q, next_id, pair) AS (
    SELECT 0, false, w, p, id, q, next_id, (merged::BIGINT << 16) | (p << 8) | q
    FROM (SELECT w, p, id, lead(p) OVER word AS q, lead(id) OVER word AS next_id FROM pieces WINDOW word AS (PARTITION BY w ORDER BY p))
    LEFT JOIN merges ON a = id AND b = next_id
    UNION ALL
    SELECT step + 1, least IS NULL, w, p, new_id, new_q, new_next, (merged::BIGINT << 16) | (p << 8) | new_q
    FROM (
        SELECT step, w, p, least,
            CASE WHEN pair = least THEN (least >> 16)::INTEGER ELSE id END AS new_id,
            CASE WHEN pair = least THEN past ELSE q END AS new_q,
            CASE WHEN pair = least THEN past_id WHEN q = (least >> 8) & 255 THEN (least >> 16)::INTEGER ELSE next_id END AS new_next
        FROM (SELECT * FROM state WHERE NOT done AND step < {steps}) JOIN (
            SELECT taken.w AS word, least, cut.q AS past, cut.next_id AS past_id
            FROM (SELECT w, min(pair) AS least FROM state WHERE NOT done AND step < {steps} GROUP BY w) taken
            LEFT JOIN state cut ON cut.w = taken.w AND cut.p = (least & 255)
        ) ON word = w
        WHERE least IS NULL OR p <> (least & 255)
    ) LEFT JOIN merges ON a = new_id AND b = new_next
)
SELECT w, p, id, done FROM state WHERE done OR step = {steps}
"""

#: The same for long words, where all pairs that nothing can come before are contracted in one step.
_CONTRACT_LONG = """
WITH RECURSIVE state(step, done, w, p, id) AS (
    SELECT 0, false, w, p, id FROM pieces
    UNION ALL
    SELECT step + 1, over, w, p, CASE WHEN joins THEN merged ELSE id END
    FROM (
        SELECT *, lag(joins) OVER (PARTITION BY w ORDER BY p) AS taken
        FROM (
            SELECT *, coalesce(least_here AND CASE WHEN early THEN before IS NULL OR before > merged
                ELSE nth % 2 = 1 AND held_up = 0 END, false) AS joins
            FROM (
                SELECT *, row_number() OVER (PARTITION BY w, run ORDER BY p) AS nth,
                    sum(CASE WHEN least_here THEN 0 ELSE 1 END) OVER (PARTITION BY w, run ORDER BY p) AS held_up
                FROM (
                    SELECT *, count(CASE WHEN merged IS DISTINCT FROM previous THEN 1 END) OVER (PARTITION BY w ORDER BY p) AS run
                    FROM (
                        SELECT *, merged = min(merged) OVER (
                                PARTITION BY w ORDER BY p RANGE BETWEEN reach PRECEDING AND 2 * reach FOLLOWING
                            ) AS least_here,
                            min(merged) OVER (PARTITION BY w ORDER BY p RANGE BETWEEN reach PRECEDING AND 1 PRECEDING) AS before,
                            lag(merged) OVER (PARTITION BY w ORDER BY p) AS previous,
                            max(merged) OVER (PARTITION BY w) IS NULL AS over
                        FROM (
                            SELECT step, w, p, s.id, merged, coalesce(reach, 1) AS reach, early.id IS NOT NULL AS early
                            FROM (
                                SELECT step, w, p, id, lead(id) OVER (PARTITION BY w ORDER BY p) AS following
                                FROM state WHERE NOT done AND step < {steps}
                            ) s LEFT JOIN merges ON a = s.id AND b = following LEFT JOIN early ON early.id = merged
                        )
                    )
                )
            )
        )
    )
    WHERE taken IS NOT TRUE
)
SELECT w, p, id, done FROM state WHERE done OR step = {steps}
"""

_SPELLED = """
SELECT n, unhex(string_agg(bytes, '' ORDER BY place)) AS bytes
FROM tokens JOIN vocabulary USING (id) GROUP BY n ORDER BY n
"""


class _Slots(dict):
    """A number for each word, in the order in which they come up."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class ByteBpe:
    """The vocabulary and its merge table as tables of a database in this process's memory.

    ``ranks`` is the text of a rank file: a token in base64 and its rank, a line each.
    """

    def __init__(self, ranks: str):
        import base64

        import duckdb

        pairs = [line.split() for line in ranks.splitlines() if line.strip()]
        tokens = [token for token, _ in pairs]
        numbers = np.array([int(number) for _, number in pairs], np.int32)
        spelled = [base64.b64decode(token) for token in tokens]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        self.db.register("ranks", pa.table({"token": tokens, "id": numbers}))
        self.db.execute(_VOCABULARY)
        self.whole = dict(zip(spelled, numbers.tolist()))
        self.of_byte = np.array([self.whole[bytes([b])] for b in range(256)], np.int32)
        self.forget()

    def forget(self) -> None:
        self.slots = _Slots()
        self.held_bytes = 0
        self.ids = np.zeros(0, np.int32)
        self.starts = self.counts = np.zeros(0, np.int64)

    def _contract(self, query: str, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in a row, and how many each has."""
        data = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        place = (np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        pieces = pa.table({"w": word, "p": place, "id": self.of_byte[data]})
        done = []
        while len(pieces):
            # a query keeps the rows of all its steps; what is not done then goes into the next one
            steps = max(4, QUERY_ROWS // len(pieces))
            self.db.register("pieces", pieces)
            found = self.db.sql(query.format(steps=steps)).to_arrow_table()
            over = found.column("done").combine_chunks()
            done.append(found.filter(over).select(["w", "p", "id"]))
            pieces = found.filter(pa.compute.invert(over)).select(["w", "p", "id"])
        found = pa.concat_tables(done)
        w, p, ids = (found.column(c).to_numpy() for c in ("w", "p", "id"))
        order = np.lexsort((p, w))
        return ids[order], np.bincount(w, minlength=len(words))

    def _learn(self, words: list[str]) -> None:
        """Find the ids of the words that got the last slots, shorter ones first."""
        spelled = [word.encode() for word in words]
        whole = [self.whole.get(word, -1) for word in spelled]
        counts = np.ones(len(words), np.int64)
        known = [np.array([i for i in whole if i >= 0], np.int32)]
        order = [np.flatnonzero(np.array(whole) >= 0)]
        sizes = np.fromiter(map(len, spelled), np.int64, len(words))
        rest = np.flatnonzero(np.array(whole) < 0)
        rest = rest[np.argsort(sizes[rest], kind="stable")]
        upto = np.cumsum(sizes[rest])
        short = int(np.searchsorted(sizes[rest], LONG_WORD))
        low = 0
        while low < len(rest):
            past = upto[low] - sizes[rest[low]] + QUERY_BYTES
            high = max(int(np.searchsorted(upto, past, "right")), low + 1)
            high = min(high, short) if low < short else high
            query = _CONTRACT if low < short else _CONTRACT_LONG
            found, counts[rest[low:high]] = self._contract(query, [spelled[i] for i in rest[low:high].tolist()])
            known.append(found)
            order.append(rest[low:high])
            low = high
        order = np.concatenate(order)
        starts = np.empty(len(words), np.int64)
        starts[order] = len(self.ids) + np.cumsum(counts[order]) - counts[order]
        self.ids = np.concatenate((self.ids, *known))
        self.starts = np.concatenate((self.starts, starts))
        self.counts = np.concatenate((self.counts, counts))
        self.held_bytes += int(sizes.sum())

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words of a text or several in a row, and how many each has."""
        if len(self.slots) > KNOWN_WORDS or self.held_bytes > KNOWN_BYTES:
            self.forget()
        known = len(self.slots)
        slot = np.fromiter(map(self.slots.__getitem__, words), np.int64, len(words))
        if len(self.slots) > known:
            self._learn(list(islice(self.slots, known, None)))
        counts = self.counts[slot]
        ends = np.cumsum(counts)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[slot] - ends + counts, counts)
        return self.ids[places], counts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each run of ``counts`` ids; an id without a token has none."""
        out = [b""] * len(counts)
        owner = np.repeat(np.arange(len(counts)), counts)
        self.db.register("tokens", pa.table({"n": owner, "place": np.arange(len(ids)), "id": ids.astype(np.int64)}))
        found = self.db.sql(_SPELLED).to_arrow_table()
        for n, spelled in zip(found.column("n").to_pylist(), found.column("bytes").to_pylist()):
            out[n] = spelled
        return out


def _coder(sent) -> ByteBpe:
    # a worker process loads this once and keeps it, with the words seen so far
    own = sent.value
    if "coder" not in own:
        own["coder"] = ByteBpe(own["ranks"])
    return own["coder"]


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    for block in blocks(column, BLOCK):
        yield block.first, column.slice(block.first, len(block)).fill_null("").to_pylist()


def _spelled(coder: ByteBpe, rows: list[np.ndarray]) -> Iterator[bytes]:
    """What each row's ids spell, ``IDS_AT_ONCE`` ids at a time."""
    held, size = [], 0
    for ids in rows:
        if held and size + len(ids) > IDS_AT_ONCE:
            yield from coder.decode(np.concatenate(held), np.array([len(x) for x in held]))
            held, size = [], 0
        if len(ids) > IDS_AT_ONCE:
            parts = [ids[i : i + IDS_AT_ONCE] for i in range(0, len(ids), IDS_AT_ONCE)]
            yield b"".join(coder.decode(part, np.array([len(part)]))[0] for part in parts)
        else:
            held.append(ids)
            size += len(ids)
    if held:
        yield from coder.decode(np.concatenate(held), np.array([len(x) for x in held]))


def _encoding(sent, pattern: str, decoded_col: str | None):
    names = ["id", "n_tokens", "ids", *([decoded_col] if decoded_col else [])]

    def run(batches):
        import regex

        coder, split = _coder(sent), regex.compile(pattern)
        for batch in batches:
            for first, texts in _texts(batch.column(1)):
                if len(texts) == 1 and len(texts[0]) > BLOCK // 4:
                    found = (m.group() for m in split.finditer(texts[0]))
                    parts = []
                    while words := list(islice(found, WORDS_AT_ONCE)):
                        parts.append(coder.encode(words)[0])
                    ids = [np.concatenate(parts)]
                else:
                    words, ends = [], []
                    for text in texts:
                        words += split.findall(text)
                        ends.append(len(words))
                    flat, counts = coder.encode(words)
                    upto = np.concatenate(([0], np.cumsum(counts)))
                    ids = np.split(flat, upto[ends[:-1]])
                columns = [
                    batch.column(0).slice(first, len(texts)),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                ]
                if decoded_col:
                    columns.append(pa.array(_spelled(coder, ids), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _decoding(sent, names: list[str], place: int):
    def run(batches):
        coder = _coder(sent)
        for batch in batches:
            rows = [np.frombuffer(ids.as_py() or b"", "<u4") for ids in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_spelled(coder, rows), pa.binary())], names)

    return run


def _sent(df: DataFrame, ranks_path: str):
    with open(ranks_path, encoding="ascii") as file:
        return df.sparkSession.sparkContext.broadcast({"ranks": file.read()})


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    decoded_col: str | None = None,
) -> DataFrame:
    """``(id_col, n_tokens, ids)``, a row for every row of ``docs``: ``ids`` are little-endian 32-bit values.

    With ``decoded_col`` a column of that name has what :func:`decode` makes of the ids, in the same pass.

    Each match of ``pattern`` is encoded by itself: as one token where it is one, else from its bytes by
    contracting the leftmost pair of least rank until none is left. The partition's words that the worker has
    not met are rows (word, place, token) of a DuckDB table; a recursive query joins neighbours with the merge
    table and contracts one pair of each word a step. In a word of ``LONG_WORD`` bytes or more a step
    contracts every pair that is least as far as any token of no greater rank reaches on either side: nothing
    that happens farther off can come before it, so the ids are the same and the steps do not grow with the word.

    The rank file is read on the driver (under 1 MB) and sent. No rows are shuffled. A worker holds the text of
    a block, at most ``KNOWN_WORDS`` known words beside those of a block, and ``QUERY_ROWS`` rows of a query (or a few
    steps of one longer word). Null and empty texts have no ids; rows that repeat an id
    are texts of their own, null ids stay null; other columns are ignored, and no rows give no rows.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "id long, n_tokens long, ids binary" + (f", `{decoded_col}` binary" if decoded_col else "")
    coded = source.mapInArrow(_encoding(_sent(docs, ranks_path), pattern, decoded_col), schema)
    return coded.withColumnRenamed("id", id_col)


def decode(coded: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``coded`` with the bytes that its ids spell, by an ordered aggregation over the ids joined with the vocabulary.

    Bytes, because ids that were cut anywhere need not be UTF-8. Null and empty ids spell nothing; ids without a
    token are left out. The other columns stay; one named ``out_col`` is replaced.
    """
    kept = coded.drop(out_col)
    schema = kept.withColumn(out_col, F.lit(None).cast("binary")).schema
    names = [*kept.columns, out_col]
    return kept.mapInArrow(_decoding(_sent(coded, ranks_path), names, kept.columns.index(ids_col)), schema)
