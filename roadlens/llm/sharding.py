"""Shards by jump consistent hashing, with gapless places, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialize

ROWS_A_CHUNK = 100_000

#: The generator of the published algorithm, key * A + 1 modulo 2 ** 64.
_A, _MODULUS, _TOP = "2862933555777941757BD", "18446744073709551616BD", "8589934592BD"


def jump_hash(key: Column, shards: int) -> Column:
    """The shard of a 64-bit key among ``shards``, by Lamping and Veach's jump consistent hash.

    With one shard more a key either stays or goes to the new one. The walk of a key from shard
    to shard takes 1 + ln(shards) steps on average; a fold over ``shards`` steps holds any walk. The
    64-bit products are taken as decimals, so nothing overflows.
    """
    unsigned = key.cast("decimal(20,0)")
    start = F.struct(
        F.when(key < 0, unsigned + F.expr(_MODULUS)).otherwise(unsigned).cast("decimal(38,0)").alias("key"),
        F.lit(-1).cast("long").alias("shard"),
        F.lit(0).cast("long").alias("next"),
    )
    count = F.lit(shards)

    def step(walk: Column, _: Column) -> Column:
        key = ((walk["key"] * F.expr(_A) + 1) % F.expr(_MODULUS)).cast("decimal(38,0)")
        draw = F.floor(key / F.expr(_TOP)).cast("double") + 1
        jump = F.floor((walk["next"] + 1) * (F.lit(float(1 << 31)) / draw)).cast("long")
        taken = F.struct(key.alias("key"), walk["next"].alias("shard"), jump.alias("next"))
        return F.when(walk["next"] < count, taken).otherwise(walk)

    steps = F.sequence(F.lit(1), count)
    return F.aggregate(steps, start, step, lambda walk: walk["shard"].cast("int"))


def shard(
    docs: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_a_chunk: int = ROWS_A_CHUNK,
) -> DataFrame:
    """``(id_col, size, text_crc32, shard, slot, grown_shard)``, a row for every row of ``docs``.

    The id alone decides the shard, 0 to ``shards - 1``; ``grown_shard`` is the shard with one
    more of them. ``size`` is the text's UTF-8 bytes and 8 more. ``slot`` counts the rows of a
    shard from 0 without gaps.

    Slots come from counts of chunks of about ``rows_a_chunk`` rows, dealt by row and not by id,
    so that neither a large shard nor an id that repeats often is numbered in one task.

    A null text has no bytes and the checksum 0; a null id goes where 0 goes; rows that repeat an
    id share its shard and have slots of their own. Other columns are ignored, and no rows give
    no rows.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        jump_hash(key, shards).alias("shard"),
        jump_hash(key, shards + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = materialize(rows, "shards")
    chunks = rows.count() // (shards * rows_a_chunk) + 1
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)))
    # a running sum over counts: a row for each chunk of a shard
    counts = rows.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = F.expr("sum(n) OVER (PARTITION BY shard ORDER BY chunk) - n")
    counts = counts.select("shard", "chunk", before.alias("before"))
    place = F.expr("row_number() OVER (PARTITION BY shard, chunk ORDER BY row) - 1")
    numbered = rows.withColumn("place", place).join(counts, ["shard", "chunk"])
    return numbered.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        "shard",
        (F.col("before") + F.col("place")).cast("long").alias("slot"),
        "grown_shard",
    )
