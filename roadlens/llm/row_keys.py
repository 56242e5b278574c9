"""Rows told apart by what an operator sees of them, the id and the text, wherever they are read again."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = ["ka", "kb"]


def row_key(id_col: str, text_col: str) -> list[Column]:
    """128 bits of id and text as two columns; equal for rows that are equal in both, and only for them."""
    number, text = F.col(id_col).cast("long"), F.col(text_col)
    first = F.xxhash64(number, text)
    second = F.xxhash64(F.lit("row"), text.isNull(), text, number.isNull(), number)
    return [c.alias(name) for c, name in zip((first, second), PARTS)]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """``docs`` with the key in one column, of a name that ``docs`` has not."""
    name = uuid.uuid4().hex
    return docs.select("*", F.struct(*row_key(id_col, text_col)).alias(name)), name


def named(keys: DataFrame, name: str) -> DataFrame:
    return keys.select(F.struct(*PARTS).alias(name))


def one_of_each(rows: DataFrame, name: str, repeated: DataFrame) -> DataFrame:
    """``rows`` with one row left of each key in ``repeated``; only rows of such keys are moved by key."""
    if repeated.isEmpty():
        return rows
    keys = named(repeated, name)
    once = rows.join(keys, name, "left_semi").dropDuplicates([name])
    return rows.join(keys, name, "left_anti").unionByName(once)
