"""Row-level operators: selection, union, newest version, ordering, search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import UnknownColumn


def require_column(df: DataFrame, name: str) -> str:
    if name not in df.columns:
        raise UnknownColumn(name, df.columns)
    return name


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a value in all ``cols``; unlike ``dropna`` this keeps NaN."""
    return df.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in cols]))


def split_vertical(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """One frame per named column group."""
    return {name: df.select(*cols) for name, cols in groups.items()}


def merge_by_name(previous: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both, duplicates kept, columns matched by name."""
    return previous.unionByName(new, allowMissingColumns=True)


def latest_per_key(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """The newest row of every key; further columns break ties, so the pick is repeatable.

    This is a maximum over a row struct rather than a numbered window: it is combined map-side,
    so a key that holds a large part of all rows arrives as one row per map task.
    Rows with a NULL key have no identity to share and are all kept: a number of their own makes
    each a group, so the source is read once.
    """
    ranked = [*latest_by, *[c for c in df.columns if c not in {*keys, *latest_by}]]
    has_key = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    numbered = df.withColumn("own number", F.when(~has_key, F.monotonically_increasing_id()))
    row = F.max(F.struct(*ranked)) if ranked else F.count(F.lit(1))
    newest = numbered.groupBy(*keys, "own number").agg(row.alias("row"))
    return newest.select(*keys, *(["row.*"] if ranked else [])).select(*df.columns)


def top_k(df: DataFrame, measure: str, keys: Sequence[str], n: int = 50) -> DataFrame:
    """The ``n`` largest by ``measure``, ties cut in key order. Each task keeps ``n`` rows."""
    return df.orderBy(F.desc(measure), *[F.asc(k) for k in keys]).limit(n)


def sort_table(
    df: DataFrame, by: str | None, order: str = "asc", keys: Sequence[str] = ()
) -> DataFrame:
    """Sort by any column, then by ``keys``, then by all others: ascending has NULLs first, descending last."""
    columns = total_order(df, by, keys)
    turn = F.desc if order == "desc" else F.asc
    return df.orderBy(*[turn(c) for c in columns])


def ordering(df: DataFrame, by: str | None, keys: Sequence[str]) -> list[str]:
    """The sort column and its tie-breaks: ``keys``, or every other column without them."""
    first = [require_column(df, by)] if by else []
    rest = [require_column(df, k) for k in keys] or df.columns
    return first + [c for c in rest if c not in first]


def total_order(df: DataFrame, by: str | None, keys: Sequence[str]) -> list[str]:
    """:func:`ordering` and then every other column that can be sorted, so only equal rows tie."""
    first = ordering(df, by, keys)
    return first + [c for c, kind in df.dtypes if c not in first and not kind.startswith(("map", "variant"))]


def search_table(df: DataFrame, text: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows with ``text`` somewhere in one of ``cols`` (default: all), whatever the case."""
    needle = F.lower(F.lit(text))
    hits = [
        F.contains(F.lower(F.col(f"`{require_column(df, c)}`").cast("string")), needle)
        for c in (cols or df.columns)
    ]
    return df.where(reduce(Column.__or__, hits))
