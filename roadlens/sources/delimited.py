"""Raw delimited feeds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rows import merge_by_name
from ..schema import RECORD_COLUMNS

BAD_FIELDS = "bad_fields"
BAD_ROW = "bad_row"


def read_raw_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    mode: str = "permissive",
    multi_line: bool = False,
) -> DataFrame:
    """Delimited parts with a header, under the declared record types.

    Nothing is inferred: every field is read as text, matched to its column *by header name* and
    cast. So parts may order their columns differently, lack one, or hold ``43065-1234`` where
    another holds ``43065``. Each path (file, folder or glob) has one header; a file in it with
    another header is an error, not a silent shift.

    ``permissive``: a field that does not fit its type becomes NULL and is named in the array
    column ``bad_fields``; a row with fewer or more fields than the header keeps what it has and
    its whole line stands in ``bad_row`` (NULL elsewhere). ``failfast``: either fails the job.

    ``multi_line`` reads quoted line breaks as part of a field; such files are not split between
    tasks. Without it the pieces of such a row are bad rows.
    """
    if mode not in ("permissive", "failfast"):
        raise ValueError(f"mode must be permissive or failfast, not {mode}")
    parts = [_read_part(spark, p, mode, multi_line) for p in ([paths] if isinstance(paths, str) else paths)]
    return reduce(merge_by_name, parts)


def _read_part(spark: SparkSession, path: str, mode: str, multi_line: bool) -> DataFrame:
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    header = reader.csv(path).columns
    columns = header if mode == "failfast" else [*header, BAD_ROW]
    text = (
        reader.schema(", ".join(f"`{c}` string" for c in columns))
        .option("enforceSchema", False)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", BAD_ROW)
        # all fields of a row are counted, whichever are asked for
        .option("columnPruning", False)
        .csv(path)
    )
    typed, misfits = [], []
    for name, _, kind in RECORD_COLUMNS:
        if name not in header:
            typed.append(F.lit(None).cast(kind).alias(name))
            continue
        raw = F.col(f"`{name}`")
        value = raw.cast(kind) if mode == "failfast" else raw.try_cast(kind)
        typed.append(value.alias(name))
        if kind != "string":
            misfits.append(F.when(raw.isNotNull() & value.isNull(), F.lit(name)))
    if mode == "permissive":
        typed += [F.array_compact(F.array(*misfits)).alias(BAD_FIELDS), F.col(BAD_ROW)]
    return text.select(*typed)
