"""A bounded sample of labelled rows to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_sample(labels: DataFrame, id_col: str, label_col: str, most: int, allowed=None) -> DataFrame:
    """``(label_id, label)`` of at most ``most`` labelled ids: those whose hashes are least, so always the same.

    Null ids and labels are left out; an id with several labels has the largest.
    """
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    if allowed is not None:
        rows = rows.where(allowed)
    rows = rows.groupBy(F.col(id_col).cast("long").alias("label_id")).agg(
        F.max(F.col(label_col).cast("int")).alias("label")
    )
    return rows.orderBy(F.xxhash64("label_id"), "label_id").limit(most)
