"""Validation report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import RepeatedIds
from ..functions.calendar import parse_day
from ..schema import SITUATION_FORMAT


def quality_report(
    df: DataFrame,
    id_col: str,
    null_cols: Sequence[str],
    ranges: Mapping[str, tuple[float, float]] | None = None,
    dates: Mapping[str, str] | None = None,
) -> DataFrame:
    """``(rule, column_name, violations)``, one row per rule.

    Rules: ``not_null`` per column, ``in_range`` per entry of ``ranges``, ``parsable_date`` per
    entry of ``dates`` (column to format), and ``unique_id``: rows beyond the first of their id.
    All but the last come from one aggregate without an exchange of rows. The last reads and
    moves the id column only.
    """
    checks = {("not_null", c): F.col(c).isNull() for c in null_cols}
    for c, (low, high) in (ranges or {}).items():
        checks["in_range", c] = ~F.col(c).between(low, high)
    for c, fmt in (dates or {"situation_date": SITUATION_FORMAT}).items():
        checks["parsable_date", c] = F.col(c).isNotNull() & parse_day(F.col(c), fmt).isNull()
    names = [F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column_name")) for r, c in checks]
    counts = [F.count_if(F.coalesce(v, F.lit(False))) for v in checks.values()]
    narrow = df.agg(F.arrays_zip(F.array(*names).alias("n"), F.array(*counts).alias("v")).alias("z"))
    report = narrow.select(F.explode("z").alias("z")).select("z.n.*", F.col("z.v").alias("violations"))
    repeated = df.agg((F.count(id_col) - F.countDistinct(id_col)).alias("violations")).select(
        F.lit("unique_id").alias("rule"), F.lit(id_col).alias("column_name"), "violations"
    )
    return report.unionByName(repeated)


def require_unique(df: DataFrame, id_col: str) -> None:
    """Raise :class:`RepeatedIds` where an id has more than one row; NULL ids are not compared.

    Ids are counted map-side before they move, so one that fills the table is no burden on one task.
    """
    counts = df.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("rows"))
    repeated = counts.where("rows > 1").agg(F.count(F.lit(1)), F.min(id_col)).first()
    if repeated[0]:
        raise RepeatedIds(*repeated)
