"""Scoring records as they arrive."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.features import LABEL, feature_rows
from ..plans.model import score

SCORED = f"id string, severity int, {LABEL} int, prediction double, probability_high double"


def scored(model: PipelineModel, records: DataFrame) -> DataFrame:
    """Predictions for silver records, batch or stream: row by row, no exchange."""
    out = score(model, feature_rows(records, impute=False))
    high = F.get(vector_to_array("probability"), F.lit(1))
    return out.select("id", "severity", LABEL, "prediction", high.alias("probability_high"))


def stream_score(
    model: PipelineModel, records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Score what arrives. The records are dealt out over the cluster first: a hundred trees a row cost far more than
    moving it, and landed files may be few."""
    parts = 2 * records.sparkSession.sparkContext.defaultParallelism
    return (
        scored(model, records.repartition(parts))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
