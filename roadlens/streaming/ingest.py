"""Landing a stream of records in a store, read back as the newest version of each id."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.rows import latest_per_key
from ..sources.storage import Folder

BATCH = "landed_batch"


def feed(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream; a single file counts as a folder of one."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if Folder(spark, path).is_file():
        path, _, name = path.rpartition("/")
        reader = reader.option("pathGlobFilter", name)
    return reader.parquet(path)


def stream_ingest(
    stream: DataFrame,
    keys: Sequence[str],
    latest_by: Sequence[str],
    store: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append versions of records to ``store``; :func:`read_store` takes the newest of each key.

    Within a batch the newest record of a key is kept, combined map-side, so a key that fills a
    third of a batch is no burden on one task (a streaming de-duplication would send it to one).
    Nothing landed before is read, so a batch costs what it holds. A batch owns one folder, named
    by the query's own id and the batch, so repeating it after a failure rewrites that folder, and
    a query with a new checkpoint, whose batches start again at 0, touches none of the old ones.
    """
    keys = list(keys)

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # the identity of a query is in its checkpoint and survives restarts
        query = json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]
        fresh = latest_per_key(batch, keys, latest_by)
        fresh.write.mode("overwrite").parquet(f"{store}/{BATCH}={query}-{batch_id}")

    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _landed(spark: SparkSession, store: str) -> list[str]:
    return [f"{store}/{n}" for n in Folder(spark, store).names() if n.startswith(f"{BATCH}=")]


def read_store(
    spark: SparkSession, store: str, schema, keys: Sequence[str] = ("id",), latest_by: Sequence[str] = ()
) -> DataFrame:
    """The newest version of each key landed so far: what the batch operator gives over all feeds."""
    paths = _landed(spark, store)
    if not paths:
        return spark.createDataFrame([], schema)
    return latest_per_key(spark.read.schema(schema).parquet(*paths), keys, latest_by)


def compact_store(
    spark: SparkSession, store: str, schema, keys: Sequence[str] = ("id",), latest_by: Sequence[str] = ()
) -> None:
    """Put all landed batches into one folder, while no query is writing.

    The old folders go after the new one is complete; breaking off in between leaves copies, which
    reading takes for one.
    """
    paths = _landed(spark, store)
    if len(paths) > 1:
        read_store(spark, store, schema, keys, latest_by).write.parquet(f"{store}/{BATCH}=compact-{uuid.uuid4().hex}")
        for path in paths:
            Folder(spark, path).remove()
