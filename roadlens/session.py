"""Session settings this package is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "roadlens", master: str | None = None, **overrides) -> SparkSession:
    """A session with the settings above; keyword ``a__b`` sets ``a.b``.

    The number of shuffle partitions is left to the cluster: start high (several times the
    total cores, so that a partition stays near 128 MB) and let adaptive execution coalesce.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in overrides.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
