"""Catalog tables replaced as a whole: the new one is complete before the old one goes."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..errors import UnknownTable
from .commits import GRACE
from .storage import Folder

#: A table that is written and not yet switched to.
NEXT = "__next"


def table_name(spark: SparkSession, name: str) -> str:
    """The catalog name to read: between the two steps of a switch, that of the new table."""
    for own in (name, name + NEXT):
        if spark.catalog.tableExists(own):
            return own
    raise UnknownTable(name)


def _switch(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {name + NEXT} RENAME TO {name}")
    spark.catalog.refreshTable(name)


def table_folder(spark: SparkSession, name: str) -> str:
    """Where the table lies now."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[-1]["data_type"]


def replace_table(
    df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = (), grace: float = GRACE
) -> None:
    """Make ``df`` the table ``name``, in Parquet.

    The rows go to a folder and a table of their own, so a write that fails leaves the table as it was. The switch
    is two steps of the catalog; :func:`table_name` finds the new table between them, and a writer that comes after one
    that broke off there finishes its switch. Tables are external: the old folder stays for those
    who are reading it, and goes in a later write, ``grace`` seconds after its last change.

    Folders are ``path`` (without it, the table's name in the warehouse) or, where that is in use, beside it
    with a number behind.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(name + NEXT):
        _switch(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name + NEXT}")
    base = (path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{name}").rstrip("/")
    target = f"{base}-{uuid.uuid4().hex}" if Folder(spark, base).exists() else base
    writer = df.write.format("parquet").option("path", target)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name + NEXT)
    old = table_folder(spark, name) if spark.catalog.tableExists(name) else None
    _switch(spark, name)
    _sweep(spark, base, {target, old}, grace)


def _sweep(spark: SparkSession, base: str, kept: set[str | None], grace: float) -> None:
    """Remove the table's folders but the present and the last one."""
    parent, _, own = base.rpartition("/")
    names = {path.rstrip("/").rpartition("/")[2] for path in kept if path}
    for name in Folder(spark, parent).names():
        if re.fullmatch(re.escape(own) + "-[0-9a-f]{32}", name) and name not in names:
            folder = Folder(spark, f"{parent}/{name}")
            if folder.modified() <= time.time() - grace:
                folder.remove()
