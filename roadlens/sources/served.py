"""Gold: served tables, and listing, describing and paging them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..operators import paging
from ..operators.rows import search_table as search_rows
from ..schema import to_source_names
from .tables import NEXT, replace_table, table_name


def write_mart(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace the served table ``name`` once ``df`` is written. Row order is not kept: sort when reading."""
    replace_table(df, name, path)


def write_mart_jdbc(
    df: DataFrame, name: str, url: str, properties: Mapping[str, str], connections: int = 8
) -> None:
    """Replace the table ``name`` of a database, over at most ``connections`` connections."""
    df.write.option("numPartitions", connections).option("batchsize", 10_000).option(
        "truncate", True
    ).jdbc(url, name, mode="overwrite", properties=dict(properties))


def jdbc_options(
    url: str,
    table: str,
    properties: Mapping[str, str],
    column: str | None = None,
    low: object = None,
    high: object = None,
    partitions: int = 1,
) -> dict[str, str]:
    """Reader options. A plain read is one task; with a numeric or date ``column`` and its
    bounds it becomes ``partitions`` range reads (rows outside the bounds are read too)."""
    out = {"url": url, "dbtable": table, **properties}
    if column is not None:
        if low is None or high is None or partitions < 2:
            raise ValueError("a partitioned read needs low, high and at least 2 partitions")
        out |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return out


def read_mart_jdbc(spark: SparkSession, **options) -> DataFrame:
    """A database table through :func:`jdbc_options`; connection errors are raised as they are."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def list_jdbc_tables(
    spark: SparkSession, url: str, properties: Mapping[str, str], schema: str
) -> DataFrame:
    """Names of a database schema's tables, asked of the database itself."""
    quoted = schema.replace("'", "''")
    query = f"(select table_name from information_schema.tables where table_schema = '{quoted}') t"
    return read_mart_jdbc(spark, url=url, table=query, properties=properties)


def open_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(table_name(spark, name))


read_mart = open_table


def register_views(accidents: DataFrame, weather: DataFrame, prefix: str = "") -> None:
    """Temporary views ``accidents`` and ``weather`` under the original column names, for
    statements written against those. Without a prefix they hide tables of the same name."""
    for name, df in (("accidents", accidents), ("weather", weather)):
        to_source_names(df).createOrReplaceTempView(prefix + name)


def list_tables(spark: SparkSession, pattern: str = "*") -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(pattern=pattern) if not t.name.endswith(NEXT))


def table_overview(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """``table_name, row_count, column_count`` of each table."""
    return reduce(
        DataFrame.unionByName,
        [
            open_table(spark, name)
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(len(spark.table(name).columns)).alias("column_count"),
            )
            for name in names
        ],
    )


def _type_name(kind: DataType) -> str:
    return kind.simpleString()


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """One row per column: its type, whether it may be NULL, and the table's size beside it."""
    df = open_table(spark, name)
    fields = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(_type_name(f.dataType)).alias("type"),
            F.lit(f.nullable).alias("nullable"),
        )
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"),
        "row_count",
        F.lit(len(fields)).alias("column_count"),
        F.inline(F.array(*fields)),
    )


def table_page(
    spark: SparkSession, name: str, keys: Sequence[str] = (), limit: int = paging.DEFAULT_LIMIT,
    offset: int = 0, sort_by: str | None = None, order: str = "asc",
) -> tuple[DataFrame, DataFrame]:
    """A page of a table, and one row saying where it lies."""
    df = open_table(spark, name)
    return (
        paging.page(df, keys, limit, offset, sort_by, order),
        paging.page_info(df, limit, offset),
    )


def page_payload(spark: SparkSession, name: str, **where) -> dict:
    """A page as plain values, for handing to a client: at most one page is collected."""
    rows, info = table_page(spark, name, **where)
    return {
        "table_name": name,
        "data": [row.asDict() for row in rows.collect()],
        "pagination": info.first().asDict(),
    }


def search_table(
    spark: SparkSession, name: str, text: str, cols: Sequence[str] | None = None
) -> DataFrame:
    return search_rows(open_table(spark, name), text, cols)
