"""Pages of a table in a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import BadPage
from ..sources.storage import Folder, scratch_path
from .rows import ordering, sort_table, total_order

# Page size.
DEFAULT_LIMIT = 100
MAX_LIMIT = 1000

# Up to here a page is taken as a top-k, further down by position: another plan, the same rows.
NEAR_ROWS = 10 * MAX_LIMIT
# Rows of a range of a page index.
RANGE_ROWS = 1_000_000


def check_page(limit: int, offset: int) -> None:
    if not 1 <= limit <= MAX_LIMIT:
        raise BadPage(f"limit must be 1 to {MAX_LIMIT}, not {limit}")
    if offset < 0:
        raise BadPage(f"offset must not be negative, not {offset}")


def page(
    df: DataFrame,
    keys: Sequence[str],
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
    sort_by: str | None = None,
    order: str = "asc",
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of ``df``, sorted by ``sort_by``, ``keys`` and all other columns.

    The order is total at every offset, so pages never overlap and leave nothing out, whether or not
    the keys repeat. A page far down goes through :func:`deep_page`, which keeps no more than a
    page in any one place and gives the same rows.
    """
    check_page(limit, offset)
    if offset + limit <= NEAR_ROWS:
        return sort_table(df, sort_by, order, keys).offset(offset).limit(limit)
    return deep_page(df, keys, limit, offset, sort_by, order)


def deep_page(
    df: DataFrame,
    keys: Sequence[str],
    limit: int,
    offset: int,
    sort_by: str | None = None,
    order: str = "asc",
) -> DataFrame:
    """A page found by position instead of by skipping rows; see :class:`PageIndex` for many of them."""
    return PageIndex(df, keys, sort_by, order).page(limit, offset)


def _div(position: Column, limit: int) -> Column:
    return F.floor((position - position % limit) / limit)


class PageIndex:
    """Positions of a table's rows, written once and used for all its pages.

    Only the sort columns are read, equal keys merged into one row with their number, then
    spread over the cluster by range and written, which pins the ranges. There are as many ranges
    as keep one near ``RANGE_ROWS`` rows. The row total of each range (one number per range) tells
    which ranges a page touches, and a running count inside those alone gives its keys. The first
    and last of them bound the read of the rows; where the sort columns are all columns, the keys
    are the page. :meth:`pages` gives all pages by one plan. :meth:`remove` deletes what was written.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], sort_by: str | None = None, order: str = "asc"):
        self.df, self.keys, self.sort_by, self.order = df, list(keys), sort_by, order
        self.columns = ordering(df, sort_by, keys)
        self.turn = F.desc if order == "desc" else F.asc
        self.turned = [self.turn(c) for c in self.columns]
        counted = df.groupBy(*self.columns).agg(F.count(F.lit(1)).alias("n"))
        ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // RANGE_ROWS + 1)
        ranged = counted.repartitionByRange(ranges, *self.turned).select(
            F.struct(*self.columns).alias("key"), "n", F.spark_partition_id().alias("part")
        )
        self._path = scratch_path(df.sparkSession, "page")
        ranged.write.parquet(self._path)
        self.placed = df.sparkSession.read.schema(ranged.schema).parquet(self._path)
        self.totals = sorted(self.placed.groupBy("part").agg(F.sum("n")).collect())
        self._finer: PageIndex | None = None

    def remove(self) -> None:
        Folder(self.df.sparkSession, self._path).remove()
        if self._finer:
            self._finer.remove()

    def _positions(self) -> DataFrame:
        """The keys with the position ``upto`` which their rows reach: the rows before a key's range, and a running count inside."""
        begin, begins = 0, [0] * (1 + max((part for part, _ in self.totals), default=0))
        for part, n in self.totals:
            begins[part], begin = begin, begin + n
        before_range = F.get(F.lit(begins).cast("array<bigint>"), F.col("part"))
        inside_range = F.sum("n").over(Window.partitionBy("part").orderBy(self.turn("key")))
        return self.placed.withColumn("upto", before_range + inside_range)

    def pages(self, limit: int = DEFAULT_LIMIT) -> DataFrame:
        """All pages: every row, in order, with the number of its page in ``page``, from 0.

        The rows of page p are those of ``page(limit, p * limit)``, found by the same positions, but the plan has one size
        however many pages there are. Equal rows are handed out page by page. Needs columns that can be sorted.
        """
        check_page(limit, 0)
        df = self.df
        if "page" in df.columns:
            raise BadPage("a column is called page")
        if set(self.columns) != set(df.columns):
            whole = total_order(df, self.sort_by, self.keys)
            if set(whole) != set(df.columns):
                raise BadPage(f"cannot be sorted: {sorted(set(df.columns) - set(whole))}")
            self._finer = self._finer or PageIndex(df, whole, self.sort_by, self.order)
            return self._finer.pages(limit)
        size, page = F.lit(limit).cast("bigint"), F.col("page")
        start = F.col("upto") - F.col("n")
        numbers = F.sequence(_div(start, limit), _div(F.col("upto") - 1, limit))
        taken = F.least("upto", (page + 1) * size) - F.greatest(F.col("start"), page * size)
        dealt = self._positions().withColumn("start", start).select("key", "start", "upto", F.explode(numbers).alias("page"))
        copies = F.explode(F.array_repeat(F.lit(0), taken.cast("int"))).alias("_copy")
        rows = dealt.select("key.*", "page", copies).select(*df.columns, "page")
        return rows.orderBy("page", *self.turned)

    def page(self, limit: int, offset: int) -> DataFrame:
        check_page(limit, offset)
        df, columns, turn = self.df, self.columns, self.turn
        end, begin, touched = offset + limit, 0, []
        for part, n in self.totals:
            if begin < end and begin + n > offset:
                touched.append(part)
            begin += n
        if not touched:
            return df.limit(0)

        upto = F.col("upto")
        start = upto - F.col("n")
        page_keys = (
            self._positions().where(F.col("part").isin(touched))
            .where((start < end) & (upto > offset))
            .select(
                "key",
                (F.least(upto, F.lit(end)) - F.greatest(start, F.lit(offset))).alias("taken"),
                F.greatest(F.lit(offset) - start, F.lit(0)).alias("skipped"),
            )
        )
        if set(columns) == set(df.columns):
            copies = F.explode(F.array_repeat(F.lit(0), F.col("taken").cast("int"))).alias("_copy")
            return page_keys.select("key.*", copies).select(*df.columns).orderBy(*self.turned)

        # Rows equal in every sort column share a key; some of the first key's may lie before the page.
        ends = page_keys.agg(
            F.min("key").alias("low"), F.max("key").alias("high"), F.max("skipped").alias("skipped")
        )
        skipped = ends.first()["skipped"]
        whole = total_order(df, self.sort_by, self.keys)
        if skipped > NEAR_ROWS:
            self._finer = self._finer or PageIndex(df, whole, self.sort_by, self.order)
            return self._finer.page(limit, offset)
        key = F.struct(*columns)
        rows = df.where((key >= ends.select("low").scalar()) & (key <= ends.select("high").scalar()))
        return rows.orderBy(*[turn(c) for c in whole]).offset(skipped).limit(limit)


def page_info(df: DataFrame, limit: int = DEFAULT_LIMIT, offset: int = 0) -> DataFrame:
    """One row: ``total_rows, returned_rows, offset, limit, has_more``."""
    check_page(limit, offset)
    total = F.col("total_rows")
    left = F.greatest(total - offset, F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        total,
        F.least(left, F.lit(limit)).cast("bigint").alias("returned_rows"),
        F.lit(offset).cast("bigint").alias("offset"),
        F.lit(limit).cast("bigint").alias("limit"),
        (total > offset + limit).alias("has_more"),
    )
