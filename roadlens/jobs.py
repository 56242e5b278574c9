"""The four daily jobs, for ``spark-submit`` or from Python.

    python -m roadlens.jobs ingest --base hdfs:///incidents part1.csv part2.csv
    python -m roadlens.jobs silver --base hdfs:///incidents --dedupe --since 2025-01-31
    python -m roadlens.jobs marts --prefix gold_ --unique-ids
    python -m roadlens.jobs marts --prefix gold_ --unique-ids --days 2025-01-30 2025-01-31
    python -m roadlens.jobs train --model hdfs:///models/severity --unique-ids
"""

from __future__ import annotations

import argparse
import os
import re
from collections.abc import Sequence
from datetime import date
from functools import partial
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .operators.quality import require_unique
from .operators.rows import latest_per_key
from .plans import day_states, features, marts, model
from .schema import bronze_schema, to_silver
from .session import build_session
from .sources import served, silver, snapshots
from .sources.delimited import BAD_FIELDS, BAD_ROW, read_raw_csv
from .sources.storage import materialize


MISFITS = "misfits"


class Ingested(NamedTuple):
    """The day's folder of a part, its rows, those with a field that fits no type, and those of
    another number of fields."""

    path: str
    rows: int
    misfit_rows: int
    bad_rows: int


def ingest(
    spark: SparkSession, parts: Sequence[str], base: str, layout: str = "delta", multi_line: bool = False
) -> list[Ingested]:
    """File each delimited part under its latest day, as a feed named after its path.

    ``delta`` writes each part once. ``cumulative`` repeats all history in each day's folder.
    Records with a misfit are filed with NULL there and also written to ``base``-misfits, by feed,
    with the names of the fields and the line. Counts are observed while writing.
    """
    append = {"delta": snapshots.append_delta, "cumulative": snapshots.append_snapshot}[layout]
    out = []
    # a session that has observed cannot ship a model it has just trained, so this one is apart
    own = spark.newSession()
    for part in parts:
        records = read_raw_csv(own, part, multi_line=multi_line)
        misfit, bad = F.size(BAD_FIELDS) > 0, F.col(BAD_ROW).isNotNull()
        seen = Observation()
        observed = records.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(misfit).alias("misfit_rows"),
            F.count_if(bad).alias("bad_rows"),
        )
        path = append(observed.drop(BAD_FIELDS, BAD_ROW), base, feed=part)
        counts = seen.get
        if counts["misfit_rows"] or counts["bad_rows"]:
            name = re.sub(r"[^0-9A-Za-z._-]", "_", part)
            records.where(misfit | bad).write.mode("overwrite").parquet(f"{base.rstrip('/')}-{MISFITS}/{name}")
        out.append(Ingested(path, counts["rows"], counts["misfit_rows"], counts["bad_rows"]))
    return out


def read_bronze(
    spark: SparkSession, base: str, day: date | None = None, layout: str = "delta"
) -> DataFrame:
    if layout == "cumulative":
        return snapshots.read_snapshot(spark, base, day)
    return snapshots.read_as_of(spark, base, day, schema=bronze_schema())


def build_silver(
    spark: SparkSession,
    bronze: DataFrame,
    dedupe: bool = False,
    mode: str = "overwrite",
    folder: str | None = None,
    prefix: str = "",
    wide: bool = False,
) -> None:
    """Write ``accidents`` and ``weather`` by day, and ``rejects`` for records without one.

    ``overwrite_days`` keeps the rejects of earlier runs as well, each different one once.
    ``wide`` also writes the unsplit ``records`` by day.
    """
    for name, df in silver.silver_tables(bronze, dedupe, wide).items():
        table = prefix + name
        path = f"{folder}/{table}" if folder else None
        if name == "rejects":
            if mode == "overwrite_days" and spark.catalog.tableExists(table):
                df = materialize(df.unionByName(spark.table(table)).distinct(), name)
            served.write_mart(df, table, path)
        else:
            silver.write_silver(df, table, path, mode)


def refresh_silver(
    spark: SparkSession,
    base: str,
    since: date,
    dedupe: bool = False,
    folder: str | None = None,
    prefix: str = "",
    wide: bool = False,
) -> list[date]:
    """Bring silver up to date with the feeds filed (delta layout) under ``since`` or later.

    Gives the days formed anew: those in these feeds and, with ``dedupe``, those where silver
    holds an older version of a record in them. Each is formed in full from the feeds that can
    hold its records (a feed lies under its latest day, so those from the first of these days on),
    and a day left without a record is emptied. Silver then equals one built from all feeds, and
    running again changes nothing. Without silver tables all feeds are read.

    Rejects of earlier feeds stay, each different one once; with ``dedupe`` one for each id, and
    none for an id that has a day by now. A feed filed again with fewer records asks for a full build.
    """
    by_day = ["accidents", "weather"] + ["records"] * wide
    tables = {name: prefix + name for name in [*by_day, "rejects"]}
    if not all(spark.catalog.tableExists(table) for table in tables.values()):
        build_silver(spark, read_bronze(spark, base), dedupe, folder=folder, prefix=prefix, wide=wide)
        return []
    new = to_silver(snapshots.read_as_of(spark, base, schema=bronze_schema(), since=since))
    touched = new.select("situation_date")
    if dedupe:
        ids = new.select("id").where("id is not null").distinct()
        for name in by_day:
            held = spark.table(tables[name]).select("id", "situation_date")
            touched = touched.unionAll(held.join(ids, "id", "left_semi").select("situation_date"))
    # one value for each day of the calendar
    days = sorted(row[0] for row in touched.where("situation_date is not null").distinct().collect())
    bronze = snapshots.read_as_of(spark, base, schema=bronze_schema(), since=min([since, *days]))
    formed = silver.silver_tables(bronze, dedupe, wide)
    for name in by_day:
        silver.replace_days(formed[name].where(F.col("situation_date").isin(days)), tables[name], days)
    rejects = formed["rejects"].unionByName(spark.table(tables["rejects"])).distinct()
    if dedupe:
        found = spark.table(tables["accidents"]).select("id")
        rejects = latest_per_key(rejects, ["id"], ["situation_date"]).join(found, "id", "left_anti")
        rejects = rejects.select(formed["rejects"].columns)
    path = f"{folder}/{tables['rejects']}" if folder else None
    served.write_mart(materialize(rejects, "rejects"), tables["rejects"], path)
    return days


def _silver(spark: SparkSession, unique_ids: bool, wide: bool) -> tuple[list[DataFrame], DataFrame | None]:
    """Both halves, and the unsplit records where they are asked for; ids checked as stated."""
    if wide and not unique_ids:
        raise ValueError("records stand for the join only where ids are unique")
    halves = [silver.read_silver(spark, name) for name in ("accidents", "weather")]
    records = silver.read_silver(spark, "records") if wide else None
    for df in [*halves, *([records] if wide else [])] if unique_ids else []:
        require_unique(df, "id")
    return halves, records


def build_marts(
    spark: SparkSession,
    prefix: str = "gold_",
    url: str | None = None,
    properties: dict | None = None,
    folder: str | None = None,
    unique_ids: bool = False,
    wide: bool = False,
) -> None:
    """Write the seven marts and copies of both silver tables, as tables or to a database.
    ``unique_ids`` states that silver was written de-duplicated, which is checked; with ``wide``
    the marts of both halves then read ``records`` instead of joining them."""
    halves, records = _silver(spark, unique_ids, wide)
    if url:
        sink = partial(served.write_mart_jdbc, url=url, properties=properties or {})
        marts.write_marts(*halves, sink, unique_ids=unique_ids, records=records)
        return

    def table(df: DataFrame, name: str) -> None:
        served.write_mart(df, name, f"{folder}/{name}" if folder else None)

    marts.write_marts(*halves, table, prefix, unique_ids, records)


STATES = "day_states"


def refresh_marts(
    spark: SparkSession,
    days: Sequence[date] | None = None,
    prefix: str = "gold_",
    folder: str | None = None,
    silver_prefix: str = "",
    wide: bool = False,
) -> list[str]:
    """Bring marts and copies up to date with the ``days`` of silver formed anew, as :func:`refresh_silver` gives them.

    Reads those days of silver and the table of day states, whose size follows days and groups, not records. Without
    ``days``, or where no states are kept yet, all days are formed: do so after a full build of silver. Silver must be
    de-duplicated; that ids are unique is checked among the rows read. Running again changes nothing. Gives the
    names of the tables written.
    """
    def name_of(table: str) -> str:
        return prefix + table

    def path_of(table: str) -> str | None:
        return f"{folder}/{name_of(table)}" if folder else None

    kept = [STATES, "accidents", "weather"]
    if not all(spark.catalog.tableExists(name_of(table)) for table in kept):
        days = None
    names = ["accidents", "weather", *(["records"] if wide else [])]
    read = {name: silver.read_silver(spark, silver_prefix + name, days=days) for name in names}
    for df in read.values():
        require_unique(df, "id")
    formed = {STATES: day_states.day_states(read["accidents"], read["weather"], read.get("records"))}
    formed |= {name: read[name] for name in kept[1:]}
    for table, df in formed.items():
        if days is None:
            silver.write_silver(df, name_of(table), path_of(table))
        elif days:
            # days that are left without a row are told from the written rows
            rows = materialize(df, table) if table == STATES else df
            silver.replace_days(rows, name_of(table), days)
    out = day_states.marts_of(spark.table(name_of(STATES)))
    for table, df in out.items():
        served.write_mart(df, name_of(table), path_of(table))
    return [name_of(table) for table in (*out, *kept[1:])]


def train(
    spark: SparkSession, path: str, unique_ids: bool = False, wide: bool = False, **settings
) -> tuple[PipelineModel, dict[str, DataFrame]]:
    """Fit on four fifths of the ids, save, and measure on the rest.

    Gives the saved model as loaded again and the reports ``confusion``, ``metrics``,
    ``importance`` and ``top``. ``unique_ids`` states that silver was written de-duplicated,
    which is checked; with ``wide`` the features come from ``records``, without a join.
    """
    halves, records = _silver(spark, unique_ids, wide)
    if records is None:
        inputs = features.feature_table(*halves, impute=False, unique_ids=unique_ids)
    else:
        inputs = features.feature_rows(records.where("id is not null"), impute=False)
    rows = model.feature_store(inputs)
    train_rows, test_rows = features.split_train_test(rows)
    model.save_model(model.train_classifier(train_rows, **settings), path)
    fitted = model.load_model(path)
    scored = model.score(fitted, test_rows)
    confusion = model.confusion_matrix(scored)
    return fitted, {
        "confusion": confusion,
        "metrics": model.evaluate(confusion),
        "importance": model.feature_importance(fitted, scored),
        "top": model.top_predictions(scored),
    }


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="roadlens.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("ingest", "silver"):
        job = jobs.add_parser(name)
        job.add_argument("--base", required=True)
        job.add_argument("--layout", choices=["delta", "cumulative"], default="delta")
        if name == "ingest":
            job.add_argument("parts", nargs="+")
            job.add_argument("--multi-line", action="store_true")
        else:
            job.add_argument("--day", type=date.fromisoformat)
            job.add_argument("--dedupe", action="store_true")
            job.add_argument("--wide", action="store_true", help="write the unsplit records as well")
            job.add_argument("--mode", choices=["overwrite", "overwrite_days"], default="overwrite")
            job.add_argument("--since", type=date.fromisoformat, help="read feeds from this day on, form the days they touch anew")
    job = jobs.add_parser("marts")
    job.add_argument("--prefix", default="gold_")
    job.add_argument("--url", help="JDBC address; user and password from DB_USER and DB_PASSWORD")
    job.add_argument("--unique-ids", action="store_true")
    job.add_argument(
        "--days", type=date.fromisoformat, nargs="*", help="keep marts by change: days of silver formed anew, none for all"
    )
    job = jobs.add_parser("train")
    job.add_argument("--model", required=True)
    job.add_argument("--unique-ids", action="store_true")
    for name in ("marts", "train"):
        jobs.choices[name].add_argument("--wide", action="store_true", help="read records, with --unique-ids")
    args = parser.parse_args(argv)
    if args.job == "silver" and args.since and (args.day or args.layout != "delta" or args.mode != "overwrite"):
        parser.error("--since goes with the delta layout, without --day and --mode")
    if args.job == "marts" and args.days is not None and (args.url or not args.unique_ids):
        parser.error("--days goes with --unique-ids, without --url")
    if args.job in ("marts", "train") and args.wide and not args.unique_ids:
        parser.error("--wide goes with --unique-ids")

    spark = build_session(f"roadlens-{args.job}", spark__sql__catalogImplementation="hive")
    if args.job == "ingest":
        for done in ingest(spark, args.parts, args.base, args.layout, args.multi_line):
            print(*done)
    elif args.job == "silver" and args.since:
        print(*refresh_silver(spark, args.base, args.since, args.dedupe, wide=args.wide))
    elif args.job == "silver":
        build_silver(spark, read_bronze(spark, args.base, args.day, args.layout), args.dedupe, args.mode, wide=args.wide)
    elif args.job == "marts" and args.days is not None:
        print(*refresh_marts(spark, args.days or None, args.prefix, wide=args.wide))
    elif args.job == "marts":
        login = {"user": os.environ.get("DB_USER"), "password": os.environ.get("DB_PASSWORD")}
        known = {k: v for k, v in login.items() if v}
        build_marts(spark, args.prefix, args.url, known, unique_ids=args.unique_ids, wide=args.wide)
    else:
        for name, df in train(spark, args.model, args.unique_ids, args.wide)[1].items():
            print(name)
            df.show(truncate=False)


if __name__ == "__main__":
    main()
