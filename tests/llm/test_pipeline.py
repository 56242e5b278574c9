"""Queries against their SQL, and the stages of the pipeline on odd rows."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from roadlens.llm import queries
from tests.llm import brute
from tests.oracle_check import differences

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def connection():
    out = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "embeddings"):
        out.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{Path(FOLDER) / name}.parquet')")
    return out


def test_all_are_registered():
    assert set(queries.queries()) | {"pipeline"} <= set(contract.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "decontamination", "packing",
    ]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, connection, name):
    assert differences(contract.queries()[name](spark, FOLDER), connection, contract.oracle_sql()[name]) is None


def test_stages_hand_on_documents(spark):
    """Each stage gives rows of the one before; what goes is what its operator names."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_rules"](spark, docs, FOLDER)
    assert good.columns == COLUMNS
    kept = queries.op2_quality_rules(spark, FOLDER).where("kept")
    assert ids(good) == ids(kept)
    near = stages["near_dedup"](spark, docs, FOLDER)
    assert near.columns == COLUMNS
    assert ids(near) == ids(queries.op3_near_duplicates(spark, FOLDER).where("kept"))
    clean = stages["decontamination"](spark, docs, FOLDER)
    assert clean.columns == COLUMNS
    assert ids(clean) == ids(queries.op1_decontamination(spark, FOLDER).where("not contaminated"))
    lines = stages["line_dedup"](spark, docs, FOLDER)
    assert lines.columns == COLUMNS
    first = queries.op8_line_components(spark, FOLDER).where("kept").groupBy("doc_id").count()
    left = {r["doc_id"]: len([x for x in r["text"].split("\n") if brute.SPACED.search(x)]) for r in lines.collect()}
    assert {k: n for k, n in left.items() if n} == {r["doc_id"]: r["count"] for r in first.collect()}


def test_whole_pipeline(spark):
    pieces = corpus_pipeline.run(spark, FOLDER).toPandas()
    assert (pieces.groupby("doc_id")["length"].sum() == pieces.groupby("doc_id")["doc_tokens"].first()).all()
    assert pieces.groupby("sequence_id")["length"].sum().max() <= 4096


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_stages_on_odd_rows(spark, rows):
    from tests.llm.test_operators import ODD

    table = [(i, t, None, "s", None) for i, t in ODD] if rows == "odd" else []
    docs = spark.createDataFrame(table, SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert name == "packing" or out.columns == COLUMNS
        assert out.count() <= max(len(table), 200)
