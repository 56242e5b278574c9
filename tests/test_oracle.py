"""Every registered query against its SQL on the whole sf0.01 tables."""

import pytest

import __spark_entry__ as contract
from tests.oracle_check import connect, differences

FOLDER = "/root/testdata/sf0.01"
ROWS_ONLY = {
    "score_batch", "confusion_matrix", "evaluate_model", "top_predictions", "feature_importance", "stream_score",
}


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_its_sql_or_a_reason():
    assert set(contract._REGISTERED) - set(contract.ORACLE_SQL) == ROWS_ONLY
    assert set(contract.ORACLE_SQL) <= set(contract._REGISTERED)
    assert set(contract._REGISTERED) <= set(contract.queries())


# text operators have tests of their own
@pytest.mark.parametrize("name", sorted(contract.ORACLE_SQL))
def test_matches_sql(spark, connection, name):
    df = contract.queries()[name](spark, FOLDER)
    assert differences(df, connection, contract.ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_gives_rows(spark, name):
    assert contract.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
