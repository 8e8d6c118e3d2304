"""Every registered query against its SQL, on the smallest test data."""

import pytest

import __spark_entry__ as entry_point
from tenura.checks.compare import compare, connect
from tenura.checks.registry import all_queries

SF = "/root/testdata/sf0.001"
CHECKED = [name for name, query in all_queries(SF).items() if query.sql is not None]


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


@pytest.mark.parametrize("name", CHECKED)
def test_same_as_sql(spark, connection, name):
    result = compare(spark, SF, name, connection)
    assert result["same"], result


def test_entry_point(spark):
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    names = set(all_queries(SF))
    assert names <= set(entry_point.queries())
    assert names - set(entry_point.oracle_sql()) == {
        "train_predict_scores", "stratified_cv_metrics", "gbt_scores", "evaluate_model"}
    assert entry_point.entry(spark).count() > 0
