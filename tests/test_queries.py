"""Every registered query against its SQL twin on the small tables."""

import os

import pytest

from tamarind.duckdb_twins import ORACLE_SQL
from tamarind.plans.registry import QUERIES
from tests.compare import connect, difference

FOLDER = os.environ.get("TAMARIND_TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are missing")
# No SQL says what these give: they train iteratively.
TRAINED = {"ml_cv_logistic", "ml_cv_linear_svm", "ml_cv_tree", "ml_leaderboard"}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_but_the_trained_ones_has_a_twin():
    assert set(QUERIES) - set(ORACLE_SQL) == TRAINED
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_twin(spark, duck, name):
    assert difference(QUERIES[name](spark, FOLDER), duck, ORACLE_SQL[name]) is None


def test_a_wrong_twin_is_noticed(spark, duck):
    df = QUERIES["eda_outcome_counts"](spark, FOLDER)
    wrong_rows = ORACLE_SQL["eda_outcome_counts"].replace("count(*)", "count(*) + 1")
    wrong_type = ORACLE_SQL["eda_outcome_counts"].replace("count(*)", "cast(count(*) as double)")
    assert "rows differ" in difference(df, duck, wrong_rows)
    assert "types" in difference(df, duck, wrong_type)


@pytest.mark.parametrize("name", sorted(TRAINED))
def test_trained(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    assert rows
    score = "score" if name == "ml_leaderboard" else "cv_accuracy"
    values = [r[score] for r in rows]
    assert values == sorted(values, reverse=True) and all(0 <= v <= 1 for v in values)


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.columns == ["rfm_score", "total_customers"] and df.count() > 0
