"""Queries of the package against their SQL twins on the small tables."""

import os

import pytest

from tamarind.llm.oracle import ORACLE_SQL
from tamarind.llm.registry import QUERIES
from tests.compare import connect, difference

FOLDER = os.environ.get("TAMARIND_TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are missing")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_twin(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE_SQL[name]) is None


def test_names():
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
