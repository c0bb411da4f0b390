"""The queries of this subpackage that SQL can express, against it."""

import pytest

import oracle_check
from supportlens.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return oracle_check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, db, name):
    query, sql = queries.QUERIES[name], queries.ORACLE[name]
    same, told = oracle_check.compare(spark, db, query, sql, FOLDER)
    assert same, told
