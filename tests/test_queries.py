"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
import oracle_check

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
OWN = sorted(name for name, query in QUERIES.items() if query.__module__.startswith("supportlens.plans"))


@pytest.fixture(scope="module")
def db():
    return oracle_check.connect(FOLDER)


@pytest.mark.parametrize("name", OWN)
def test_matches_sql(spark, db, name):
    assert not oracle_check.kinds_differ(QUERIES[name](spark, FOLDER), db, ORACLE[name])
    same, told = oracle_check.compare(spark, db, QUERIES[name], ORACLE[name], FOLDER)
    assert same, told


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
