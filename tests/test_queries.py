"""Every query against its DuckDB statement."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import differences, oracle

STATEMENTS = {n: s for n, s in entry.oracle_sql().items() if n not in entry.LLM_QUERIES}
QUERIES = {n: q for n, q in entry.queries().items() if n not in entry.LLM_QUERIES}


@pytest.fixture(scope="module")
def db(sf_dir):
    return oracle(sf_dir)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, sf_dir, db, name):
    assert differences(QUERIES[name](spark, sf_dir), db, STATEMENTS[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
