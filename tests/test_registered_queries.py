"""Every registered query against its SQL, on the smallest test tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.differential import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, CHECKS = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_checks_belong_to_queries():
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_sql(spark, db, name):
    assert compare(spark, db, SF_DIR, QUERIES[name], CHECKS[name]) == []


def test_vip_program_has_rows(spark):
    assert QUERIES["vip_program"](spark, SF_DIR).count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_model_query_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_flagship_query_has_a_stable_schema(spark):
    assert dict(entry.entry(spark).dtypes) == {
        "seller_id": "string", "final_score": "double", "segment": "string"}
