"""Every registered query against its SQL, over whole tables."""

import re

import pytest

from tidemark.verify.compare import differences, engine
from tidemark.verify.oracles import all_oracles
from tidemark.verify.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def connection():
    pytest.importorskip("duckdb")
    return engine(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, SQL[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_names_are_plain():
    assert all(re.fullmatch(r"[a-z][a-z0-9_]*", name) for name in QUERIES)
