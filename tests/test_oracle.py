"""Every registered query against its SQL in DuckDB, on the test tables."""

from __future__ import annotations

import os
from datetime import datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    yield con
    con.close()


def _cell(x):
    if isinstance(x, datetime):
        return x.isoformat()
    if isinstance(x, (int, float, Decimal)):
        return float(x)
    return x


def _table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    named = [columns[i] for i in order]
    return named, sorted((tuple(_cell(r[i]) for i in order) for r in data), key=repr)


def test_each_query_has_sql():
    own = set(contract.queries()) - set(contract.LLM_QUERIES)
    assert own == set(contract.oracle_sql()) - set(contract.LLM_SQL)


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) - set(contract.LLM_SQL)))
def test_matches_duckdb(spark, tables, name):
    df = contract.queries()[name](spark, SF_DIR)
    found = tables.execute(contract.oracle_sql()[name])
    want = _table([d[0] for d in found.description], found.fetchall())
    assert want[1], "the SQL result should not be empty"
    assert _table(df.columns, df.collect()) == want


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "escola_id" and df.count() == 150


def test_plain_statements_give_the_same_rows(spark):
    """What the library is timed against answers the same questions."""
    from boletim.plans.queries import NAMED_QUERIES
    from derived_views import warehouse
    from plain_sql import STATEMENTS, plain

    w = warehouse(spark, SF_DIR)
    assert set(STATEMENTS) == set(NAMED_QUERIES)
    for name, question in NAMED_QUERIES.items():
        one, other = question(w), plain(name)(w)
        assert one.columns == other.columns, name
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect())), name
