"""Every registered query against its SQL twin."""

import datetime

import duckdb
import pytest

import __spark_entry__ as entry
from checks.logs import NAMES
from checks.registry import QUERIES, SQL


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(rows):
    return sorted(repr(tuple(v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v for v in r)) for r in rows)


def test_every_sql_has_a_query():
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert QUERIES.keys() == SQL.keys()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf, db, name):
    df = entry.queries()[name](spark, sf)
    relation = db.sql(entry.oracle_sql()[name])
    names = sorted(df.columns)
    assert names == sorted(relation.columns)
    got = df.select(*[f"`{n}`" for n in names]).collect()
    want = relation.select(*[duckdb.ColumnExpression(n) for n in names]).fetchall()
    assert plain(map(tuple, got)) == plain(want)
