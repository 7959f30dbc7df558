"""Every registered query against its SQL in DuckDB; queries without SQL must give rows with a stable schema."""

from __future__ import annotations

import datetime

import duckdb
import pytest

from logmill.plans import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return value.replace(tzinfo=None) if isinstance(value, datetime.datetime) else value


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLE_SQL:
        assert got
        return
    quoted = ", ".join(f'"{c}"' for c in columns)
    assert sorted(duck.sql(ORACLE_SQL[name]).columns) == columns
    assert got == sorted((tuple(map(plain, r)) for r in duck.sql(f"select {quoted} from ({ORACLE_SQL[name]})").fetchall()), key=repr)


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
