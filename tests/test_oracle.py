"""Every registered query against its SQL on another engine, over whole tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from voltstream.oracle import ORACLE
from voltstream.queries import registered


@pytest.fixture(scope="module")
def sql(tables):
    connection = duckdb.connect()
    for file in Path(tables).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_its_sql():
    assert set(registered()) == set(ORACLE)
    assert set(registered()) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", registered())
def test_query_equals_its_sql(spark, sql, tables, name):
    frame = registered()[name](spark, tables)
    columns = sorted(frame.columns)
    got = [tuple(row) for row in frame.select(*columns).collect()]
    cursor = sql.execute(ORACLE[name])
    order = sorted(range(len(cursor.description)), key=lambda n: cursor.description[n][0])
    assert [cursor.description[n][0] for n in order] == columns
    expected = [tuple(row[n] for n in order) for row in cursor.fetchall()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert expected or os.environ.get("TEST_SF_DIR")


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.columns == ["window_start", "window_end", "Radiacion", "PA"]
    assert frame.count() > 0


def test_queries_may_be_called_again(spark, tables):
    query = entry_point.queries()["q16_stream_alerts"]
    assert query(spark, tables).count() == query(spark, tables).count() > 0
