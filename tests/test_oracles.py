"""Every registered query against its SQL, at a small scale."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from queryset.oracles import ORACLES
from queryset.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(normal(r[i]) for i in order) for r in rows], key=repr)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = entry_points.queries()[name](spark, SF_DIR)
    got = [tuple(r) for r in frame.collect()]
    result = duck.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(frame.columns) == sorted(columns)
    assert got, "no rows"
    assert sorted_rows(frame.columns, got) == sorted_rows(columns, expected)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 3
