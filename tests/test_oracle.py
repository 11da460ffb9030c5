"""Every registered query against its SQL, on the smallest data set."""

import glob
import math
import os
from decimal import Decimal

import duckdb
import pytest

from checks.oracle import oracle_sql
from checks.registry import QUERIES


def test_every_query_has_sql():
    assert set(oracle_sql()) == set(QUERIES)


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    return str(value)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, name):
    with duckdb.connect() as con:
        for path in glob.glob(f"{sf}/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
        cursor = con.execute(oracle_sql()[name])
        names = [d[0] for d in cursor.description]
        expected = cursor.fetchall()
    frame = QUERIES[name](spark, sf)
    columns = sorted(names)
    assert sorted(frame.columns) == columns
    got = sorted(tuple(plain(r[c]) for c in columns) for r in frame.collect())
    places = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in places) for r in expected)
    assert got
