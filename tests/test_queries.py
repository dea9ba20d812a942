"""Every registered query gives the same rows as its SQL text on a second engine."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

from runwaylens.plans.catalogue import QUERIES, SQL

DATA = Path("/root/testdata/sf0.01")
# Engine type names that mean the same.
SAME_TYPE = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "array<int>": "INTEGER[]",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return 0.0 if v == 0 else ("nan" if math.isnan(v) else v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def bag(rows):
    return sorted((tuple(plain(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    expected = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: SAME_TYPE[t] for c, t in df.dtypes} == types
    got, want = bag(df.collect()), bag(expected.select(*[f'"{c}"' for c in df.columns]).fetchall())
    assert len(got) == len(want)
    assert [p for p in zip(got, want) if p[0] != p[1]][:3] == []
    assert got, "an empty result checks nothing"


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
