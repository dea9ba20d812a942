"""Queries of the text operators that SQL can state give the same rows on a second engine."""

from pathlib import Path

import duckdb
import pytest
from text_cases import SF01

from runwaylens.llm.catalogue import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for f in Path(SF01).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    df = QUERIES[name](spark, SF01)
    want = con.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    assert got == sorted(want.select(*[f'"{c}"' for c in df.columns]).fetchall(), key=repr)
    assert got


def test_one_query_for_each_operator():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted([f"op{i}" for i in range(1, 14)] + ["pipeline"])
