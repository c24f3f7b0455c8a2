"""Every query with an oracle agrees with DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from strandline.plans import worklist

SF = "/root/testdata/sf0.001"
SQL = worklist.oracle_sql()


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: f"{v:.4f}" if isinstance(v, float) else str(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = con.sql(SQL[name])
    got = worklist.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())
