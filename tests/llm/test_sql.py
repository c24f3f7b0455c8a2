"""The operators that SQL can express agree with DuckDB in every row."""

from pathlib import Path

import duckdb
import pytest

from strandline.llm import queries as Q

SF = "/root/testdata/sf0.001"
SQL = Q.oracle_sql()


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = con.sql(SQL[name])
    got = Q.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


ROWS = [(1, None), (2, ""), (3, "a b c"), (4, "A b\tc"), (5, " ".join(f"w{i}" for i in range(70))), (6, "x " + " ".join(f"w{i}" for i in range(70)) + " é")]


@pytest.mark.parametrize("name", ["op1_suffix_array", "op3_near_duplicates", "op4_substrings"])
def test_edge_cases(spark, tmp_path, name):
    spark.createDataFrame(ROWS, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(SQL[name])
    got = Q.queries()[name](spark, str(tmp_path))
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())
