"""Queries that SQL can express, against DuckDB."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_oracle import TABLES, rows_of  # noqa: E402
from cumulus.llm import queries  # noqa: E402

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    df = queries.QUERIES[name](spark, DIR)
    cur = con.execute(queries.ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
