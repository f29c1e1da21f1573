"""The registered training-data queries against DuckDB where SQL can express them."""

from __future__ import annotations

import duckdb
import pytest

from scripts.check_oracle import TABLES, digest
from shelfwise.llm import queries

from ..conftest import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = queries.queries()[name](spark, SF_SMALL)
    order = sorted(df.columns)
    cur = duck.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == order
    got = [tuple(r[c] for c in order) for r in df.collect()]
    want = [tuple(r[columns.index(c)] for c in order) for r in cur.fetchall()]
    assert len(got) == len(want) and digest(got) == digest(want)


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
