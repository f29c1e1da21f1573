"""Registered queries against their DuckDB oracle on the smallest data set.

Every registered query with oracle SQL is compared (row count, column names,
order-free hash of normalised values). ``scripts/check_oracle.py`` runs the
same comparison on any data directory.
"""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, digest
from shelfwise.plans import catalog

NAMES = sorted(catalog.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    from tests.conftest import SF_SMALL

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql()) and set(catalog.queries()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    from tests.conftest import SF_SMALL

    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    order = sorted(cols)
    sr = [tuple(r[cols.index(c)] for c in order) for r in srows]
    dr = [tuple(r[dcols.index(c)] for c in order) for r in drows]
    assert len(sr) == len(dr)
    assert digest(sr) == digest(dr)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["shop_id", "month", "qty", "n_lines"]


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_or_nested_loop_joins(spark, name):
    """No registered query pairs rows without an equi-key (no all-pairs work at any scale)."""
    from tests.conftest import SF_SMALL
    from tests.test_streaming_plans import _plan

    txt = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt, name
