"""Every registered query against its DuckDB oracle on the smallest test folder.

The driver runs the same comparison at sf0.01 (``tools/oracle_check.py``).
"""

import os

import duckdb
import pytest

from conftest import SF_SMALL
from tools.oracle_check import TABLES, rows_of
from __spark_entry__ import entry
from vigil.plans.catalog import QUERIES
from vigil.plans.oracle import ORACLE

SLOW = {"stream_fraud_card_alerts", "run_available_now", "stream_outbox", "stream_tx_count_sliding"}
KEYS = sorted(k for k in QUERIES if k not in SLOW)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0 and "alert_id" in df.columns


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == rows_of(cols, res.fetchall())
