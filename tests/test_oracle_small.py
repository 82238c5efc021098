"""A slice of the correctness gate inside pytest: Spark vs the DuckDB oracle at sf0.001."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest

import __spark_entry__ as E
from oracle_check import TABLES, digest

SMALL = "/root/testdata/sf0.001"
CORE = ["catalog_dedup", "url_key_catalog", "health_history", "retry_resolution", "candidates", "probe_urls"]


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SMALL}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", CORE)
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    srows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]
