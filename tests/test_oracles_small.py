"""Keys added for hot bills and incremental staging, next to their DuckDB oracles at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans.standins import TABLES
from tools.check_oracles import canon

SF = "/root/testdata/sf0.001"
KEYS = ["hot_bill_payments_log", "hot_bill_bills", "incremental_ingest_by_batch"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    cur = duck.execute(E.oracle_sql()[key])
    expected = canon([d[0] for d in cur.description], cur.fetchall())
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == expected
