"""The registered queries against their DuckDB oracles at sf0.001 (larger
data: ``python checks/oracle_compare.py``)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "checks"))

import __spark_entry__ as E  # noqa: E402
import oracle_compare as OC  # noqa: E402
from lake_helpers import SF_SMALL  # noqa: E402

# the training-data operators' queries have tests of their own
KEYS = sorted(k for k in E.oracle_sql() if not k.startswith("op"))


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in OC.TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    got = OC.rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    want = OC.rows_of(cols, res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert all(OC.close(a, b) for a, b in zip(got, want))
