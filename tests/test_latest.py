from pyspark.sql import functions as F

from lake_helpers import rows
from lakeops.operators.latest import latest_by_key, sorted_limit, top_n_by_key


def _df(spark):
    data = [("a", "20240101", "t1", 1), ("a", "20240102", "t0", 2), ("a", "20240102", "t1", 3),
            ("b", None, "t9", 4), ("b", "20230101", "t0", 5), ("c", "20240101", "t0", 6)]
    return spark.createDataFrame(data, "k string, batch string, ingest string, v int")


def test_latest_window_and_aggregate_agree(spark):
    df = _df(spark)
    w = latest_by_key(df, ["k"], ["batch", "ingest"], "window")
    a = latest_by_key(df, ["k"], ["batch", "ingest"], "aggregate")
    assert rows(w) == rows(a)
    assert rows(w, "k", "v") == [("a", 3), ("b", 5), ("c", 6)]  # null batch ranks lowest


def test_top_n_and_limit(spark):
    df = _df(spark)
    top2 = top_n_by_key(df, ["k"], ["batch", "ingest"], 2, rank_col="rn")
    assert rows(top2.filter("k = 'a'"), "v", "rn") == [(2, 2), (3, 1)]
    assert [r.v for r in sorted_limit(df, ["v"], 2).collect()] == [1, 2]


def test_window_plan_has_group_limit(spark):
    plan = latest_by_key(_df(spark), ["k"], ["batch"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
