import datetime as dt

import pytest

from lake_helpers import rows
from lakeops.operators.reshape import expand_struct, explode_records, map_to_rows, union_all, unpivot
from lakeops.operators.rollups import ohlc_rollup


def test_empty_and_null_arrays_and_maps_give_no_rows(spark):
    df = spark.createDataFrame([(1, [1, 2], {"a": 1}), (2, [], {}), (3, None, None)],
                               "k int, arr array<int>, m map<string,int>")
    assert rows(explode_records(df.drop("m"), "arr"), "k") == [(1,), (1,)]
    assert rows(map_to_rows(df, "m", keep=["k"]), "k", "key", "value") == [(1, "a", 1)]


def test_unpivot_keeps_nulls_and_tags(spark):
    df = spark.createDataFrame([(1, 2, None)], "id int, a int, b double")
    out = unpivot(df, ["id"], ["a", "b"], tag={"statement_type": "s"})
    assert rows(out) == [(1, "s", "a", 2.0), (1, "s", "b", None)]


def test_union_missing_columns_and_struct_clash(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 5)], "k int, b int")
    assert rows(union_all([a, b], allow_missing=True)) == [(1, "x", None), (2, None, 5)]
    s = spark.createDataFrame([(1, (2, 3))], "k int, r struct<k: int, z: int>")
    with pytest.raises(ValueError):
        expand_struct(s, "r", keep=["k"])


def test_min_by_max_by_keep_null_at_extreme(spark):
    t = dt.datetime
    df = spark.createDataFrame([("x", t(2024, 1, 1), None), ("x", t(2024, 1, 2), 5.0), ("x", t(2024, 1, 3), None)],
                               "k string, ts timestamp, v double")
    r = ohlc_rollup(df, ["k"], "ts", "v", "v", "v", "v").first()
    assert r.period_open is None and r.period_close is None
    assert r.period_high == 5.0 and r.row_count == 3
