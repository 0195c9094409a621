import datetime as dt

import pytest

from lake_helpers import rows
from pyspark.sql import functions as F

from lakeops.operators.upsert import (full_refresh, incremental_build, lookback_filter, merge_partitions, merge_upsert,
                                      read_partitions, write_partitions)

D = dt.date
S = "k int, d date, v double"


def test_empty_target_loads_everything(spark):
    src = spark.createDataFrame([(1, D(2020, 1, 1), 1.0)], S)
    empty = spark.createDataFrame([], S)
    assert lookback_filter(src, empty, "d", 7).count() == 1
    assert lookback_filter(src, None, "d", 7).count() == 1


def test_lookback_window_and_future_anchor(spark):
    tgt = spark.createDataFrame([(1, D(2020, 1, 10), 1.0), (2, D(2020, 3, 1), 1.0)], S)
    src = spark.createDataFrame([(1, D(2020, 1, 10), 9.0), (2, D(2020, 2, 25), 9.0), (3, D(2020, 3, 2), 9.0)], S)
    out = incremental_build(src, tgt, ["k"], "d", 7)
    # key 1 is older than max - 7 days: its change stays out
    assert rows(out, "k", "v") == [(1, 1.0), (2, 9.0), (3, 9.0)]
    # an explicit anchor replaces the target maximum
    assert lookback_filter(src, tgt, "d", 7, anchor="2020-01-12").count() == 3


def test_null_keys_insert_again_and_duplicates_raise(spark):
    tgt = spark.createDataFrame([(None, D(2020, 1, 1), 1.0)], S)
    src = spark.createDataFrame([(None, D(2020, 1, 1), 2.0)], S)
    assert merge_upsert(tgt, src, ["k"]).count() == 2
    dup = spark.createDataFrame([(1, D(2020, 1, 1), 1.0), (1, D(2020, 1, 2), 2.0)], S)
    with pytest.raises(Exception):
        merge_upsert(tgt, dup, ["k"]).collect()


def test_two_null_keys_are_no_duplicates(spark):
    src = spark.createDataFrame([(None, D(2020, 1, 1), 2.0), (None, D(2020, 1, 1), 3.0), (1, D(2020, 1, 1), 1.0)], S)
    assert merge_upsert(spark.createDataFrame([], S), src, ["k"]).count() == 3


def test_full_refresh_gated_by_expectations(spark, tmp_path):
    from lakeops.operators.expectations import ExpectationFailed, expect_or_fail
    path = str(tmp_path / "g")
    good = spark.createDataFrame([(1, D(2020, 1, 1), 1.0)], S)
    assert full_refresh(good, path, expectations=[expect_or_fail("pos", "v > 0")]) == {"rows": 1, "pos": 0}
    bad = spark.createDataFrame([(2, D(2020, 1, 1), -1.0)], S)
    with pytest.raises(ExpectationFailed):
        full_refresh(bad, path, expectations=[expect_or_fail("pos", "v > 0")])
    assert rows(spark.read.parquet(path), "k", "v") == [(1, 1.0)]
    # a refresh may read the table it replaces
    full_refresh(spark.read.parquet(path).withColumn("v", F.col("v") + 1), path)
    assert rows(spark.read.parquet(path), "k", "v") == [(1, 2.0)]


def test_partitioned_merge_rewrites_touched_partitions_only(spark, tmp_path):
    path, month = str(tmp_path / "p"), F.trunc("d", "MM")
    base = spark.createDataFrame([(1, D(2020, 1, 5), 1.0), (2, D(2020, 2, 5), 1.0), (3, D(2020, 3, 5), 1.0)], S)
    write_partitions(base, path, month)
    kept = sorted(x.name for x in (tmp_path / "p" / "_part=v2020-02-01").iterdir())
    # key 1 moves from January to March; key 4 is new in April
    src = spark.createDataFrame([(1, D(2020, 3, 9), 2.0), (4, D(2020, 4, 1), 2.0)], S)
    assert merge_partitions(path, src, ["k"], month) == ["v2020-01-01", "v2020-03-01", "v2020-04-01"]
    assert sorted(x.name for x in (tmp_path / "p" / "_part=v2020-02-01").iterdir()) == kept
    assert rows(read_partitions(spark, path, base.schema), "k", "d", "v") == [
        (1, D(2020, 3, 9), 2.0), (2, D(2020, 2, 5), 1.0), (3, D(2020, 3, 5), 1.0), (4, D(2020, 4, 1), 2.0)]


@pytest.mark.parametrize("kind,values", [
    ("string", [None, None, "p", "", "a/b=c"]), ("boolean", [True, False, None, True, False]), ("double", [1.5, None, 0.1, -2.0, 1e300]),
    ("timestamp", [dt.datetime(2020, 1, 1, 1, 2, 3, 456789), None, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1, 1, 2, 3), dt.datetime(1969, 7, 1)])])
def test_partition_values_of_any_type_lose_no_rows(spark, tmp_path, kind, values):
    schema = f"k int, p {kind}"
    base = spark.createDataFrame(list(enumerate(values)), schema)
    path, p = str(tmp_path / "t"), F.col("p")
    write_partitions(base, path, p)
    merge_partitions(path, spark.createDataFrame([(9, None), (2, values[0])], schema), ["k"], p)
    want = {**dict(enumerate(values)), 9: None, 2: values[0]}
    got = read_partitions(spark, path, base.schema).collect()
    assert len(got) == 6 and {r.k: r.p for r in got} == want
    # null keys stay and insert, in whatever partition
    merge_partitions(path, spark.createDataFrame([(None, values[0]), (None, None)], schema), ["k"], p)
    assert read_partitions(spark, path, base.schema).count() == 8


def test_lookback_bound_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "src")
    spark.createDataFrame([(1, D(2020, 1, 10), 1.0)], S).write.parquet(path)
    tgt = spark.createDataFrame([(9, D(2020, 1, 12), 1.0)], S)
    plan = lookback_filter(spark.read.parquet(path), tgt, "d", 7)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,ScalarSubquery" in plan


def test_lookback_drops_null_dates_but_empty_target_loads_all(spark):
    src = spark.createDataFrame([(1, None, 1.0), (2, D(2020, 1, 10), 1.0)], S)
    tgt = spark.createDataFrame([(9, D(2020, 1, 12), 1.0)], S)
    assert rows(lookback_filter(src, tgt, "d", 7), "k") == [(2,)]
    assert lookback_filter(src, spark.createDataFrame([], S), "d", 7).count() == 2


def test_key_filters_name_the_partitions_that_may_hold_a_key(spark, tmp_path, monkeypatch):
    """A merge reads the partitions whose filter may hold one of its keys, never the whole table."""
    from lakeops.operators import upsert
    from lakeops.operators.keyfilter import candidates, filter_path
    path, month = str(tmp_path / "t"), F.trunc("d", "MM")
    base = spark.range(24_000).selectExpr("cast(id as int) as k", "date_add(date'2020-01-01', cast(id % 720 as int)) as d", "1d as v")
    write_partitions(base, path, month, ["k"])
    part = lambda k: rows(base.where(f"k = {k}").select(F.concat(F.lit("v"), F.trunc("d", "MM").cast("string"))))[0][0]
    asked = spark.createDataFrame([(k, D(2022, 5, 1), 2.0) for k in (3, 9000)] + [(None, D(2022, 5, 1), 2.0)], S)
    maybe = candidates(spark, path, asked, ["k"])
    assert {part(3), part(9000)} <= set(maybe) and len(maybe) <= 4
    read = []
    plain = upsert.read_partitions
    monkeypatch.setattr(upsert, "read_partitions", lambda s, p, schema, names=None: read.append(names) or plain(s, p, schema, names))
    touched = merge_partitions(path, asked, ["k"], month)
    assert set(touched) == {part(3), part(9000), "v2022-05-01"}
    assert all(names is not None and len(names) <= 5 for names in read)
    monkeypatch.undo()
    got = read_partitions(spark, path, base.schema)
    assert got.count() == 24_001 and rows(got.where("k in (3, 9000)"), "k", "v") == [(3, 2.0), (9000, 2.0)]
    # what moved is found where it is now
    assert set(merge_partitions(path, spark.createDataFrame([(3, D(2020, 1, 9), 5.0)], S), ["k"], month)) == {"v2022-05-01", "v2020-01-01"}
    assert spark.read.parquet(filter_path(path)).agg(F.max(F.octet_length("bits"))).first()[0] == 4096


def test_a_table_without_filters_gets_them(spark, tmp_path):
    path, month = str(tmp_path / "t"), F.trunc("d", "MM")
    base = spark.createDataFrame([(1, D(2020, 1, 5), 1.0), (2, D(2020, 2, 5), 1.0)], S)
    write_partitions(base, path, month)
    assert merge_partitions(path, spark.createDataFrame([(1, D(2020, 3, 1), 2.0)], S), ["k"], month) == ["v2020-01-01", "v2020-03-01"]
    assert merge_partitions(path, spark.createDataFrame([(2, D(2020, 3, 1), 2.0)], S), ["k"], month) == ["v2020-02-01", "v2020-03-01"]
    assert rows(read_partitions(spark, path, base.schema), "k", "v") == [(1, 2.0), (2, 2.0)]


def test_filters_of_a_merge_that_broke_off_lack_no_key(spark, tmp_path, monkeypatch):
    """The filters are written before the rows and cover what is still there."""
    from pyspark.sql import DataFrameWriter
    path, month = str(tmp_path / "t"), F.trunc("d", "MM")
    base = spark.createDataFrame([(k, D(2020, 1, 5), 1.0) for k in range(40)], S)
    write_partitions(base, path, month, ["k"])
    plain = DataFrameWriter.parquet

    def broken(self, at, *a, **k):
        if at == path:
            raise OSError("broke off")
        return plain(self, at, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", broken)
    with pytest.raises(OSError):
        merge_partitions(path, spark.createDataFrame([(7, D(2020, 2, 1), 2.0)], S), ["k"], month)
    monkeypatch.undo()
    assert merge_partitions(path, spark.createDataFrame([(7, D(2020, 2, 1), 2.0)], S), ["k"], month) == ["v2020-01-01", "v2020-02-01"]
    assert read_partitions(spark, path, base.schema).count() == 40


def test_latest_state_equals_a_full_build(spark, tmp_path):
    """Deliveries in any order, late and repeated ones included; sums follow the changes."""
    import random

    from lakeops.operators.latest import latest_by_key
    from lakeops.operators.state import LatestState, merge_sums, sum_changes
    rnd = random.Random(4)
    schema = "k int, part int, seq int, day date, n double"
    data = [(rnd.choice([*range(12), None]), 0, s, D(2020, 1 + rnd.randint(0, 5), 1), float(rnd.randint(1, 9))) for s in range(120)]
    data = [(k, None if k is None else k % 3, *rest) for k, _, *rest in data]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, schema)
    state = LatestState(spark, str(tmp_path / "s"), df.schema, ["k", "part"], ["seq"], F.col("part"))
    for i in range(0, 120, 30):
        wave = spark.createDataFrame(data[i : i + 30] + data[:3], schema)
        added = sum_changes(state.apply(wave), {"day": F.col("day")}, {"n": F.col("n")})
        sums_schema = added.schema
        merge_sums(str(tmp_path / "sums"), added, ["day"], F.trunc("day", "YEAR"))
        so_far = latest_by_key(spark.createDataFrame(data[: i + 30], schema), ["k", "part"], ["seq"])
        assert rows(state.read(), *df.columns) == rows(so_far, *df.columns)
        sums = read_partitions(spark, str(tmp_path / "sums"), sums_schema).where("rows_added > 0")
        assert rows(sums, "day", "n", "rows_added") == rows(so_far.groupBy("day").agg(F.sum("n").alias("n"), F.count("*").alias("rows_added")), "day", "n", "rows_added")


def test_state_reads_touched_partitions_only(spark, tmp_path, monkeypatch):
    from lakeops.operators import state as module
    from lakeops.operators.state import LatestState
    schema = "k int, seq int"
    first = spark.range(1000).selectExpr("cast(id as int) as k", "1 as seq")
    state = LatestState(spark, str(tmp_path / "s"), first.schema, ["k"], ["seq"], F.floor(F.col("k") / 100))
    state.apply(first)
    read, plain = [], module.read_partitions
    monkeypatch.setattr(module, "read_partitions", lambda s, p, sc, names=None: read.append(names) or plain(s, p, sc, names))
    changed = state.apply(spark.createDataFrame([(5, 2), (512, 0), (513, 7)], schema))
    assert read == [["v0", "v5"]]
    assert rows(changed.select("k", "old.seq", "new.seq")) == [(5, 1, 2), (513, 1, 7)]


def _tables(spark, tmp_path) -> str:
    """Lines with repeated, late and null deliveries, and orders of few customers and many days."""
    at = lambda n: dt.datetime(2000, 1, 1) + dt.timedelta(days=n)
    lines = [(o if o else None, n if n != 4 else None, (o * 7 + n * 3 + r) % 5, r, at((o * 31 + n * 17 + r * 90) % 400) if (o + n + r) % 11 else None, float(o + n + r), 1.0, 0.1, 0.1, "AN"[r % 2], "OF"[n % 2])
             for o in range(40) for n in range(1, 5) for r in range(3)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp_ntz, l_quantity double, l_extendedprice double, l_discount double, "
                                 "l_tax double, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(o, o % 7 if o % 13 else None, at(o * 37 % 400), "HML"[o * 5 % 3], float(o)) for o in range(200)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_lines_of_days_are_the_latest_within_the_bound(spark, tmp_path):
    """Either bound takes the latest lines that lie within it, from one pass over the lines."""
    from lakeops.operators.latest import latest_by_key
    from lakeops.plans import marts, standins as S
    d = _tables(spark, tmp_path)
    latest = latest_by_key(S.table(spark, d, "lineitem").dropna(subset=S.LINE_KEY).withColumn("event_date", F.to_date("l_shipdate")), S.LINE_KEY, S.LINE_ORDER)
    day = F.lit("2000-09-01").cast("date")
    for below, keep in ((True, lambda df, c: df.filter(F.col(c) >= day)), (False, lambda df, c: df.filter(F.col(c) < day)), (True, lambda df, c: df)):
        got = marts.lines_of_days(spark, d, marts.Bound(keep, below))
        want = rows(keep(latest, "event_date"), *latest.columns)
        assert want and sorted(map(repr, rows(got, *latest.columns))) == sorted(map(repr, want))
        assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_the_dimension_needs_no_bounds_and_no_second_dedup(spark, tmp_path, monkeypatch):
    from lakeops.operators import history
    from lakeops.plans import standins as S
    d = _tables(spark, tmp_path)
    want = rows(history.scd2_history(S.snapshots(spark, d), ["o_custkey"], "batch_date", untracked=["o_totalprice"]))

    def never(*args, **kw):
        raise AssertionError("a pass that the snapshots don't need")
    monkeypatch.setattr(history, "sequence_bucket", never)
    monkeypatch.setattr(history, "latest_by_key", never)
    got = rows(S.history(spark, d))
    assert len(want) > 50 and sorted(map(repr, got)) == sorted(map(repr, want))
