import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from lake_helpers import rows
from lakeops.operators.pit import pit_join

STRATEGIES = ["range", "bucketed", "window"]
D = dt.date


def _dim(spark, data):
    return spark.createDataFrame(data, "symbol string, scd_effective_from date, scd_effective_to date, company_key string")


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_boundary_day_matches_later_version(spark, strategy):
    dim = _dim(spark, [("x", D(1900, 1, 1), D(2024, 1, 10), "v1"), ("x", D(2024, 1, 10), None, "v2"),
                       ("y", D(2024, 1, 5), D(2024, 1, 5), "zero")])
    facts = spark.createDataFrame([("x", D(2024, 1, 9), 1), ("x", D(2024, 1, 10), 2), ("z", D(2024, 1, 10), 3),
                                   ("y", D(2024, 1, 5), 4)], "sym string, day date, id int")
    out = pit_join(facts, dim, "sym", "day", strategy=strategy)
    assert rows(out, "id", "company_key") == [(1, "v1"), (2, "v2"), (3, None), (4, None)]


def test_strategies_agree_on_random_data(spark):
    rnd = random.Random(3)
    dim_rows, fact_rows = [], []
    for k in range(20):
        starts = sorted(rnd.sample(range(0, 2000), rnd.randint(1, 8)))
        for i, s in enumerate(starts):
            end = starts[i + 1] if i + 1 < len(starts) else (None if rnd.random() < 0.7 else s + 50)
            dim_rows.append((f"k{k}", D(2015, 1, 1) + dt.timedelta(s),
                             None if end is None else D(2015, 1, 1) + dt.timedelta(end), f"k{k}-{i}"))
    for i in range(600):
        fact_rows.append((f"k{rnd.randint(0, 24)}", D(2014, 6, 1) + dt.timedelta(rnd.randint(0, 2600)), i))
    dim = _dim(spark, dim_rows)
    facts = spark.createDataFrame(fact_rows, "sym string, day date, id int")
    results = [rows(pit_join(facts, dim, "sym", "day", strategy=s), "id", "company_key") for s in STRATEGIES]
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 600


def test_clashing_columns_raise(spark):
    dim = _dim(spark, [("x", D(2024, 1, 1), None, "v")])
    facts = spark.createDataFrame([("x", D(2024, 1, 2), "f")], "sym string, day date, company_key string")
    with pytest.raises(ValueError):
        pit_join(facts, dim, "sym", "day")


def test_overlapping_versions_detected(spark):
    from lakeops.operators.pit import OverlappingVersions, overlapping_versions
    dim = _dim(spark, [("x", D(2024, 1, 1), D(2024, 2, 1), "a"), ("x", D(2024, 1, 15), None, "b"),
                       ("y", D(2024, 1, 1), D(2024, 1, 1), "zero"), ("y", D(2024, 1, 1), None, "ok")])
    assert [r.company_key for r in overlapping_versions(dim).collect()] == ["b"]
    facts = spark.createDataFrame([("x", D(2024, 1, 20), 1)], "sym string, day date, id int")
    with pytest.raises(OverlappingVersions):
        pit_join(facts, dim, "sym", "day", check_overlap=True)


def test_range_matches_brute_force(spark):
    rnd = random.Random(5)
    dims, facts = [], []
    for k in range(6):
        starts = sorted(rnd.sample(range(0, 300), 5))
        for i, s in enumerate(starts):
            e = starts[i + 1] if i + 1 < len(starts) else None
            dims.append((f"k{k}", D(2020, 1, 1) + dt.timedelta(s), None if e is None else D(2020, 1, 1) + dt.timedelta(e),
                         f"k{k}-{i}"))
    for i in range(300):
        facts.append((f"k{rnd.randint(0, 7)}", D(2019, 12, 1) + dt.timedelta(rnd.randint(0, 400)), i))
    expected = []
    for sym, day, i in facts:
        hit = [c for s_, f, t, c in dims if s_ == sym and f <= day and (t is None or day < t)]
        assert len(hit) <= 1
        expected.append((i, hit[0] if hit else None))
    got = rows(pit_join(spark.createDataFrame(facts, "sym string, day date, id int"), _dim(spark, dims),
                        "sym", "day"), "id", "company_key")
    assert got == sorted(expected, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_strategies_agree_on_timestamps_dates_and_null_keys(spark):
    """Random versions and facts, times within days, null keys on both sides."""
    rnd = random.Random(8)
    T0 = dt.datetime(2024, 1, 1)
    dims, facts = [(None, T0, None, "null-key")], []
    for k in range(8):
        cuts = sorted(rnd.sample(range(0, 24 * 900), 6))
        for i, c in enumerate(cuts):
            end = None if i == 5 and k % 2 else T0 + dt.timedelta(hours=cuts[i + 1] if i < 5 else c + 7)
            dims.append((f"k{k}", T0 + dt.timedelta(hours=c), end, f"k{k}-{i}"))
    for i in range(400):
        when = None if i % 50 == 0 else T0 + dt.timedelta(hours=rnd.randint(-2000, 24 * 1200), minutes=rnd.choice((0, 30)))
        facts.append((rnd.choice([None, *(f"k{k}" for k in range(9))]), when, i))
    expected = sorted((i, next((c for s_, f, t, c in dims if s_ == sym and sym is not None and when is not None and f <= when
                                and (t is None or when < t)), None)) for sym, when, i in facts)
    dim = spark.createDataFrame(dims, "symbol string, scd_effective_from timestamp, scd_effective_to timestamp, company_key string")
    f = spark.createDataFrame(facts, "sym string, at timestamp, id int")
    for s in STRATEGIES:
        got = sorted((r.id, r.company_key) for r in pit_join(f, dim, "sym", "at", strategy=s).collect())
        assert got == expected, s
    # a timestamp fact on the day a version starts
    day = _dim(spark, [("x", D(2024, 1, 5), None, "v")])
    late = spark.createDataFrame([("x", dt.datetime(2024, 1, 5, 13), 1)], "sym string, at timestamp, id int")
    assert all(pit_join(late, day, "sym", "at", strategy=s).first().company_key == "v" for s in STRATEGIES)


def test_bucketed_join_keys_include_the_time_bucket(spark):
    dim = _dim(spark, [("x", D(2020, 1, 1), None, "v")])
    facts = spark.createDataFrame([("x", D(2021, 5, 5), 1)], "sym string, day date, id int")
    out = pit_join(facts, dim, "sym", "day", strategy="bucketed", bucket_unit="month")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_fb" in plan and "_bk" in plan
    assert rows(out, "id", "company_key") == [(1, "v")]


def test_versions_bring_no_hash_into_the_bucketed_join(spark, tmp_path):
    """Versions repeated by bucket carry their start; keys are hashed after the
    join and equal the dimension's, also where nothing is found."""
    from lakeops.plans import core, standins
    d = str(tmp_path)
    spark.sql("""select * from values (1L, 1L, date '1999-01-05', '1-URGENT', 1.0), (2L, 1L, date '1999-04-05', '2-HIGH', 2.0),
        (3L, 2L, cast(null as date), '1-URGENT', 3.0), (4L, null, date '1999-02-01', '5-LOW', 4.0), (5L, 3L, date '1999-02-01', null, 5.0)
        as t(o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_totalprice)""").write.parquet(f"{d}/orders.parquet")
    spark.sql("""select o as l_orderkey, 1L as l_partkey, 1L as l_suppkey, n as l_linenumber, 1.0 as l_quantity, 1.0 as l_extendedprice,
        0.0 as l_discount, 0.0 as l_tax, date_add(date '1999-01-01', int(n * 40)) as l_shipdate
        from (select explode(array(1L, 2L, 3L, 4L, 5L, 6L)) as o) lateral view explode(sequence(1, 4)) as n
        """).write.parquet(f"{d}/lineitem.parquet")
    out = core.pit_join_auto_q(spark, d)
    assert out.columns[-2:] == ["customer_key", "o_orderpriority"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in plan and "md5" not in plan[plan.index("Join"):]
    dim = {(r.o_custkey, r.scd_effective_from): r for r in standins.dimension(spark, d).collect()}
    got = {(r.l_orderkey, r.l_linenumber): (r.customer_key, r.o_orderpriority) for r in out.collect()}
    assert len(got) == 20
    for (order, line), found in got.items():
        customer = {1: 1, 2: 1, 3: 2, 4: None, 5: 3}[order]
        day = dt.date(1999, 1, 1) + dt.timedelta(days=40 * line)
        fits = [v for (c, since), v in dim.items() if c is not None and c == customer and since is not None and since <= day
                and (v.scd_effective_to is None or day < v.scd_effective_to)]
        assert found == ((fits[0].customer_key, fits[0].o_orderpriority) if fits else (None, None))
    assert sum(k is not None for k, _ in got.values()) == 12


def test_date_key_of_dates_and_times(spark):
    from lakeops.functions.keys import date_key
    df = spark.sql("""select explode(array(date '2024-02-29', date '0001-01-01', date '9999-12-31', date '-0005-03-04',
        date '12024-01-02', null)) as d""").withColumn("t", F.col("d").cast("timestamp"))
    assert df.where("d > date '0000-12-31' or d is null").select(date_key("d"), date_key("t")).distinct().count() == 5
    for c in ("d", "t"):
        assert df.where(~date_key(c).eqNullSafe(F.date_format(c, "yyyyMMdd").cast("int"))).count() == 0
