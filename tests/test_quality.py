import pytest
from pyspark.sql import functions as F

from lake_helpers import rows
from lakeops.operators import contracts as C
from lakeops.operators.audit import coverage_matrix, reconcile
from lakeops.operators.expectations import (ExpectationFailed, apply_expectations, check, expect, expect_or_drop,
                                            expect_or_fail, expectation_report)


def test_drop_warn_and_null_condition(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "k int, p double")
    rules = [expect_or_drop("non_negative", "p >= 0"), expect("small", "p < 3")]
    out, obs = apply_expectations(df, rules)
    assert rows(out, "k") == [(1,)]
    assert check(obs, rules) == {"rows": 3, "non_negative": 2, "small": 2}
    rep = rows(expectation_report(df, rules), "rule", "violations")
    assert rep == [("non_negative", 2), ("small", 2)]


def test_fail_raises(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    rules = [expect_or_fail("key", "k IS NOT NULL")]
    out, obs = apply_expectations(df, rules)
    with pytest.raises(Exception):
        out.collect()
    out2, obs2 = apply_expectations(df, rules, guard_fail=False)
    out2.collect()
    with pytest.raises(ExpectationFailed):
        check(obs2, rules)


def test_contract_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "z")], "k int, c string")
    got = dict(rows(C.run_tests([C.not_null(df, "k", "nn"), C.unique(df, "k", name="u"),
                                  C.unique_combination(df, ["k", "c"], "uc"),
                                  C.accepted_values(df, "c", ["a", "b"], "av")])))
    assert got == {"nn": 1, "u": 1, "uc": 0, "av": 1}


def test_sequential_days_matches_lag_definition(spark):
    import datetime as dt
    days = [dt.date(2024, 1, d) for d in (1, 2, 2, 3, 5, 6, 9, 9, 9)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    s = sorted(days)
    expected = sum(1 for a, b in zip(s, s[1:]) if b != a + dt.timedelta(1))
    assert C.sequential_days(df, "d", "s").first().failures == expected


def test_relationships_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (2,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert C.relationships(child, "k", parent, "k", "r").first().failures == 2


def test_reconcile_zero_base_gives_null_flag(spark):
    a = spark.createDataFrame([("x", 0.0), ("y", 100.0), ("z", None)], "k string, p double")
    b = spark.createDataFrame([("x", 1.0), ("y", 100.6), ("z", 1.0)], "k string, p double")
    out = {r.k: (r.pct_diff, r.is_divergent) for r in reconcile(a, b, ["k"], "p").collect()}
    assert out["x"] == (None, None)
    assert out["y"][1] is True
    assert out["z"] == (None, None)


def test_coverage_has_no_join_for_grid(spark):
    uni = spark.createDataFrame([(1,), (2,)], "k int")
    t = {"a": spark.createDataFrame([(1,), (1,)], "k int"), "b": spark.createDataFrame([], "k int")}
    out = coverage_matrix(uni, "k", t, "k")
    assert rows(out, "symbol", "endpoint", "record_count", "has_data") == [
        (1, "a", 2, True), (1, "b", 0, False), (2, "a", 0, False), (2, "b", 0, False)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_yaml_contracts(spark):
    import datetime as dt
    text = """
version: 2
models:
  - name: child
    data_tests:
      - dbt_utils.unique_combination_of_columns:
          arguments:
            combination_of_columns: ["k", "c"]
    columns:
      - name: k
        data_tests:
          - not_null
          - relationships:
              arguments:
                to: ref('parent')
                field: k
      - name: c
        data_tests:
          - accepted_values:
              arguments:
                values: ['a', 'b']
          - unique:
              config:
                where: "k = 1"
sources:
  - name: raw
    tables:
      - name: days
        columns:
          - name: d
            tests:
              - dbt_utils.sequential_values:
                  interval: 1
                  datepart: day
"""
    specs = C.specs_from_yaml(text)
    tables = {"child": spark.createDataFrame([(1, "a"), (1, "a"), (2, "z"), (None, "b")], "k int, c string"),
              "parent": spark.createDataFrame([(1,)], "k int"),
              "days": spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 4)], "d date")}
    got = dict(rows(C.run_specs(tables, specs)))
    assert got == {"unique_combination_child_k_c": 1, "not_null_child_k": 1,
                   "relationships_child_k_to_parent_k": 1, "accepted_values_child_c": 1,
                   "unique_child_c": 1, "sequential_days_d": 1}
