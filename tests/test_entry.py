import __spark_entry__ as E
from lake_helpers import SF_SMALL

PURE = ["latest_by_key", "scd2_batch", "dim_scd2", "pit_join", "pit_join_bucketed", "pit_join_window",
        "segment_daily_pit", "ohlc_rollup", "coverage_audit", "test_suite", "fact_long", "upsert_lookback"]


def test_contract_keys_align():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 55


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["sector", "date_key", "trade_date", "company_count", "total_quantity",
                          "avg_price", "avg_discount"]


def test_plans_have_no_cartesian_or_global_window(spark):
    for name in PURE:
        plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                # only one-row partial aggregates may be gathered into one task
                assert "partial_" in lines[i + 1], (name, lines[i + 1])


def test_a_missing_library_leaves_the_rest(monkeypatch):
    """Without the subpackage, or a library it needs, its queries are left out with a warning."""
    import sys
    import warnings
    for name in [m for m in sys.modules if m.startswith("lakeops.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "lakeops.llm", None)
    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        assert len(E.queries()) >= 70 and not any(k.startswith("op") for k in E.queries())
    assert any("left out" in str(w.message) for w in told)
