"""Queries for expectations, contract tests, reconciliation and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators import contracts as C
from lakeops.operators.audit import coverage_matrix, reconcile
from lakeops.operators.expectations import (apply_expectations, expect, expect_or_drop,
                                            expect_or_fail, expectation_report)
from lakeops.plans import standins as S
from lakeops.plans.core import dim_date_q
from lakeops.plans.registry import query
from lakeops.plans.sql_parts import DIM, FL, LI, SNAP
from lakeops.session import materialize

# The order priorities of the test data, used as the dataset
# list of the coverage matrix (one 'endpoint' per priority).
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("expect_drop", "select * from customer where c_acctbal >= 0")
def expect_drop_q(spark: SparkSession, d: str) -> DataFrame:
    rules = [expect_or_drop("non_negative_balance", "c_acctbal >= 0")]
    out, _ = apply_expectations(S.table(spark, d, "customer"), rules)
    return out


@query("expect_fail_passes", "select * from orders")
def expect_fail_passes_q(spark, d):
    rules = [expect_or_fail("valid_key", "o_orderkey IS NOT NULL AND o_orderdate IS NOT NULL"),
             expect("known_status", "o_orderstatus IN ('F', 'O', 'P')")]
    out, _ = apply_expectations(S.table(spark, d, "orders"), rules)
    return out


LINE_RULES = [
    expect_or_fail("valid_key", "l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL"),
    expect_or_drop("non_negative_price", "l_extendedprice >= 0 AND l_quantity >= 0"),
    expect("tax_not_above_discount", "l_tax <= l_discount"),
    expect("shipped_before_2001", "l_shipdate < DATE'2001-01-01'"),
]


def _rules_sql(src: str) -> str:
    parts = [f"select '{r.name}' as rule, '{r.action}' as action, count(*) as rows, "
             f"count(*) filter (where not coalesce({r.condition.replace('DATE', 'date ')}, false)) as violations "
             f"from {src}" for r in LINE_RULES]
    return " union all ".join(parts)


@query("expect_metrics", f"with {LI} " + _rules_sql("li"))
def expect_metrics_q(spark, d):
    """Rule report on the operator's output (after dedup), one row per rule."""
    return expectation_report(S.lines(spark, d), LINE_RULES)


def suite_tables(spark, d) -> dict[str, DataFrame]:
    """The tables under test; those that are plans of their own are written
    once, and read by every test."""
    lines, dim = materialize(S.lines(spark, d), "suite-lines"), materialize(S.dimension(spark, d), "suite-dim")
    orders = S.table(spark, d, "orders")
    facts = lines.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    return {"orders": orders, "lineitem": S.table(spark, d, "lineitem"), "customer": S.table(spark, d, "customer"), "lines": lines,
            "dim": dim, "snapshots": S.snapshots(spark, d), "facts": facts, "dates": dim_date_q(spark, d),
            "order_days": orders.select(F.to_date("o_orderdate").alias("day")).distinct()}


NOT_NULL_UNIQUE = [
    C.spec("orders", "not_null", "o_orderkey", "not_null_orders_o_orderkey"),
    C.spec("orders", "unique", "o_orderkey", "unique_orders_o_orderkey"),
    C.spec("lines", "not_null", "l_shipdate", "not_null_li_l_shipdate"),
    C.spec("lineitem", "unique", "l_orderkey", "unique_lineitem_l_orderkey"),
    C.spec("dim", "unique", "customer_key", "unique_dim_customer_key"),
    C.spec("dim", "unique", "o_custkey", "unique_dim_current_o_custkey", where="is_current")]


NOT_NULL_UNIQUE_SQL = f"""
select 'not_null_orders_o_orderkey' as test_name, count(*) filter (where o_orderkey is null) as failures from orders
union all select 'unique_orders_o_orderkey', count(*) from
  (select o_orderkey from orders where o_orderkey is not null group by 1 having count(*) > 1)
union all select 'not_null_li_l_shipdate', count(*) filter (where l_shipdate is null) from li
union all select 'unique_lineitem_l_orderkey', count(*) from
  (select l_orderkey from lineitem where l_orderkey is not null group by 1 having count(*) > 1)
union all select 'unique_dim_customer_key', count(*) from
  (select customer_key from dim where customer_key is not null group by 1 having count(*) > 1)
union all select 'unique_dim_current_o_custkey', count(*) from
  (select o_custkey from dim where is_current and o_custkey is not null group by 1 having count(*) > 1)"""


@query("test_not_null_unique", f"with {LI}, {DIM} {NOT_NULL_UNIQUE_SQL}")
def test_not_null_unique_q(spark, d):
    return C.run_specs(suite_tables(spark, d), NOT_NULL_UNIQUE)


UNIQUE_COMBINATION = [
    C.spec("lineitem", "unique_combination", name="unique_combination_lineitem", combination_of_columns=S.LINE_KEY),
    C.spec("lines", "unique_combination", name="unique_combination_li", combination_of_columns=S.LINE_KEY),
    C.spec("snapshots", "unique_combination", name="unique_combination_snapshots",
           combination_of_columns=["o_custkey", "batch_date"])]


UNIQUE_COMBINATION_SQL = """
select 'unique_combination_lineitem' as test_name, count(*) as failures from
  (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
union all select 'unique_combination_li', count(*) from
  (select 1 from li group by l_orderkey, l_linenumber having count(*) > 1)
union all select 'unique_combination_snapshots', count(*) from
  (select 1 from snap group by o_custkey, batch_date having count(*) > 1)"""


@query("test_unique_combination", f"with {LI}, {SNAP} {UNIQUE_COMBINATION_SQL}")
def test_unique_combination_q(spark, d):
    tables = {"lineitem": S.table(spark, d, "lineitem"), "lines": S.lines(spark, d), "snapshots": S.snapshots(spark, d)}
    return C.run_specs(tables, UNIQUE_COMBINATION)


ACCEPTED = [
    C.spec("orders", "accepted_values", "o_orderpriority", "accepted_values_o_orderpriority", values=PRIORITIES),
    C.spec("lineitem", "accepted_values", "l_returnflag", "accepted_values_l_returnflag", values=["A", "N"]),
    C.spec("dates", "accepted_values", "quarter_of_year", "accepted_values_quarter_of_year", values=[1, 2, 3, 4])]


ACCEPTED_SQL = """
select 'accepted_values_o_orderpriority' as test_name, count(distinct o_orderpriority) as failures from orders
  where o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')
union all select 'accepted_values_l_returnflag', count(distinct l_returnflag) from lineitem
  where l_returnflag not in ('A', 'N')
union all select 'accepted_values_quarter_of_year', count(distinct quarter_of_year) from dd
  where quarter_of_year not in (1, 2, 3, 4)"""


def _dd() -> str:
    from lakeops.plans.core import _dim_date_sql
    return f"dd as ({_dim_date_sql()})"


@query("test_accepted_values", f"with {_dd()} {ACCEPTED_SQL}")
def test_accepted_values_q(spark, d):
    tables = {"orders": S.table(spark, d, "orders"), "lineitem": S.table(spark, d, "lineitem"), "dates": dim_date_q(spark, d)}
    return C.run_specs(tables, ACCEPTED)


SEQUENTIAL = [C.spec("dates", "sequential", "date_day", "sequential_values_dim_date"),
              C.spec("order_days", "sequential", "day", "sequential_values_order_days"),
              C.spec("orders", "sequential", "o_orderdate", "sequential_values_orders_raw")]


SEQUENTIAL_SQL = """
with od as (select distinct cast(o_orderdate as date) as d from orders),
     raw as (select cast(o_orderdate as date) as d from orders)
select 'sequential_values_dim_date' as test_name, count(*) as failures from
  (select date_day, lag(date_day) over (order by date_day) as p from dd) where not (date_day = p + 1)
union all select 'sequential_values_order_days', count(*) from
  (select d, lag(d) over (order by d) as p from od) where not (d = p + 1)
union all select 'sequential_values_orders_raw', count(*) from
  (select d, lag(d) over (order by d) as p from raw) where not (d = p + 1)"""


@query("test_sequential_days", f"with {_dd()} select * from ({SEQUENTIAL_SQL})")
def test_sequential_days_q(spark, d):
    orders = S.table(spark, d, "orders")
    return C.run_specs({"dates": dim_date_q(spark, d), "orders": orders,
                        "order_days": orders.select(F.to_date("o_orderdate").alias("day")).distinct()}, SEQUENTIAL)


RELATIONSHIPS = [C.spec("lineitem", "relationships", "l_orderkey", "relationships_lines_to_orders", to="orders", field="o_orderkey"),
                 C.spec("orders", "relationships", "o_orderkey", "relationships_orders_to_lines", to="lineitem", field="l_orderkey"),
                 C.spec("facts", "relationships", "o_custkey", "relationships_facts_to_customer", to="customer", field="c_custkey")]


RELATIONSHIP_SQL = """
select 'relationships_lines_to_orders' as test_name, count(*) as failures from lineitem l
  where l.l_orderkey is not null and not exists (select 1 from orders o where o.o_orderkey = l.l_orderkey)
union all select 'relationships_orders_to_lines', count(*) from orders o
  where o.o_orderkey is not null and not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey)
union all select 'relationships_facts_to_customer', count(*) from fl
  where fl.o_custkey is not null and not exists (select 1 from customer c where c.c_custkey = fl.o_custkey)"""


@query("test_relationships", f"with {FL} {RELATIONSHIP_SQL}")
def test_relationships_q(spark, d):
    tables = {n: S.table(spark, d, n) for n in ("orders", "lineitem", "customer")} | {"facts": S.fact_lines(spark, d)}
    return C.run_specs(tables, RELATIONSHIPS)


@query("test_suite", f"""with {DIM}, {FL}, {_dd()}
{NOT_NULL_UNIQUE_SQL} union all {UNIQUE_COMBINATION_SQL} union all {ACCEPTED_SQL}
union all {RELATIONSHIP_SQL} union all
select * from ({SEQUENTIAL_SQL})""")
def test_suite_q(spark, d):
    """All contract tests in one result table (Q12)."""
    return C.run_specs(suite_tables(spark, d), NOT_NULL_UNIQUE + UNIQUE_COMBINATION + ACCEPTED + RELATIONSHIPS + SEQUENTIAL)


@query("cross_feed_reconcile", f"""
with {LI}, f2 as (select l_orderkey, l_linenumber, l_extendedprice * (1 + l_tax * 0.11) as price
                  from li where l_shipdate >= timestamp '2001-01-01')
select a.l_orderkey, a.l_linenumber, a.l_extendedprice as primary_value, b.price as secondary_value,
       abs(a.l_extendedprice - b.price) as abs_diff,
       case when a.l_extendedprice <> 0 then abs(a.l_extendedprice - b.price) / a.l_extendedprice end as pct_diff,
       case when a.l_extendedprice <> 0 then abs(a.l_extendedprice - b.price) / a.l_extendedprice end > 0.005
         as is_divergent
from li a join f2 b on a.l_orderkey = b.l_orderkey and a.l_linenumber = b.l_linenumber
""")
def cross_feed_reconcile_q(spark, d):
    li = S.lines(spark, d)
    primary = li.select(*S.LINE_KEY, F.col("l_extendedprice").alias("price"))
    secondary = (li.filter(F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
                 .select(*S.LINE_KEY, (F.col("l_extendedprice") * (1 + F.col("l_tax") * 0.11)).alias("price")))
    return reconcile(primary, secondary, S.LINE_KEY, "price")


COVERAGE_VALUES = ", ".join(f"('{p}')" for p in PRIORITIES)


@query("coverage_audit", f"""
with grid as (select c.c_custkey as symbol, e.endpoint from customer c, (values {COVERAGE_VALUES}) e(endpoint)),
counts as (select o_custkey as symbol, o_orderpriority as endpoint, count(*) as record_count
           from orders group by 1, 2)
select g.symbol, g.endpoint, coalesce(c.record_count, 0) as record_count,
       coalesce(c.record_count, 0) > 0 as has_data
from grid g left join counts c on g.symbol = c.symbol and g.endpoint = c.endpoint
""")
def coverage_audit_q(spark, d):
    orders = S.table(spark, d, "orders")
    tables = {p: orders.filter(F.col("o_orderpriority") == p) for p in PRIORITIES}
    return coverage_matrix(S.table(spark, d, "customer"), "c_custkey", tables, "o_custkey")


@query("test_no_overlap", f"""
with {DIM},
x as (select *, max(coalesce(scd_effective_to, date '9999-12-31')) over (
              partition by o_custkey order by scd_effective_from, coalesce(scd_effective_to, date '9999-12-31')
              rows between unbounded preceding and 1 preceding) as pe
      from dim where coalesce(scd_effective_to, date '9999-12-31') > scd_effective_from),
shifted as (select o_custkey, cast(strptime(valid_from, '%Y%m%d') as date) + 30 as scd_effective_from,
                   cast(strptime(valid_to, '%Y%m%d') as date) + 30 as scd_effective_to from ver),
y as (select *, max(coalesce(scd_effective_to, date '9999-12-31')) over (
              partition by o_custkey order by scd_effective_from, coalesce(scd_effective_to, date '9999-12-31')
              rows between unbounded preceding and 1 preceding) as pe
      from (select * from dim union all select null, o_custkey, null, scd_effective_from, scd_effective_to, null
            from shifted)
      where coalesce(scd_effective_to, date '9999-12-31') > scd_effective_from)
select 'no_overlapping_versions_dim' as test_name, count(*) filter (where scd_effective_from < pe) as failures from x
union all
select 'no_overlapping_versions_shifted', count(*) filter (where scd_effective_from < pe) from y
""")
def test_no_overlap_q(spark, d):
    """The customer dimension has no overlapping versions; the same dimension
    unioned with a copy shifted by 30 days has (fan-out would follow)."""
    dim = S.dimension(spark, d).select("o_custkey", "scd_effective_from", "scd_effective_to")
    hist = S.history(spark, d, untracked=())
    shifted = hist.select("o_custkey",
                          F.date_add(F.to_date("valid_from", "yyyyMMdd"), 30).alias("scd_effective_from"),
                          F.date_add(F.to_date("valid_to", "yyyyMMdd"), 30).alias("scd_effective_to"))
    return C.run_tests([
        C.no_overlapping_versions(dim, "o_custkey", "scd_effective_from", "scd_effective_to",
                                  "no_overlapping_versions_dim"),
        C.no_overlapping_versions(dim.unionByName(shifted), "o_custkey", "scd_effective_from", "scd_effective_to",
                                  "no_overlapping_versions_shifted")])


# A contract for the stand-in tables in the schema-YAML layout of SQL projects.
CONTRACT_YAML = """
version: 2
models:
  - name: orders
    tests:
      - unique_combination_of_columns: {combination_of_columns: [o_orderkey]}
    columns:
      - {name: o_orderkey, tests: [not_null, unique]}
      - name: o_orderpriority
        tests: [{accepted_values: {values: [1-URGENT, 2-HIGH, 3-MEDIUM, 4-NOT SPECIFIED, 5-LOW]}}]
      - name: o_custkey
        tests: [{relationships: {to: ref('customer'), field: c_custkey}}]
  - name: lineitem
    tests:
      - unique_combination_of_columns: {combination_of_columns: [l_orderkey, l_linenumber]}
    columns:
      - name: l_orderkey
        tests: [{relationships: {to: ref('orders'), field: o_orderkey}}]
  - name: dim_customer
    columns:
      - {name: customer_key, tests: [not_null, unique]}
      - name: o_custkey
        tests: [{unique: {config: {where: is_current}}}]
  - name: dim_date
    columns:
      - name: day_of_week
        tests: [{accepted_values: {values: [1, 2, 3, 4, 5, 6, 7]}}]
      - name: date_key
        tests: [not_null, unique]
      - name: month_start_date
        tests: [{relationships: {to: ref('dim_date'), field: date_day}}]
"""


def _contract_sql() -> str:
    from lakeops.plans.core import _dim_date_sql
    return f"""
with {DIM}, dd as ({_dim_date_sql()})
select 'unique_combination_orders_o_orderkey' as test_name, count(*) as failures from
  (select 1 from orders group by o_orderkey having count(*) > 1)
union all select 'not_null_orders_o_orderkey', count(*) filter (where o_orderkey is null) from orders
union all select 'unique_orders_o_orderkey', count(*) from
  (select o_orderkey from orders where o_orderkey is not null group by 1 having count(*) > 1)
union all select 'accepted_values_orders_o_orderpriority', count(distinct o_orderpriority) from orders
  where o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')
union all select 'relationships_orders_o_custkey_to_customer_c_custkey', count(*) from orders o
  where o.o_custkey is not null and not exists (select 1 from customer c where c.c_custkey = o.o_custkey)
union all select 'unique_combination_lineitem_l_orderkey_l_linenumber', count(*) from
  (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
union all select 'relationships_lineitem_l_orderkey_to_orders_o_orderkey', count(*) from lineitem l
  where l.l_orderkey is not null and not exists (select 1 from orders o where o.o_orderkey = l.l_orderkey)
union all select 'not_null_dim_customer_customer_key', count(*) filter (where customer_key is null) from dim
union all select 'unique_dim_customer_customer_key', count(*) from
  (select customer_key from dim where customer_key is not null group by 1 having count(*) > 1)
union all select 'unique_dim_customer_o_custkey', count(*) from
  (select o_custkey from dim where is_current and o_custkey is not null group by 1 having count(*) > 1)
union all select 'accepted_values_dim_date_day_of_week', count(distinct day_of_week) from dd where day_of_week not between 1 and 7
union all select 'not_null_dim_date_date_key', count(*) filter (where date_key is null) from dd
union all select 'unique_dim_date_date_key', count(*) from (select date_key from dd group by 1 having count(*) > 1)
union all select 'relationships_dim_date_month_start_date_to_dim_date_date_day', count(*) from dd a
  where not exists (select 1 from dd b where b.date_day = a.month_start_date)
"""


@query("test_contract_yaml", _contract_sql())
def test_contract_yaml_q(spark, d):
    """Contracts read from schema YAML and run over the stand-in models."""
    tables = {"orders": S.table(spark, d, "orders"), "lineitem": S.table(spark, d, "lineitem"),
              "customer": S.table(spark, d, "customer"), "dim_customer": materialize(S.dimension(spark, d), "contract-dim"),
              "dim_date": dim_date_q(spark, d)}
    return C.run_specs(tables, C.specs_from_yaml(CONTRACT_YAML))
