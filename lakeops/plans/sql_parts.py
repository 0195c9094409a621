"""Shared CTEs for the DuckDB oracle strings (independent SQL formulations
of the stand-ins; they never call the package)."""

NULLK = "'_dbt_utils_surrogate_key_null_'"


def sk(*cols: str) -> str:
    """Surrogate key in SQL: md5 of the parts joined by '-'."""
    parts = [f"coalesce(cast({c} as varchar), {NULLK})" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


LI = """li as (
  select * from lineitem
  qualify row_number() over (partition by l_orderkey, l_linenumber
                             order by l_shipdate desc, l_partkey desc, l_suppkey desc) = 1)"""

SNAP = """snap as (
  select o_custkey, strftime(o_orderdate, '%Y%m%d') as batch_date, o_orderpriority, o_totalprice
  from orders
  qualify row_number() over (partition by o_custkey, strftime(o_orderdate, '%Y%m%d')
                             order by o_orderkey desc) = 1)"""

VER = SNAP + """,
marked as (
  select *, case when row_number() over w = 1 then 1
                 when lag(o_orderpriority) over w is not distinct from o_orderpriority then 0
                 else 1 end as chg
  from snap window w as (partition by o_custkey order by batch_date)),
numbered as (
  select *, sum(chg) over (partition by o_custkey order by batch_date
                           rows between unbounded preceding and current row) as v
  from marked),
grouped as (
  select o_custkey, v, min(batch_date) as valid_from, any_value(o_orderpriority) as o_orderpriority,
         arg_max_null(o_totalprice, batch_date) as o_totalprice
  from numbered group by o_custkey, v),
ver as (
  select o_custkey, o_orderpriority, o_totalprice, valid_from,
         lead(valid_from) over (partition by o_custkey order by valid_from) as valid_to
  from grouped)"""

DIM = VER + f""",
dim as (
  select {sk('o_custkey', 'valid_from')} as customer_key, o_custkey, o_orderpriority,
         case when valid_from = min(valid_from) over (partition by o_custkey) then date '1900-01-01'
              else cast(strptime(valid_from, '%Y%m%d') as date) end as scd_effective_from,
         cast(strptime(valid_to, '%Y%m%d') as date) as scd_effective_to,
         valid_to is null as is_current
  from ver)"""

FL = LI + """,
fl as (
  select cast(strftime(li.l_shipdate, '%Y%m%d') as integer) as date_key, o.o_custkey,
         li.l_orderkey, li.l_linenumber, cast(li.l_shipdate as date) as ship_date,
         li.l_quantity, li.l_extendedprice, li.l_discount, li.l_tax
  from li join orders o on li.l_orderkey = o.o_orderkey)"""

PIT = DIM + ",\n" + FL + """,
pit as (
  select fl.*, d.customer_key, d.o_orderpriority
  from fl left join dim d
    on fl.o_custkey = d.o_custkey and fl.ship_date >= d.scd_effective_from
   and fl.ship_date < coalesce(d.scd_effective_to, date '9999-12-31'))"""

PERIOD = f"""fin as (
  select o_custkey as symbol, cast(year(o_orderdate) as varchar) as fiscalYear,
         'Q' || cast(quarter(o_orderdate) as varchar) as period, cast(o_orderdate as date) as period_end_date
  from orders where o_orderpriority like '1%'
  union all
  select o_custkey, cast(year(o_orderdate) as varchar), 'Q' || cast(quarter(o_orderdate) as varchar),
         cast(o_orderdate as date) from orders where o_orderpriority like '2%'
  union all
  select o_custkey, cast(year(o_orderdate) as varchar), 'Q' || cast(quarter(o_orderdate) as varchar),
         cast(o_orderdate as date) from orders where o_orderpriority like '3%'
  union all
  select o_custkey, cast(year(o_orderdate) as varchar), 'Q' || cast(quarter(o_orderdate) as varchar),
         cast(o_orderdate as date) from orders
  where not (o_orderpriority like '1%' or o_orderpriority like '2%' or o_orderpriority like '3%')),
dedup as (
  select symbol, cast(fiscalYear as integer) as fiscal_year, period as fiscal_period,
         max(period_end_date) as period_end_date
  from fin group by symbol, fiscalYear, period),
period_dim as (
  select {sk('symbol', 'fiscal_year', 'fiscal_period')} as fiscal_period_key, symbol, fiscal_year,
         fiscal_period, period_end_date,
         cast(strftime(period_end_date, '%Y%m%d') as integer) as period_end_date_key
  from dedup)"""
