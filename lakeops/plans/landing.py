"""Queries for landing envelopes, file streams, rescue, XML filings, response
triage, run log and streaming SCD2. Queries with side effects write to a
fresh folder under the shared checkpoint dir and return a DataFrame over
what they wrote."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.keys import batch_day, iso_utc
from lakeops.operators.expectations import expect, expect_or_drop, expect_or_fail
from lakeops.operators.latest import latest_by_key
from lakeops.operators.reshape import union_all
from lakeops.plans import standins as S
from lakeops.plans.registry import query
from lakeops.plans.sql_parts import LI, VER
from lakeops.session import scratch_path
from lakeops.sources import fs
from lakeops.sources import documents as X
from lakeops.sources.landing import (bronze_frame, ENVELOPE_META, frozen_schema, landing_dir, landing_inventory,
                                     pack_envelopes, write_landing)
from lakeops.sources.rescue import parse_with_rescue, recover_field
from lakeops.sources.triage import RUN_LOG_SCHEMA, append_run_log, latest_status, triage
from lakeops.sources.walk import walk_landing, write_documents
from lakeops.streaming.bronze import BronzeSpec, bronze_stream, load_datasets
from lakeops.streaming.expected import read_counts, run_expected
from lakeops.streaming.scd2 import StreamingSCD2

# Fixed values of the landing scenario (envelope metadata of one batch).
SOURCE, ENDPOINT = "conversations", "turns"
BATCH_DATE, INGEST_TS = "20240101", "2024-01-02T00:00:00Z"
RECORD_COLS = ["conv_id", "turn", "role", "text"]
TURNS_PER_DOCUMENT = 1000  # bound on records per envelope
RECORD_SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                              T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
VOLATILE = ["_loaded_at", "_source_file"]


def envelopes(spark: SparkSession, d: str, records: DataFrame | None = None, cols=RECORD_COLS) -> DataFrame:
    recs = records if records is not None else S.table(spark, d, "conversations")
    return pack_envelopes(recs, "conv_id", F.lit(BATCH_DATE), SOURCE, ENDPOINT, INGEST_TS, cols, order_col="turn",
                          page=F.floor(F.col("turn") / TURNS_PER_DOCUMENT))


def _seen_at(conv: Column) -> Column:
    """When a conversation was seen: a zoned time, some hours after a fixed
    evening in a zone west of UTC."""
    return F.to_timestamp(F.lit("2024-01-01T20:00:00-05:00")) + F.make_interval(hours=(conv % 48).cast("int"))


@query("envelope_pack", f"""
with e as (select conv_id, turn // 1000 as page, timestamp '2024-01-02 01:00:00' + to_hours(cast(conv_id % 48 as integer)) as seen, count(*) as record_count,
                  to_json(list({{'conv_id': conv_id, 'turn': turn, 'role': role, 'text': text}} order by turn)) as data
           from conversations group by conv_id, turn // 1000),
t as (select *, strftime(seen, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' as stamp, strftime(seen, '%Y%m%d') as day from e)
select stamp as _ingest_timestamp, '{SOURCE}' as _source, '{ENDPOINT}' as _endpoint, cast(conv_id as varchar) as _ticker, day as _batch_date, record_count,
       '{{"_ingest_timestamp":"' || stamp || '","_source":"{SOURCE}","_endpoint":"{ENDPOINT}","_ticker":"' || cast(conv_id as varchar)
       || '","_batch_date":"' || day || '","data":' || data || '}}' as value
from t
""")
def envelope_pack_q(spark, d):
    """Envelopes stamped from a zoned time: ISO text in UTC and the UTC day as batch id."""
    env = pack_envelopes(S.table(spark, d, "conversations"), "conv_id", batch_day(_seen_at(F.col("conv_id"))), SOURCE, ENDPOINT,
                         iso_utc(_seen_at(F.col("_ticker").cast("bigint"))), RECORD_COLS, order_col="turn", page=F.floor(F.col("turn") / TURNS_PER_DOCUMENT))
    return env.select(*ENVELOPE_META, F.size("data").cast("bigint").alias("record_count"), "value")


BRONZE_SQL = f"""
select '{INGEST_TS}' as _ingest_timestamp, '{SOURCE}' as _source, '{ENDPOINT}' as _endpoint,
       cast(conv_id as varchar) as _ticker, '{BATCH_DATE}' as _batch_date, conv_id, turn, role, text,
       cast(null as varchar) as _rescued_data
from conversations
"""


def _land(spark, d, root: str, records: DataFrame | None = None, cols=RECORD_COLS) -> str:
    write_landing(envelopes(spark, d, records, cols), f"{root}/landing")
    return landing_dir(f"{root}/landing", SOURCE, ENDPOINT)


@query("stream_envelope_load", BRONZE_SQL)
def stream_envelope_load_q(spark, d):
    root = scratch_path(spark, "bronze")
    src = _land(spark, d, root)
    bronze_stream(spark, src, f"{root}/bronze", f"{root}/ckpt", RECORD_SCHEMA)
    return spark.read.parquet(f"{root}/bronze").drop(*VOLATILE)


@query("stream_reupload_ignored", BRONZE_SQL)
def stream_reupload_ignored_q(spark, d):
    """A landing file rewritten at the same path after it was loaded is not
    read again: the second run adds nothing and changes nothing."""
    root = scratch_path(spark, "reupload")
    src = _land(spark, d, root)
    bronze_stream(spark, src, f"{root}/bronze", f"{root}/ckpt", RECORD_SCHEMA)
    first = fs.first_file(spark, src, ".txt")
    changed = F.replace("value", F.lit('"role":"user"'), F.lit('"role":"changed"'))
    spark.read.text(first).select(changed.alias("value")).coalesce(1).write.text(f"{root}/changed")
    fs.replace_file(spark, first, f"{root}/changed", ".txt")
    bronze_stream(spark, src, f"{root}/bronze", f"{root}/ckpt", RECORD_SCHEMA)
    return spark.read.parquet(f"{root}/bronze").drop(*VOLATILE)


@query("stream_replay_dedup", BRONZE_SQL)
def stream_replay_dedup_q(spark, d):
    """A lost checkpoint loads every file again (bronze holds each record
    twice); the latest-record step at silver hides it."""
    root = scratch_path(spark, "replay")
    src = _land(spark, d, root)
    bronze_stream(spark, src, f"{root}/bronze", f"{root}/ckpt-1", RECORD_SCHEMA)
    bronze_stream(spark, src, f"{root}/bronze", f"{root}/ckpt-2", RECORD_SCHEMA)
    bronze = spark.read.parquet(f"{root}/bronze")
    latest = latest_by_key(bronze, ["conv_id", "turn"], ["_batch_date", "_ingest_timestamp", "_loaded_at",
                                                         "_source_file"])
    return latest.drop(*VOLATILE)


@query("infer_and_freeze_schema", f"""
select '{INGEST_TS}' as _ingest_timestamp, '{SOURCE}' as _source, '{ENDPOINT}' as _endpoint,
       cast(conv_id as varchar) as _ticker, '{BATCH_DATE}' as _batch_date, conv_id, turn, role, text,
       conv_id % 10 = 9 as has_rescued, case when conv_id % 10 = 9 then upper(role) end as lang_hint
from conversations
""")
def infer_and_freeze_schema_q(spark, d):
    """Record schema inferred from the landing files present and saved; a later
    file with one more field loads under the saved schema, the new field
    going to the rescue column."""
    root = scratch_path(spark, "freeze")
    conv = S.table(spark, d, "conversations")
    early = conv.filter(F.col("conv_id") % 10 != 9)
    late = conv.filter(F.col("conv_id") % 10 == 9).withColumn("lang_hint", F.upper("role"))
    src = _land(spark, d, root, early)
    schema = frozen_schema(spark, f"{root}/schema", src)
    bronze_stream(spark, src, f"{root}/bronze", f"{root}/ckpt", schema)
    _land(spark, d, root, late, RECORD_COLS + ["lang_hint"])
    schema2 = frozen_schema(spark, f"{root}/schema", src)  # saved one, not re-inferred
    bronze_stream(spark, src, f"{root}/bronze", f"{root}/ckpt", schema2)
    b = spark.read.parquet(f"{root}/bronze")
    return b.select(*ENVELOPE_META, *RECORD_COLS, F.col("_rescued_data").isNotNull().alias("has_rescued"),
                    recover_field(F.col("_rescued_data"), "lang_hint").alias("lang_hint"))


PROPS_DECLARED = T.StructType([T.StructField("v", T.LongType())])


def rescued_events(spark, d) -> DataFrame:
    e = S.table(spark, d, "events")
    typed, rescued = parse_with_rescue(F.col("props"), PROPS_DECLARED)
    return e.select("event_id", typed["v"].alias("v"), rescued.alias("_rescued_data"))


@query("rescue_unknown_fields", """
select event_id, cast(null as bigint) as v, '{"k":"' || json_extract_string(props, '$.k') || '"}' as _rescued_data
from events
""")
def rescue_unknown_fields_q(spark, d):
    return rescued_events(spark, d)


@query("rescue_nested", f"""
select conv_id, turn, role as meta_role, case when turn % 2 = 0 then 'n' || turn end as item_note,
       '{ENDPOINT}-v2' as envelope_version, case when conv_id % 5 = 0 then 'scalar-' || turn end as scalar_value,
       'conv/' || conv_id || '.json' as file_path
from conversations
""")
def rescue_nested_q(spark, d):
    """Unknown fields inside a declared struct, inside the elements of a
    declared array, and on the envelope; a scalar among the records; the file's
    path. One document per turn, parsed as bronze rows."""
    c = S.table(spark, d, "conversations")
    schema = T.StructType([T.StructField("turn", T.LongType()),
                           T.StructField("meta", T.StructType([T.StructField("conv_id", T.LongType())])),
                           T.StructField("items", T.ArrayType(T.StructType([T.StructField("n", T.LongType())])))])
    note = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("n"), F.col("turn")))
    record = F.to_json(F.struct("turn", F.struct("conv_id", "role").alias("meta"),
                                F.array(F.struct(F.col("turn").alias("n"), note.alias("note"))).alias("items")))
    scalar = F.when(F.col("conv_id") % 5 == 0, F.concat(F.lit(',"scalar-'), F.col("turn"), F.lit('"'))).otherwise("")
    text = F.concat(F.lit('{"_ticker":"'), F.col("conv_id"), F.lit(f'","version":"{ENDPOINT}-v2","data":['), record, scalar, F.lit("]}"))
    path = F.concat(F.lit("conv/"), F.col("conv_id"), F.lit(".json"))
    bronze = bronze_frame(c.select(text.alias("value"), path.alias("path")), schema, F.col("path"))
    at = lambda col, p: F.get_json_object(col, p)
    r = F.col("_rescued_data")
    rows = bronze.select(F.col("_ticker").cast("bigint").alias("conv_id"), "turn", at(at(r, "$.data[0].meta"), "$.role").alias("meta_role"),
                         at(F.get(F.from_json(at(r, "$.data[0].items"), "array<string>"), F.lit(0)), "$.note").alias("item_note"),
                         at(r, "$._envelope.version").alias("envelope_version"), at(r, "$._file_path").alias("file_path"),
                         at(r, "$.data[0]._value").alias("value"))
    # the scalar's row has no turn of its own: brought beside its record's
    scalars = rows.where("value is not null").select("conv_id", F.regexp_extract("value", "([0-9]+)", 1).cast("bigint").alias("turn"),
                                                     F.col("value").alias("scalar_value"))
    return rows.where("value is null").drop("value").join(scalars, ["conv_id", "turn"], "left")


@query("rescue_recover_field", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def rescue_recover_field_q(spark, d):
    r = rescued_events(spark, d)
    return r.select("event_id", recover_field(F.col("_rescued_data"), "k", "bigint", root=None).alias("k"))


def filings(spark, d) -> DataFrame:
    """Orders and their latest lines rendered as filings: lines with return
    flag 'A' are derivative transactions, the rest non-derivative; one
    document per (order, page of 100 line numbers)."""
    o = S.table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
                                           "o_orderpriority", "o_orderdate")
    li = S.lines(spark, d).join(o, "l_orderkey").withColumn("page", F.floor(F.col("l_linenumber") / 100))
    day = lambda n: F.date_format(F.date_add(F.to_date("l_shipdate"), n), "yyyy-MM-dd")
    common = {"security_title": F.concat(F.lit("part-"), F.col("l_partkey")), "transaction_date": day(0),
              "transaction_code": F.when(F.col("l_linestatus") == "O", F.lit("  ")).otherwise(F.col("l_linestatus")),
              "transaction_form_type": F.lit("4"), "equity_swap_involved": F.col("l_linenumber") % 2,
              "transaction_shares": F.col("l_quantity"), "transaction_price_per_share": F.col("l_extendedprice"),
              "acquired_disposed_code": F.col("l_returnflag"), "shares_owned_following": F.col("l_linenumber"),
              "direct_or_indirect": F.lit("D")}
    more = {"conversion_or_exercise_price": F.col("l_tax"), "exercise_date": day(30), "expiration_date": day(60),
            "underlying_security_title": F.lit("Common"), "underlying_security_shares": F.col("l_quantity")}
    line = F.struct(*X.nested(X.COMMON, common))
    deriv = F.struct(*X.nested(X.COMMON | X.DERIVATIVE_ONLY, common | more))
    is_d, n = F.col("l_returnflag") == "A", F.col("l_linenumber").alias("_n")
    g = li.groupBy("l_orderkey", "page").agg(
        F.first("o_custkey").alias("cust"), F.first("o_orderpriority").alias("prio"), F.first("o_orderdate").alias("odate"),
        F.array_sort(F.collect_list(F.when(~is_d, F.struct(n, line.alias("_t"))))).alias("_non"),
        F.array_sort(F.collect_list(F.when(is_d, F.struct(n, deriv.alias("_t"))))).alias("_der"))
    cust = F.col("cust").cast("string")
    owner = {"rpt_owner_cik": F.lpad(cust, 10, "0"), "rpt_owner_name": F.concat(F.lit("owner-"), F.col("prio")),
             "is_director": F.col("cust") % 2, "is_officer": F.col("cust") % 3, "officer_title": F.lit(" "),
             "is_ten_percent_owner": F.lit("0"), "is_other": F.lit("0")}
    issuer = {"period_of_report": F.date_format("odate", "yyyy-MM-dd"), "issuer_cik": F.lpad(cust, 10, "0"),
              "issuer_name": F.concat(F.lit("Issuer "), cust), "issuer_symbol": cust}
    second = {k: F.lit("co-owner") if k == "rpt_owner_name" else v for k, v in owner.items()}
    holding = F.struct(F.struct(F.struct(F.lit("1").alias("value")).alias("sharesOwnedFollowingTransaction")).alias("postTransactionAmounts"))
    return g.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("page").cast("string")).alias("accession"),
        F.lit("4").alias("documentType"), *X.nested(X.DOCUMENT, issuer),
        F.array(*(F.struct(*X.nested(X.OWNER, v)) for v in (owner, second))).alias("reportingOwner"),
        F.struct(F.transform("_non", lambda x: x["_t"]).alias("nonDerivativeTransaction"),
                 F.array(holding).alias("nonDerivativeHolding")).alias("nonDerivativeTable"),
        F.struct(F.transform("_der", lambda x: x["_t"]).alias("derivativeTransaction")).alias("derivativeTable"))


@query("xml_lines_flatten", f"""
with {LI},
x as (select li.*, o.o_custkey, o.o_orderpriority, o.o_orderdate,
             case when li.l_returnflag = 'A' then 'derivative' else 'non_derivative' end as tbl
      from li join orders o on li.l_orderkey = o.o_orderkey)
select cast(l_orderkey as varchar) || '-' || cast(l_linenumber // 100 as varchar) as accession,
       strftime(o_orderdate, '%Y-%m-%d') as period_of_report, lpad(cast(o_custkey as varchar), 10, '0') as issuer_cik,
       'Issuer ' || o_custkey as issuer_name, cast(o_custkey as varchar) as issuer_symbol,
       lpad(cast(o_custkey as varchar), 10, '0') as rpt_owner_cik, 'owner-' || o_orderpriority as rpt_owner_name,
       cast(o_custkey % 2 as varchar) as is_director, cast(o_custkey % 3 as varchar) as is_officer,
       cast(null as varchar) as officer_title, '0' as is_ten_percent_owner, '0' as is_other, tbl as "table",
       cast(row_number() over (partition by l_orderkey, l_linenumber // 100, tbl order by l_linenumber) - 1
            as integer) as line_index,
       'part-' || l_partkey as security_title, cast(l_shipdate as date) as transaction_date,
       case when l_linestatus = 'O' then null else l_linestatus end as transaction_code, '4' as transaction_form_type,
       cast(l_linenumber % 2 as varchar) as equity_swap_involved, l_quantity as transaction_shares,
       l_extendedprice as transaction_price_per_share, l_returnflag as acquired_disposed_code,
       cast(l_linenumber as varchar) as shares_owned_following, 'D' as direct_or_indirect,
       case when tbl = 'derivative' then l_tax end as conversion_or_exercise_price,
       case when tbl = 'derivative' then cast(l_shipdate as date) + 30 end as exercise_date,
       case when tbl = 'derivative' then cast(l_shipdate as date) + 60 end as expiration_date,
       case when tbl = 'derivative' then 'Common' end as underlying_security_title,
       case when tbl = 'derivative' then l_quantity end as underlying_security_shares
from x
""")
def xml_lines_flatten_q(spark, d):
    """Round trip of the stand-in filings through XML files; the format's own
    paths are held against a hand-made filing in the tests."""
    path = scratch_path(spark, "filings")
    X.write_filings(filings(spark, d), path)
    lines = X.flatten_filings(X.read_filings(spark, path))
    numbers = ["transaction_shares", "transaction_price_per_share", "conversion_or_exercise_price", "underlying_security_shares"]
    days = ["transaction_date", "exercise_date", "expiration_date"]
    return lines.withColumns({**{c: F.col(c).cast("double") for c in numbers}, **{c: F.to_date(c) for c in days}})


def landing_paths(spark, d) -> DataFrame:
    """Landing paths derived from conversations, with some bad shapes: keys
    containing '_', 7-digit batch ids, wrong extensions."""
    c = S.table(spark, d, "conversations")
    key = F.when(F.col("conv_id") % 7 == 0, F.concat(F.lit("C_"), F.col("conv_id").cast("string"))) \
        .otherwise(F.concat(F.lit("C"), F.col("conv_id").cast("string")))
    day = (F.lit(20240101) + F.col("turn")).cast("string")
    day = F.when(F.col("turn") % 13 == 12, F.substring(day, 1, 7)).otherwise(day)
    ext = F.when(F.col("turn") % 11 == 10, F.lit(".txt")).otherwise(F.lit(".json"))
    src = F.when(F.col("role") == "user", F.lit("feed_a")).otherwise(F.lit("feed_b"))
    return c.select(F.concat(F.lit("landing/"), src, F.lit("/turns/"), key, F.lit("_"), day, ext).alias("path"))


@query("landing_inventory", """
with p as (
  select 'landing/' || case when role = 'user' then 'feed_a' else 'feed_b' end || '/turns/'
         || case when conv_id % 7 = 0 then 'C_' else 'C' end || cast(conv_id as varchar) || '_'
         || case when turn % 13 = 12 then substr(cast(20240101 + turn as varchar), 1, 7)
                 else cast(20240101 + turn as varchar) end
         || case when turn % 11 = 10 then '.txt' else '.json' end as path
  from conversations)
select path, regexp_extract(path, '([^/]+)/([^/]+)/([^/]+)_([0-9]{8})\\.json$', 1) as source,
       regexp_extract(path, '([^/]+)/([^/]+)/([^/]+)_([0-9]{8})\\.json$', 2) as endpoint,
       regexp_extract(path, '([^/]+)/([^/]+)/([^/]+)_([0-9]{8})\\.json$', 3) as key,
       regexp_extract(path, '([^/]+)/([^/]+)/([^/]+)_([0-9]{8})\\.json$', 4) as batch_date
from p
where regexp_extract(path, '([^/]+)/([^/]+)/([^/]+)_([0-9]{8})\\.json$', 4) <> ''
  and regexp_extract(path, '([^/]+)/([^/]+)/([^/]+)_([0-9]{8})\\.json$', 1) = 'feed_a'
""")
def landing_inventory_q(spark, d):
    return landing_inventory(landing_paths(spark, d), source="feed_a")


WALK_LIMIT = 40


@query("landing_walk", f"""
with f as (select distinct 'feed_' || case conv_id % 3 when 0 then 'a' else 'b' end as source, case when conv_id % 2 = 0 then 'turns' else 'notes' end as endpoint,
                  case when conv_id % 7 = 0 then 'C_' else 'C' end || conv_id as key, cast(20240101 + conv_id % 5 as varchar) as day, conv_id from conversations)
select source, endpoint, key, day as batch_date from f
where source = 'feed_a' and endpoint = 'turns' and conv_id % 11 <> 3
order by key || '_' || day || '.json' limit {WALK_LIMIT}
""")
def landing_walk_q(spark, d):
    """A file per conversation, written by the tasks under its own name; the
    folders listed by the tasks; the first files by path of one source and
    endpoint, bad names skipped."""
    root = scratch_path(spark, "walk")
    conv = F.col("conv_id")
    day = (F.lit(20240101) + conv % 5).cast("string")
    docs = S.table(spark, d, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        F.when(conv % 3 == 0, "feed_a").otherwise("feed_b").alias("source"), F.when(conv % 2 == 0, "turns").otherwise("notes").alias("endpoint"),
        F.concat(F.when(conv % 7 == 0, "C_").otherwise("C"), conv.cast("string")).alias("key"),
        F.when(conv % 11 == 3, F.left(day, F.lit(7))).otherwise(day).alias("batch_date"), F.to_json(F.struct("conv_id", "n")).alias("value"))
    write_documents(docs, root)
    files = walk_landing(spark, root, source="feed_a")
    return landing_inventory(files, "path", endpoint="turns", limit=WALK_LIMIT).drop("path")


DATASETS = [BronzeSpec("conversations", "turns"), BronzeSpec("web", "events"), BronzeSpec("broken", "nothing"), BronzeSpec("sales", "orders")]


@query("bronze_datasets", """
select 'conversations.turns' as dataset, conv_id * 100000 + turn as id, role as label, cast(null as varchar) as error from conversations
union all select 'web.events', event_id, event_type, null from events
union all select 'sales.orders', o_orderkey, o_orderstatus, null from orders
union all select 'broken.nothing', null, null, 'failed'
""")
def bronze_datasets_q(spark, d):
    """One spec list, a stream per dataset, schemas unlike each other and
    inferred; a dataset whose landing files are no envelopes fails alone."""
    root = scratch_path(spark, "datasets")
    landing = f"{root}/landing"
    block = lambda c: F.floor(F.col(c) / TURNS_PER_DOCUMENT)
    recs = {"conversations.turns": (S.table(spark, d, "conversations"), "conv_id", RECORD_COLS, block("turn")),
            "web.events": (S.table(spark, d, "events"), "user_id", ["event_id", "event_type", "value"], block("event_id")),
            "sales.orders": (S.table(spark, d, "orders"), "o_custkey", ["o_orderkey", "o_orderstatus", "o_totalprice"], block("o_orderkey"))}
    for spec in DATASETS:
        if (name := f"{spec.source}.{spec.endpoint}") in recs:
            df, key, cols, page = recs[name]
            write_landing(pack_envelopes(df, key, F.lit(BATCH_DATE), spec.source, spec.endpoint, INGEST_TS, cols, page=page), landing)
    S.table(spark, d, "region").select(F.lit("no envelope").alias("value")).write.text(landing_dir(landing, "broken", "nothing"))
    ids = {"conversations.turns": (F.col("conv_id") * 100_000 + F.col("turn"), "role"), "web.events": (F.col("event_id"), "event_type"),
           "sales.orders": (F.col("o_orderkey"), "o_orderstatus")}
    none = F.lit(None).cast("string")
    parts = []
    for x in load_datasets(spark, landing, f"{root}/bronze", DATASETS):
        if x.error:
            parts.append(spark.range(1).select(F.lit(x.name).alias("dataset"), F.lit(None).cast("bigint").alias("id"), none.alias("label"), F.lit("failed").alias("error")))
        else:
            value, label = ids[x.name]
            parts.append(spark.read.parquet(x.table).select(F.lit(x.name).alias("dataset"), value.cast("bigint").alias("id"), F.col(label).alias("label"), none.alias("error")))
    return union_all(parts)


PAYLOAD_SQL = """case event_type
    when 'view' then '[]'
    when 'error' then '{"Error Message": "Invalid request ' || cast(event_id as varchar) || '"}'
    when 'click' then '{"Note": "call frequency exceeded"}'
    else case when value < 2 then '{"broken": ' else '[' || props || ']' end end"""


def payloads(spark, d) -> DataFrame:
    e = S.table(spark, d, "events")
    p = (F.when(F.col("event_type") == "view", F.lit("[]"))
         .when(F.col("event_type") == "error",
               F.concat(F.lit('{"Error Message": "Invalid request '), F.col("event_id").cast("string"), F.lit('"}')))
         .when(F.col("event_type") == "click", F.lit('{"Note": "call frequency exceeded"}'))
         .when(F.col("value") < 2, F.lit('{"broken": '))
         .otherwise(F.concat(F.lit("["), F.col("props"), F.lit("]"))))
    return e.select("event_id", "ts", "user_id", "event_type", p.alias("payload"))


TRIAGE_SQL = f"""
with p as (select event_id, ts, user_id, event_type, {PAYLOAD_SQL} as payload from events),
s as (
  select *, case
      when not json_valid(payload) then 'error'
      when json_type(payload) = 'ARRAY' and json_array_length(payload) = 0 then 'empty'
      when json_type(payload) = 'OBJECT' and json_extract(payload, '$."Error Message"') is not null then 'error_in_body'
      when json_type(payload) = 'OBJECT' and (json_extract(payload, '$.Information') is not null
                                              or json_extract(payload, '$.Note') is not null) then 'throttled'
      else 'success' end as status
  from p)
select event_id, ts, user_id, event_type, status,
       case status when 'empty' then '0 records returned'
                   when 'error_in_body' then json_extract_string(payload, '$."Error Message"')
                   when 'throttled' then coalesce(json_extract_string(payload, '$.Information'),
                                                  json_extract_string(payload, '$.Note'))
                   when 'error' then 'unparseable response' end as message
from s"""


def triaged(spark, d) -> DataFrame:
    p = payloads(spark, d)
    status, message = triage(F.col("payload"))
    return p.select("event_id", "ts", "user_id", "event_type", status.alias("status"), message.alias("message"))


@query("response_triage", f"select event_id, status, message from ({TRIAGE_SQL})")
def response_triage_q(spark, d):
    return triaged(spark, d).select("event_id", "status", "message")


@query("run_log_latest", f"""
with t as ({TRIAGE_SQL}),
log as (select strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as timestamp, cast(user_id as varchar) as ticker,
               'events' as source, event_type as endpoint, status, message as error from t)
select * from log
qualify row_number() over (partition by ticker, source, endpoint
                           order by timestamp desc, status desc, error desc nulls last) = 1
""")
def run_log_latest_q(spark, d):
    """Every attempt appended to a JSON-lines run log, then the latest status
    per (ticker, source, endpoint) read back from it."""
    path = scratch_path(spark, "runlog")
    t = triaged(spark, d)
    entries = t.select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
                       F.col("user_id").cast("string").alias("ticker"), F.lit("events").alias("source"),
                       F.col("event_type").alias("endpoint"), "status", F.col("message").alias("error"))
    append_run_log(entries, path)
    log = spark.read.schema(RUN_LOG_SCHEMA).json(path)
    return latest_status(log).select(*RUN_LOG_SCHEMA.fieldNames())


STREAM_RULES = [expect_or_fail("has_conversation", "conv_id IS NOT NULL"), expect_or_drop("says_something", "length(text) > 40"),
                expect("nothing_rescued", "_rescued_data IS NULL"), expect("first_turns", "turn < 4")]


@query("stream_expectations", """
with c as (select *, coalesce(length(text) > 40, false) as kept from conversations),
n as (select count(*) as total, count(*) filter (conv_id is null) as a, count(*) filter (not kept) as b,
             count(*) filter (not coalesce(turn < 4, false)) as d, count(*) filter (kept) as written from c)
select 'has_conversation' as rule, 'fail' as action, total as rows, a as violations, written from n
union all select 'says_something', 'drop', total, b, written from n
union all select 'nothing_rescued', 'warn', total, 0, written from n
union all select 'first_turns', 'warn', total, d, written from n
""")
def stream_expectations_q(spark, d):
    """Rules on a bronze stream of several batches: each batch's counts are
    stored by a listener and summed here, beside the rows written. A delivery
    that violates the fail rule then stops the stream before its batch is
    written and changes neither."""
    root = scratch_path(spark, "expected")
    src = _land(spark, d, root)
    files = {"counts": f"{root}/counts", "table": f"{root}/table", "checkpoint": f"{root}/ckpt"}

    def run() -> None:
        raw = spark.readStream.format("text").option("maxFilesPerTrigger", 2).load(src)
        run_expected(bronze_frame(raw, RECORD_SCHEMA, F.col("_metadata.file_path")), STREAM_RULES, **files)

    run()
    one = S.table(spark, d, "conversations").limit(1).withColumn("conv_id", F.lit(None).cast("bigint"))
    _land(spark, d, root, one)
    try:
        run()
    except StreamingQueryException:
        pass
    written = spark.read.parquet(files["table"]).agg(F.count(F.lit(1)).alias("written"))
    totals = read_counts(spark, files["counts"]).groupBy("rule", "action").agg(F.sum("rows").alias("rows"), F.sum("violations").alias("violations"))
    return totals.withColumn("written", written.scalar())


@query("stream_scd2", f"with {VER} select * from ver")
def stream_scd2_q(spark, d):
    """Snapshots land as monthly files in two waves -- the second wave holds
    every third month, so it arrives after later months (late rows) -- and
    are streamed in several micro-batches into the streaming SCD2."""
    root = scratch_path(spark, "stream_scd2")
    snaps = S.snapshots(spark, d).withColumn("month", F.substring("batch_date", 1, 6))
    late = F.substring("batch_date", 5, 2).cast("int") % 3 == 0
    # one file per month and wave, as a landing zone receives them
    snaps.filter(~late).repartition("month").write.partitionBy("month").parquet(f"{root}/landing")
    snaps.filter(late).repartition("month").write.mode("append").partitionBy("month").parquet(f"{root}/landing")
    schema = snaps.drop("month").schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 16)
              .option("recursiveFileLookup", "true").parquet(f"{root}/landing"))
    job = StreamingSCD2(spark, f"{root}/state", ["o_custkey"], "batch_date", untracked=["o_totalprice"],
                        expectations=[expect_or_fail("valid_key", "o_custkey IS NOT NULL"), expect("has_priority", "o_orderpriority IS NOT NULL")])
    job.run(stream, f"{root}/ckpt")
    return job.read().select("o_custkey", "o_orderpriority", "o_totalprice", "valid_from", "valid_to")
