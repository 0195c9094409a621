"""Landing envelopes and the incremental bronze loader.

Envelope: one JSON document per (source, endpoint, key, batch day)::

    {"_ingest_timestamp": ..., "_source": ..., "_endpoint": ..., "_ticker": ...,
     "_batch_date": "yyyyMMdd", "data": [record, ...]}

``pack_envelopes`` builds them with a grouped ``collect_list`` (one key and
one day per document: the landing contract bounds a document's size) and
``write_landing`` writes them as JSON lines under ``source=/endpoint=``
folders; Spark's commit protocol means readers never see half a file.

``bronze_stream`` is the loader: a file stream over the landing folder
(each file once; a rewritten path is not read again), envelope parsed with
the record array kept as raw text, one row per record, envelope columns and
``record.*`` flattened, ``_source_file``, ``_loaded_at`` and the rescue
column added; ``availableNow`` trigger into an append-only Parquet table
with its own checkpoint per dataset.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.latest import sorted_limit
from lakeops.sources import fs
from lakeops.sources.rescue import fields_of, rescued_record, text_of

ENVELOPE_META = ["_ingest_timestamp", "_source", "_endpoint", "_ticker", "_batch_date"]


def pack_envelopes(records: DataFrame, key_col: str, batch_col: str | Column, source: str, endpoint: str,
                   ingest_timestamp: str | Column, record_cols: Sequence[str],
                   page: Column, order_col: str | None = None) -> DataFrame:
    """One envelope per (key, batch, page): metadata + ``data`` array + JSON text.

    ``page`` splits a key's batch into several documents (e.g. by record
    number), so no document grows with a hot key; a literal puts a key's
    batch into one document, for batches known to be small."""
    batch = F.col(batch_col) if isinstance(batch_col, str) else batch_col
    ts = F.lit(ingest_timestamp) if isinstance(ingest_timestamp, str) else ingest_timestamp
    rec = F.struct(*record_cols)
    if order_col:  # deterministic record order inside the document
        rec = F.struct(F.col(order_col).alias("_o"), rec.alias("_r"))
    groups = [F.col(key_col).cast("string").alias("_ticker"), batch.alias("_batch_date"), page.alias("_page")]
    g = records.groupBy(*groups).agg(F.collect_list(rec).alias("_recs"))
    data = F.transform(F.array_sort("_recs"), lambda x: x["_r"]) if order_col else F.col("_recs")
    env = g.select(ts.alias("_ingest_timestamp"), F.lit(source).alias("_source"), F.lit(endpoint).alias("_endpoint"),
                   "_ticker", "_batch_date", data.alias("data"))
    return env.withColumn("value", F.to_json(F.struct(*ENVELOPE_META, "data")))


def write_landing(envelopes: DataFrame, root: str, mode: str = "append") -> None:
    """JSON lines, one envelope per line, in ``source=/endpoint=`` folders."""
    (envelopes.select(F.col("_source").alias("source"), F.col("_endpoint").alias("endpoint"), "value")
     .write.mode(mode).partitionBy("source", "endpoint").text(root))


def landing_dir(root: str, source: str, endpoint: str) -> str:
    return f"{root.rstrip('/')}/source={source}/endpoint={endpoint}"


def infer_record_schema(spark: SparkSession, path: str, wholetext: bool = False) -> T.StructType:
    """Infer the record type from all landing files present: one distributed
    JSON inference over the envelopes, then the element type of ``data``."""
    env = spark.read.option("multiLine", str(wholetext).lower()).option("recursiveFileLookup", "true").json(path)
    if "data" not in env.columns:
        raise FileNotFoundError(f"no landing envelopes under {path}")
    data = env.schema["data"].dataType
    if not isinstance(data, T.ArrayType) or not isinstance(data.elementType, T.StructType):
        raise TypeError(f"envelope data is {data.simpleString()}, expected an array of records")
    return data.elementType


def frozen_schema(spark: SparkSession, schema_location: str, path: str, wholetext: bool = False) -> T.StructType:
    """Schema stored at ``schema_location``; inferred once and saved when absent."""
    saved = fs.read_text(spark, f"{schema_location.rstrip('/')}/_schema.json")
    if saved:
        return T.StructType.fromJson(json.loads(saved))
    schema = infer_record_schema(spark, path, wholetext=wholetext)
    fs.write_text_once(spark, f"{schema_location.rstrip('/')}/_schema.json", schema.json())
    return schema


def bronze_frame(raw: DataFrame, record_schema: T.StructType, file_col: Column | None = None) -> DataFrame:
    """Envelope text (column ``value``) -> one row per record, flattened.

    A document is parsed once, into a VARIANT; envelope, records and rescue
    column are read from it. An empty ``data`` array gives no row. Unknown
    envelope fields go to the rescue column of each of its records
    (``_envelope``). A document that is not valid JSON, or whose ``data`` is no
    array, is not lost: it gives one row with null fields whose rescue column
    holds the raw text (``_corrupt_record``) and the file path."""
    clash = set(record_schema.fieldNames()) & (set(ENVELOPE_META) | {"_source_file", "_loaded_at", "_rescued_data"})
    if clash:
        raise ValueError(f"record fields clash with envelope columns: {sorted(clash)}")
    src = file_col if file_col is not None else F.lit(None).cast("string")
    # one projection a step, each value worked out once
    env = raw.select(F.try_parse_json("value").alias("_doc"), src.alias("_source_file"), F.col("value").alias("_raw"))
    env = env.select(fields_of(F.col("_doc")).alias("_m"), "_source_file", "_raw")
    of = lambda name: F.try_element_at("_m", F.lit(name))
    data = F.try_variant_get(of("data"), "$", "array<variant>")
    no_data = of("data").isNull() | F.is_variant_null(of("data"))
    outer = F.transform_values(F.map_filter("_m", lambda k, v: ~k.isin(*ENVELOPE_META, "data")), lambda k, v: text_of(v))
    env = env.select(*(text_of(of(c)).alias(c) for c in ENVELOPE_META), "_source_file", F.current_timestamp().alias("_loaded_at"), "_raw",
                     (F.col("_m").isNull() | (data.isNull() & ~no_data)).alias("_bad"), data.alias("_data"), outer.alias("_outer"))
    records = F.when(F.col("_bad"), F.array(F.lit(None).cast("variant"))).otherwise(F.col("_data"))
    rows = env.select(*(c for c in env.columns if c != "_data"), F.explode(records).alias("_v"))  # empty/null array: no row
    made = rescued_record(F.col("_v"), record_schema, text_of(F.col("_v")), F.col("_source_file"), "data", F.col("_outer"))
    corrupt = F.to_json(F.struct(F.col("_raw").alias("_corrupt_record"), F.col("_source_file").alias("_file_path")))
    rows = rows.select(*ENVELOPE_META, "_source_file", "_loaded_at", "_bad", "_raw", made.alias("_r"))
    return rows.select(*ENVELOPE_META, "_source_file", "_loaded_at", F.col("_r.value").alias("record"),
                       F.when(F.col("_bad"), corrupt).otherwise(F.col("_r.rescued")).alias("_rescued_data")).select(
        *ENVELOPE_META, "_source_file", "_loaded_at", "record.*", "_rescued_data")


def read_documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Batch read of multi-line JSON files under a declared schema: a file holds
    one document or an array of documents (S7)."""
    return spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path)


def landing_inventory(paths: DataFrame, path_col: str = "path", source: str | None = None,
                      endpoint: str | None = None, key: str | None = None,
                      limit: int | None = None) -> DataFrame:
    """Parse ``.../source/endpoint/key_yyyymmdd.json`` paths.

    The key is everything before the *last* underscore; the batch id must be
    exactly eight digits; other shapes are skipped. Optional filters, and an
    optional sorted limit (the ``--limit`` of a file walk)."""
    pat = r"([^/]+)/([^/]+)/([^/]+)_([0-9]{8})\.json$"
    p = F.col(path_col)
    parsed = paths.select(p.alias("path"),
                          F.regexp_extract(p, pat, 1).alias("source"),
                          F.regexp_extract(p, pat, 2).alias("endpoint"),
                          F.regexp_extract(p, pat, 3).alias("key"),
                          F.regexp_extract(p, pat, 4).alias("batch_date"))
    out = parsed.filter(F.col("batch_date") != "")
    for c, v in (("source", source), ("endpoint", endpoint), ("key", key)):
        if v is not None:
            out = out.filter(F.col(c) == v)
    if limit is not None:
        out = sorted_limit(out, ["path"], limit)
    return out
