"""Incremental bronze load: file stream, availableNow, checkpointed append
(S1-S3, K1, Z1). One stream per (source, endpoint), each with its own
checkpoint and table; the stream definitions are data (a list of specs)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.sources.landing import bronze_frame, frozen_schema, landing_dir


def start_bronze(spark: SparkSession, landing: str, bronze: str, checkpoint: str, record_schema: T.StructType,
                 wholetext: bool = False, max_files_per_trigger: int | None = None, name: str | None = None) -> StreamingQuery:
    """Start loading every landing file not seen before into the bronze table.

    ``wholetext``: one (pretty-printed) document per file; otherwise JSON
    lines. The checkpoint's file log guarantees each path is read once."""
    reader = spark.readStream.format("text").option("wholetext", str(wholetext).lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(landing)
    out = bronze_frame(raw, record_schema, F.col("_metadata.file_path"))
    writer = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.queryName(name) if name else writer).start(bronze)


def bronze_stream(spark: SparkSession, landing: str, bronze: str, checkpoint: str,
                  record_schema: T.StructType, wholetext: bool = False,
                  max_files_per_trigger: int | None = None) -> None:
    """Load what is there, then stop."""
    start_bronze(spark, landing, bronze, checkpoint, record_schema, wholetext, max_files_per_trigger).awaitTermination()


@dataclass(frozen=True)
class BronzeSpec:
    source: str
    endpoint: str
    wholetext: bool = False


@dataclass(frozen=True)
class Loaded:
    """How a dataset's load ended: its table, and what was wrong (None if nothing was)."""
    name: str
    table: str
    error: str | None = None


def load_datasets(spark: SparkSession, landing_root: str, bronze_root: str, specs: list[BronzeSpec],
                  schemas: dict | None = None, at_once: int = 4) -> list[Loaded]:
    """An isolated stream per spec, ``at_once`` of them side by side, each with
    its own schema (frozen on the first run), checkpoint and table. A dataset
    that fails, before its stream starts or while it runs, ends alone: the
    others are loaded, and its own next run goes on from its checkpoint."""
    done: dict[str, Loaded] = {}
    running: list[tuple[str, str, StreamingQuery]] = []

    def finish() -> None:
        name, table, q = running.pop(0)
        try:
            q.awaitTermination()
            done[name] = Loaded(name, table)
        except Exception as wrong:  # noqa: BLE001 - a dataset's failure is its result
            done[name] = Loaded(name, table, _reason(wrong))

    for spec in specs:
        name = f"{spec.source}.{spec.endpoint}"
        src = landing_dir(landing_root, spec.source, spec.endpoint)
        base = f"{bronze_root.rstrip('/')}/{spec.source}/{spec.endpoint}"
        if len(running) >= max(1, at_once):
            finish()
        try:
            schema = (schemas or {}).get(name) or frozen_schema(spark, f"{base}/_schema", src, spec.wholetext)
            running.append((name, f"{base}/table", start_bronze(spark, src, f"{base}/table", f"{base}/_checkpoint", schema, spec.wholetext)))
        except Exception as wrong:  # noqa: BLE001
            done[name] = Loaded(name, f"{base}/table", _reason(wrong))
    while running:
        finish()
    return [done[f"{s.source}.{s.endpoint}"] for s in specs]


def _reason(wrong: Exception) -> str:
    return f"{type(wrong).__name__}: {str(wrong).splitlines()[0] if str(wrong) else ''}"


class DatasetsFailed(RuntimeError):
    pass


def load_all(spark: SparkSession, landing_root: str, bronze_root: str, specs: list[BronzeSpec],
             schemas: dict | None = None) -> dict[str, str]:
    """``load_datasets``, whose failures are raised together once all others
    are loaded; the tables by dataset name."""
    ended = load_datasets(spark, landing_root, bronze_root, specs, schemas)
    if wrong := [f"{x.name} ({x.error})" for x in ended if x.error]:
        raise DatasetsFailed("; ".join(wrong))
    return {x.name: x.table for x in ended}


def main(argv: list[str] | None = None) -> None:
    """One bronze job per (source, endpoint):

        python -m lakeops.streaming.bronze --landing L --bronze B --source S --endpoint E [--wholetext]
    """
    import argparse

    from lakeops.session import get_session
    p = argparse.ArgumentParser(description="incremental bronze load of one dataset")
    p.add_argument("--landing", required=True)
    p.add_argument("--bronze", required=True)
    p.add_argument("--source", required=True)
    p.add_argument("--endpoint", required=True)
    p.add_argument("--wholetext", action="store_true", help="one pretty-printed document per file")
    a = p.parse_args(argv)
    spark = get_session()
    out = load_all(spark, a.landing, a.bronze, [BronzeSpec(a.source, a.endpoint, a.wholetext)])
    print(f"bronze {a.source}.{a.endpoint} -> {out[f'{a.source}.{a.endpoint}']}")


if __name__ == "__main__":
    main()
