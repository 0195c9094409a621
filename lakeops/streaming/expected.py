"""Expectations on streams (Q1-Q3).

``expected_stream`` puts rules on a streaming DataFrame: violations are counted
by ``observe`` in the batch's own job, rows that violate a ``drop`` rule go,
and a row that violates a ``fail`` rule fails the batch's job, so nothing of
the batch is committed and the stream stops; its next start takes the batch
again. ``CountListener`` hears every finished batch and stores its counts as a
small file named by stream and batch (a replayed batch writes the same name).

Streams that write in ``foreachBatch`` use ``gate``: the rules are observed
while the batch's rows are staged, and a violated ``fail`` rule raises before
anything of the table is touched.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from lakeops.operators.expectations import Expectation, apply_expectations, check, guarded, violation_counts
from lakeops.session import materialize
from lakeops.sources import fs

#: Name of the observation on a stream.
OBSERVED = "expectations"
COUNTS_SCHEMA = "stream string, batch long, rule string, action string, rows long, violations long"


def expected_stream(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """The stream's rows that its rules let through, the rules' counts observed."""
    return guarded(df.observe(OBSERVED, *violation_counts(rules)), rules)


def counts_path(root: str, stream: str, batch: int) -> str:
    return f"{root.rstrip('/')}/{stream}-{batch}.json"


def store_counts(spark: SparkSession, root: str, stream: str, batch: int, rules: Sequence[Expectation], counts: dict) -> None:
    """One JSON line per rule; a batch's file is written once."""
    lines = [json.dumps({"stream": stream, "batch": batch, "rule": r.name, "action": r.action, "rows": counts["rows"], "violations": counts[r.name]}) for r in rules]
    fs.write_text_once(spark, counts_path(root, stream, batch), "\n".join(lines))


def read_counts(spark: SparkSession, root: str) -> DataFrame:
    """(stream, batch, rule, action, rows, violations) of all stored batches."""
    if not fs.exists(spark, root):
        return spark.createDataFrame([], COUNTS_SCHEMA)
    return spark.read.schema(COUNTS_SCHEMA).json(root)


class CountListener(StreamingQueryListener):
    """Stores the counts of the batches of the streams it is told of."""

    def __init__(self, spark: SparkSession, root: str, rules: Sequence[Expectation]):
        self.spark, self.root, self.rules = spark, root, list(rules)
        self.ended = threading.Event()
        self.run_id: str | None = None
        self.failed: Exception | None = None

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        row = (p.observedMetrics or {}).get(OBSERVED)
        if str(p.runId) != self.run_id or row is None:
            return
        try:
            store_counts(self.spark, self.root, str(p.id), p.batchId, self.rules, row.asDict())
        except Exception as lost:  # noqa: BLE001 - told to the caller, a listener must not raise
            self.failed = lost

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if str(event.runId) == self.run_id:
            self.ended.set()


def run_expected(stream: DataFrame, rules: Sequence[Expectation], table: str, checkpoint: str, counts: str, seconds: float = 60) -> None:
    """Append the stream to a Parquet table under its rules until all input
    that is there is taken, storing the counts of each batch."""
    spark = stream.sparkSession
    listener = CountListener(spark, counts, rules)
    spark.streams.addListener(listener)
    try:
        q = (expected_stream(stream, rules).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(table))
        listener.run_id = str(q.runId)
        try:
            q.awaitTermination()
        finally:
            listener.ended.wait(seconds)  # events of the last batches come after
            # batches that ended before the listener knew the stream's name
            for p in q.recentProgress:
                row = (p.observedMetrics or {}).get(OBSERVED)
                if row is not None:
                    store_counts(spark, counts, str(p.id), p.batchId, rules, row.asDict())
    finally:
        spark.streams.removeListener(listener)
    if listener.failed is not None:
        raise listener.failed


def gate(batch: DataFrame, rules: Sequence[Expectation], name: str) -> tuple[DataFrame, dict]:
    """A batch's rows, staged, and the rules' counts; raises if a ``fail``
    rule is violated."""
    if not rules:
        return materialize(batch, name), {}
    out, seen = apply_expectations(batch, rules, guard_fail=False)
    staged = materialize(out, name)
    return staged, check(seen, rules)
