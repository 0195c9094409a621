"""Raw API responses as a table job (S17) and the attempt run log (K8).

``triage`` gives every payload exactly one status:

* ``error``         -- not parseable as JSON;
* ``empty``         -- a JSON array with no element;
* ``error_in_body`` -- an object with an ``Error Message`` field;
* ``throttled``     -- an object with an ``Information`` or ``Note`` field;
* ``success``       -- anything else.

The run log is JSON lines ``timestamp, ticker, source, endpoint, status,
error``, appended per attempt; ``latest_status`` is the latest attempt per
(ticker, source, endpoint).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.latest import latest_by_key

# The fields providers use to report errors and rate limits.
ERROR_FIELD = "Error Message"
THROTTLE_FIELDS = ["Information", "Note"]

RUN_LOG_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                               ("timestamp", "ticker", "source", "endpoint", "status", "error")])


def triage(payload: Column) -> tuple[Column, Column]:
    """(status, message) for a raw response text."""
    arr = F.from_json(payload, "array<string>")
    obj = F.from_json(payload, "map<string,string>")
    throttle = F.coalesce(*[obj[f] for f in THROTTLE_FIELDS])
    status = (F.when(arr.isNotNull() & (F.size(arr) == 0), "empty")
              .when(obj.isNotNull() & obj[ERROR_FIELD].isNotNull(), "error_in_body")
              .when(obj.isNotNull() & throttle.isNotNull(), "throttled")
              .when(arr.isNotNull() | obj.isNotNull(), "success")
              .otherwise("error"))
    message = (F.when(status == "empty", F.lit("0 records returned"))
               .when(status == "error_in_body", obj[ERROR_FIELD])
               .when(status == "throttled", throttle)
               .when(status == "error", F.lit("unparseable response")))
    return status, message


def append_run_log(entries: DataFrame, path: str) -> None:
    entries.select(*RUN_LOG_SCHEMA.fieldNames()).write.mode("append").json(path)


def latest_status(log: DataFrame) -> DataFrame:
    return latest_by_key(log, ["ticker", "source", "endpoint"], ["timestamp", "status", "error"])
