"""lakeops: lakehouse operators on Spark DataFrames.

Public entry points (all plain functions ``DataFrame -> DataFrame`` unless noted)::

    from lakeops import (latest_by_key, top_n_by_key, scd2_history, dimension_view, pit_join,
                         unpivot, ohlc_rollup, segment_rollup, reconcile, coverage_matrix,
                         apply_expectations, expect, expect_or_drop, expect_or_fail,
                         merge_upsert, lookback_filter, incremental_build,
                         full_refresh, merge_partitions, StreamingSCD2, bronze_stream)
"""

from lakeops.functions.keys import batch_day, date_key, iso_utc, month_key, surrogate_key
from lakeops.operators.audit import coverage_matrix, reconcile
from lakeops.operators.expectations import (apply_expectations, check, expect, expect_or_drop, expect_or_fail,
                                            expectation_report)
from lakeops.operators.history import dimension_view, scd2_history
from lakeops.operators.latest import latest_by_key, sorted_limit, top_n_by_key
from lakeops.operators.pit import overlapping_versions, pit_join
from lakeops.operators.reshape import expand_struct, explode_records, map_to_rows, union_all, unpivot
from lakeops.operators.rollups import counts_per_key, dedup_max, ohlc_rollup, segment_rollup
from lakeops.operators.upsert import (full_refresh, incremental_build, lookback_filter, merge_partitions,
                                      merge_upsert, read_partitions, write_partitions)
from lakeops.session import get_session
from lakeops.streaming.bronze import bronze_stream
from lakeops.streaming.scd2 import StreamingSCD2

__all__ = [n for n in dir() if not n.startswith("_")]
