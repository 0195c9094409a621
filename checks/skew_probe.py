"""Hot-key probe: derive inputs where one customer holds a third of all
rows (from the driver's tables) and time the operators' strategies.

    python checks/skew_probe.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from lakeops.operators.history import dimension_view, scd2_history  # noqa: E402
from lakeops.operators.latest import latest_by_key  # noqa: E402
from lakeops.operators.pit import pit_join  # noqa: E402
from lakeops.plans import standins as S  # noqa: E402
from lakeops.session import get_session  # noqa: E402


def timed(df):
    t0 = time.time()
    df.write.format("noop").mode("overwrite").save()
    return round(time.time() - t0, 2)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey"))
    orders = S.table(spark, sf, "orders").withColumn("o_custkey", hot.cast("bigint"))
    # snapshots per (customer, order time): the hot customer gets one per order
    snaps = latest_by_key(orders.select("o_custkey", F.date_format("o_orderdate", "yyyyMMddHHmmss")
                                        .alias("batch_date"), "o_orderkey", "o_orderpriority"),
                          ["o_custkey", "batch_date"], ["o_orderkey"]).drop("o_orderkey")
    t0 = time.time()  # scd2_history runs its materialising jobs when called
    hist = scd2_history(snaps, ["o_custkey"], "batch_date")
    scd2_s = round(time.time() - t0 + timed(hist), 2)
    dim = dimension_view(hist, ["o_custkey"], key_col="customer_key", columns=[],
                         date_format="yyyyMMddHHmmss").cache()
    out = {"scd2_hot_key": scd2_s, "dim_rows": dim.count(),
           "hot_versions": dim.filter("o_custkey = 0").count()}
    li = S.lines(spark, sf).join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    facts = li.select("o_custkey", "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship_date")).cache()
    out["facts"] = facts.count()
    out["hot_facts"] = facts.filter("o_custkey = 0").count()
    for strategy in ("range", "bucketed", "window"):
        j = pit_join(facts, dim.select("o_custkey", "customer_key", "scd_effective_from", "scd_effective_to"),
                     "o_custkey", "ship_date", dim_key="o_custkey", attach=["customer_key"], strategy=strategy,
                     bucket_unit="month")
        out[f"pit_{strategy}"] = timed(j)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
