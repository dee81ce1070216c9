"""Times the headline queries and prints one JSON line.

The tables are derived from the star-schema folder first (``load``); every
query then reads them from Parquet.  ``compare`` holds the plain plan of three
queries next to ours, on the same data.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

from pyspark.sql import DataFrame, Window, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dockside.operators import backorders, otif  # noqa: E402
from dockside.plans.model import FulfilmentModel  # noqa: E402
from dockside.registry import QUERIES  # noqa: E402
from dockside.session import build_session  # noqa: E402
from fixtures.sample_erp import load_erp  # noqa: E402
from fixtures.sample_mart import load_mart  # noqa: E402

HEADLINE = [
    "v01_otif_line_level", "v03_rolling_active_7", "v05_vendor_hierarchy", "v07_carrier_scorecard",
    "v08_consecutive_failures", "v10_dwell_times", "v12_backorder_running_costs",
    "v14_alert_otif_below_threshold", "v15_alert_backorder_threshold", "v19_alert_dashboard_summary",
    "m10_rolling_7d_otif", "m12_current_failure_streak", "m14_open_backorder_cost",
    "d03_daily_deliveries", "d07_vendor_table", "d13_recent_deliveries", "e08_line_level_on_erp",
    "r10_regional_line_level", "s06_surrogate_keys", "a09_escalation", "a10_repeated_critical",
    "a11_cooldown", "t03_daily_kpis",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def plain_hierarchy(m: FulfilmentModel) -> DataFrame:
    """The hierarchy's totals by the join it describes."""
    t, ll = m.tables, m.line_level.select("shipment_id", "is_otif")
    return (
        t.vendors.join(t.shipments, "vendor_code", "left")
        .join(t.orders.select(F.col("order_number").alias("o")), F.col("order_number") == F.col("o"), "left")
        .join(t.order_lines.select(F.col("order_number").alias("ol"), "ordered_qty"), F.col("o") == F.col("ol"), "left")
        .join(t.delivery_lines.select("shipment_number", "delivered_qty"), "shipment_number", "left")
        .join(ll, "shipment_id", "left")
        .groupBy("vendor_code")
        .agg(F.sum("ordered_qty"), F.sum("delivered_qty"), F.count_distinct("shipment_id"),
             F.count_distinct("o"), F.sum("is_otif"), F.count("is_otif"))
    )


def plain_running_costs(m: FulfilmentModel) -> DataFrame:
    """The running costs by one window over everything."""
    base = backorders.costed(m.tables).withColumn("cost", F.col("backorder_qty") * F.col("unit_price"))
    w = Window.orderBy("created_at", "backorder_id", "delivery_line_id")
    return base.select("backorder_id", F.sum("cost").over(w.rowsBetween(Window.unboundedPreceding, 0)),
                       F.sum("cost").over(w.rowsBetween(-6, 0)))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "dockside-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__driver__memory="12g",
        spark__sql__adaptive__coalescePartitions__initialPartitionNum=str(4 * int(cpus)),
    )
    spark.sparkContext.setLogLevel("ERROR")
    with contextlib.redirect_stdout(sys.stderr):
        load = timed(lambda: (load_mart(spark, folder), load_erp(spark, folder)))
        wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
        run(QUERIES["v02_date_anchor"](spark, folder))  # warm-up
        times = {name: timed(lambda n=name: run(QUERIES[n](spark, folder))) for name in wanted}
        m = FulfilmentModel(load_mart(spark, folder))
        compare = {
            "hierarchy_rewritten": timed(lambda: run(otif.vendor_hierarchy(m.tables, m.line_level))),
            "hierarchy_plain_join": timed(lambda: run(plain_hierarchy(m))),
            "running_costs_segments": timed(lambda: run(backorders.backorder_running_costs(m.tables, segments=int(cpus)))),
            "running_costs_one_window": timed(lambda: run(plain_running_costs(m))),
            "summary_line_level_shared": timed(lambda: run(FulfilmentModel.for_snapshots(m.tables).alert_summary)),
            "summary_line_level_rebuilt": timed(lambda: run(FulfilmentModel(m.tables).alert_summary)),
        }
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "load": load, "compare": compare,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
