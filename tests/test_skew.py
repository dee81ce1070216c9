"""One order with a third of all shipments must not end up in one join task."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from dockside.operators import backorders, otif
from dockside.plans.staging import stage
from dockside.schemas import GENERIC
from dockside.session import SETTINGS
from dockside.tables import Tables

SMALL = {
    **{k: v for k, v in SETTINGS.items() if "adaptive" in k},
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
}


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def conform(df, name):
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in GENERIC[name]
    ])


def hot_tables(spark, n=240_000):
    i = F.col("id")
    ships = spark.range(n).select(
        i.alias("shipment_id"), F.concat(F.lit("S"), i.cast("string")).alias("shipment_number"),
        F.when(i % 3 == 0, "HOT").otherwise(F.concat(F.lit("O"), (i % 60_000).cast("string"))).alias("order_number"),
        F.concat(F.lit("V"), (i % 50).cast("string")).alias("vendor_code"), F.lit("R").alias("vendor_region"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 60).cast("int")).alias("actual_delivery_date"),
    )
    orders = ships.select("order_number").distinct().select(
        "order_number", F.lit("2024-02-01").cast("date").alias("requested_delivery_date"))
    lines = orders.select("order_number", F.lit(1).alias("line_number"), F.lit(10).alias("ordered_qty"),
                          F.lit("S1").alias("sku"), F.lit(5).alias("unit_price"))
    moved = ships.select(
        F.col("shipment_id").alias("delivery_line_id"), "shipment_number", "order_number",
        F.lit(1).alias("line_number"), F.lit("S1").alias("sku"), F.lit(9).alias("delivered_qty"), F.lit(0).alias("damage_qty"))
    short = orders.select(
        F.monotonically_increasing_id().alias("backorder_id"), "order_number", F.lit(1).alias("line_number"),
        F.lit(1).alias("backorder_qty"), F.lit("open").alias("status"))
    products = spark.range(1).select(F.lit("S1").alias("sku"), F.lit(5).alias("unit_price"))
    made = dict(shipments=ships, orders=orders, order_lines=lines, delivery_lines=moved, backorders=short, products=products)
    out = {}
    for name in GENERIC:
        df = conform(made[name], name) if name in made else conform(spark.range(0), name)
        out[name] = stage(df.repartition(16), f"hot-{name}") if name in made else df
    return Tables(**out)


def test_hot_order_is_split(spark):
    t = hot_tables(spark)
    with settings(spark, SMALL):
        counted = otif.line_level(t).groupBy().count()
        assert counted.collect()[0][0] == 240_000
        plan = counted._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("skew=true") >= 1
        # 80,000 shipments of one order, one backorder each counted per delivery line.
        totals = {r.vendor_code: r for r in backorders.vendor_backorder_totals(t).collect()}
        assert len(totals) == 50
        assert sum(r.total_open_backorder_cost for r in totals.values()) == 5 * (80_000**2 + sum(
            c * c for c in _cold_order_sizes(240_000)))


def _cold_order_sizes(n):
    sizes = {}
    for i in range(n):
        if i % 3:
            sizes[i % 60_000] = sizes.get(i % 60_000, 0) + 1
    return sizes.values()
