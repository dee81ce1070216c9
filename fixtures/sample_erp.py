"""ERP-shaped tables derived from the star-schema folder.

Key rules put every awkward case in: items without schedule lines, an order
whose items disagree on their first date, deliveries of several items, missing
proof of delivery, foreign document flows, and a second client whose schedule
lines must not leak into the first.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from dockside.plans.staging import stage
from dockside.schemas import ERP
from dockside.tables import Later, Tables
from fixtures.sample_mart import load_mart


class Frames(dict):
    """Tables by name, each made when it is first read."""

    def __getitem__(self, name: str) -> DataFrame:
        return super().__getitem__(name)()

    def items(self):
        return [(name, self[name]) for name in self]

    def values(self):
        return [self[name] for name in self]


_loaded: dict[tuple[str, str], dict[str, DataFrame]] = {}


def load_erp(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        _loaded[key] = derive_erp(spark, sf_dir)
    return _loaded[key]


def derive_erp(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = load_mart(spark, sf_dir)
    client = F.lit(100)
    k, n = F.col("order_number").cast("long"), F.col("line_number")
    cust = F.col("customer_id")

    kna1 = lambda: t.customers.select(
        client.alias("mandt"), F.col("customer_code").alias("kunnr"), F.col("customer_name").alias("name1"),
        F.when(cust % 11 != 0, F.col("region")).alias("regio"),
        F.when(cust % 13 != 0, F.lit("US ")).alias("land1"),
    )
    vend = F.col("vendor_id")
    lfa1 = lambda: t.vendors.select(
        client.alias("mandt"), F.col("vendor_code").alias("lifnr"), F.col("vendor_name").alias("name1"),
        F.when(vend % 7 != 0, F.col("region")).alias("regio"),
        F.when(vend % 5 != 0, F.lit("US ")).alias("land1"),
    )
    part = F.col("product_id")
    mara = lambda: t.products.select(
        client.alias("mandt"), F.col("sku").alias("matnr"),
        F.when(part % 9 != 0, F.col("product_name")).alias("maktx"),
        F.when(part % 4 == 0, "").when(part % 4 != 1, "EA").alias("meins"),
        F.lit("FERT").alias("mtart"), F.col("category").alias("matkl"),
    )
    vbak = lambda: t.orders.select(
        client.alias("mandt"), F.col("order_number").alias("vbeln"), F.col("order_date").alias("erdat"),
        F.col("order_date").alias("audat"), F.concat(F.lit("10"), (k % 3).cast("string")).alias("vkorg"),
        F.col("customer_code").alias("kunnr"), F.lit("C").alias("vbtyp"), F.lit("OR").alias("auart"),
        F.col("total_value").alias("netwr"), F.col("currency").alias("waerk"),
    )
    vbap = lambda: t.order_lines.select(
        client.alias("mandt"), F.col("order_number").alias("vbeln"), n.alias("posnr"), F.col("sku").alias("matnr"),
        F.col("category").alias("matkl"), F.col("ordered_qty").alias("kwmeng"), F.lit("EA").alias("vrkme"),
        F.col("line_total").alias("netwr"), F.when(k % 2 == 0, "X").alias("pmgcn"),
    )
    ship = F.col("shipment_id") % 10_000_000
    likp = lambda: t.shipments.select(
        client.alias("mandt"), F.col("shipment_number").alias("vbeln"),
        F.col("planned_delivery_date").alias("lfdat"), F.col("planned_ship_date").alias("wadat"),
        F.col("actual_ship_date").alias("wadat_ist"), F.col("actual_delivery_date").alias("podat"),
        F.col("shipping_point").alias("vstel"), "route", F.col("incoterm").alias("inco1"),
        F.when(ship % 6 != 0, F.lit("LF")).alias("lfart"),
    )
    lips = lambda: t.delivery_lines.select(
        client.alias("mandt"), F.col("shipment_number").alias("vbeln"), n.alias("posnr"), F.col("sku").alias("matnr"),
        F.col("delivered_qty").alias("lfimg"), F.lit("EA").alias("vrkme"),
        F.col("order_number").alias("vgbel"), n.alias("vgpos"),
    )
    vbfa = lambda: t.delivery_lines.select(
        client.alias("mandt"), F.col("shipment_number").alias("vbeln"), n.alias("posnn"),
        F.col("order_number").alias("vbeln_v"), n.alias("posnv"),
        F.when((k * 3 + n) % 50 == 0, "R").otherwise("J").alias("vbtyp_n"), F.lit("C").alias("vbtyp_v"),
        F.col("delivered_qty").alias("rfmng"),
    )
    frames = dict(kna1=kna1, lfa1=lfa1, mara=mara, vbak=vbak, vbap=vbap, vbep=lambda: _schedule_lines(t), likp=likp, lips=lips, vbfa=vbfa)

    def make(name: str) -> DataFrame:
        df = frames[name]()
        cols = [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ERP[name]
        ]
        df = df.select(*cols)
        return stage(df, f"erp-{name}") if name == "vbep" else df

    return Frames({name: Later(spark, ERP[name], partial(make, name)) for name in frames})


def _schedule_lines(t: Tables) -> DataFrame:
    client, k, n = F.lit(100), F.col("order_number").cast("long"), F.col("line_number")
    due = t.orders.select("order_number", "requested_delivery_date")
    items = t.order_lines.select("order_number", "line_number", "ordered_qty").join(due, "order_number")
    first = items.where((k + n) % 6 != 0).select(
        client.alias("mandt"), F.col("order_number").alias("vbeln"), n.alias("posnr"), F.lit(1).alias("etenr"),
        F.date_add("requested_delivery_date", (n % 2).cast("int")).alias("edatu"),
        F.col("ordered_qty").alias("wmeng"),
        F.when((k + n) % 10 != 0, F.col("ordered_qty")).alias("lmeng"),
    )
    second = items.where((k + n) % 4 == 0).select(
        client.alias("mandt"), F.col("order_number").alias("vbeln"), n.alias("posnr"), F.lit(2).alias("etenr"),
        F.date_add("requested_delivery_date", 7).alias("edatu"),
        F.lit(1).alias("wmeng"), F.lit(1).alias("lmeng"),
    )
    foreign = items.where(k % 20 == 1).select(
        F.lit(200).alias("mandt"), F.col("order_number").alias("vbeln"), n.alias("posnr"), F.lit(0).alias("etenr"),
        F.lit("1990-01-01").cast("date").alias("edatu"), F.lit(0).alias("wmeng"), F.lit(0).alias("lmeng"),
    )
    return first.unionByName(second).unionByName(foreign)
