"""ERP documents mapped onto the common tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dockside.schemas import ERP_PADDED, GENERIC
from dockside.tables import Tables


def trimmed(name: str, df: DataFrame) -> DataFrame:
    """Fixed-width columns arrive blank padded."""
    for c in ERP_PADDED.get(name, []):
        df = df.withColumn(c, F.rtrim(c))
    return df


def customers(kna1: DataFrame) -> DataFrame:
    return trimmed("kna1", kna1).select(
        F.col("kunnr").alias("customer_code"), F.col("name1").alias("customer_name"),
        F.coalesce("regio", F.lit("N/A")).alias("region"),
        F.coalesce("land1", F.lit("US")).alias("country"),
    )


def vendors(lfa1: DataFrame) -> DataFrame:
    return trimmed("lfa1", lfa1).select(
        F.col("lifnr").alias("vendor_code"), F.col("name1").alias("vendor_name"),
        F.coalesce("regio", F.lit("N/A")).alias("region"),
        F.coalesce("land1", F.lit("US")).alias("country"),
        F.lit("standard").alias("tier"),
    )


def products(mara: DataFrame) -> DataFrame:
    return mara.select(
        F.col("matnr").alias("sku"), F.coalesce("maktx", "matnr").alias("product_name"),
        F.col("matkl").alias("category"),
        F.when(F.col("meins") == "", "EA").otherwise(F.col("meins")).alias("unit_of_measure"),
    )


def orders(vbak: DataFrame, vbep: DataFrame) -> DataFrame:
    """Order headers; the requested date is the first schedule line of the order.

    The first line is an aggregate, so an order with very many schedule lines
    is reduced before it is shuffled.  Items may share the lowest schedule
    number; the lowest item decides.
    """
    first = vbep.groupBy("mandt", "vbeln").agg(
        F.min_by("edatu", F.struct("etenr", "posnr")).alias("edatu")
    )
    return vbak.join(first, ["mandt", "vbeln"], "left").select(
        F.col("vbeln").alias("order_number"), F.col("erdat").alias("order_date"),
        F.coalesce("edatu", "erdat").alias("requested_delivery_date"),
        F.col("netwr").alias("total_value"), F.col("waerk").alias("currency"),
        F.col("vkorg").alias("sales_org"), F.lit("completed").alias("order_status"),
        F.col("kunnr").alias("customer_code"),
    )


def order_lines(vbap: DataFrame, vbep: DataFrame, *, priced: bool = False) -> DataFrame:
    """Order items with the quantities of their first schedule line.

    ``priced=True`` adds the unit price the source leaves out.
    """
    first = vbep.groupBy("mandt", "vbeln", "posnr").agg(
        F.min_by(F.struct("lmeng", "wmeng"), "etenr").alias("first")
    )
    cols = [
        F.col("vbeln").alias("order_number"), F.col("posnr").alias("line_number"),
        F.col("matnr").alias("sku"), F.col("matkl").alias("category"),
        F.col("kwmeng").alias("ordered_qty"),
        F.coalesce("first.lmeng", "kwmeng").alias("confirmed_qty"),
        F.coalesce("first.wmeng", "kwmeng").alias("delivered_qty"),
        F.lit("EA").alias("unit_of_measure"), F.col("pmgcn").alias("partial_delivery_flag"),
    ]
    if priced:
        unit = F.col("netwr") / F.nullif(F.col("kwmeng"), F.lit(0))
        cols.append(unit.cast("decimal(18,2)").alias("unit_price"))
    return vbap.join(first, ["mandt", "vbeln", "posnr"], "left").select(*cols)


def _order_to_delivery(vbfa: DataFrame) -> DataFrame:
    # Document categories order (C) and delivery (J).
    return vbfa.where((F.col("vbtyp_n") == "J") & (F.col("vbtyp_v") == "C"))


def shipments(likp: DataFrame, vbfa: DataFrame, *, dedupe: bool = False) -> DataFrame:
    """Delivery headers with their order; one row per delivery *item* unless ``dedupe``."""
    flow = _order_to_delivery(vbfa).select("mandt", "vbeln", "vbeln_v")
    if dedupe:
        flow = flow.distinct()
    none = lambda name: F.lit(None).cast("string").alias(name)
    return likp.where(F.col("podat").isNotNull()).join(flow, ["mandt", "vbeln"]).select(
        F.col("vbeln").alias("shipment_number"), F.col("vbeln_v").alias("order_number"),
        F.col("wadat").alias("planned_ship_date"), F.col("lfdat").alias("planned_delivery_date"),
        F.col("wadat_ist").alias("actual_ship_date"), F.col("podat").alias("actual_delivery_date"),
        F.lit("delivered").alias("shipment_status"), F.col("vstel").alias("shipping_point"),
        "route", F.col("inco1").alias("incoterm"),
        F.coalesce("lfart", F.lit("LF")).alias("delivery_type"),
        none("carrier_code"), none("carrier_name"), none("carrier_mode"), none("vendor_code"),
        none("vendor_region"),
    )


def delivery_lines(lips: DataFrame, vbfa: DataFrame) -> DataFrame:
    flow = _order_to_delivery(vbfa).select("mandt", "vbeln", F.col("posnn").alias("posnr"), "vbeln_v")
    return lips.join(flow, ["mandt", "vbeln", "posnr"]).select(
        F.col("vbeln").alias("shipment_number"), F.col("vbeln_v").alias("order_number"),
        F.col("posnr").alias("line_number"), F.col("matnr").alias("sku"),
        F.col("lfimg").alias("delivered_qty"), F.lit(0).alias("damage_qty"),
        F.lit("EA").alias("unit_of_measure"),
    )


def bundle(erp: dict[str, DataFrame], base: Tables, *, dedupe: bool = True) -> Tables:
    """The common tables fed from ERP documents, so every view runs on them unchanged.

    Ids and prices missing in the source are filled: ids by hashing the
    natural key, the unit price from value over quantity.  Tables the source
    has no counterpart for come from ``base``.
    """
    made = {
        "customers": customers(erp["kna1"]),
        "vendors": vendors(erp["lfa1"]),
        "products": products(erp["mara"]),
        "orders": orders(erp["vbak"], erp["vbep"]).withColumn("order_id", F.xxhash64("order_number")),
        "order_lines": order_lines(erp["vbap"], erp["vbep"], priced=True)
        .withColumn("order_line_id", F.xxhash64("order_number", "line_number")),
        "shipments": shipments(erp["likp"], erp["vbfa"], dedupe=dedupe)
        .withColumn("shipment_id", F.xxhash64("shipment_number", "order_number")),
        "delivery_lines": delivery_lines(erp["lips"], erp["vbfa"])
        .withColumn("delivery_line_id", F.xxhash64("shipment_number", "order_number", "line_number")),
    }
    out = {}
    for name, df in made.items():
        out[name] = df.select(*[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in GENERIC[name]
        ])
    return base.but(**out)
