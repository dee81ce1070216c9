"""The common tables derived from a star-schema Parquet folder.

Every value is integer arithmetic on the star's keys, so any SQL engine can
restate the rules and get the same rows.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from dockside.plans.staging import stage
from dockside.schemas import GENERIC
from dockside.tables import Later, Tables

_marts: dict[tuple[str, str], Tables] = {}

#: Tables without a join are columns of what they are derived from; writing them again would save no work.
PROJECTED = ("products", "orders", "delivery_lines")


def load_mart(spark: SparkSession, sf_dir: str) -> Tables:
    """Tables derived once per application, each when it is first read; those that joins make are read back from Parquet."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _marts:
        _marts[key] = derive_tables(spark, sf_dir)
    return _marts[key]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _conform(df: DataFrame, table: str) -> DataFrame:
    """Select the table's columns in order, cast, NULL where the star has none."""
    out = []
    for field in GENERIC[table]:
        c = F.col(field.name) if field.name in df.columns else F.lit(None)
        out.append(c.cast(field.dataType).alias(field.name))
    return df.select(*out)


def vendor_code(v: Column) -> Column:
    digits = v.cast("string")
    return F.concat(F.lit("V"), F.when(F.length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(digits))


def shipment_number(k: Column, v: Column) -> Column:
    return F.concat(F.lit("SHIP-"), k.cast("string"), F.lit("-"), v.cast("string"))


def derive_tables(spark: SparkSession, sf_dir: str) -> Tables:
    read = lambda name: _read(spark, sf_dir, name)
    k, v, n = F.col("k"), F.col("v"), F.col("n")

    places = read("nation").join(
        read("region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "n_name", F.col("r_name").alias("region"))

    customers = read("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit("CUST"), F.col("c_custkey").cast("string")).alias("customer_code"),
        F.col("c_name").alias("customer_name"),
        "region",
        F.lit("US").alias("country"),
    )

    suppliers = read("supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("v"), F.col("s_name").alias("vendor_name"), "region"
    )
    tier = F.element_at(
        F.array(F.lit("strategic"), F.lit("standard"), F.lit("emerging")), (v % 3 + 1).cast("int")
    )
    vendors = suppliers.select(
        v.alias("vendor_id"), vendor_code(v).alias("vendor_code"), "vendor_name", "region",
        F.lit("US").alias("country"), tier.alias("tier"),
    )
    idle = suppliers.agg((F.max("v") + 1).alias("vendor_id"), F.min("region").alias("region")).select(
        "vendor_id", F.lit("VIDLE").alias("vendor_code"), F.lit("Idle vendor").alias("vendor_name"),
        "region", F.lit("US").alias("country"), F.lit("standard").alias("tier"),
    )
    vendors = vendors.unionByName(idle)

    cents = F.round(F.col("p_retailprice") * 100).cast("long")
    parts = read("part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("SKU"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.lit("EA").alias("unit_of_measure"),
        # A twentieth of the retail price, rounded to whole cents in integers.
        (F.floor((cents + 10) / 20).cast("decimal(18,0)") / F.lit(100).cast("decimal(18,0)"))
        .cast("decimal(18,2)").alias("unit_price"),
    )

    carriers = suppliers.select((v % 9).alias("c")).distinct().select(
        F.col("c").alias("carrier_id"), *_carrier(F.col("c")),
    ).withColumnRenamed("carrier_mode", "mode")

    order_date = F.to_date("o_orderdate")
    peak = order_date.between(F.lit("2001-07-23").cast("date"), F.lit("2001-07-29").cast("date"))
    slack = (F.lit(3) + F.col("o_orderkey") % 8 + F.when(peak, 8).otherwise(0)).cast("int")
    status = (
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 4 == 0), "pending")
        .when((F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 10 == 0), "shipped")
        .otherwise("completed")
    )
    channel = F.element_at(
        F.array(F.lit("web"), F.lit("edi"), F.lit("phone")), (F.col("o_orderkey") % 3 + 1).cast("int")
    )
    orders = read("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderkey").cast("string").alias("order_number"),
        F.concat(F.lit("CUST"), F.col("o_custkey").cast("string")).alias("customer_code"),
        order_date.alias("order_date"),
        F.date_add(order_date, slack).alias("requested_delivery_date"),
        status.alias("order_status"),
        channel.alias("channel"),
        F.lit("USD").alias("currency"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_value"),
    )

    heads = orders.select(F.col("order_id").alias("k"), "order_date", "requested_delivery_date", "order_status")
    items = Later(spark, StructType(), lambda: stage(_items(read("lineitem"), heads), "mart-items"))
    order_lines = lambda: items().where("first_of_line").join(parts, F.col("p") == F.col("product_id")).select(
        (k * 10 + n).alias("order_line_id"),
        k.cast("string").alias("order_number"),
        n.alias("line_number"),
        "sku", "product_name", "category",
        F.col("q").alias("ordered_qty"),
        F.col("q").alias("confirmed_qty"),
        "unit_price",
        (F.col("q").cast("decimal(18,0)") * F.col("unit_price")).alias("line_total"),
        F.lit(1).alias("partial_delivery_allowed"),
    )

    c = v % 9
    late = (k * 7 + v * 13) % 100 >= 99 - c * 3
    requested = F.col("requested_delivery_date")
    delivered_on = (
        F.when(F.col("order_status") == "pending", F.lit(None).cast("date"))
        .when(late, F.date_add(requested, (1 + (k + v) % 5).cast("int")))
        .otherwise(F.date_sub(requested, ((k + v) % 2).cast("int")))
    )
    # Its size is known once it is written; that of a join is taken for the product of its sides, and all pairs would move.
    regions_of = lambda: stage(suppliers.select("v", F.col("region").alias("vendor_region")), "mart-regions")
    with_heads = lambda: items().select("*", F.inline("heads"))
    shipments = lambda: (
        with_heads().where("first_of_pair")
        .join(regions_of(), "v")
        .select(
            (k * 10_000_000 + v).alias("shipment_id"),
            shipment_number(k, v).alias("shipment_number"),
            k.cast("string").alias("order_number"),
            *_carrier(c),
            vendor_code(v).alias("vendor_code"),
            "vendor_region",
            F.concat(F.lit("SP"), (v % 4).cast("string")).alias("shipping_point"),
            F.concat(F.lit("R"), ((k + v) % 12).cast("string")).alias("route"),
            F.date_add("order_date", (1 + (k + v) % 5).cast("int")).alias("planned_ship_date"),
            requested.alias("planned_delivery_date"),
            F.date_add("order_date", (1 + (k * 3 + v) % 8).cast("int")).alias("actual_ship_date"),
            delivered_on.alias("actual_delivery_date"),
            F.when(F.col("order_status") == "pending", "pending").otherwise("delivered").alias("shipment_status"),
            F.lit("outbound").alias("delivery_type"),
            F.lit("DAP").alias("incoterm"),
        )
    )

    short = (k * 11 + v * 3 + n * 17) % 100 >= 100 - (v % 4) * 4
    delivered = F.when(short, F.floor(F.col("q") * 6 / 10)).otherwise(F.col("q"))
    damage = (
        F.when((k * 5 + n) % 97 == 0, F.lit(None).cast("int"))
        .when((v % 2 == 1) & ((k * 3 + n) % 20 == 0), 1)
        .otherwise(0)
    )
    moved = lambda: with_heads().where(n.isNotNull() & (F.col("order_status") != "pending"))
    line_id = (k * 10_000_000 + v) * 10 + n
    delivery_lines = lambda: moved().select(
        line_id.alias("delivery_line_id"),
        shipment_number(k, v).alias("shipment_number"),
        k.cast("string").alias("order_number"),
        n.alias("line_number"),
        F.col("p").alias("product_id"),
        F.concat(F.lit("SKU"), F.col("p").cast("string")).alias("sku"),
        delivered.alias("delivered_qty"),
        damage.alias("damage_qty"),
    )

    backorders = lambda: (
        moved().withColumn("delivered", delivered)
        .withColumn("delivered_on", delivered_on)
        .where((F.col("delivered") < F.col("q")) & ((k + n) % 5 < 3))
        .select(
            line_id.alias("backorder_id"),
            k.cast("string").alias("order_number"),
            n.alias("line_number"),
            F.col("p").alias("product_id"),
            (F.col("q") - F.col("delivered")).alias("backorder_qty"),
            F.date_add("delivered_on", (3 + (k + n) % 28).cast("int")).alias("estimated_fill_date"),
            F.when(k % 6 == 0, "filled").otherwise("open").alias("status"),
            F.col("delivered_on").cast("timestamp_ntz").alias("created_at"),
        )
    )

    alerts = event_alerts(read("events"))
    regions = read("region").select(F.col("r_regionkey"), F.col("r_name").alias("region"))
    alert_history = alerts.join(regions, F.col("user_id") % 5 == F.col("r_regionkey"), "left").select(
        F.col("alert_id").alias("alert_history_id"), "alert_type", "entity", "region", "severity",
        F.col("metric_value"), F.lit(50.0).alias("threshold_value"),
        F.concat(F.lit("Error value for entity "), F.col("entity")).alias("alert_description"),
        F.lit("Email").alias("channels"), F.lit(0).alias("acknowledged"), F.lit(0).alias("escalated"),
        F.col("ts").alias("created_at"),
    )

    frames = dict(
        customers=customers, vendors=vendors, products=parts, carriers=carriers, orders=orders,
        order_lines=order_lines, shipments=shipments, delivery_lines=delivery_lines,
        backorders=backorders, alert_history=alert_history,
    )

    def make(name: str) -> DataFrame:
        df = frames[name]
        df = _conform(df() if callable(df) else df, name)
        return df if name in PROJECTED else stage(df, f"mart-{name}")

    return Tables(**{name: Later(spark, GENERIC[name], partial(make, name)) for name in frames})


def _items(lineitem: DataFrame, heads: DataFrame) -> DataFrame:
    """A row for each (order k, vendor v, line n), with the figures q and p of the line and the order's heads.

    Lines and heads are dealt by order once; what tells the first row of a line and of an (order, vendor) needs no more.
    """
    rows = lineitem.select(
        F.col("l_orderkey").alias("k"), F.col("l_suppkey").alias("v"), F.col("l_linenumber").alias("n"), "l_quantity", "l_partkey"
    ).repartition("k").groupBy("k", "v", "n").agg(F.max("l_quantity").cast("long").alias("q"), F.min("l_partkey").alias("p"))
    line, pair = Window.partitionBy("k", "n"), Window.partitionBy("k", "v")
    rows = rows.select(
        "k", "v", "n", F.max("q").over(line).alias("q"), F.min("p").over(line).alias("p"),
        (F.row_number().over(line.orderBy("v")) == 1).alias("first_of_line"),
        (F.row_number().over(pair.orderBy("n")) == 1).alias("first_of_pair"),
    )
    by_order = heads.where("k is not null").groupBy("k").agg(
        F.collect_list(F.struct("order_date", "requested_delivery_date", "order_status")).alias("heads")
    )
    return rows.join(by_order.hint("merge"), "k", "left")


def _carrier(c: Column) -> list[Column]:
    digit = c.cast("string")
    mode = F.element_at(F.array(F.lit("truck"), F.lit("air"), F.lit("rail")), (c % 3 + 1).cast("int"))
    return [
        F.concat(F.lit("C"), digit).alias("carrier_code"),
        F.concat(F.lit("Carrier "), digit).alias("carrier_name"),
        mode.alias("carrier_mode"),
    ]


def event_alerts(events: DataFrame) -> DataFrame:
    """Alerts carried by the event table: error events, severity by value band."""
    kind = F.element_at(
        F.array(F.lit("OTIF_THRESHOLD"), F.lit("BACKORDER_COST"), F.lit("CONSECUTIVE_FAILURES")),
        (F.col("user_id") % 3 + 1).cast("int"),
    )
    severity = (
        F.when(F.col("value") >= 100, "CRITICAL").when(F.col("value") >= 50, "BREACHED").otherwise("WARNING")
    )
    return events.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("alert_id"),
        kind.alias("alert_type"),
        F.col("user_id").cast("string").alias("entity"),
        F.col("user_id"),
        severity.alias("severity"),
        F.col("value").alias("metric_value"),
        F.col("ts"),
    )


def event_acks(events: DataFrame) -> DataFrame:
    """Acknowledgments carried by the event table: clicks of the same entity."""
    return events.where(F.col("event_type") == "click").select(
        F.col("event_id").alias("ack_id"),
        F.col("user_id").cast("string").alias("entity"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("acknowledged_by"),
        F.col("ts").alias("ack_ts"),
    )
