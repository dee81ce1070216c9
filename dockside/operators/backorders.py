"""Backorder cost over time and per vendor."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dockside.plans.ordered import ordered_columns
from dockside.plans.staging import stage
from dockside.tables import Tables

LINE = ["order_number", "line_number"]


def costed(t: Tables, backorders: DataFrame | None = None) -> DataFrame:
    """Backorders priced by the product of each matching delivery line."""
    source = t.backorders if backorders is None else backorders
    return source.join(
        t.delivery_lines.select(*LINE, "delivery_line_id", "sku"), LINE
    ).join(t.products.select("sku", "unit_price"), "sku")


def backorder_running_costs(t: Tables, *, segments: int | None = None) -> DataFrame:
    """Cumulative and trailing backorder cost over one global time order.

    The order has no partition key, so the sums are built from range segments
    plus the totals in front of each segment.
    """
    cost = F.round(F.col("backorder_qty") * F.col("unit_price"), 2)
    base = costed(t).select(
        "backorder_id", "delivery_line_id", *LINE, "product_id", "backorder_qty", "status",
        F.col("created_at").alias("backorder_date"),
        cost.alias("backorder_cost"),
        F.when(F.col("status") == "open", cost).otherwise(F.lit(0).cast("decimal(38,2)")).alias("open_cost"),
    )
    run = ordered_columns(
        base, [],
        [("backorder_date", True), ("backorder_id", True), ("delivery_line_id", True)],
        segments=segments,
        running={"open_so_far": ("open_cost", "sum"), "total_so_far": ("backorder_cost", "sum")},
        trailing={"last_7": ("backorder_cost", 7)},
    )
    return run.select(
        "backorder_id", *LINE, "product_id", "backorder_qty", "backorder_cost", "backorder_date",
        "status",
        F.round("open_so_far", 2).alias("cumulative_open_cost"),
        F.round("total_so_far", 2).alias("cumulative_total_cost"),
        F.round("last_7", 2).alias("rolling_7d_backorder_cost"),
    )


def vendor_backorder_totals(t: Tables) -> DataFrame:
    """Open backorder cost credited to every vendor shipping the order.

    Joining backorders with all delivery lines and all shipments of the order
    multiplies rows; here every side is first reduced to one row per order
    line, order, or (order, vendor), and counts take the place of copies.
    Order lines with a backorder are few; they are written, so that their size
    is known, and delivery lines and shipments of other orders move no further.
    """
    opened = t.backorders.where(F.col("status") == "open").groupBy(*LINE).agg(
        F.sum("backorder_qty").alias("qty"), F.count(F.lit(1)).alias("n"), F.max("created_at").alias("latest")
    )
    opened = stage(opened, "open-backorders")
    # What one unit of the order line costs over all deliveries of it.
    delivered = t.delivery_lines.join(opened.select(*LINE), LINE, "left_semi").groupBy(*LINE, "sku").agg(
        F.count(F.lit(1)).cast("decimal(10,0)").alias("times")
    )
    unit_cost = delivered.join(t.products.select("sku", "unit_price"), "sku").groupBy(*LINE).agg(
        F.sum(F.col("unit_price") * F.col("times")).cast("decimal(18,2)").alias("unit_cost")
    )
    per_order = opened.join(unit_cost, LINE).groupBy("order_number").agg(
        F.sum((F.col("qty") * F.col("unit_cost")).cast("decimal(28,2)")).alias("cost"),
        F.sum("n").alias("backorders"),
        F.max("latest").alias("latest"),
    )
    shipping = t.shipments.select("order_number", "vendor_code").join(
        opened.select("order_number"), "order_number", "left_semi"
    ).groupBy("order_number", "vendor_code").agg(
        F.count(F.lit(1)).cast("decimal(20,0)").alias("copies")
    )
    return (
        shipping.join(per_order, "order_number")
        .groupBy("vendor_code")
        .agg(
            F.sum(F.col("cost") * F.col("copies")).alias("total_open_backorder_cost"),
            F.sum("backorders").alias("open_backorder_count"),
            F.max("latest").alias("latest_backorder_date"),
        )
    )


def open_backorders(t: Tables) -> DataFrame:
    """Open backorders with sku, unit price and cost, one row each (price by order line)."""
    return price_lines(t, t.backorders.where(F.col("status") == "open"), "backorder_qty")


def open_cost_by_line(t: Tables, backorders: DataFrame | None = None) -> DataFrame:
    """Open quantity, cost and count per order line.

    Quantities are summed before the price look-up, so an order line with very
    many backorders reaches the joins as one row.
    """
    source = t.backorders if backorders is None else backorders
    per_line = source.where(F.col("status") == "open").groupBy(*LINE).agg(
        F.sum("backorder_qty").alias("qty"), F.count(F.lit(1)).alias("backorders"),
    )
    return price_lines(t, per_line, "qty")


def price_lines(t: Tables, rows: DataFrame, quantity: str) -> DataFrame:
    """``rows`` with sku, unit price and cost of their order line; it is unique, so no row is added."""
    return (
        rows.join(t.order_lines.select(*LINE, "sku"), LINE, "left")
        .join(t.products.select("sku", "unit_price"), "sku", "left")
        .withColumn("cost", F.coalesce(F.col(quantity) * F.col("unit_price"), F.lit(0)))
    )
