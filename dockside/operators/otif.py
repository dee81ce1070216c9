"""On-time / in-full flags and the rolled-up views over them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from dockside.config import SlaConfig
from dockside.functions.exprs import at_least, flag, pct, pct2, round_to, week_of
from dockside.plans.staging import stage
from dockside.tables import Tables

LINE_KEY = [("actual_delivery_date", True), ("shipment_number", True), ("line_number", True)]


def line_level(
    t: Tables, cfg: SlaConfig = SlaConfig(), *, null_damage: str = "unknown", since: dt.date | None = None,
    newest: str | None = None,
) -> DataFrame:
    """One row per delivered line with its on-time, in-full and combined flags.

    The whole history is joined in a bushy shape: order lines take the dates
    of their order, delivery lines meet them, and the wide shipments come
    last, so they travel once, straight from their scan.  With ``since`` the
    few recent headers (shipment with order) go first and cut the delivery
    lines before order lines are looked up.  Either way every join reads two
    fresh exchanges, so adaptive execution can split a hot order, line or
    shipment.

    null_damage  'unknown' leaves in-full false when damage is missing (the
                 combined flag still counts it as zero); 'zero' counts it as
                 zero in both, as the portable variant does.
    since        keep deliveries on or after this day; the bound is a literal
                 and reaches the shipments scan.
    newest       a number that the rows of all four tables carry; a line gets
                 the greatest of its own.
    """
    carried = lambda name: [F.col(newest).alias(f"_{newest}_of_{name}")] if newest else []
    shipped = t.shipments.where(F.col("actual_delivery_date").isNotNull())
    if since is not None:
        shipped = shipped.where(F.col("actual_delivery_date") >= F.lit(since))
    shipped = shipped.select(
        "shipment_id", "shipment_number", "order_number", "carrier_code", "carrier_name",
        "carrier_mode", "vendor_code", "vendor_region", "shipping_point", "route",
        "actual_ship_date", "actual_delivery_date", *carried("shipment"),
    )
    dates = t.orders.select(
        "order_number", "order_date", F.col("requested_delivery_date").alias("requested_date"), *carried("order")
    )
    delivered = t.delivery_lines.select(
        "shipment_number", "order_number", "line_number", "delivered_qty", "damage_qty", *carried("delivery")
    )
    ordered = t.order_lines.select(
        "order_number", "line_number", "sku", "category", "ordered_qty", "confirmed_qty", "unit_price", *carried("line")
    )
    shipment, line = ["shipment_number", "order_number"], ["order_number", "line_number"]
    if since is None:
        rows = shipped.join(delivered.join(ordered.join(dates, "order_number"), line), shipment)
    else:
        rows = delivered.join(shipped.join(dates, "order_number"), shipment).join(ordered, line)

    due, came = F.col("requested_date"), F.col("actual_delivery_date")
    on_time = (came <= due) & (came >= F.date_sub(due, cfg.early_tolerance_days))
    sound = F.col("delivered_qty") - F.coalesce(F.col("damage_qty"), F.lit(0))
    counted = sound if null_damage == "zero" else F.col("delivered_qty") - F.col("damage_qty")
    return rows.select(
        "shipment_id", "shipment_number", "order_number", "carrier_code", "carrier_name",
        "carrier_mode", "vendor_code", "vendor_region", "shipping_point", "route", "order_date",
        "requested_date", "actual_ship_date", "actual_delivery_date", "line_number", "sku",
        "category", "ordered_qty", "confirmed_qty", "delivered_qty", "damage_qty",
        flag(on_time).alias("is_on_time"),
        flag(counted >= F.col("ordered_qty")).alias("is_in_full"),
        flag(on_time & (sound >= F.col("ordered_qty"))).alias("is_otif"),
        ((F.col("ordered_qty") - F.coalesce(F.col("delivered_qty"), F.lit(0))) * F.col("unit_price"))
        .alias("backorder_value"),
        *([F.greatest(*[f"_{newest}_of_{x}" for x in ("shipment", "order", "delivery", "line")]).alias(newest)] if newest else []),
    )


def date_anchor(ll: DataFrame, cfg: SlaConfig = SlaConfig()) -> DataFrame:
    """One row: the newest delivery date and the three window starts."""
    newest = ll.agg(F.max("actual_delivery_date").alias("max_delivery_date"))
    top = F.col("max_delivery_date")
    return newest.select(
        top,
        F.date_sub(top, cfg.lookback_short_days).alias("window_start_30d"),
        F.date_sub(top, cfg.lookback_days).alias("window_start_90d"),
        F.date_sub(top, cfg.lookback_long_days).alias("window_start_180d"),
    )


def anchor_date(t: Tables, cfg: SlaConfig = SlaConfig()) -> dt.date | None:
    """The newest delivery date, found without joining the whole history.

    Tries the newest days of shipments first and widens fourfold until a
    delivered line turns up, so the usual cost is one narrow slice.  What is
    left after each look-up is written, so its size is known and the large
    tables are scanned past it, not exchanged, while it is small.
    """
    span = t.shipments.agg(
        F.max("actual_delivery_date").alias("hi"), F.min("actual_delivery_date").alias("lo")
    ).first()
    if span.hi is None:
        return None
    width, day = 2, "actual_delivery_date"
    while True:
        since = span.hi - dt.timedelta(days=width)
        left = stage(
            t.shipments.where(F.col(day) >= F.lit(since)).select("shipment_number", "order_number", day).distinct(), "newest-shipments"
        )
        for table, keys, kept in (
            (t.delivery_lines, ["shipment_number", "order_number"], ["order_number", "line_number", day]),
            (t.order_lines, ["order_number", "line_number"], ["order_number", day]),
        ):
            left = stage(table.select(*keys, *[c for c in kept if c not in [*keys, day]]).join(left, keys).select(*kept).distinct(), "newest-lines")
        found = t.orders.select("order_number").join(left, "order_number").agg(F.max(day)).first()[0]
        if found is not None or since <= span.lo:
            return found
        width *= 4


MONTH = "delivery_month"


def _since(ll: DataFrame, day: dt.date | None) -> DataFrame:
    """Lines from ``day`` on; where they lie in folders by month, earlier months are not opened."""
    if day is None:
        return ll
    if MONTH in ll.columns:
        ll = ll.where(F.col(MONTH) >= F.lit(day.replace(day=1))).drop(MONTH)
    return ll.where(F.col("actual_delivery_date") >= F.lit(day))


def days_back(anchor: dt.date | None, days: int | None) -> dt.date | None:
    return None if anchor is None or days is None else anchor - dt.timedelta(days=days)


def rolling_active_days(
    ll: DataFrame, anchor: dt.date | None, cfg: SlaConfig = SlaConfig(), *, lookback_days: int | None = -1
) -> DataFrame:
    """Daily figures per vendor with a frame of seven *delivery* days.

    ``lookback_days=None`` keeps the whole history (portable variant).
    """
    back = cfg.lookback_days if lookback_days == -1 else lookback_days
    daily = (
        _since(ll, days_back(anchor, back))
        .groupBy("vendor_code", "vendor_region", F.col("actual_delivery_date").alias("metric_date"))
        .agg(
            F.count(F.lit(1)).alias("total_lines"),
            F.sum("is_on_time").alias("on_time_lines"),
            F.sum("is_in_full").alias("in_full_lines"),
            F.sum("is_otif").alias("otif_lines"),
            F.sum("backorder_value").alias("backorder_value_total"),
        )
    )
    # A vendor has one row per delivery day here, so the window stays small.
    frame = (
        Window.partitionBy("vendor_code").orderBy("metric_date", "vendor_region").rowsBetween(-6, 0)
    )
    return daily.select(
        "vendor_code", "vendor_region", "metric_date", "total_lines", "on_time_lines",
        "in_full_lines", "otif_lines",
        pct2("otif_lines", "total_lines").alias("otif_pct"),
        pct2("on_time_lines", "total_lines").alias("on_time_pct"),
        pct2("in_full_lines", "total_lines").alias("in_full_pct"),
        round_to(F.avg(pct("otif_lines", "total_lines")).over(frame), 2).alias("rolling_7d_otif_pct"),
        F.sum("total_lines").over(frame).alias("rolling_7d_line_count"),
        F.round(F.sum("backorder_value_total").over(frame), 2).alias("rolling_7d_backorder_cost"),
    )


def rolling_active_month(rolling_7d: DataFrame) -> DataFrame:
    """The same daily figures with a frame of thirty delivery days."""
    frame = (
        Window.partitionBy("vendor_code").orderBy("metric_date", "vendor_region").rowsBetween(-29, 0)
    )
    return rolling_7d.select(
        "vendor_code", "vendor_region", "metric_date", "total_lines", "otif_lines",
        "on_time_lines", "in_full_lines", "otif_pct", "on_time_pct", "in_full_pct",
        round_to(F.avg(pct("otif_lines", "total_lines")).over(frame), 2).alias("rolling_30d_otif_pct"),
        F.sum("total_lines").over(frame).alias("rolling_30d_line_count"),
    )


def _whole(x: Column) -> Column:
    return x.cast("decimal(20,0)")


def vendor_hierarchy(
    t: Tables, ll: DataFrame, cfg: SlaConfig = SlaConfig(), *, mode: str = "exact"
) -> DataFrame:
    """Vendor totals, OTIF share, rank in region and service status.

    Order lines, delivery lines and flagged lines hang off a shipment
    independently, so a plain join multiplies them with each other.
    ``exact`` gives the totals of that join without building it: every branch
    is summed per shipment and weighted by the row counts of the others.
    ``dedupe`` counts each line once.

    Shipments shrink to one row per (order, vendor) before they meet the
    orders: a hot order then has at most one row per vendor, and orders and
    shipments are counted without a distinct.
    """
    delivered = t.delivery_lines.groupBy("shipment_number").agg(
        F.count(F.lit(1)).alias("c2"), F.sum("delivered_qty").alias("q2")
    )
    flagged = ll.groupBy("shipment_id").agg(
        F.count("is_otif").alias("c3"), F.sum("is_otif").alias("passed")
    )

    def seen(c):  # rows a branch contributes to the outer join: at least one
        return F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(1))

    exact = mode == "exact"
    one = F.lit(1)
    pairs = (
        t.shipments.select("shipment_id", "shipment_number", "order_number", "vendor_code")
        .join(delivered, "shipment_number", "left")
        .join(flagged, "shipment_id", "left")
        .groupBy("order_number", "vendor_code")
        .agg(
            F.count("shipment_id").alias("shipments"),
            F.sum(seen("c2") * seen("c3") if exact else one).alias("w_ordered"),
            F.sum(F.col("q2") * _whole(seen("c3") if exact else one)).alias("delivered"),
            F.sum(F.col("passed") * (seen("c2") if exact else one)).alias("passed"),
            F.sum(F.col("c3") * (seen("c2") if exact else one)).alias("flagged"),
        )
    )
    order_side = (
        t.orders.groupBy("order_number").agg(F.count(F.lit(1)).alias("c0"))
        .join(
            t.order_lines.groupBy("order_number").agg(
                F.count(F.lit(1)).alias("c1"), F.sum("ordered_qty").alias("q1")
            ),
            "order_number",
            "left",
        )
    )
    known = F.col("c0").isNotNull()
    copies = F.when(known, F.col("c0") * seen("c1")).otherwise(one) if exact else one
    per_order = F.col("c0") * F.col("w_ordered") if exact else F.col("shipments")
    totals = pairs.join(order_side, "order_number", "left").groupBy("vendor_code").agg(
        F.sum(F.col("q1") * _whole(per_order)).alias("ordered"),
        F.sum(F.col("delivered") * _whole(copies)).alias("delivered"),
        F.sum("shipments").alias("shipments"),
        F.sum(flag(known)).alias("orders"),
        F.sum(F.col("passed") * copies).alias("passed"),
        F.sum(F.col("flagged") * copies).alias("flagged"),
    )
    masters = t.vendors.groupBy(
        "vendor_code", "vendor_name", F.col("region").alias("vendor_region"), "tier"
    ).agg(F.count(F.lit(1)).alias("copies"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    share = pct("passed", "flagged")
    rank = Window.partitionBy("vendor_region").orderBy(share.desc_nulls_last(), "vendor_code")
    return masters.join(totals, "vendor_code", "left").select(
        "vendor_code", "vendor_name", "vendor_region", "tier",
        (zero("ordered") * F.col("copies")).alias("total_ordered_qty"),
        (zero("delivered") * F.col("copies")).alias("total_delivered_qty"),
        zero("shipments").alias("total_shipments"),
        zero("orders").alias("total_orders"),
        round_to(share, 2).alias("overall_otif_pct"),
        F.row_number().over(rank).alias("rank_in_region"),
        at_least(
            share,
            (cfg.vendor_exceeding, "EXCEEDING"),
            (cfg.vendor_meeting, "MEETING"),
            (cfg.vendor_at_risk, "AT_RISK"),
            otherwise="CRITICAL",
        ).alias("sla_status"),
    )


def geographic(ll: DataFrame) -> DataFrame:
    """OTIF by shipping point, region and carrier mode, ranked overall."""
    grouped = ll.groupBy("shipping_point", "vendor_region", "carrier_mode").agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.sum("is_otif").alias("otif_pass_count"),
        F.sum("is_on_time").alias("on_time_count"),
        F.sum("is_in_full").alias("in_full_count"),
    )
    rank = Window.orderBy(
        pct("otif_pass_count", "total_lines").desc_nulls_last(),
        "shipping_point", "vendor_region", "carrier_mode",
    )
    return grouped.select(
        "*",
        pct2("otif_pass_count", "total_lines").alias("otif_pct"),
        pct2("on_time_count", "total_lines").alias("on_time_pct"),
        pct2("in_full_count", "total_lines").alias("in_full_pct"),
        F.row_number().over(rank).alias("rank"),
    )


def carrier_scorecard(ll: DataFrame, anchor: dt.date | None, cfg: SlaConfig = SlaConfig()) -> DataFrame:
    """Weekly on-time share per carrier with a frame of four weekly rows."""
    weekly = (
        _since(ll, days_back(anchor, cfg.lookback_long_days))
        .groupBy(
            "carrier_code", "carrier_name", "carrier_mode",
            week_of("actual_delivery_date").alias("delivery_week"),
        )
        .agg(F.count(F.lit(1)).alias("total_deliveries"), F.sum("is_on_time").alias("on_time_count"))
    )
    frame = (
        Window.partitionBy("carrier_code")
        .orderBy("delivery_week", "carrier_name", "carrier_mode").rowsBetween(-3, 0)
    )
    return weekly.select(
        "*",
        pct2("on_time_count", "total_deliveries").alias("on_time_pct"),
        round_to(F.avg(pct("on_time_count", "total_deliveries")).over(frame), 2)
        .alias("rolling_4wk_on_time_pct"),
    )


def top_failing_vendors(ll: DataFrame, limit: int = 5) -> DataFrame:
    """Vendors with the most failed lines."""
    return (
        ll.where(F.col("is_otif") == 0)
        .groupBy("vendor_code")
        .agg(F.count(F.lit(1)).alias("failures"))
        .orderBy(F.desc("failures"), "vendor_code")
        .limit(limit)
    )
