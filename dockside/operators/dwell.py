"""Time spent between the milestones of an order."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from dockside.config import SlaConfig
from dockside.functions.exprs import days, flag, pct, round_to, week_of
from dockside.operators.otif import days_back
from dockside.tables import Tables


def dwell_times(t: Tables) -> DataFrame:
    """One row per order with its milestone distances in days.

    Shipments shrink to one row per order before the join, so a hot order
    costs nothing past the map side.
    """
    firsts = t.shipments.groupBy("order_number").agg(
        F.min("planned_ship_date").alias("planned_ship_date"),
        F.min("actual_ship_date").alias("actual_ship_date"),
        F.min("actual_delivery_date").alias("actual_delivery_date"),
    )
    orders = t.orders.select("order_number", "order_date", "requested_delivery_date").distinct()
    return orders.join(firsts, "order_number", "left").select(
        "order_number", "order_date", "requested_delivery_date", "actual_ship_date",
        "actual_delivery_date",
        days("order_date", "actual_ship_date").alias("order_to_ship_days"),
        days("actual_ship_date", "actual_delivery_date").alias("ship_to_delivery_days"),
        days("planned_ship_date", "actual_ship_date").alias("ship_variance_days"),
        days("order_date", "actual_delivery_date").alias("total_lead_time_days"),
        flag(F.col("actual_delivery_date") > F.col("requested_delivery_date")).alias("is_delayed"),
    )


def dwell_time_trends(dwell: DataFrame) -> DataFrame:
    """Weekly averages with a frame of four weekly rows."""
    weekly = dwell.groupBy(week_of("order_date").alias("order_week")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.avg("order_to_ship_days").alias("to_ship"),
        F.avg("ship_to_delivery_days").alias("to_door"),
        F.avg("total_lead_time_days").alias("lead_time"),
        F.avg("ship_variance_days").alias("variance"),
        F.sum("is_delayed").alias("delayed"),
    )
    # One row per calendar week: an unpartitioned window is safe here.
    frame = Window.orderBy("order_week").rowsBetween(-3, 0)
    return weekly.select(
        "order_week", "order_count",
        round_to(F.col("to_ship"), 1).alias("avg_order_to_ship"),
        round_to(F.col("to_door"), 1).alias("avg_ship_to_delivery"),
        round_to(F.col("lead_time"), 1).alias("avg_total_lead_time"),
        round_to(F.col("variance"), 1).alias("avg_ship_variance"),
        round_to(F.avg("to_ship").over(frame), 1).alias("rolling_4wk_order_to_ship"),
        round_to(F.avg("to_door").over(frame), 1).alias("rolling_4wk_ship_to_delivery"),
        round_to(pct("delayed", "order_count"), 1).alias("delay_rate_pct"),
    )


def dwell_time_spikes(
    trends: DataFrame, anchor: dt.date | None, cfg: SlaConfig = SlaConfig()
) -> DataFrame:
    """Recent weeks whose average lead time jumped against the week before."""
    by_week = Window.orderBy("order_week")
    now, prev = F.col("avg_total_lead_time"), F.col("prev_avg_lead_time")
    change = (now - prev) / prev
    # Averages carry one decimal, so the nudge only absorbs binary noise.
    limit = cfg.dwell_spike + 1e-9
    return (
        trends.withColumn("prev_avg_lead_time", F.lag("avg_total_lead_time", 1).over(by_week))
        .where(F.col("order_week") >= F.lit(days_back(anchor, cfg.lookback_short_days)).cast("date"))
        # CASE keeps the division away from zero and negative baselines.
        .where(F.when(prev > 0, change > limit).otherwise(False))
        .select(
            "order_week", "avg_total_lead_time", "avg_order_to_ship", "avg_ship_to_delivery",
            "prev_avg_lead_time",
            round_to(F.lit(100.0) * (now - prev) / prev, 1).alias("lead_time_wow_pct_change"),
            F.lit("SPIKE_DETECTED").alias("lead_time_alert"),
            F.lit(anchor).cast("date").alias("alert_generated_at"),
        )
    )


def dwell_outliers(trends: DataFrame, cfg: SlaConfig = SlaConfig()) -> DataFrame:
    """Weeks in which a dwell stage stayed above its limit for several weeks."""
    weeks = cfg.dwell_sustained_weeks
    frame = Window.partitionBy("stage").orderBy("order_week").rowsBetween(-(weeks - 1), 0)
    stages = trends.select(
        "order_week",
        F.explode(
            F.array(
                _stage("ORDER_TO_SHIP", "avg_order_to_ship", cfg.dwell_order_to_ship_days),
                _stage("SHIP_TO_DELIVERY", "avg_ship_to_delivery", cfg.dwell_ship_to_delivery_days),
                _stage("TOTAL_LEAD_TIME", "avg_total_lead_time", cfg.dwell_total_days),
            )
        ).alias("s"),
    ).select("order_week", "s.stage", "s.average", "s.outlier_limit")
    over = flag(F.col("average") > F.col("outlier_limit"))
    return (
        stages.withColumn("weeks_over", F.sum(over).over(frame))
        .where(F.col("weeks_over") == weeks)
        .select("order_week", "stage", "average", "outlier_limit")
    )


def _stage(name: str, column: str, limit: float):
    return F.struct(
        F.lit(name).alias("stage"), F.col(column).alias("average"), F.lit(limit).alias("outlier_limit")
    )
