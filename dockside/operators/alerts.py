"""Rows that breach a threshold, and their union."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from dockside.config import SlaConfig
from dockside.functions.exprs import banded, below, round_to
from dockside.operators.backorders import vendor_backorder_totals
from dockside.tables import Tables


def _latest(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    # row_number() == 1 becomes a group limit: one row per key leaves each task.
    first = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") == 1).drop("_rn")


def otif_below_threshold(
    rolling_7d: DataFrame, anchor: dt.date | None, cfg: SlaConfig = SlaConfig(), *,
    portable: bool = False, targets: DataFrame | None = None,
) -> DataFrame:
    """Vendors whose latest rolling OTIF share is under target.

    ``targets`` (vendor_code, target in percent) replaces the default target of
    the vendors it lists: tighter for strategic partners, looser in a peak.
    """
    share = F.col("rolling_7d_otif_pct")
    rows = _latest(rolling_7d, "vendor_code", [F.desc("metric_date"), F.desc("vendor_region")])
    target, breached = F.lit(cfg.otif_target), F.lit(cfg.otif_breached)
    if targets is not None:
        own = targets.groupBy("vendor_code").agg(F.max("target").alias("_target"))
        rows = rows.join(own, "vendor_code", "left")
        target = F.coalesce("_target", target)
        breached = F.coalesce("_target", breached)
    cols = [
        F.col("vendor_code"),
        F.col("vendor_region"),
        F.col("metric_date").alias("last_metric_date"),
        share,
        F.col("rolling_7d_line_count"),
        F.col("rolling_7d_backorder_cost"),
        target.alias("sla_threshold"),
        round_to(target - share, 2).alias("gap_to_threshold"),
        banded(
            [(share < cfg.otif_critical, "CRITICAL"), (share < breached, "BREACHED")], otherwise="WARNING"
        ).alias("alert_severity"),
    ]
    if not portable:
        cols.append(F.lit(anchor).cast("date").alias("alert_generated_at"))
    return rows.where(share < target).select(*cols)


def backorder_threshold(
    t: Tables, cfg: SlaConfig = SlaConfig(), *, scope: str = "vendor"
) -> DataFrame:
    """Vendors whose open backorder cost reaches a limit.

    ``scope='aggregate'`` tests the upper limit against the sum over all
    vendors instead of each vendor's own cost.
    """
    totals = vendor_backorder_totals(t)
    cost = F.col("total_open_backorder_cost")
    upper = cost
    if scope == "aggregate":
        upper = vendor_backorder_totals(t).agg(F.sum(cost)).scalar()
    over = upper >= F.lit(cfg.backorder_aggregate_limit).cast("decimal(18,2)")
    near = cost >= F.lit(cfg.backorder_vendor_limit).cast("decimal(18,2)")
    return totals.where(near).select(
        "vendor_code",
        F.round(cost, 2).alias("total_open_backorder_cost"),
        "open_backorder_count",
        "latest_backorder_date",
        F.lit(cfg.backorder_vendor_limit).alias("vendor_threshold"),
        F.lit(cfg.backorder_aggregate_limit).alias("aggregate_threshold"),
        banded([(over, "CRITICAL"), (near, "EXCEEDED")], otherwise="WITHIN_LIMITS").alias("alert_severity"),
        banded(
            [
                (over, f"Aggregate backorder cost exceeds {_short(cfg.backorder_aggregate_limit)}"),
                (near, f"Vendor backorder cost exceeds {_short(cfg.backorder_vendor_limit)}"),
            ],
            otherwise="NONE",
        ).alias("alert_reason"),
        F.col("latest_backorder_date").alias("alert_generated_at"),
    )


def _short(amount: float) -> str:
    return f"${amount / 1000:g}K"


def consecutive_failure_alerts(failures: DataFrame) -> DataFrame:
    """Failures that close a streak of three or more."""
    label = F.col("failure_streak_label")
    return failures.where(label.isin("3 CONSECUTIVE FAILURES", "4+ CONSECUTIVE FAILURES")).select(
        "vendor_code", "actual_delivery_date", "delivery_rank", "failure_streak_label",
        "failure_reason",
        banded(
            [(label.like("4+%"), "CRITICAL"), (label.like("3 %"), "HIGH"), (label.like("2 %"), "WARNING")],
            otherwise="INFO",
        ).alias("alert_severity"),
        F.col("actual_delivery_date").alias("alert_generated_at"),
    )


def carrier_performance(
    scorecard: DataFrame, anchor: dt.date | None, cfg: SlaConfig = SlaConfig()
) -> DataFrame:
    """Carriers whose latest four-week on-time share is under target."""
    share = F.col("rolling_4wk_on_time_pct")
    rows = _latest(
        scorecard, "carrier_code", [F.desc("delivery_week"), F.desc("carrier_name"), F.desc("carrier_mode")]
    )
    return rows.where(share < cfg.carrier_target).select(
        "carrier_code", "carrier_name", "carrier_mode", "delivery_week", share,
        F.lit(cfg.carrier_target).alias("carrier_sla_threshold"),
        below(share, (cfg.carrier_critical, "CRITICAL"), (cfg.carrier_target, "BREACHED"), otherwise="WARNING")
        .alias("alert_severity"),
        F.lit(anchor).cast("date").alias("alert_generated_at"),
    )


def dashboard_summary(
    otif: DataFrame, backorder: DataFrame, failures: DataFrame, carriers: DataFrame, spikes: DataFrame,
    cfg: SlaConfig = SlaConfig(),
) -> DataFrame:
    """All alert kinds in one shape: doubles for figures, timestamps for times."""

    def shaped(df, kind, entity, severity, value, limit, gap, at, made, text):
        return df.select(
            F.lit(kind).alias("alert_type"),
            entity.alias("entity"),
            severity.alias("alert_severity"),
            value.cast("double").alias("metric_value"),
            limit.cast("double").alias("sla_threshold"),
            round_to(gap, 2).alias("gap_to_threshold"),
            at.cast("timestamp_ntz").alias("event_date"),
            made.cast("timestamp_ntz").alias("alert_generated_at"),
            text.alias("alert_description"),
        )

    c = F.col
    change = c("lead_time_wow_pct_change")
    parts = [
        shaped(
            otif, "OTIF_THRESHOLD", c("vendor_code"), c("alert_severity"), c("rolling_7d_otif_pct"),
            c("sla_threshold"), c("gap_to_threshold"), c("last_metric_date"), c("alert_generated_at"),
            F.lit(f"Rolling 7-day OTIF below {cfg.otif_target:g}% SLA"),
        ),
        shaped(
            backorder, "BACKORDER_COST", c("vendor_code"), c("alert_severity"),
            c("total_open_backorder_cost"), c("vendor_threshold"),
            c("total_open_backorder_cost") - c("vendor_threshold"), c("latest_backorder_date"),
            c("alert_generated_at"), c("alert_reason"),
        ),
        shaped(
            failures, "CONSECUTIVE_FAILURES", c("vendor_code"), c("alert_severity"), c("delivery_rank"),
            F.lit(0), F.lit(0), c("actual_delivery_date"), c("alert_generated_at"),
            F.concat(c("failure_streak_label"), F.lit(": "), c("failure_reason")),
        ),
        shaped(
            carriers, "CARRIER_PERFORMANCE", c("carrier_code"), c("alert_severity"),
            c("rolling_4wk_on_time_pct"), c("carrier_sla_threshold"),
            c("carrier_sla_threshold") - c("rolling_4wk_on_time_pct"), c("delivery_week"),
            c("alert_generated_at"),
            F.concat(c("carrier_name"), F.lit(" ("), c("carrier_mode"), F.lit(") below carrier SLA")),
        ),
        shaped(
            spikes, "DWELL_TIME_SPIKE", F.lit("GLOBAL"), F.lit("WARNING"), c("avg_total_lead_time"),
            c("prev_avg_lead_time"), change, c("order_week"), c("alert_generated_at"),
            F.concat(F.lit("Lead time spike: "), change.cast("decimal(18,1)").cast("string"),
                     F.lit("% week-over-week")),
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
