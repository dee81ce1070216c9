"""Failure streaks and order-state sequences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from dockside.config import SlaConfig
from dockside.functions.exprs import banded, days, flag
from dockside.operators.otif import LINE_KEY, days_back
from dockside.plans.ordered import ordered_columns
from dockside.tables import Tables


def consecutive_failures(ll: DataFrame) -> DataFrame:
    """Every failed line with the length class of the streak it closes."""
    lines = ll.select(
        "vendor_code", "actual_delivery_date", "shipment_number", "line_number",
        "is_otif", "is_on_time", "is_in_full",
    )
    ranked = ordered_columns(
        lines, ["vendor_code"], LINE_KEY,
        rank="delivery_rank",
        lags={"back_1": ("is_otif", 1), "back_2": ("is_otif", 2), "back_3": ("is_otif", 3)},
    )
    failed = [F.col(c) == 0 for c in ("back_1", "back_2", "back_3")]
    late, short = F.col("is_on_time") == 0, F.col("is_in_full") == 0
    return ranked.where(F.col("is_otif") == 0).select(
        "vendor_code", "actual_delivery_date", "delivery_rank", "is_otif",
        banded(
            [
                (failed[0] & failed[1] & failed[2], "4+ CONSECUTIVE FAILURES"),
                (failed[0] & failed[1], "3 CONSECUTIVE FAILURES"),
                (failed[0], "2 CONSECUTIVE FAILURES"),
            ],
            otherwise="SINGLE FAILURE",
        ).alias("failure_streak_label"),
        failure_reason(late, short).alias("failure_reason"),
    )


def failure_reason(late, short):
    return banded(
        [(late & short, "LATE + SHORT"), (late, "LATE"), (short, "SHORT")], otherwise="UNKNOWN"
    )


def failures_lead(ll: DataFrame) -> DataFrame:
    """Every line with a forward look at the vendor's next two."""
    lines = ll.select(
        "vendor_code", "actual_delivery_date", "shipment_number", "line_number", "is_otif"
    )
    ahead = ordered_columns(
        lines, ["vendor_code"], LINE_KEY,
        leads={"next_delivery_otif": ("is_otif", 1), "next_2": ("is_otif", 2)},
    )
    now, nxt, second = F.col("is_otif"), F.col("next_delivery_otif"), F.col("next_2")
    return ahead.select(
        "vendor_code", "actual_delivery_date", "is_otif", "next_delivery_otif",
        banded(
            [
                ((now == 0) & (nxt == 0), "IMMINENT_STREAK"),
                ((now == 0) & (nxt == 1), "RECOVERING"),
                ((now == 1) & (nxt == 0), "IMPENDING_FAILURE"),
            ],
            otherwise="STABLE",
        ).alias("forward_look_status"),
        F.when((now == 0) & (nxt == 0) & (second == 0), "ESCALATE").otherwise("MONITOR")
        .alias("escalation_flag"),
    )


def order_state_sequence(
    t: Tables, anchor: dt.date | None, cfg: SlaConfig = SlaConfig()
) -> DataFrame:
    """Order rows with the previous state, a stall flag and a rush flag."""
    orders = t.orders.select(
        "order_id", "order_number", "order_status", "order_date", "requested_delivery_date"
    )
    seq = ordered_columns(
        orders, ["order_number"], [("order_date", False), ("order_id", False)],
        leads={"previous_status": ("order_status", 1)},
    )
    limit = F.lit(days_back(anchor, cfg.stall_days)).cast("date")
    return seq.select(
        "order_number", "order_status", "order_date", "requested_delivery_date", "previous_status",
        flag(F.col("order_status").isin("pending", "confirmed") & (F.col("order_date") < limit))
        .alias("is_stalled"),
        flag(days("order_date", "requested_delivery_date") <= cfg.rush_days).alias("is_rush_order"),
    )
