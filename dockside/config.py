"""Service-level thresholds in one place; operators never carry literals."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class SlaConfig:
    # Service targets, in percent.
    otif_target: float = 92.0
    otif_breached: float = 92.0  # 88 separates a warning band below the target
    otif_critical: float = 85.0
    strategic_target: float = 95.0
    peak_target: float = 88.0
    on_time_target: float = 95.0
    in_full_target: float = 98.0
    vendor_exceeding: float = 95.0
    vendor_meeting: float = 92.0
    vendor_at_risk: float = 85.0
    carrier_target: float = 85.0
    carrier_critical: float = 80.0
    # Money limits for open backorders.
    backorder_vendor_limit: float = 10_000.0
    backorder_aggregate_limit: float = 50_000.0
    # Day windows.
    early_tolerance_days: int = 1
    lookback_short_days: int = 30
    lookback_days: int = 90
    lookback_long_days: int = 180
    stall_days: int = 14
    rush_days: int = 3
    # Trends, dwell baselines and streaks.
    dwell_spike: float = 0.50
    trend_band: float = 0.01
    trend_decline: float = 0.05
    streak_limit: int = 2
    dwell_order_to_ship_days: float = 5.0
    dwell_ship_to_delivery_days: float = 7.0
    dwell_total_days: float = 10.0
    dwell_sustained_weeks: int = 2
    # Alert handling.
    escalation_minutes: int = 30
    repeat_window_hours: int = 24
    repeat_critical_count: int = 2
    cooldown_hours: int = 6
    streak_cooldown_hours: int = 1
    def but(self, **changes) -> "SlaConfig":
        return replace(self, **changes)
