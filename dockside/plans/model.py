"""Wires the operators over one table bundle, sharing what several of them need."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from dockside.config import SlaConfig
from dockside.operators import alerts, backorders, dwell, otif, sequences
from dockside.operators.cube import Cube
from dockside.plans.staging import stage
from dockside.tables import Tables


# What the alert views and the snapshots read of the line level.
SNAPSHOT_COLUMNS = [
    "shipment_id", "shipment_number", "line_number", "vendor_code", "vendor_region", "carrier_code",
    "carrier_name", "carrier_mode", "actual_delivery_date", "is_on_time", "is_in_full", "is_otif",
    "backorder_value",
]


# What the alert views alone read of it.
ALERT_COLUMNS = [c for c in SNAPSHOT_COLUMNS if c != "shipment_id"]


class FulfilmentModel:
    """The named views over ``tables``.

    The line level is used by most views.  ``shared=True`` writes it once to
    the shared folder and lets every view scan only the columns it needs;
    ``shared=False`` leaves it as a plain lazy join, which is right when a
    single view is wanted.  ``keep`` limits the columns that are written.
    """

    def __init__(
        self, tables: Tables, cfg: SlaConfig = SlaConfig(), *, shared: bool = False,
        keep: list[str] | None = None,
    ):
        self.tables = tables
        self.cfg = cfg
        self.shared = shared
        self.keep = keep

    @classmethod
    def for_snapshots(cls, tables: Tables, cfg: SlaConfig = SlaConfig()) -> "FulfilmentModel":
        """A model that shares just what alerts and snapshots need."""
        return cls(tables, cfg, shared=True, keep=SNAPSHOT_COLUMNS)

    @classmethod
    def for_alerts(cls, tables: Tables, cfg: SlaConfig = SlaConfig()) -> "FulfilmentModel":
        """A model that shares just what alerts need."""
        return cls(tables, cfg, shared=True, keep=ALERT_COLUMNS)

    @cached_property
    def line_level(self) -> DataFrame:
        return self._by_day.drop(otif.MONTH) if self.shared else otif.line_level(self.tables, self.cfg)

    @cached_property
    def _by_day(self) -> DataFrame:
        """The shared line level, each file sorted by day of delivery, so that recent days are read by their pages.

        Folders by month would move every line once more.
        """
        ll = otif.line_level(self.tables, self.cfg)
        ll = ll.select(*self.keep) if self.keep else ll
        return stage(ll.sortWithinPartitions("actual_delivery_date"), "line-level")

    @cached_property
    def cube(self) -> Cube:
        """Additive figures by day and slice, written once for all measures that are read off them."""
        return Cube.build(self.tables, self.cfg)

    @cached_property
    def anchor(self) -> dt.date | None:
        if self.shared:
            return otif.date_anchor(self.line_level, self.cfg).first()["max_delivery_date"]
        return otif.anchor_date(self.tables, self.cfg)

    def _recent(self, days: int) -> DataFrame:
        """Line level from ``days`` before the anchor; the bound reaches the scan."""
        since = otif.days_back(self.anchor, days)
        if self.shared:
            return otif._since(self._by_day, since)
        return otif.line_level(self.tables, self.cfg, since=since)

    @property
    def rolling_7d(self) -> DataFrame:
        return otif.rolling_active_days(self._recent(self.cfg.lookback_days), self.anchor, self.cfg)

    @property
    def rolling_30d(self) -> DataFrame:
        return otif.rolling_active_month(self.rolling_7d)

    @property
    def vendor_hierarchy(self) -> DataFrame:
        return otif.vendor_hierarchy(self.tables, self.line_level, self.cfg)

    @property
    def geographic(self) -> DataFrame:
        return otif.geographic(self.line_level)

    @property
    def carrier_scorecard(self) -> DataFrame:
        return otif.carrier_scorecard(self._recent(self.cfg.lookback_long_days), self.anchor, self.cfg)

    @property
    def consecutive_failures(self) -> DataFrame:
        return sequences.consecutive_failures(self.line_level)

    @property
    def failures_lead(self) -> DataFrame:
        return sequences.failures_lead(self.line_level)

    @property
    def dwell_times(self) -> DataFrame:
        return dwell.dwell_times(self.tables)

    @property
    def dwell_time_trends(self) -> DataFrame:
        return dwell.dwell_time_trends(self.dwell_times)

    @property
    def backorder_running_costs(self) -> DataFrame:
        return backorders.backorder_running_costs(self.tables)

    @property
    def order_state_sequence(self) -> DataFrame:
        return sequences.order_state_sequence(self.tables, self.anchor, self.cfg)

    # The short alert views come in the order in which they are read; the summary takes them as they are.
    def _alerts(self) -> dict[str, DataFrame]:
        return {
            "otif": alerts.otif_below_threshold(self.rolling_7d, self.anchor, self.cfg),
            "backorder": alerts.backorder_threshold(self.tables, self.cfg),
            "failures": alerts.consecutive_failure_alerts(self.consecutive_failures),
            "carriers": alerts.carrier_performance(self.carrier_scorecard, self.anchor, self.cfg),
            "spikes": dwell.dwell_time_spikes(self.dwell_time_trends, self.anchor, self.cfg),
        }

    @property
    def alert_otif(self) -> DataFrame:
        rows = alerts.otif_below_threshold(self.rolling_7d, self.anchor, self.cfg)
        return rows.orderBy("gap_to_threshold", "vendor_code")

    @property
    def alert_backorder(self) -> DataFrame:
        rows = alerts.backorder_threshold(self.tables, self.cfg)
        return rows.orderBy(F.desc("total_open_backorder_cost"), "vendor_code")

    @property
    def alert_failures(self) -> DataFrame:
        return alerts.consecutive_failure_alerts(self.consecutive_failures)

    @property
    def alert_carrier(self) -> DataFrame:
        rows = alerts.carrier_performance(self.carrier_scorecard, self.anchor, self.cfg)
        return rows.orderBy("rolling_4wk_on_time_pct", "carrier_code")

    @property
    def alert_dwell(self) -> DataFrame:
        rows = dwell.dwell_time_spikes(self.dwell_time_trends, self.anchor, self.cfg)
        return rows.orderBy(F.desc("order_week"))

    @property
    def alert_summary(self) -> DataFrame:
        return alerts.dashboard_summary(**self._alerts(), cfg=self.cfg)

    def views(self) -> dict[str, DataFrame]:
        """Every view by name, ready for ``createOrReplaceTempView``."""
        names = [
            "line_level", "rolling_7d", "rolling_30d", "vendor_hierarchy", "geographic",
            "carrier_scorecard", "consecutive_failures", "failures_lead", "dwell_times",
            "dwell_time_trends", "backorder_running_costs", "order_state_sequence", "alert_otif",
            "alert_backorder", "alert_failures", "alert_carrier", "alert_dwell", "alert_summary",
        ]
        return {n: getattr(self, n) for n in names}
