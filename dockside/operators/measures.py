"""Business measures over any slice: one function per measure name.

A measure returns the slice columns plus ``value``.  Slices live on shipments;
a delivery line takes its shipment's, an order the ones of its shipments, and
a backorder those of every vendor that shipped its order line.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from dockside.config import SlaConfig
from dockside.functions.exprs import at_least, banded, days, divide, flag
from dockside.operators.backorders import LINE, open_cost_by_line, price_lines
from dockside.plans.ordered import same_keys
from dockside.plans.staging import stage
from dockside.tables import Tables

SLICES = [
    "vendor_code", "vendor_region", "carrier_code", "carrier_name", "carrier_mode",
    "actual_delivery_date",
]


@dataclass(frozen=True)
class Slice:
    """Grouping columns, slicer predicates and the day to look from.

    With ``as_of`` only shipments delivered, backorders created and orders
    placed by the end of that day count.  ``narrowed`` says that the tables
    themselves were cut down, so orders and backorders must follow shipments.
    """

    by: tuple[str, ...] = ()
    filters: dict = field(default_factory=dict)
    as_of: dt.date | None = None
    narrowed: bool = False

    @property
    def sliced(self) -> bool:
        return bool(self.by or self.filters or self.narrowed)


def slicer(df: DataFrame, filters: dict) -> DataFrame:
    """Apply {column: value | list of values | (low, high)}; None means open."""
    for name, want in filters.items():
        if name not in SLICES:
            raise ValueError(f"no slicer {name!r}; there are {', '.join(SLICES)}")
        c = F.col(name)
        if isinstance(want, tuple):
            low, high = want
            if low is not None:
                df = df.where(c >= F.lit(low))
            if high is not None:
                df = df.where(c <= F.lit(high))
        elif isinstance(want, list):
            df = df.where(c.isin(want))
        elif want is not None:
            df = df.where(c == F.lit(want))
    return df


def sliced_shipments(t: Tables, s: Slice) -> DataFrame:
    shipments = slicer(t.shipments, s.filters)
    return shipments if s.as_of is None else shipments.where(F.col("actual_delivery_date") <= F.lit(s.as_of))


def created_by(backorders: DataFrame, s: Slice) -> DataFrame:
    """The backorders there were at the end of the day looked from."""
    if s.as_of is None:
        return backorders
    return backorders.where(F.col("created_at") < F.lit(s.as_of + dt.timedelta(days=1)))


def shipment_results(t: Tables, s: Slice, cfg: SlaConfig, shipments: DataFrame | None = None) -> DataFrame:
    """Line counts per shipment: all, on time, in full and both; of some ``shipments`` or of the slice's.

    Whether a line is in full depends on its order line, whether it is on time
    only on its shipment.  Lines are therefore counted per shipment before
    they meet the shipments and orders.  Blanks count as zero, and lines
    without a shipment stay in the count unless a slicer narrows it.
    """
    narrowed = bool(s.filters) or s.as_of is not None or shipments is not None
    shipments = sliced_shipments(t, s) if shipments is None else shipments
    headers = shipments.select("shipment_number", "order_number", *SLICES).join(
        t.orders.select("order_number", "requested_delivery_date"), "order_number", "left"
    ).drop("order_number")
    delivered = t.delivery_lines.select(
        "shipment_number", "order_number", "line_number", "delivered_qty", "damage_qty"
    )
    if narrowed:
        delivered = delivered.join(shipments.select("shipment_number"), "shipment_number", "left_semi")
    ordered = t.order_lines.select("order_number", "line_number", "ordered_qty")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    moved = F.col("delivered_qty") > 0
    whole = zero("delivered_qty") - zero("damage_qty") >= zero("ordered_qty")
    counted = (
        delivered.join(ordered, ["order_number", "line_number"], "left")
        .groupBy("shipment_number")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum(flag(moved)).alias("moved"),
            F.sum(flag(whole)).alias("in_full"),
            F.sum(flag(moved & whole)).alias("moved_in_full"),
        )
    )
    came, want = F.col("actual_delivery_date"), F.col("requested_delivery_date")
    on_time = (came <= want) & (came >= F.date_sub(want, cfg.early_tolerance_days))
    return counted.join(headers, "shipment_number", "inner" if narrowed else "left").select(
        "shipment_number", *SLICES, "lines",
        F.when(on_time, F.col("moved")).otherwise(0).alias("on_time"),
        "in_full",
        F.when(on_time, F.col("moved_in_full")).otherwise(0).alias("otif"),
    )


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("lines", "on_time", "in_full", "otif")]


def line_counts(t: Tables, s: Slice, cfg: SlaConfig) -> DataFrame:
    return shipment_results(t, s, cfg).groupBy(*s.by).agg(*_sums())


def daily_counts(t: Tables, s: Slice, cfg: SlaConfig, results: DataFrame | None = None) -> DataFrame:
    """Line counts per slice and delivery day: small, and reused by every rolling figure."""
    by = [c for c in s.by if c != "actual_delivery_date"]
    rows = shipment_results(t, s, cfg) if results is None else results
    return rows.groupBy(*by, F.col("actual_delivery_date").alias("day")).agg(*_sums())


def last_days(t: Tables, s: Slice) -> DataFrame:
    """The day each slice is looked at from: its newest shipment's, or ``as_of``; a narrow scan."""
    dated = sliced_shipments(t, s).where(F.col("actual_delivery_date").isNotNull())
    newest = F.max("actual_delivery_date") if s.as_of is None else F.max(F.lit(s.as_of))
    return dated.groupBy(*s.by).agg(newest.alias("top"))


def _recent_shipments(t: Tables, s: Slice, tops: DataFrame, span: int) -> DataFrame:
    """Shipments of the last ``span`` days of each slice; the earliest day of any is a bound on the scan."""
    first = tops.agg(F.date_sub(F.min("top"), span - 1)).scalar()
    shipments = sliced_shipments(t, s).where(F.col("actual_delivery_date") >= first)
    if not s.by:
        return shipments
    kept = shipments.alias("x").join(
        tops.alias("t"),
        same_keys("x", "t", list(s.by)) & (F.col("x.actual_delivery_date") > F.date_sub("t.top", span)), "left_semi",
    )
    return kept.select(*t.shipments.columns)


def rolling_calendar_days(
    t: Tables, s: Slice, cfg: SlaConfig, results: DataFrame | None = None
) -> DataFrame:
    """7- and 30-calendar-day OTIF shares up to the slice's last day, and the 7 days before.

    The last day is that of the newest shipment, with lines or without.  Given
    ``results`` of all shipments, their totals come along; otherwise only the
    last 30 days of each slice are read.
    """
    if "actual_delivery_date" in s.by:
        raise ValueError("rolling figures span days, so they can't be sliced by day")
    tops = last_days(t, s)
    if results is None:
        results = shipment_results(t, s, cfg, _recent_shipments(t, s, tops, 30))
    daily = daily_counts(t, s, cfg, results)
    if s.by:
        rows = tops.alias("t").join(daily.alias("d"), same_keys("t", "d", list(s.by)), "left").select(
            *[F.col(f"t.{c}") for c in s.by], "t.top", "d.day", "d.lines", "d.on_time", "d.in_full", "d.otif"
        )
    else:
        rows = daily.withColumn("top", tops.select("top").scalar())
    age = F.datediff(F.col("top"), F.col("day"))

    def share(first: int, last: int) -> Column:
        inside = age.between(first, last)
        return divide(F.sum(F.when(inside, F.col("otif"))), F.sum(F.when(inside, F.col("lines"))))

    return rows.groupBy(*s.by).agg(
        *_sums(),
        F.max("top").alias("last_day"),
        share(0, 6).alias("rolling_7d"),
        share(0, 29).alias("rolling_30d"),
        share(7, 13).alias("previous_7d"),
    )


def vendor_failures(
    t: Tables, s: Slice, cfg: SlaConfig, results: DataFrame | None = None, *, recent: int = 100
) -> DataFrame:
    """Failed shipments among each vendor's most recent ones, ties included.

    Works on one row per (vendor, day): a day belongs to the recent set when
    fewer than ``recent`` shipments came after it.  Only the lines of the
    shipments of those days are read.
    """
    shipped = sliced_shipments(t, s).where(F.col("actual_delivery_date").isNotNull())
    daily = shipped.groupBy("vendor_code", "actual_delivery_date").agg(F.count(F.lit(1)).alias("shipments"))
    newer = (
        Window.partitionBy("vendor_code").orderBy(F.desc("actual_delivery_date"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    after = F.coalesce(F.sum("shipments").over(newer), F.lit(0))
    days_kept = daily.withColumn("after", after).where(F.col("after") < recent)
    on = [F.col(f"x.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ("vendor_code", "actual_delivery_date")]
    kept = shipped.alias("x").join(days_kept.alias("k"), on, "left_semi").select(*t.shipments.columns)
    rows = shipment_results(t, s, cfg, kept) if results is None else results
    return (
        kept.select("shipment_number", "vendor_code")
        .join(rows.select("shipment_number", "otif"), "shipment_number", "left")
        .groupBy("vendor_code")
        .agg(F.sum(flag(F.coalesce(F.col("otif"), F.lit(0)) == 0)).alias("value"))
    )


def vendor_streak(ll: DataFrame) -> DataFrame:
    """Failed lines since each vendor's last good one: the streak as the word is meant."""
    place = F.struct("actual_delivery_date", "shipment_number", "line_number")
    last_good = (
        ll.where(F.col("is_otif") == 1).groupBy("vendor_code").agg(F.max(place).alias("last_good"))
    )
    # Staged, so that the join reads two plain exchanges and a hot vendor can be split.
    last_good = stage(last_good, "last-good")
    open_run = F.col("last_good").isNull() | (place > F.col("last_good"))
    return (
        ll.select("vendor_code", "actual_delivery_date", "shipment_number", "line_number")
        .join(last_good, "vendor_code", "left")
        .groupBy("vendor_code")
        .agg(F.sum(flag(open_run)).alias("value"))
    )


def line_slices(t: Tables, s: Slice, lines: DataFrame) -> DataFrame:
    """The slices of each order line in ``lines``: those of every shipment that carried it, each once."""
    carried = t.delivery_lines.select("shipment_number", *LINE).join(lines.select(*LINE), LINE, "left_semi")
    slices = sliced_shipments(t, s).select("shipment_number", *s.by)
    return carried.join(slices, "shipment_number").select(*LINE, *s.by).distinct()


def backorder_sums(t: Tables, s: Slice) -> DataFrame:
    """Open cost and open count per slice."""
    lines = open_cost_by_line(t, created_by(t.backorders, s))
    if s.sliced:
        lines = lines.join(line_slices(t, s, lines), LINE)
    return lines.groupBy(*s.by).agg(
        F.coalesce(F.sum("cost"), F.lit(0)).alias("open_cost"),
        F.coalesce(F.sum("backorders"), F.lit(0)).alias("open_count"),
    )


def recent_backorder_cost(t: Tables, s: Slice) -> DataFrame:
    """Cost of the open backorders of the seven days up to the slice's newest backorder, open or not."""
    known = created_by(t.backorders, s)
    newest = known.groupBy(*LINE).agg(F.max("created_at").alias("newest"))
    if s.sliced:
        slices = line_slices(t, s, newest)
        newest = newest.join(slices, LINE)
    tops = newest.groupBy(*s.by).agg((F.max("newest") - F.expr("INTERVAL 6 DAYS")).alias("since"))
    opened = known.where(F.col("status") == "open")
    if not s.by:
        if s.sliced:
            opened = opened.join(slices, LINE, "left_semi")
        inside = opened.where(F.col("created_at") >= tops.select("since").scalar())
        lines = open_cost_by_line(t, inside.select(*t.backorders.columns))
        return lines.agg(F.coalesce(F.sum("cost"), F.lit(0)).alias("cost_7d"))
    # A line's backorders are summed for each day its slices look back to, before the price look-up.
    since = slices.alias("l").join(tops.alias("t"), same_keys("l", "t", list(s.by))).select(
        *[F.col(f"l.{c}") for c in LINE], "since"
    ).distinct()
    recent = opened.join(since, LINE).where(F.col("created_at") >= F.col("since")).groupBy(*LINE, "since").agg(
        F.sum("backorder_qty").alias("qty")
    )
    priced = price_lines(t, recent, "qty").select(*LINE, "since", "cost")
    of_slice = slices.alias("l").join(tops.alias("t"), same_keys("l", "t", list(s.by))).select(
        *[F.col(f"l.{c}") for c in [*LINE, *s.by]], "since"
    )
    return of_slice.join(priced, [*LINE, "since"], "left").groupBy(*s.by).agg(
        F.coalesce(F.sum("cost"), F.lit(0)).alias("cost_7d"),
    )


def order_figures(t: Tables, s: Slice) -> DataFrame:
    """Distinct orders and their value; a sliced order counts once per slice."""
    orders = t.orders if s.as_of is None else t.orders.where(F.col("order_date") <= F.lit(s.as_of))
    orders = orders.select("order_number", "total_value")
    if s.sliced:
        keys = list(dict.fromkeys(["order_number", *s.by]))
        orders = orders.join(sliced_shipments(t, s).select(*keys).distinct(), "order_number")
    return orders.groupBy(*s.by).agg(
        F.count_distinct("order_number").alias("orders"), F.sum("total_value").alias("revenue")
    )


def shipment_figures(t: Tables, s: Slice) -> DataFrame:
    """Distinct shipments and the average milestone distances per shipment."""
    dated = sliced_shipments(t, s).join(
        t.orders.select("order_number", "order_date"), "order_number", "left"
    )
    return dated.groupBy(*s.by).agg(
        F.count_distinct("shipment_number").alias("shipments"),
        F.avg(days("order_date", "actual_ship_date")).alias("order_to_ship"),
        F.avg(days("actual_ship_date", "actual_delivery_date")).alias("ship_to_delivery"),
        F.avg(days("order_date", "actual_delivery_date")).alias("lead_time"),
    )


def sla_targets(t: Tables, cfg: SlaConfig, overrides: DataFrame | None = None) -> DataFrame:
    """Target share per vendor; ``overrides`` (vendor_code, target) wins over the default."""
    vendors = t.vendors.select("vendor_code").distinct()
    default = F.lit(cfg.otif_target / 100)
    if overrides is None:
        return vendors.select("vendor_code", default.alias("value"))
    chosen = overrides.groupBy("vendor_code").agg(F.max("target").alias("target"))
    return vendors.join(chosen, "vendor_code", "left").select(
        "vendor_code", F.coalesce(F.col("target"), default).alias("value")
    )


def target_attainment(t: Tables, s: Slice, cfg: SlaConfig) -> DataFrame:
    """On-time, in-full and combined share against their targets, one row per slice and metric."""
    counts = line_counts(t, s, cfg)
    goals = [("on_time", cfg.on_time_target), ("in_full", cfg.in_full_target), ("otif", cfg.otif_target)]
    metric = F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), divide(n, "lines").alias("share"), F.lit(g / 100).alias("target"))
        for n, g in goals
    ])).alias("m")
    rows = counts.select(*s.by, metric).select(*s.by, "m.metric", "m.share", "m.target")
    return rows.withColumn("met", flag(F.col("share") >= F.col("target")))


def compliance_score(share: Column) -> Column:
    # Share of OTIF lines -> score.
    return (
        F.when(share >= 0.95, 100).when(share >= 0.92, 85).when(share >= 0.85, 60)
        .when(share >= 0.75, 30).otherwise(0)
    )


def compliance_status(score: Column) -> Column:
    return at_least(score, (85, "EXCEEDING"), (60, "MEETING"), (30, "AT_RISK"), otherwise="CRITICAL")


def trend_direction(change: Column, cfg: SlaConfig) -> Column:
    return banded(
        [(change > cfg.trend_band, "UP"), (change < -cfg.trend_band, "DOWN")], otherwise="FLAT"
    )


def _pick(frame: Callable, value: Callable[[], Column] | str):
    def run(t: Tables, s: Slice, cfg: SlaConfig) -> DataFrame:
        v = F.col(value) if isinstance(value, str) else value()
        return frame(t, s, cfg).select(*s.by, v.alias("value"))

    return run


def _no_cfg(frame: Callable):
    return lambda t, s, cfg: frame(t, s)


def _by_target(compare: Callable[[Column, Column], Column]):
    def run(t: Tables, s: Slice, cfg: SlaConfig) -> DataFrame:
        rolled = rolling_calendar_days(t, s, cfg)
        return rolled.select(
            *s.by, compare(F.col("rolling_7d"), F.lit(cfg.otif_target / 100)).alias("value")
        )

    return run


def _backorder_to_revenue(t: Tables, s: Slice, cfg: SlaConfig) -> DataFrame:
    cost, revenue = backorder_sums(t, s), order_figures(t, s)
    if not s.by:
        # Two one-row results: read the cost as a scalar.
        value = divide(cost.select("open_cost").scalar(), F.col("revenue"))
        return revenue.select(value.alias("value"))
    both = revenue.alias("r").join(cost.alias("c"), same_keys("r", "c", list(s.by)), "left")
    return both.select(
        *[F.col(f"r.{c}") for c in s.by], divide("open_cost", "revenue").alias("value")
    )


def _max_failures(t: Tables, s: Slice, cfg: SlaConfig) -> DataFrame:
    return vendor_failures(t, s, cfg).agg(F.max("value").alias("value"))


_trend = lambda: F.col("rolling_7d") - F.col("previous_7d")

MEASURES: dict[str, Callable[[Tables, Slice, SlaConfig], DataFrame]] = {
    "total_delivery_lines": _pick(line_counts, "lines"),
    "total_orders": _pick(_no_cfg(order_figures), "orders"),
    "total_shipments": _pick(_no_cfg(shipment_figures), "shipments"),
    "on_time_count": _pick(line_counts, "on_time"),
    "in_full_count": _pick(line_counts, "in_full"),
    "otif_count": _pick(line_counts, "otif"),
    "otif_share": _pick(line_counts, lambda: divide("otif", "lines")),
    "on_time_share": _pick(line_counts, lambda: divide("on_time", "lines")),
    "in_full_share": _pick(line_counts, lambda: divide("in_full", "lines")),
    "rolling_7d_otif": _pick(rolling_calendar_days, "rolling_7d"),
    "rolling_30d_otif": _pick(rolling_calendar_days, "rolling_30d"),
    "current_failure_streak": lambda t, s, cfg: vendor_failures(t, s, cfg),
    "max_consecutive_failures": _max_failures,
    "open_backorder_cost": _pick(_no_cfg(backorder_sums), "open_cost"),
    "open_backorder_count": _pick(_no_cfg(backorder_sums), "open_count"),
    "rolling_7d_backorder_cost": _pick(_no_cfg(recent_backorder_cost), "cost_7d"),
    "backorder_to_revenue": _backorder_to_revenue,
    "avg_order_to_ship_days": _pick(_no_cfg(shipment_figures), "order_to_ship"),
    "avg_ship_to_delivery_days": _pick(_no_cfg(shipment_figures), "ship_to_delivery"),
    "avg_total_lead_time_days": _pick(_no_cfg(shipment_figures), "lead_time"),
    "sla_target": lambda t, s, cfg: sla_targets(t, cfg),
    "sla_breached": _by_target(lambda share, target: flag(share < target)),
    "sla_gap": _by_target(lambda share, target: share - target),
    "vendor_compliance_score": _pick(
        rolling_calendar_days, lambda: compliance_score(F.col("rolling_7d"))
    ),
    "vendor_sla_status": _pick(
        rolling_calendar_days, lambda: compliance_status(compliance_score(F.col("rolling_7d")))
    ),
    "carrier_on_time_share": _pick(line_counts, lambda: divide("on_time", "lines")),
    "otif_trend": _pick(rolling_calendar_days, _trend),
    "otif_trend_direction": lambda t, s, cfg: rolling_calendar_days(t, s, cfg).select(
        *s.by, trend_direction(_trend(), cfg).alias("value")
    ),
}


def measure_table(t: Tables, s: Slice, cfg: SlaConfig = SlaConfig()) -> DataFrame:
    """All line, rolling and service-level measures of a slice from one pass over the lines."""
    return service_levels(rolling_calendar_days(t, s, cfg, shipment_results(t, s, cfg)), s, cfg)


def service_levels(rolled: DataFrame, s: Slice, cfg: SlaConfig) -> DataFrame:
    """The table's columns from the totals and rolling shares of a slice."""
    share, change = F.col("rolling_7d"), F.col("rolling_7d") - F.col("previous_7d")
    target = F.lit(cfg.otif_target / 100)
    return rolled.select(
        *s.by, "lines", "on_time", "in_full", "otif",
        divide("otif", "lines").alias("otif_share"),
        divide("on_time", "lines").alias("on_time_share"),
        divide("in_full", "lines").alias("in_full_share"),
        share.alias("rolling_7d_otif"),
        F.col("rolling_30d").alias("rolling_30d_otif"),
        flag(share < target).alias("sla_breached"),
        (share - target).alias("sla_gap"),
        compliance_score(share).alias("compliance_score"),
        compliance_status(compliance_score(share)).alias("sla_status"),
        change.alias("otif_trend"),
        trend_direction(change, cfg).alias("otif_trend_direction"),
    )


# Measures whose grain is fixed, whatever ``by`` says.
_FIXED_GRAIN = {"current_failure_streak": ["vendor_code"], "sla_target": ["vendor_code"],
                "max_consecutive_failures": []}


def measure(
    t: Tables, name: str, by: list[str] | None = None, filters: dict | None = None,
    as_of: dt.date | None = None, cfg: SlaConfig = SlaConfig(),
) -> DataFrame:
    """One measure as ``by… , value``."""
    if name in _FIXED_GRAIN and by and by != _FIXED_GRAIN[name]:
        raise ValueError(f"{name} is defined per {_FIXED_GRAIN[name] or 'whole model'}")
    filters = dict(filters or {})
    status = filters.pop("sla_status", None)
    if status is not None:
        t = with_sla_status(t, [status] if isinstance(status, str) else status, cfg)
    return MEASURES[name](t, Slice(tuple(by or ()), filters, as_of, status is not None), cfg)


def with_sla_status(t: Tables, wanted: list[str], cfg: SlaConfig) -> Tables:
    """Shipments (and their lines) of vendors whose current status is among ``wanted``."""
    status = measure(t, "vendor_sla_status", ["vendor_code"], cfg=cfg)
    chosen = status.where(F.col("value").isin(wanted)).select("vendor_code")
    shipments = t.shipments.join(chosen, "vendor_code", "left_semi")
    lines = t.delivery_lines.join(
        shipments.select("shipment_number"), "shipment_number", "left_semi"
    )
    return t.but(shipments=shipments.select(*t.shipments.columns), delivery_lines=lines.select(*t.delivery_lines.columns))
