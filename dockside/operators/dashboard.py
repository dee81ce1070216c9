"""The queries behind each dashboard visual."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from dockside.config import SlaConfig
from dockside.functions.exprs import at_least, below, days, divide, pct2, week_of
from dockside.operators import measures as m
from dockside.operators.backorders import LINE, open_backorders
from dockside.operators.measures import Slice
from dockside.operators.sequences import failure_reason
from dockside.plans.staging import stage
from dockside.tables import Tables


def kpi_row(t: Tables, as_of: dt.date, cfg: SlaConfig = SlaConfig(), *, filters: dict | None = None) -> DataFrame:
    """One row with the five headline figures; "today" is ``as_of``."""
    s = Slice(filters=filters or {})
    age = F.datediff(F.lit(as_of), F.col("day"))
    recent = age.between(0, 6)
    one = lambda df, c: df.select(c).scalar()
    return m.daily_counts(t, s, cfg).agg(
        divide(F.sum("otif"), F.sum("lines")).alias("otif_share"),
        divide(F.sum(F.when(recent, F.col("otif"))), F.sum(F.when(recent, F.col("lines")))).alias("rolling_7d_otif"),
        F.coalesce(F.sum(F.when(age == 0, F.col("lines"))), F.lit(0)).alias("lines_today"),
    ).select(
        "otif_share", "rolling_7d_otif",
        one(m.backorder_sums(t, s), "open_cost").alias("open_backorder_cost"),
        "lines_today",
        one(m.shipment_figures(t, s), "lead_time").alias("avg_total_lead_time_days"),
    )


def otif_colour(share: Column, cfg: SlaConfig, *, four: bool = False) -> Column:
    """Traffic-light band of a 0-1 share; ``four`` adds orange."""
    if four:
        return at_least(
            share, (cfg.vendor_exceeding / 100, "green"), (cfg.otif_target / 100, "yellow"),
            (cfg.otif_critical / 100, "orange"), otherwise="red",
        )
    return at_least(
        share, (cfg.vendor_exceeding / 100, "green"), (cfg.otif_target / 100, "amber"), otherwise="red"
    )


def backorder_colour(cost: Column, cfg: SlaConfig) -> Column:
    return below(
        cost.cast("double"), (cfg.backorder_vendor_limit, "green"),
        (cfg.backorder_aggregate_limit, "amber"), otherwise="red",
    )


def colour_bands(t: Tables, cfg: SlaConfig = SlaConfig(), *, filters: dict | None = None) -> DataFrame:
    """Colours per vendor for its OTIF share and open backorder cost."""
    s = Slice(("vendor_code",), filters or {})
    share = m.line_counts(t, s, cfg).select("vendor_code", divide("otif", "lines").alias("otif_share"))
    cost = m.backorder_sums(t, s).select("vendor_code", "open_cost")
    return share.join(cost, "vendor_code", "left").select(
        "vendor_code", "otif_share",
        F.coalesce("open_cost", F.lit(0)).alias("open_backorder_cost"),
        otif_colour(F.col("otif_share"), cfg).alias("otif_colour"),
        otif_colour(F.col("otif_share"), cfg, four=True).alias("otif_colour_four"),
        backorder_colour(F.coalesce("open_cost", F.lit(0)), cfg).alias("backorder_colour"),
    )


def date_dimension(first: dt.date, last: dt.date, spark) -> DataFrame:
    """Every calendar day from ``first`` to ``last``."""
    span = spark.range((last - first).days + 1)
    day = F.date_add(F.lit(first), F.col("id").cast("int"))
    return span.select(
        day.alias("day"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        week_of(day).alias("week_start"),
        (F.weekday(day) >= 5).cast("int").alias("is_weekend"),
    )


def delivery_calendar(t: Tables) -> DataFrame:
    """The date dimension of the delivery dates."""
    span = t.shipments.agg(
        F.min("actual_delivery_date").alias("lo"), F.max("actual_delivery_date").alias("hi")
    ).first()
    return date_dimension(span.lo, span.hi, t.spark)


def daily_deliveries(
    t: Tables, as_of: dt.date, cfg: SlaConfig = SlaConfig(), *, back: int | None = None,
    filters: dict | None = None,
) -> DataFrame:
    """Lines per calendar day, 7-day rolling share and the target line; idle days show zero."""
    first = as_of - dt.timedelta(days=cfg.lookback_days if back is None else back)
    s = Slice(filters={**(filters or {}), "actual_delivery_date": (first - dt.timedelta(days=6), as_of)})
    daily = m.daily_counts(t, s, cfg)
    calendar = date_dimension(first - dt.timedelta(days=6), as_of, t.spark).select("day")
    # One row per calendar day.
    frame = Window.orderBy(F.datediff(F.col("day"), F.lit(first))).rangeBetween(-6, 0)
    return (
        calendar.join(daily, "day", "left")
        .select(
            "day",
            F.coalesce("lines", F.lit(0)).alias("delivered_lines"),
            divide(F.sum("otif").over(frame), F.sum("lines").over(frame)).alias("rolling_7d_otif"),
            F.lit(cfg.otif_target / 100).alias("sla_target"),
        )
        .where(F.col("day") >= F.lit(first))
    )


def vendor_week_heatmap(
    t: Tables, as_of: dt.date, cfg: SlaConfig = SlaConfig(), *, top: int = 15, back: int | None = None,
    filters: dict | None = None,
) -> DataFrame:
    """Top vendors by volume against the weeks of the last ``back`` days; column w00 is the week of ``as_of``.

    There is a column for every calendar week that so many days can touch.
    """
    back = cfg.lookback_days if back is None else back
    weeks = (back + 6) // 7 + 1
    monday = as_of - dt.timedelta(days=as_of.weekday())
    first = as_of - dt.timedelta(days=back)
    s = Slice(filters={**(filters or {}), "actual_delivery_date": (first, as_of)})
    results = m.shipment_results(t, s, cfg)
    cells = results.groupBy(
        "vendor_code",
        (F.datediff(F.lit(monday), week_of("actual_delivery_date")) / 7).cast("int").alias("weeks_ago"),
    ).agg(F.sum("lines").alias("lines"), F.sum("otif").alias("otif"))
    volume = cells.groupBy("vendor_code").agg(F.sum("lines").alias("volume"))
    largest = volume.orderBy(F.desc("volume"), "vendor_code").limit(top)
    wide = (
        cells.join(F.broadcast(largest.select("vendor_code")), "vendor_code", "left_semi")
        .groupBy("vendor_code")
        .pivot("weeks_ago", list(range(weeks)))
        .agg(F.first(divide("otif", "lines")))
    )
    return wide.select("vendor_code", *[F.col(str(w)).alias(f"w{w:02d}") for w in range(weeks)])


def vendor_gauge(t: Tables, vendor: str, cfg: SlaConfig = SlaConfig(), *, filters: dict | None = None) -> DataFrame:
    rolled = m.rolling_calendar_days(t, Slice(filters={**(filters or {}), "vendor_code": vendor}), cfg)
    return rolled.select(
        F.lit(vendor).alias("vendor_code"), F.col("rolling_7d").alias("rolling_7d_otif"),
        F.lit(cfg.otif_target / 100).alias("target"), F.lit(1.0).alias("maximum"),
    )


def backorder_treemap(t: Tables, *, filters: dict | None = None) -> DataFrame:
    return m.backorder_sums(t, Slice(("vendor_code",), filters or {})).select("vendor_code", "open_cost")


def vendor_table(t: Tables, cfg: SlaConfig = SlaConfig(), *, filters: dict | None = None) -> DataFrame:
    """Vendors worst first: rolling share, volume, status, failures."""
    s = Slice(("vendor_code",), filters or {})
    results = stage(m.shipment_results(t, s, cfg), "shipment-results")
    rolled = m.rolling_calendar_days(t, s, cfg, results)
    failed = m.vendor_failures(t, s, cfg, results)
    share = F.col("rolling_7d")
    return (
        rolled.join(failed, "vendor_code", "left")
        .select(
            "vendor_code", share.alias("rolling_7d_otif"), F.coalesce("lines", F.lit(0)).alias("total_lines"),
            m.compliance_status(m.compliance_score(share)).alias("sla_status"),
            F.col("value").alias("consecutive_failures"),
        )
        .orderBy("rolling_7d_otif", "vendor_code")
    )


def carrier_table(t: Tables, cfg: SlaConfig = SlaConfig(), *, filters: dict | None = None) -> DataFrame:
    """Carriers worst first."""
    return (
        m.line_counts(t, Slice(("carrier_code", "carrier_mode"), filters or {}), cfg)
        .where(F.col("carrier_code").isNotNull())
        .select(
            "carrier_code", "carrier_mode", divide("on_time", "lines").alias("on_time_share"),
            F.col("lines").alias("total_deliveries"),
        )
        .orderBy("on_time_share", "carrier_code")
    )


def region_rolling(t: Tables, cfg: SlaConfig = SlaConfig(), *, filters: dict | None = None) -> DataFrame:
    return m.measure(t, "rolling_7d_otif", ["vendor_region"], filters, cfg=cfg)


def active_alerts_by_severity(summary: DataFrame, as_of: dt.date, *, back: int = 7) -> DataFrame:
    """Alerts whose event fell within the last days, counted by severity."""
    since = as_of - dt.timedelta(days=back)
    return (
        summary.where(F.col("event_date") >= F.lit(since).cast("timestamp_ntz"))
        .groupBy("alert_severity")
        .agg(F.count(F.lit(1)).alias("alerts"))
    )


def sliced_kpis(t: Tables, filters: dict, cfg: SlaConfig = SlaConfig()) -> DataFrame:
    """Volume and shares under a set of slicers, by vendor."""
    counts = m.line_counts(t, Slice(("vendor_code",), filters), cfg)
    return counts.select(
        "vendor_code", "lines", divide("otif", "lines").alias("otif_share"),
        divide("on_time", "lines").alias("on_time_share"), divide("in_full", "lines").alias("in_full_share"),
    )


def vendor_profile(hierarchy: DataFrame, vendor: str | None = None) -> DataFrame:
    rows = hierarchy if vendor is None else hierarchy.where(F.col("vendor_code") == vendor)
    return rows.select("vendor_code", "vendor_name", "tier", "vendor_region", "overall_otif_pct")


def recent_deliveries(ll: DataFrame, *, keep: int = 30) -> DataFrame:
    """The newest lines of each vendor; the rank limit is applied before the shuffle."""
    newest = Window.partitionBy("vendor_code").orderBy(
        F.desc("actual_delivery_date"), F.desc("shipment_number"), F.desc("line_number")
    )
    late, short = F.col("is_on_time") == 0, F.col("is_in_full") == 0
    reason = F.when(F.col("is_otif") == 1, "NONE").otherwise(failure_reason(late, short))
    return (
        ll.select(
            "vendor_code", "actual_delivery_date", "shipment_number", "order_number", "line_number",
            "is_on_time", "is_in_full", "is_otif",
        )
        .withColumn("recency", F.row_number().over(newest))
        .where(F.col("recency") <= keep)
        .withColumn("failure_reason", reason)
    )


def otif_trend(ll: DataFrame, as_of: dt.date, cfg: SlaConfig = SlaConfig(), *, grain: str = "month") -> DataFrame:
    """OTIF percentage per month or week over the last half year."""
    since = as_of - dt.timedelta(days=cfg.lookback_long_days)
    period = F.date_trunc(grain, F.col("actual_delivery_date")).cast("date")
    return (
        ll.where(F.col("actual_delivery_date") >= F.lit(since))
        .groupBy(period.alias("period"))
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("is_otif").alias("passed"))
        .select("period", "lines", pct2("passed", "lines").alias("otif_pct"))
    )


def failure_breakdown(ll: DataFrame) -> DataFrame:
    """Failed lines per vendor and reason."""
    late, short = F.col("is_on_time") == 0, F.col("is_in_full") == 0
    return (
        ll.where(F.col("is_otif") == 0)
        .groupBy("vendor_code", failure_reason(late, short).alias("failure_reason"))
        .agg(F.count(F.lit(1)).alias("failures"))
    )


def _sliced_open(t: Tables, filters: dict | None) -> DataFrame:
    """Open backorders of the order lines that a shipment of the slice carried; all without slicers."""
    opened = open_backorders(t)
    if not filters:
        return opened
    return opened.join(m.line_slices(t, Slice(filters=filters), opened), LINE, "left_semi")


def open_backorder_list(t: Tables, *, filters: dict | None = None) -> DataFrame:
    """Open backorders with every vendor that shipped the line."""
    listed = _sliced_open(t, filters).select(
        "backorder_id", *LINE, "sku", "backorder_qty", "cost", "estimated_fill_date"
    )
    # One row per (line, vendor) before the backorders meet them, so none is repeated.
    vendors = m.line_slices(t, Slice(("vendor_code",), filters or {}), listed)
    return listed.join(vendors, LINE, "left").select(
        "backorder_id", "vendor_code", "sku", "backorder_qty", "cost", "estimated_fill_date"
    )


def cumulative_backorder_cost(t: Tables, *, filters: dict | None = None) -> DataFrame:
    """Open cost per day and its running total (one row per day, so one small window)."""
    daily = _sliced_open(t, filters).groupBy(F.to_date("created_at").alias("day")).agg(
        F.sum("cost").alias("cost")
    )
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select("day", "cost", F.sum("cost").over(upto).alias("cumulative_cost"))


def days_open(t: Tables, as_of: dt.date, *, filters: dict | None = None) -> DataFrame:
    """Average age of open backorders on ``as_of``."""
    return _sliced_open(t, filters).agg(
        F.avg(days(F.to_date("created_at"), F.lit(as_of))).alias("avg_days_open"),
        F.count(F.lit(1)).alias("open_backorders"),
    )
