"""Additive figures of shipments in cuboids of (day, slice), and the measures that are read off them.

One pass over shipments, orders and lines yields a row for each day and combination of slice columns; ``GROUPING SETS``
over that table, not over the lines, give the coarser cuboids, each in a folder of its own.  A question takes the
cuboid with the fewest rows that has its grouping columns and its filters; the day is in all of them, so rolling figures,
days looked from and date filters work on every one.

What is kept adds up: counts of lines, on time, in full and both, shipments, failed shipments, and sums with counts of
milestone distances.  Distinct counts don't, and stay with :mod:`measures` (exact) or :mod:`sketches`.

A cuboid has at most as many rows as there are days times slices, whatever the number of lines.  Lines without a
shipment are kept apart (``known`` false): they count unless a filter or a day narrows the question.  Shipment numbers
are taken to be unique, as the key checks assert.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from dockside.config import SlaConfig
from dockside.functions.exprs import days, divide, flag
from dockside.operators import measures as m
from dockside.operators.measures import SLICES, Slice
from dockside.plans.staging import fresh_path, stage
from dockside.tables import Tables

DAY = "actual_delivery_date"
LINES = ["lines", "on_time", "in_full", "otif"]
MILESTONES = {
    "order_to_ship": ("order_date", "actual_ship_date"),
    "ship_to_delivery": ("actual_ship_date", "actual_delivery_date"),
    "lead_time": ("order_date", "actual_delivery_date"),
}
FIGURES = [*LINES, "shipments", "failed", *[f"{n}_{x}" for n in MILESTONES for x in ("sum", "n")]]
#: Slice columns of the coarser cuboids; the day comes with each.
CUBOIDS = ((), ("vendor_code",), ("vendor_region",), ("carrier_code", "carrier_name", "carrier_mode"))


def shipment_rows(t: Tables, cfg: SlaConfig) -> DataFrame:
    """A row for every shipment, and for every shipment number that only lines have, with its figures."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    moved = F.col("delivered_qty") > 0
    whole = zero("delivered_qty") - zero("damage_qty") >= zero("ordered_qty")
    counted = (
        t.delivery_lines.select("shipment_number", "order_number", "line_number", "delivered_qty", "damage_qty")
        .join(t.order_lines.select("order_number", "line_number", "ordered_qty"), ["order_number", "line_number"], "left")
        .groupBy("shipment_number")
        .agg(
            F.count(F.lit(1)).alias("lines"), F.sum(flag(moved)).alias("moved"),
            F.sum(flag(whole)).alias("in_full"), F.sum(flag(moved & whole)).alias("moved_in_full"),
        )
    )
    headers = t.shipments.select("shipment_number", "order_number", "actual_ship_date", *SLICES).join(
        t.orders.select("order_number", "order_date", "requested_delivery_date"), "order_number", "left"
    ).withColumn("known", F.lit(True))
    came, want = F.col(DAY), F.col("requested_delivery_date")
    on_time = (came <= want) & (came >= F.date_sub(want, cfg.early_tolerance_days))
    timely = lambda c: F.when(F.col("lines").isNull(), None).when(on_time, F.col(c)).otherwise(0)
    known = F.coalesce("known", F.lit(False))
    otif = timely("moved_in_full")
    apart = {n: days(a, b) for n, (a, b) in MILESTONES.items()}
    return headers.join(counted, "shipment_number", "full").select(
        *SLICES, known.alias("known"), "lines", timely("moved").alias("on_time"), "in_full", otif.alias("otif"),
        flag(known).alias("shipments"), flag(known & (F.coalesce(otif, F.lit(0)) == 0)).alias("failed"),
        *[x.alias(f"{n}_sum") for n, x in apart.items()], *[flag(x.isNotNull()).alias(f"{n}_n") for n, x in apart.items()],
    )


def _sums(names: list[str]) -> list[Column]:
    return [F.sum(c).alias(c) for c in names]


@dataclass(frozen=True)
class Cube:
    """Written cuboids by their slice columns, and how many rows each has."""

    cuboids: dict[tuple[str, ...], DataFrame]
    rows: dict[tuple[str, ...], int]
    cfg: SlaConfig

    @classmethod
    def build(cls, t: Tables, cfg: SlaConfig = SlaConfig(), cuboids: tuple[tuple[str, ...], ...] = CUBOIDS) -> "Cube":
        finest = stage(shipment_rows(t, cfg).groupBy(*SLICES, "known").agg(*_sums(FIGURES)), "cube")
        slices = [c for c in SLICES if c != DAY]
        for columns in cuboids:
            if unknown := set(columns) - set(slices):
                raise ValueError(f"no slice column {', '.join(sorted(unknown))}")
        kept = [[DAY, "known", *columns] for columns in dict.fromkeys(cuboids)]
        # grouping() is one for a column that a set leaves out; the set's bits name its folder.
        bits = [(F.grouping(c) if any(c not in k for k in kept) else F.lit(0)).cast("string") for c in slices]
        coarser = finest.groupingSets(kept, *SLICES, "known").agg(F.concat(*bits).alias("cuboid"), *_sums(FIGURES))
        path = fresh_path(finest.sparkSession, "cuboids")
        # Every task writes its share of each cuboid: dealt by cuboid, the largest one would meet in one task.
        coarser.write.partitionBy("cuboid").parquet(path)
        name = lambda columns: "".join("0" if c in columns else "1" for c in slices)
        schema = finest.schema
        frames = {tuple(c for c in slices if c in k): finest.sparkSession.read.schema(schema).parquet(f"{path}/cuboid={name(k)}")
                  for k in kept} if finest.limit(1).count() else {}
        frames = {k: f.select(DAY, "known", *k, *FIGURES) for k, f in frames.items()}
        frames[tuple(slices)] = finest
        return cls(frames, {k: f.count() for k, f in frames.items()}, cfg)

    def route(self, columns: set[str]) -> tuple[str, ...]:
        """The cuboid with the fewest rows that has these columns."""
        if unknown := columns - set(SLICES):
            raise ValueError(f"no slicer {', '.join(sorted(unknown))}; there are {', '.join(SLICES)}")
        fit = [k for k in self.cuboids if columns - {DAY} <= set(k)]
        return min(fit, key=lambda k: (self.rows[k], len(k)))

    def daily(self, s: Slice) -> DataFrame:
        """The figures by slice and day, narrowed as the slice says."""
        rows = m.slicer(self.cuboids[self.route({*s.by, *s.filters})], s.filters)
        if s.as_of is not None:
            rows = rows.where(F.col(DAY) <= F.lit(s.as_of))
        if s.filters or s.as_of is not None:
            rows = rows.where("known")
        by = [c for c in s.by if c != DAY]
        return rows.groupBy(*by, DAY).agg(*_sums(FIGURES))

    def line_counts(self, s: Slice) -> DataFrame:
        """As :func:`measures.line_counts`."""
        counted = self.daily(s).groupBy(*s.by).agg(*_sums(LINES))
        return counted.where(F.col("lines").isNotNull()) if s.by else counted

    def milestones(self, s: Slice) -> DataFrame:
        """Average milestone distances per shipment, as :func:`measures.shipment_figures`."""
        summed = self.daily(s).groupBy(*s.by).agg(
            F.sum("shipments").alias("shipments"), *[F.try_divide(F.sum(f"{n}_sum"), F.sum(f"{n}_n")).alias(n) for n in MILESTONES]
        )
        return (summed.where(F.col("shipments") > 0) if s.by else summed).drop("shipments")

    def rolling(self, s: Slice) -> DataFrame:
        """As :func:`measures.rolling_calendar_days` with the totals of all shipments."""
        if DAY in s.by:
            raise ValueError("rolling figures span days, so they can't be sliced by day")
        # No more rows in a group of the window than there are days.
        dated = F.when((F.col("shipments") > 0) & F.col(DAY).isNotNull(), F.col(DAY) if s.as_of is None else F.lit(s.as_of))
        rows = self.daily(s).withColumn("top", F.max(dated).over(Window.partitionBy(*s.by)))
        age = F.datediff("top", DAY)

        def share(first: int, last: int) -> Column:
            inside = age.between(first, last)
            return divide(F.sum(F.when(inside, F.col("otif"))), F.sum(F.when(inside, F.col("lines"))))

        rolled = rows.groupBy(*s.by).agg(
            *_sums(LINES), F.max("top").alias("last_day"),
            share(0, 6).alias("rolling_7d"), share(0, 29).alias("rolling_30d"), share(7, 13).alias("previous_7d"),
        )
        return rolled.where(F.col("last_day").isNotNull()) if s.by else rolled

    def vendor_failures(self, s: Slice, *, recent: int = 100) -> DataFrame:
        """As :func:`measures.vendor_failures`: failed ones of each vendor's most recent shipments, whole days."""
        daily = self.daily(Slice(("vendor_code",), s.filters, s.as_of)).where(F.col(DAY).isNotNull() & (F.col("shipments") > 0))
        newer = Window.partitionBy("vendor_code").orderBy(F.desc(DAY)).rowsBetween(Window.unboundedPreceding, -1)
        after = F.coalesce(F.sum("shipments").over(newer), F.lit(0))
        return daily.withColumn("after", after).where(F.col("after") < recent).groupBy("vendor_code").agg(F.sum("failed").alias("value"))

    def measure_table(self, s: Slice) -> DataFrame:
        return m.service_levels(self.rolling(s), s, self.cfg)

    def measure(self, name: str, s: Slice = Slice()) -> DataFrame:
        """``by… , value`` of one of :data:`MEASURES`."""
        frame, value = MEASURES[name]
        return frame(self, s).select(*s.by, value().alias("value"))

    def vendor_table(self, *, filters: dict | None = None) -> DataFrame:
        """Vendors worst first: rolling share, volume, status, failures; of vendors that aren't told, no failures."""
        s = Slice(("vendor_code",), filters or {})
        rolled, failed = self.rolling(s).alias("r"), self.vendor_failures(s).alias("f")
        share = F.col("rolling_7d")
        return rolled.join(failed, F.col("r.vendor_code") == F.col("f.vendor_code"), "left").select(
            "r.vendor_code", share.alias("rolling_7d_otif"), F.coalesce("lines", F.lit(0)).alias("total_lines"),
            m.compliance_status(m.compliance_score(share)).alias("sla_status"), F.col("value").alias("consecutive_failures"),
        ).orderBy("rolling_7d_otif", "vendor_code")


_share = lambda c: (lambda: divide(c, "lines"))
_col = lambda c: (lambda: F.col(c))
#: Measures that the cube answers: the figures they are read from, and how.
MEASURES = {
    "total_delivery_lines": (Cube.line_counts, _col("lines")),
    "on_time_count": (Cube.line_counts, _col("on_time")),
    "in_full_count": (Cube.line_counts, _col("in_full")),
    "otif_count": (Cube.line_counts, _col("otif")),
    "otif_share": (Cube.line_counts, _share("otif")),
    "on_time_share": (Cube.line_counts, _share("on_time")),
    "in_full_share": (Cube.line_counts, _share("in_full")),
    "carrier_on_time_share": (Cube.line_counts, _share("on_time")),
    "rolling_7d_otif": (Cube.rolling, _col("rolling_7d")),
    "rolling_30d_otif": (Cube.rolling, _col("rolling_30d")),
    "otif_trend": (Cube.rolling, lambda: F.col("rolling_7d") - F.col("previous_7d")),
    "avg_order_to_ship_days": (Cube.milestones, _col("order_to_ship")),
    "avg_ship_to_delivery_days": (Cube.milestones, _col("ship_to_delivery")),
    "avg_total_lead_time_days": (Cube.milestones, _col("lead_time")),
}
