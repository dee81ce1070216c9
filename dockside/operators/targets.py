"""Targets with a period of validity.

A target row names a vendor, a carrier, both or neither, and the days it holds, the last included; an open end holds on.  For a
figure of a vendor, a carrier and a day the most specific valid row counts (vendor and carrier, vendor, carrier, all), of
several the one that began last, of those the highest.  Validity is matched by months, an equal join, and the days compared
within; only distinct keys and days of the figures meet the targets, so a vendor with many figures costs as much as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dockside.plans.ordered import same_keys
from dockside.plans.staging import stage

#: From the most specific on.
LEVELS = (("vendor_code", "carrier_code"), ("vendor_code",), ("carrier_code",), ())
SCHEMA = "vendor_code string, carrier_code string, valid_from date, valid_to date, target double"


def with_targets(figures: DataFrame, targets: DataFrame, *, day: str, default: float) -> DataFrame:
    """``figures`` (vendor_code, carrier_code, ``day``) with the target that holds for each row."""
    last = figures.agg(F.max(day)).first()[0]
    until = F.coalesce("valid_to", F.lit(last).cast("date"))
    spans = stage(
        targets.withColumn("until", until).where(F.col("until") >= F.col("valid_from")).withColumn(
            "month", F.explode(F.sequence(F.trunc("valid_from", "month"), F.trunc("until", "month"), F.expr("INTERVAL 1 MONTH")))
        ), "target-spans",
    )
    out, found = figures, []
    for k, keys in enumerate(LEVELS):
        named = F.lit(True)
        for c in LEVELS[0]:
            named = named & (F.col(c).isNotNull() if c in keys else F.col(c).isNull())
        asked = figures.select(*keys, F.col(day).alias("on_day")).distinct().withColumn("month", F.trunc("on_day", "month"))
        held = asked.alias("f").join(spans.where(named).alias("t"), [*keys, "month"]).where(
            F.col("on_day").between(F.col("valid_from"), F.col("until"))
        ).groupBy(*keys, "on_day").agg(F.max(F.struct("valid_from", "target")).alias("best"))
        name = f"_target_{k}"
        held = stage(held.select(*keys, F.col("on_day").alias(day), F.col("best.target").alias(name)), "targets-held")
        on = same_keys("o", "h", [*keys, day])
        out = out.alias("o").join(held.alias("h"), on, "left").select("o.*", f"h.{name}")
        found.append(name)
    return out.withColumn("target", F.coalesce(*found, F.lit(default))).drop(*found)


def misses(figures: DataFrame, targets: DataFrame, *, day: str, share: str, default: float) -> DataFrame:
    """Figures below the target of their day, and by how much."""
    return with_targets(figures, targets, day=day, default=default).where(F.col(share) < F.col("target")).withColumn(
        "gap", F.col("target") - F.col(share)
    )
