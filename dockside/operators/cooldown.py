"""At most one alert per key and cooldown period.

Which alert may fire depends on the last one that *did*, so this is a chain:
each fired alert points at the first alert a full period later.  The chain is
found by joins: every alert is linked to its successor, links are squared
(1, 2, 4, ... steps), and the set of fired alerts doubles its reach in every
round, so the number of rounds is the logarithm of the chain's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dockside.config import SlaConfig
from dockside.plans.ordered import ordered_columns
from dockside.plans.staging import stage

KEY = ["alert_type", "entity"]


def period_micros(cfg: SlaConfig, alert_type: str = "alert_type") -> Column:
    """Cooldown length per alert type: streak alerts may repeat sooner."""
    hours = F.when(F.col(alert_type) == "CONSECUTIVE_FAILURES", cfg.streak_cooldown_hours)
    return hours.otherwise(cfg.cooldown_hours).cast("long") * 3_600_000_000


def throttle(alerts: DataFrame, cfg: SlaConfig = SlaConfig()) -> DataFrame:
    """The alerts that fire.  Needs alert_id, alert_type, entity and ts."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    # Alerts of one key at one instant are one candidate: the lowest id.
    nodes = stage(
        alerts.groupBy(*KEY, at.alias("at"), period_micros(cfg).alias("period")).agg(
            F.min("alert_id").alias("alert_id")
        ),
        "cooldown-nodes",
    )
    fired = _chained(nodes).select("alert_id")
    return alerts.join(fired, "alert_id", "left_semi").select(*alerts.columns)


def _chained(nodes: DataFrame) -> DataFrame:
    """The nodes that the chain from each key's first alert reaches."""
    links = stage(_successors(nodes), "cooldown-links")
    reached = nodes.groupBy(*KEY).agg(F.min("at").alias("at"))
    while not links.isEmpty():
        further = reached.join(links, [*KEY, "at"]).select(*KEY, F.col("to").alias("at"))
        reached = stage(reached.unionByName(further), "cooldown-reached")
        second = links.select(*KEY, F.col("at").alias("to"), F.col("to").alias("far"))
        links = stage(
            links.join(second, [*KEY, "to"]).select(*KEY, "at", F.col("far").alias("to")),
            "cooldown-links",
        )
    return nodes.join(reached, [*KEY, "at"], "left_semi")


def _successors(nodes: DataFrame) -> DataFrame:
    """Every alert with the first alert at least one period later.

    Alerts and probes (an alert's time plus its period) are merged in falling
    time; the running minimum of the alert times seen so far is the first
    alert at or after each probe.
    """
    none = F.lit(None).cast("long")
    marks = nodes.select(*KEY, F.col("at").alias("t"), F.lit(0).alias("kind"),
                         F.col("at").alias("alert_at"), none.alias("src"))
    probes = nodes.select(*KEY, (F.col("at") + F.col("period")).alias("t"), F.lit(1).alias("kind"),
                          none.alias("alert_at"), F.col("at").alias("src"))
    merged = ordered_columns(
        marks.unionByName(probes), KEY, [("t", False), ("kind", True)],
        running={"to": ("alert_at", "min")},
    )
    return merged.where(F.col("src").isNotNull() & F.col("to").isNotNull()).select(
        *KEY, F.col("src").alias("at"), "to"
    )
