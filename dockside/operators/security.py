"""Who may see which rows, applied to the base tables before any view."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from dockside.tables import Later, Tables

REGION_SETTING = "app.region"

# Tables a role may read at all.  Anything not listed is denied.
_READ_ALL = {
    "reporting_user": set(Tables.names()),
    "auditor": {"alert_history"},
}
_BY_REGION = {
    "regional_manager": {
        "customers", "vendors", "orders", "order_lines", "shipments", "alert_history",
    },
}


def current_region(spark: SparkSession, region: str | None = None) -> str | None:
    """The caller's region; None when unset or blank, and None sees nothing."""
    value = region if region is not None else spark.conf.get(REGION_SETTING, "")
    return value or None


def secure_tables(
    t: Tables, grants: Iterable[tuple[str, str | None]] | str, region: str | None = None,
    *, derived: bool = False,
) -> Tables:
    """Rows visible to a role, or to several (role, region) grants together.

    Grants add up: a table is open when any grant opens it, otherwise it shows
    the union of the granted regions, otherwise it is empty.

    derived  let views over a region's shipments and orders also read their
             delivery lines and backorders, and the reference tables.
    """
    if isinstance(grants, str):
        grants = [(grants, region)]
    opened: set[str] = set()
    regions: set[str] = set()
    scoped: set[str] = set()
    for role, asked in grants:
        opened |= _READ_ALL.get(role, set())
        if role in _BY_REGION:
            value = current_region(t.spark, asked)
            if value is not None:
                regions.add(value)
                scoped |= _BY_REGION[role]
    inside = _region_frames(t, sorted(regions), derived)

    def seen(name: str) -> DataFrame:
        return inside[name]().select(*t.schema(name).names)

    # A table that nobody asks for is not read, and a denied one never is.
    out = {}
    for name in Tables.names():
        if name in opened:
            out[name] = t.unread(name)
        elif name in scoped or (derived and regions and name in inside):
            out[name] = Later(t.spark, t.schema(name), partial(seen, name))
        else:
            out[name] = t.spark.createDataFrame([], t.schema(name))
    return Tables(**out)


def _region_frames(t: Tables, regions: list[str], derived: bool) -> dict[str, Callable[[], DataFrame]]:
    customers = lambda: t.customers.where(F.col("region").isin(regions))
    orders = lambda: t.orders.join(customers().select("customer_code"), "customer_code", "left_semi")
    order_keys = lambda: orders().select("order_number")
    shipments = lambda: t.shipments.where(F.col("vendor_region").isin(regions))
    frames = {
        "customers": customers,
        "vendors": lambda: t.vendors.where(F.col("region").isin(regions)),
        "orders": orders,
        "order_lines": lambda: t.order_lines.join(order_keys(), "order_number", "left_semi"),
        "shipments": shipments,
        "alert_history": lambda: t.alert_history.where(F.col("region").isin(regions)),
    }
    if derived:
        frames["delivery_lines"] = lambda: t.delivery_lines.join(
            shipments().select("shipment_number"), "shipment_number", "left_semi"
        )
        frames["backorders"] = lambda: t.backorders.join(order_keys(), "order_number", "left_semi")
        frames["products"] = lambda: t.products
        frames["carriers"] = lambda: t.carriers
    return frames
