"""Hand-made tables of a few rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from dockside.schemas import DEFAULTS, GENERIC
from dockside.tables import Tables


def day(text):
    return dt.date.fromisoformat(text)


def _value(field, v):
    if v is None:
        return None
    if isinstance(field.dataType, T.DecimalType):
        return Decimal(str(v))
    if isinstance(field.dataType, T.DateType) and isinstance(v, str):
        return day(v)
    if isinstance(field.dataType, T.TimestampNTZType) and isinstance(v, str):
        return dt.datetime.fromisoformat(v)
    return v


def frame(spark, schema, rows):
    data = [tuple(_value(f, r.get(f.name)) for f in schema) for r in rows]
    return spark.createDataFrame(data, schema)


def tables(spark, **rows):
    """Tables from {name: [row dicts]}; a missing column takes its default."""
    out = {}
    for name, schema in GENERIC.items():
        filled = [{**DEFAULTS.get(name, {}), **r} for r in rows.get(name, [])]
        out[name] = frame(spark, schema, filled)
    return Tables(**out)


def one_line_order(i, *, requested, delivered_on, ordered=10, delivered=10, damage=0, vendor="V1",
                   region="R1", price=5, **shipment):
    """Rows of one order with one line and one shipment."""
    number = f"O{i}"
    return dict(
        orders=[dict(order_id=i, order_number=number, customer_code="C1", order_date="2024-01-01",
                     requested_delivery_date=requested, order_status="completed", total_value=100)],
        order_lines=[dict(order_line_id=i, order_number=number, line_number=1, sku="S1", category="K",
                          ordered_qty=ordered, confirmed_qty=ordered, unit_price=price)],
        shipments=[dict(shipment_id=i, shipment_number=f"SH{i:04d}", order_number=number, vendor_code=vendor,
                        vendor_region=region, carrier_code="CA", carrier_name="Carrier A", carrier_mode="truck",
                        shipping_point="P1", actual_delivery_date=delivered_on, actual_ship_date="2024-01-02",
                        planned_ship_date="2024-01-02", **shipment)],
        delivery_lines=[dict(delivery_line_id=i, shipment_number=f"SH{i:04d}", order_number=number, line_number=1,
                             sku="S1", delivered_qty=delivered, damage_qty=damage)],
    )


def merged(*parts):
    out = {}
    for part in parts:
        for name, rows in part.items():
            out.setdefault(name, []).extend(rows)
    return out


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]
