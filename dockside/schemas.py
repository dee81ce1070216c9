"""Explicit column types of the common tables and of the ERP-shaped sources."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
QTY = T.DecimalType(18, 3)

_ALIASES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "str": T.StringType(),
    "float": T.FloatType(),
    "date": T.DateType(),
    "ts": T.TimestampNTZType(),
    "money": MONEY,
    "qty": QTY,
    "m15": T.DecimalType(15, 2),
    "q15": T.DecimalType(15, 3),
    "n6": T.DecimalType(6, 0),
    "n4": T.DecimalType(4, 0),
    "double": T.DoubleType(),
}


def _struct(spec: str) -> T.StructType:
    fields = []
    for item in spec.split():
        name, kind = item.split(":")
        fields.append(T.StructField(name, _ALIASES[kind], True))
    return T.StructType(fields)


GENERIC: dict[str, T.StructType] = {
    "customers": _struct(
        "customer_id:long customer_code:str customer_name:str region:str country:str"
    ),
    "vendors": _struct(
        "vendor_id:long vendor_code:str vendor_name:str region:str country:str tier:str "
        "otif_rate:float on_time_rate:float in_full_rate:float"
    ),
    "products": _struct(
        "product_id:long sku:str product_name:str category:str subcategory:str "
        "unit_of_measure:str unit_price:money"
    ),
    "carriers": _struct(
        "carrier_id:long carrier_code:str carrier_name:str mode:str on_time_rate:float"
    ),
    "orders": _struct(
        "order_id:long order_number:str customer_code:str order_date:date "
        "requested_delivery_date:date order_status:str channel:str currency:str total_value:money"
    ),
    "order_lines": _struct(
        "order_line_id:long order_number:str line_number:int sku:str product_name:str category:str "
        "ordered_qty:qty confirmed_qty:qty unit_price:money line_total:money "
        "partial_delivery_allowed:int"
    ),
    "shipments": _struct(
        "shipment_id:long shipment_number:str order_number:str carrier_code:str carrier_name:str "
        "carrier_mode:str vendor_code:str vendor_region:str shipping_point:str route:str "
        "planned_ship_date:date planned_delivery_date:date actual_ship_date:date "
        "actual_delivery_date:date shipment_status:str delivery_type:str incoterm:str"
    ),
    "delivery_lines": _struct(
        "delivery_line_id:long shipment_number:str order_number:str line_number:int "
        "product_id:long sku:str delivered_qty:qty damage_qty:qty"
    ),
    "backorders": _struct(
        "backorder_id:long order_number:str line_number:int product_id:long backorder_qty:qty "
        "estimated_fill_date:date status:str created_at:ts"
    ),
    "alert_history": _struct(
        "alert_history_id:long alert_type:str entity:str region:str severity:str "
        "metric_value:float threshold_value:float alert_description:str channels:str "
        "acknowledged:int acknowledged_by:str acknowledged_at:ts escalated:int created_at:ts"
    ),
}

# Values a column takes when the *whole column* is missing on load.
DEFAULTS: dict[str, dict[str, object]] = {
    "customers": {"country": "US"},
    "vendors": {"country": "US", "tier": "standard"},
    "products": {"unit_of_measure": "EA"},
    "carriers": {"mode": "truck"},
    "orders": {"order_status": "pending", "currency": "USD"},
    "order_lines": {"partial_delivery_allowed": 1},
    "shipments": {"shipment_status": "pending", "delivery_type": "outbound"},
    "delivery_lines": {"damage_qty": 0},
    "backorders": {"status": "open"},
    "alert_history": {"acknowledged": 0, "escalated": 0},
}

# Tables whose load time stands in for a missing creation stamp.
STAMPED = {"backorders": "created_at", "alert_history": "created_at"}

SURROGATE_KEYS = {
    "customers": "customer_id",
    "vendors": "vendor_id",
    "products": "product_id",
    "carriers": "carrier_id",
    "orders": "order_id",
    "order_lines": "order_line_id",
    "shipments": "shipment_id",
    "delivery_lines": "delivery_line_id",
    "backorders": "backorder_id",
    "alert_history": "alert_history_id",
}

# Natural keys give surrogate numbering a stable order.
NATURAL_KEYS = {
    "customers": ["customer_code"],
    "vendors": ["vendor_code"],
    "products": ["sku"],
    "carriers": ["carrier_code"],
    "orders": ["order_number"],
    "order_lines": ["order_number", "line_number"],
    "shipments": ["shipment_number"],
    "delivery_lines": ["shipment_number", "order_number", "line_number"],
    "backorders": ["order_number", "line_number", "created_at", "backorder_qty"],
    "alert_history": ["created_at", "alert_type", "entity"],
}

ERP: dict[str, T.StructType] = {
    "kna1": _struct("mandt:int kunnr:str name1:str ort01:str regio:str land1:str"),
    "lfa1": _struct("mandt:int lifnr:str name1:str regio:str land1:str"),
    "mara": _struct("mandt:int matnr:str maktx:str meins:str mtart:str matkl:str"),
    "vbak": _struct(
        "mandt:int vbeln:str erdat:date erzet:str audat:date vkorg:str vtweg:str spart:str "
        "kunnr:str kunwe:str kunag:str vbtyp:str auart:str netwr:m15 waerk:str"
    ),
    "vbap": _struct(
        "mandt:int vbeln:str posnr:n6 matnr:str matkl:str kwmeng:q15 vrkme:str meins:str "
        "netwr:m15 pmgcn:str werks:str"
    ),
    "vbep": _struct(
        "mandt:int vbeln:str posnr:n6 etenr:n4 edatu:date ezeit:str wmeng:q15 lmeng:q15 bmeng:q15"
    ),
    "likp": _struct(
        "mandt:int vbeln:str erdat:date erzet:str lfdat:date wadat:date wadat_ist:date lfuhr:str "
        "podat:date potim:str vstel:str vkorg:str kunnr:str kunwe:str lfart:str route:str "
        "inco1:str vsart:str"
    ),
    "lips": _struct(
        "mandt:int vbeln:str posnr:n6 matnr:str matkl:str lfimg:q15 vrkme:str pstyv:str "
        "vgbel:str vgpos:n6 uepos:n6 werks:str"
    ),
    "vbfa": _struct(
        "mandt:int vbeln:str posnn:n6 vbeln_v:str posnv:n6 vbtyp_n:str vbtyp_v:str rfmng:q15"
    ),
}

# Blank-padded fixed-width columns lose their padding on ingest.
ERP_PADDED = {"kna1": ["land1"], "lfa1": ["land1"]}

# The eleven required members of an incoming alert event.
ALERT_EVENT = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("alertTitle", T.StringType()),
        T.StructField("dashboardName", T.StringType()),
        T.StructField("cardName", T.StringType()),
        T.StructField("metricName", T.StringType()),
        T.StructField("metricValue", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("direction", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("dashboardId", T.StringType()),
        T.StructField("occurred", T.TimestampType()),
    ]
)
