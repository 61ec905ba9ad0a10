"""Declared schemas and value domains. Schemas are never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: names and codes the data itself carries ---------------------
LINE_A = "QDCA10"
LINE_B = "QDCA10PRO"
ASSEMBLY_LINES = (LINE_A, LINE_B)
# host-name prefix -> (assembly line, source domain)
HOST_PREFIXES = {
    "qdca10": (LINE_A, "qdca10"),
    "qdca10pro": (LINE_B, "qdca10pro"),
}
EVENT_TYPES = ("ORDER_PLACED", "LINE_ITEM_STATUS_CHANGED", "ORDER_CANCELLED")
ORDER_SOURCES = ("COUNTER", "WEB", "PARTNER")
LOCATIONS = ("ATLANTA", "CHARLOTTE", "RALEIGH", "TOKYO")
ORDER_STATUSES = ("PLACED", "IN_PROGRESS", "FULFILLED", "CANCELLED")
LINE_ITEM_STATUSES = ("PLACED", "IN_PROGRESS", "FULFILLED")
STOCK_EVENT_TYPES = ("RESTOCK_REQUESTED", "RESTOCK_COMPLETED")
# raw stock event code -> published code
STOCK_EVENT_CODES = {
    "RESTOCK_REQUESTED_EVENT": "RESTOCK_REQUESTED",
    "RESTOCK_COMPLETED_EVENT": "RESTOCK_COMPLETED",
}
# --- end of fixed values ------------------------------------------------------

PRICE = T.DecimalType(10, 2)
REVENUE = T.DecimalType(12, 2)

_S, _L, _TS = T.StringType(), T.LongType(), T.TimestampType()


def _record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


ORDER_LINE = _record(itemId=_S, item=_S, name=_S, price=PRICE)

# Payloads of the raw topics. The event time is the record timestamp, not a payload field.
ORDERS_IN = _record(
    id=_S,
    orderSource=_S,
    location=_S,
    loyaltyMemberId=_S,
    qdca10LineItems=T.ArrayType(ORDER_LINE),
    qdca10proLineItems=T.ArrayType(ORDER_LINE),
)
ORDERS_UP = _record(orderId=_S, lineItemId=_S, item=_S, name=_S, madeBy=_S)
EIGHTY_SIX = _record(orderId=_S, lineItemId=_S, item=_S)
INVENTORY_OUT = _record(skuId=_S, item=_S, eventType=_S, quantity=_L)
STOCK_DECREMENT = _record(item=_S, quantity=_L)
COMPLETION = _record(
    orderId=_S, lineItemId=_S, item=_S, name=_S, timestamp=_S, madeBy=_S
)

EVENT_LINE_ITEM = _record(
    itemId=_S,
    item=_S,
    name=_S,
    price=PRICE,
    lineItemStatus=_S,
    assemblyLine=_S,
    madeBy=_S,
)
ORDER_EVENT = _record(
    eventId=_S,
    orderId=_S,
    eventType=_S,
    eventTimestamp=_TS,
    orderSource=_S,
    location=_S,
    loyaltyMemberId=_S,
    orderStatus=_S,
    lineItem=EVENT_LINE_ITEM,
    sourceDomain=_S,
    sourceTopic=_S,
)
