"""Order event hub: raw order, completion and cancellation topics in one event schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import (
    assembly_line,
    event_id,
    last_value,
    null_of,
    source_domain,
)
from orderloom.schemas import EVENT_LINE_ITEM, LINE_A, LINE_B, ORDER_LINE, PRICE

_LINES = f"array<{ORDER_LINE.simpleString()}>"


def _line_item(**values: Column) -> Column:
    """Line item struct in contract order; fields not given are typed NULLs."""
    return F.struct(
        *[
            values.get(f.name, null_of(f.dataType)).alias(f.name)
            for f in EVENT_LINE_ITEM.fields
        ]
    )


def placed_events(orders_in: DataFrame) -> DataFrame:
    """One ORDER_PLACED per order line. NULL and empty line arrays give no event.

    Both arrays are unnested together, in one pass over the orders; a line's
    position tells which array it came from.
    """
    first, second = F.col("qdca10LineItems"), F.col("qdca10proLineItems")
    both = F.concat(*[F.coalesce(a, F.array().cast(_LINES)) for a in (first, second)])
    lines = orders_in.select(
        "id",
        "orderSource",
        "location",
        "loyaltyMemberId",
        "event_time",
        F.coalesce(F.size(first), F.lit(0)).alias("in_first"),
        F.posexplode(both).alias("position", "li"),
    )
    line = F.when(F.col("position") < F.col("in_first"), LINE_A).otherwise(LINE_B)
    return lines.select(
        event_id(F.col("id"), F.col("li.itemId"), "ORDER_PLACED", F.col("event_time")).alias(
            "eventId"
        ),
        F.col("id").alias("orderId"),
        F.lit("ORDER_PLACED").alias("eventType"),
        F.col("event_time").alias("eventTimestamp"),
        "orderSource",
        "location",
        "loyaltyMemberId",
        F.lit("PLACED").alias("orderStatus"),
        _line_item(
            itemId=F.col("li.itemId"),
            item=F.col("li.item"),
            name=F.col("li.name"),
            price=F.col("li.price").cast(PRICE),
            lineItemStatus=F.lit("PLACED"),
            assemblyLine=line,
        ).alias("lineItem"),
        F.lit("counter").alias("sourceDomain"),
        F.lit("orders-in").alias("sourceTopic"),
    )


def status_events(orders_up: DataFrame) -> DataFrame:
    """A completion message means its line is FULFILLED; the host tells the line."""
    made_by = F.col("madeBy")
    return orders_up.select(
        event_id(
            F.col("orderId"), F.col("lineItemId"), "FULFILLED", F.col("event_time")
        ).alias("eventId"),
        "orderId",
        F.lit("LINE_ITEM_STATUS_CHANGED").alias("eventType"),
        F.col("event_time").alias("eventTimestamp"),
        null_of("string").alias("orderSource"),
        null_of("string").alias("location"),
        null_of("string").alias("loyaltyMemberId"),
        F.lit("FULFILLED").alias("orderStatus"),
        _line_item(
            itemId=F.col("lineItemId"),
            item=F.col("item"),
            name=F.col("name"),
            lineItemStatus=F.lit("FULFILLED"),
            assemblyLine=assembly_line(made_by),
            madeBy=made_by,
        ).alias("lineItem"),
        source_domain(made_by).alias("sourceDomain"),
        F.lit("orders-up").alias("sourceTopic"),
    )


def cancelled_events(eighty_six: DataFrame) -> DataFrame:
    """A stockout cancels the line; only its id and item are known."""
    return eighty_six.select(
        event_id(
            F.col("orderId"), F.col("lineItemId"), "ORDER_CANCELLED", F.col("event_time")
        ).alias("eventId"),
        "orderId",
        F.lit("ORDER_CANCELLED").alias("eventType"),
        F.col("event_time").alias("eventTimestamp"),
        null_of("string").alias("orderSource"),
        null_of("string").alias("location"),
        null_of("string").alias("loyaltyMemberId"),
        F.lit("CANCELLED").alias("orderStatus"),
        _line_item(itemId=F.col("lineItemId"), item=F.col("item")).alias("lineItem"),
        F.lit("qdca10").alias("sourceDomain"),
        F.lit("eighty-six").alias("sourceTopic"),
    )


def order_events(orders_in: DataFrame, orders_up: DataFrame, eighty_six: DataFrame) -> DataFrame:
    """The hub. A consumer's filter on eventType prunes the branches it does not need."""
    return (
        placed_events(orders_in)
        .unionByName(status_events(orders_up))
        .unionByName(cancelled_events(eighty_six))
    )


def history(events: DataFrame) -> DataFrame:
    """Flat append-only form. The line's ``item`` code and host are not part of it."""
    return events.select(
        F.col("eventId").alias("event_id"),
        F.col("orderId").alias("order_id"),
        F.col("eventType").alias("event_type"),
        F.col("eventTimestamp").alias("event_timestamp"),
        F.col("orderSource").alias("order_source"),
        "location",
        F.col("loyaltyMemberId").alias("loyalty_member_id"),
        F.col("orderStatus").alias("order_status"),
        F.col("lineItem.itemId").alias("line_item_id"),
        F.col("lineItem.name").alias("line_item_name"),
        F.col("lineItem.price").alias("line_item_price"),
        F.col("lineItem.lineItemStatus").alias("line_item_status"),
        F.col("lineItem.assemblyLine").alias("assembly_line"),
        F.col("sourceDomain").alias("source_domain"),
        F.col("sourceTopic").alias("source_topic"),
    )


def current(events: DataFrame) -> DataFrame:
    """Latest state per order.

    Status is the newest one, at equal times the one further in the life cycle.
    Source, location, loyalty id and line are the newest non-NULL values. One
    shuffle by order, partially aggregated before it.
    """
    stage = (
        F.when(F.col("orderStatus") == "PLACED", 0)
        .when(F.col("orderStatus") == "IN_PROGRESS", 1)
        .when(F.col("orderStatus") == "FULFILLED", 2)
        .when(F.col("orderStatus") == "CANCELLED", 3)
        .otherwise(-1)
    )
    rows = events.select(
        F.col("orderId").alias("order_id"),
        F.col("eventTimestamp").alias("ts"),
        F.col("eventType").alias("event_type"),
        stage.alias("stage"),
        F.col("orderStatus").alias("order_status"),
        F.col("orderSource").alias("order_source"),
        "location",
        F.col("loyaltyMemberId").alias("loyalty_member_id"),
        F.col("lineItem.assemblyLine").alias("assembly_line"),
    )
    placed_ts = F.when(F.col("event_type") == "ORDER_PLACED", F.col("ts"))
    return rows.groupBy("order_id").agg(
        F.max(F.struct("ts", "stage", "order_status"))
        .getField("order_status")
        .alias("order_status"),
        last_value("order_source", "ts").alias("order_source"),
        last_value("location", "ts").alias("location"),
        last_value("loyalty_member_id", "ts").alias("loyalty_member_id"),
        F.min(placed_ts).alias("placed_at"),
        F.max("ts").alias("last_updated_at"),
        last_value("assembly_line", "ts").alias("assembly_line"),
    )
