"""Event-time streams built from the same operators as the batch queries.

Each function takes streaming frames and returns a streaming frame; the caller
chooses sink and trigger. Watermarks sit above the source and below every filter
(see :func:`orderloom.functions.keep`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import keep
from orderloom.operators import assembly, customer, stock, trends, turnover
from orderloom.schemas import REVENUE
from orderloom.streaming.enriched import with_placements

# --- fixed values: how late an event may be -----------------------------------
RAW_DELAY = "5 seconds"
TREND_DELAY = "10 seconds"
PROFILE_DELAY = "30 seconds"
# --- end of fixed values ------------------------------------------------------


def raw(topic: DataFrame) -> DataFrame:
    """A raw topic with its watermark at the source. With several topics the slowest decides
    (``session.use_slowest``): one that is idle holds back what the others could close."""
    return topic.withWatermark("event_time", RAW_DELAY)


def trends_stream(events: DataFrame, size: str) -> DataFrame:
    """Append: a window is emitted once, when event time has passed its end."""
    return trends.trends(events.withWatermark("eventTimestamp", TREND_DELAY), size)


def trends_enriched_stream(events: DataFrame, placed: DataFrame, size: str) -> DataFrame:
    """Trends with price and location of the line's own ORDER_PLACED event, the newest one.

    There is no bound on the time between the two: placements stay in keyed state.
    A fulfilment counts once, with NULLs if no placement is known when event time
    has passed it. ``events`` and ``placed`` may be two reads of the hub. The
    session must use the RocksDB state store (``session.use_rocksdb``).
    """
    key = [F.col("orderId").alias("order_id"), F.col("lineItem.itemId").alias("item_id")]
    done = keep(
        events.withWatermark("eventTimestamp", TREND_DELAY),
        (F.col("eventType") == "LINE_ITEM_STATUS_CHANGED") & (F.col("orderStatus") == "FULFILLED"),
        "eventTimestamp",
    ).select(
        *key,
        F.col("lineItem.item").alias("item"),
        F.col("lineItem.assemblyLine").alias("line"),
        F.col("eventTimestamp").alias("ts"),
    )
    orders = keep(
        placed.withWatermark("eventTimestamp", TREND_DELAY),
        F.col("eventType") == "ORDER_PLACED",
        "eventTimestamp",
    ).select(
        *key, F.col("lineItem.price").alias("price"), "location", F.col("eventTimestamp").alias("ts")
    )
    joined = with_placements(done, orders)
    return (
        joined.groupBy(F.window("done_at", size).alias("window"), "item", "assembly_line", "location")
        .agg(F.count("*").alias("order_count"), F.sum("price").alias("total"))
        .select(
            "item",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "order_count",
            F.col("total").try_cast(REVENUE).alias("revenue"),
            "assembly_line",
            "location",
        )
    )


def turnover_stream(stock_events: DataFrame, order_events: DataFrame) -> DataFrame:
    """Append, hourly. The slower of the two inputs decides when an hour is over."""
    return turnover.turnover(
        stock_events.withWatermark("event_timestamp", TREND_DELAY),
        order_events.withWatermark("eventTimestamp", TREND_DELAY),
    )


def turnover_partials_stream(stock_events: DataFrame, order_events: DataFrame) -> DataFrame:
    """Append: each input's hours on their own, as the stored partial rows."""
    return turnover.turnover_partials(
        stock_events.withWatermark("event_timestamp", TREND_DELAY),
        order_events.withWatermark("eventTimestamp", TREND_DELAY),
    )


def stockout_risk_hourly_stream(order_events: DataFrame) -> DataFrame:
    """Append, one row per item and hour with a cancellation."""
    return turnover.stockout_risk_hourly(
        order_events.withWatermark("eventTimestamp", TREND_DELAY)
    )


def stockout_risk_current_stream(order_events: DataFrame) -> DataFrame:
    """Update, keyed by item."""
    return turnover.stockout_risk_current(order_events)


def stock_current_stream(inventory_out: DataFrame) -> DataFrame:
    """Update, keyed by SKU."""
    return stock.stock_current(inventory_out)


def stock_quantity_stream(inventory_out: DataFrame, decrement: DataFrame) -> DataFrame:
    """Update, keyed by item."""
    return stock.stock_quantity(inventory_out, decrement)


def customer_history_stream(events: DataFrame) -> DataFrame:
    """Append: placed lines that name a customer."""
    return customer.customer_history(events.withWatermark("eventTimestamp", PROFILE_DELAY))


def customer_last_seen_stream(events: DataFrame) -> DataFrame:
    """Update, keyed by customer: newest values."""
    return customer.last_seen(customer.customer_history(events))


def customer_order_count_stream(events: DataFrame) -> DataFrame:
    """Update, keyed by customer: number of distinct orders.

    Seen orders are remembered one state row per customer and order, spread over
    all state partitions; no row ever holds a customer's whole order list.
    """
    orders = customer.customer_history(events).select("customer_name", "order_id")
    return customer.order_counts(orders.dropDuplicates(["customer_name", "order_id"]))


def customer_profile(last_seen: DataFrame, counts: DataFrame) -> DataFrame:
    """Batch view over the two keyed customer tables."""
    return last_seen.join(counts, "customer_name", "left").select(
        F.col("customer_name").alias("customerName"),
        "loyaltyMemberId",
        "lastLocation",
        "lastOrderId",
        "lastOrderAt",
        F.coalesce("totalOrders", F.lit(0)).alias("totalOrders"),
    )


def order_assembly_stream(events: DataFrame, gap_seconds: int = 5) -> DataFrame:
    """Append: an order is emitted once it has been silent for the gap."""
    return assembly.order_assembly_stream(
        events.withWatermark("eventTimestamp", RAW_DELAY), gap_seconds
    )
