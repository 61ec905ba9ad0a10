"""Inventory turnover per item and hour, and stockout risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import keep

ONE_HOUR = "1 hour"


def _requests(stock_events: DataFrame) -> DataFrame:
    rows = keep(
        stock_events, F.col("event_type") == "RESTOCK_REQUESTED", "event_timestamp"
    )
    return rows.select("item", F.col("event_timestamp").alias("ts"))


def _cancellations(order_events: DataFrame) -> DataFrame:
    timed = F.col("eventTimestamp").isNotNull()
    rows = keep(
        order_events, timed & (F.col("eventType") == "ORDER_CANCELLED"), "eventTimestamp"
    )
    return rows.select(F.col("lineItem.item").alias("item"), F.col("eventTimestamp").alias("ts"))


def _per_hour(rows: DataFrame, *measures: Column) -> DataFrame:
    grouped = rows.groupBy(F.window("ts", ONE_HOUR).alias("window"), "item").agg(*measures)
    rest = [c for c in grouped.columns if c not in ("window", "item")]
    return grouped.select(
        "item",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *rest,
    )


def request_partials(stock_events: DataFrame) -> DataFrame:
    return _per_hour(
        _requests(stock_events), F.count("*").alias("restock_requested_count")
    ).withColumn("stockout_cancelled_count", F.lit(0).cast("bigint"))


def cancellation_partials(order_events: DataFrame) -> DataFrame:
    counted = _per_hour(
        _cancellations(order_events), F.count("*").alias("stockout_cancelled_count")
    )
    return counted.withColumn("restock_requested_count", F.lit(0).cast("bigint"))


def turnover_partials(stock_events: DataFrame, order_events: DataFrame) -> DataFrame:
    """Up to two rows per item and hour: requests alone and cancellations alone."""
    return request_partials(stock_events).unionByName(cancellation_partials(order_events))


def turnover_from_partials(partials: DataFrame) -> DataFrame:
    """One row per item and hour, from stored partial rows."""
    return partials.groupBy("item", "window_start", "window_end").agg(
        F.sum("restock_requested_count").alias("restock_requested_count"),
        F.sum("stockout_cancelled_count").alias("stockout_cancelled_count"),
    )


def turnover(stock_events: DataFrame, order_events: DataFrame) -> DataFrame:
    """The same result straight from the events: one union, one aggregation, one shuffle."""
    tagged = (
        _requests(stock_events)
        .withColumn("requested", F.lit(True))
        .unionByName(_cancellations(order_events).withColumn("requested", F.lit(False)))
    )
    return _per_hour(
        tagged,
        F.count_if(F.col("requested")).alias("restock_requested_count"),
        F.count_if(~F.col("requested")).alias("stockout_cancelled_count"),
    )


def stockout_risk_current(order_events: DataFrame) -> DataFrame:
    """Items ever cancelled for lack of stock. The flag never returns to false."""
    grouped = _cancellations(order_events).groupBy("item")
    return grouped.agg(F.max("ts").alias("last_stockout_event_at")).select(
        "item", F.lit(True).alias("at_risk"), "last_stockout_event_at"
    )


def stockout_risk_hourly(order_events: DataFrame) -> DataFrame:
    """One row per item and hour with a cancellation; the hour itself is not kept."""
    hourly = _per_hour(
        _cancellations(order_events), F.max("ts").alias("last_stockout_event_at")
    )
    return hourly.select("item", F.lit(True).alias("at_risk"), "last_stockout_event_at")
