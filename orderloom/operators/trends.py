"""Sales trends: fulfilled lines per item, line, location and tumbling window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import keep
from orderloom.schemas import REVENUE

FIVE_MINUTES, ONE_DAY = "5 minutes", "1 day"


def _fulfilled(events: DataFrame) -> DataFrame:
    done = (F.col("eventType") == "LINE_ITEM_STATUS_CHANGED") & (
        F.col("orderStatus") == "FULFILLED"
    )
    return keep(events, done, "eventTimestamp")


def _output(grouped: DataFrame) -> DataFrame:
    return grouped.select(
        "item",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "order_count",
        # NULL instead of an error when the sum needs more digits
        F.col("total").try_cast(REVENUE).alias("revenue"),
        "assembly_line",
        "location",
    )


def trends(events: DataFrame, size: str) -> DataFrame:
    """Count and revenue of FULFILLED lines. NULL line and location are groups of their own.

    Hub FULFILLED events carry no price or location, so both are NULL there; see
    :func:`trends_enriched`.
    """
    rows = _fulfilled(events).select(
        F.window("eventTimestamp", size).alias("window"),
        F.col("lineItem.item").alias("item"),
        F.col("lineItem.assemblyLine").alias("assembly_line"),
        "location",
        F.col("lineItem.price").alias("price"),
    )
    return _output(
        rows.groupBy("window", "item", "assembly_line", "location").agg(
            F.count("*").alias("order_count"), F.sum("price").alias("total")
        )
    )


def trends_enriched(events: DataFrame, size: str) -> DataFrame:
    """Trends with price and location taken from the line's own ORDER_PLACED event.

    Both sides are aggregated before they meet: fulfilments to a count per line
    and window, placements to the newest price and location per line. A line that
    repeats very often thus reaches the join as a few rows. Lines without a complete
    key match nothing; a further join column, their group's hash, keeps them from
    meeting in one task.
    """
    key = ["order_id", "item_id"]
    done = (
        _fulfilled(events)
        .select(
            F.window("eventTimestamp", size).alias("window"),
            F.col("orderId").alias("order_id"),
            F.col("lineItem.itemId").alias("item_id"),
            F.col("lineItem.item").alias("item"),
            F.col("lineItem.assemblyLine").alias("assembly_line"),
        )
        .groupBy("window", *key, "item", "assembly_line")
        .agg(F.count("*").alias("n"))
    )
    placed = (
        events.where(F.col("eventType") == "ORDER_PLACED")
        .select(
            F.col("orderId").alias("order_id"),
            F.col("lineItem.itemId").alias("item_id"),
            F.struct("eventTimestamp", "lineItem.price", "location").alias("placement"),
        )
        .where(F.col("order_id").isNotNull() & F.col("item_id").isNotNull())
        .groupBy(*key)
        .agg(F.max("placement").alias("placement"))
        .select(*key, "placement.price", "placement.location")
    )
    complete = F.col("order_id").isNotNull() & F.col("item_id").isNotNull()
    spread = F.when(complete, 0).otherwise(
        F.hash("window", *key, "item", "assembly_line").bitwiseOR(F.lit(1))
    )
    done = done.withColumn("spread", spread)
    placed = placed.withColumn("spread", F.lit(0))
    return _output(
        done.join(placed, [*key, "spread"], "left")
        .groupBy("window", "item", "assembly_line", "location")
        .agg(F.sum("n").alias("order_count"), F.sum(F.col("n") * F.col("price")).alias("total"))
    )
