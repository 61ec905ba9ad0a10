"""Orders put together again from their lines: an order is complete once no further
line arrives for a while. An addition of this library, kept apart from the products."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions import keep

MEASURES = ["first_line_at", "last_line_at", "line_count", "total_price"]


def _lines(events: DataFrame) -> DataFrame:
    placed = keep(events, F.col("eventType") == "ORDER_PLACED", "eventTimestamp")
    return placed.select(
        F.col("orderId").alias("order_id"),
        F.col("eventTimestamp").alias("ts"),
        F.col("lineItem.price").alias("price"),
    )


def order_assembly(events: DataFrame, gap_seconds: int = 5) -> DataFrame:
    """Batch form. A silence of more than ``gap_seconds`` starts a new assembly.

    Lines less than one gap apart always belong together, so lines are first
    summed per order and gap-sized time bucket. However many lines an order
    has, the sessions are then cut from at most one row per bucket.
    """
    bucket = F.window("ts", f"{gap_seconds} seconds")["start"]
    buckets = (
        _lines(events)
        .groupBy("order_id", bucket.alias("bucket"))
        .agg(
            F.min("ts").alias("first_at"),
            F.max("ts").alias("last_at"),
            F.count("*").alias("n"),
            F.sum("price").alias("price"),
        )
    )
    w = Window.partitionBy("order_id").orderBy("bucket")
    silence = F.col("first_at") - F.lag("last_at").over(w)
    starts = F.coalesce((silence > F.make_dt_interval(secs=F.lit(gap_seconds))).cast("int"), F.lit(0))
    return (
        buckets.withColumn("starts", starts)
        .withColumn("session", F.sum("starts").over(w))
        .groupBy("order_id", "session")
        .agg(
            F.min("first_at").alias("first_line_at"),
            F.max("last_at").alias("last_line_at"),
            F.sum("n").alias("line_count"),
            F.sum("price").try_cast("decimal(12,2)").alias("total_price"),
        )
        .select("order_id", *MEASURES)
    )


def order_assembly_stream(events: DataFrame, gap_seconds: int = 5) -> DataFrame:
    """Streaming form: a session per order, emitted once event time has passed its end.
    The watermark must already be set on ``eventTimestamp``."""
    return (
        _lines(events)
        .groupBy("order_id", F.session_window("ts", f"{gap_seconds} seconds"))
        .agg(
            F.min("ts").alias("first_line_at"),
            F.max("ts").alias("last_line_at"),
            F.count("*").alias("line_count"),
            F.sum("price").try_cast("decimal(12,2)").alias("total_price"),
        )
        .select("order_id", *MEASURES)
    )
