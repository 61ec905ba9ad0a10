"""Raw topics derived from the retail test tables.

Each adapter joins only what its topic needs and leaves the join strategy to
Catalyst: dimension sides are broadcast when their size allows it, and adaptive
execution splits skewed sort-merge partitions. Dimensions are left joins on
their unique key: a missing row leaves a field NULL and drops no event.
``stream=True`` gives the same topic as a stream of files cut by time.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import assembly_line, to_millis
from orderloom.schemas import LINE_A, LINE_B, LOCATIONS, ORDER_LINE, ORDER_SOURCES, PRICE
from orderloom.sources.replayed import as_stream
from orderloom.sources.tables import table

REPLAY_START = "2024-01-01 00:00:00"
REPLAY_SECONDS = 30 * 86400
# coprime to REPLAY_SECONDS: consecutive order keys spread over the whole calendar
REPLAY_STEP = 104729


# stretches of time that cover a calendar's events
ORDER_CALENDAR = (datetime(1995, 1, 1), datetime(2002, 1, 1))
STOCK_CALENDAR = (datetime(2024, 1, 1), datetime(2024, 1, 31))
LATE_DAYS = 700


def _topic(calendar: tuple[datetime, datetime], ts: str = "event_time") -> Callable:
    """Lets a batch topic be read as a stream too."""

    def wrap(batch: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(batch)
        def topic(spark: SparkSession, sf: str, stream: bool = False, **options: bool) -> DataFrame:
            df = batch(spark, sf, **options)
            if not stream:
                return df
            replay = options.get("replay", False)
            name = batch.__name__ + "_replayed" * replay
            return as_stream(df, name, sf, ts, *(STOCK_CALENDAR if replay else calendar))

        return topic

    return wrap


def _orders(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate", *columns)


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def _millis(column: str) -> Column:
    """Cut to milliseconds, without a zone."""
    return to_millis(F.col(column)).cast("timestamp_ntz")


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    """values[index], NULL beyond the end."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _order_time() -> Column:
    return _plus_seconds(F.col("o_orderdate"), F.col("o_orderkey") % 86400)


def _item_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _order_id() -> Column:
    return F.col("l_orderkey").cast("string")


def _made_by() -> Column:
    key = F.col("l_suppkey")
    prefix = (
        F.when(key % 11 == 0, "other-").when(key % 2 == 0, "qdca10-").otherwise("qdca10pro-")
    )
    return F.when(key % 13 != 0, F.concat(prefix, key.cast("string")))


def _with_order(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines and orders are both fact tables: a sort-merge join, whatever their size."""
    return lines.join(orders.hint("merge"), lines.l_orderkey == orders.o_orderkey)


def _with_part(lines: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """Adds ``p_brand``, before the lines meet their orders: where both joins shuffle, the
    lines that move to their parts are narrow."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    return lines.join(part, lines.l_partkey == part.p_partkey, "left")


def _with_customer(orders: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """Adds the customer and region columns."""
    customer = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_acctbal", "c_nationkey"
    )
    known = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    return known.join(nation, known.c_nationkey == nation.n_nationkey, "left")


def _line_delay() -> Column:
    """Seconds between an order and one of its lines. Every third order's lines come so far
    apart that its assembly is cut between them."""
    apart = F.when(F.col("l_orderkey") % 3 == 0, 9).otherwise(2)
    return (F.col("l_linenumber") - 1) * apart


@_topic(ORDER_CALENDAR)
def orders_in(spark: SparkSession, sf: str) -> DataFrame:
    """Order records. An order's lines come as separate records of one line each,
    so no record grows with the size of an order."""
    orders = _with_customer(_orders(spark, sf, "o_custkey"), spark, sf)
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"
    )
    joined = _with_order(_with_part(lines, spark, sf), orders)
    key = F.col("o_orderkey")
    line = F.struct(
        _item_id().alias("itemId"),
        F.col("p_brand").alias("item"),
        F.col("c_name").alias("name"),
        F.col("l_extendedprice").cast(PRICE).alias("price"),
    )
    none = F.array().cast(f"array<{ORDER_LINE.simpleString()}>")
    even = F.col("l_suppkey") % 2 == 0
    return joined.select(
        _order_id().alias("id"),
        _pick(key % 3, ORDER_SOURCES).alias("orderSource"),
        _pick(F.col("n_regionkey"), LOCATIONS).alias("location"),
        F.when(
            (F.col("c_acctbal") > 0) & (key % 2 == 0),
            F.concat(F.lit("L"), F.col("o_custkey").cast("string")),
        )
        .when(key % 10 == 1, "")
        .alias("loyaltyMemberId"),
        F.when(even, F.array(line)).otherwise(none).alias("qdca10LineItems"),
        F.when(~even, F.array(line)).otherwise(none).alias("qdca10proLineItems"),
        _plus_seconds(_order_time(), _line_delay()).alias("event_time"),
    )


@_topic(ORDER_CALENDAR)
def orders_up(spark: SparkSession, sf: str) -> DataFrame:
    """Completions: finished lines, one minute per unit after the order."""
    orders = _with_customer(_orders(spark, sf, "o_custkey"), spark, sf)
    lines = (
        table(spark, sf, "lineitem")
        .where(F.col("l_linestatus") == "F")
        .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    )
    return _with_order(_with_part(lines, spark, sf), orders).select(
        _order_id().alias("orderId"),
        _item_id().alias("lineItemId"),
        F.col("p_brand").alias("item"),
        F.col("c_name").alias("name"),
        _made_by().alias("madeBy"),
        _plus_seconds(_order_time(), 60 * F.col("l_quantity").cast("int")).alias("event_time"),
    )


@_topic(ORDER_CALENDAR, "arrival_time")
def orders_up_late(spark: SparkSession, sf: str) -> DataFrame:
    """Completions in order of arrival: those of every seventh order come 700 days late."""
    late = F.col("orderId").cast("long") % 7 == 3
    days = F.when(late, F.lit(LATE_DAYS)).otherwise(F.lit(0))
    return orders_up(spark, sf).withColumn(
        "arrival_time", _plus_seconds(F.col("event_time"), days * F.lit(86_400))
    )


@_topic(ORDER_CALENDAR)
def eighty_six(spark: SparkSession, sf: str, replay: bool = False) -> DataFrame:
    """Cancellations: returned lines that were never finished.

    ``replay`` puts them on the calendar of the stock events, so that hourly
    windows of both can meet; the order table is not needed then.
    """
    lines = (
        table(spark, sf, "lineitem")
        .where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"))
        .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    )
    lines = _with_part(lines, spark, sf)
    if replay:
        start = F.lit(REPLAY_START).cast("timestamp_ntz")
        when = _plus_seconds(start, F.col("l_orderkey") * REPLAY_STEP % REPLAY_SECONDS)
    else:
        lines = _with_order(lines, _orders(spark, sf))
        when = _plus_seconds(_order_time(), F.lit(120))
    return lines.select(
        _order_id().alias("orderId"),
        _item_id().alias("lineItemId"),
        F.col("p_brand").alias("item"),
        when.alias("event_time"),
    )


@_topic(STOCK_CALENDAR)
def inventory_out(spark: SparkSession, sf: str) -> DataFrame:
    """Stock messages: purchases request a restock, views complete one, all but clicks are
    messages with a code that nobody knows."""
    kind = F.col("event_type")
    return (
        table(spark, sf, "events")
        .where(kind != "click")
        .select(
            F.concat(F.lit("sku-"), F.col("user_id").cast("string")).alias("skuId"),
            F.concat(F.lit("Brand#"), (F.col("user_id") % 25 + 1).cast("string")).alias("item"),
            F.when(kind == "purchase", "RESTOCK_REQUESTED_EVENT")
            .when(kind == "view", "RESTOCK_COMPLETED_EVENT")
            .otherwise("OTHER_EVENT")
            .alias("eventType"),
            F.floor("value").cast("bigint").alias("quantity"),
            _millis("ts").alias("event_time"),
        )
    )


@_topic(STOCK_CALENDAR)
def stock_decrement(spark: SparkSession, sf: str) -> DataFrame:
    """Remaining quantity after consumption: click events."""
    return (
        table(spark, sf, "events")
        .where(F.col("event_type") == "click")
        .select(
            F.concat(F.lit("Brand#"), (F.col("user_id") % 25 + 1).cast("string")).alias("item"),
            F.floor("value").cast("bigint").alias("quantity"),
            _millis("ts").alias("event_time"),
        )
    )


def completion_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Completions as their publishers send them: time as ISO-8601 text, unreadable for
    every 17th supplier."""
    up = orders_up(spark, sf)
    iso = F.concat(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))
    supplier = F.substring_index("lineItemId", "-", -1).cast("bigint")
    return up.select(
        "orderId",
        "lineItemId",
        "item",
        "name",
        F.when(supplier % 17 == 0, "unknown").otherwise(iso).alias("timestamp"),
        "madeBy",
    )


@_topic(ORDER_CALENDAR, "eventTimestamp")
def item_status_events(spark: SparkSession, sf: str) -> DataFrame:
    """Status changes per item for the row pattern: placed, sometimes in progress, sometimes
    cancelled in between, finished lines fulfilled. One pass over the lines."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_returnflag",
        "l_linestatus",
    )
    joined = _with_order(_with_part(lines, spark, sf), _orders(spark, sf))
    planned = F.when(F.col("l_suppkey") % 2 == 0, LINE_A).otherwise(LINE_B)

    # one row per step the line goes through; columns follow from the step number
    placed, progress, cancelled, fulfilled = range(4)
    step = F.col("step")
    happens = (
        (step == placed)
        | ((step == progress) & (F.col("l_returnflag") == "A"))
        | ((step == cancelled) & (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1))
        | ((step == fulfilled) & (F.col("l_linestatus") == "F"))
    )
    seconds = (
        F.when(step == placed, 0)
        .when(step == progress, 30)
        .when(step == cancelled, 40)
        .otherwise(60 * F.col("l_quantity").cast("int"))
    )
    line = F.when(step.isin(placed, progress), planned).when(
        step == fulfilled, assembly_line(_made_by())
    )
    return (
        joined.withColumn("step", F.explode(F.array(*[F.lit(n) for n in range(4)])))
        .where(happens)
        .select(
            _order_id().alias("orderId"),
            F.when(step == cancelled, "ORDER_CANCELLED")
            .otherwise("LINE_ITEM_STATUS_CHANGED")
            .alias("eventType"),
            _plus_seconds(_order_time(), seconds).alias("eventTimestamp"),
            F.when(step == placed, "PLACED")
            .when(step == progress, "IN_PROGRESS")
            .when(step == cancelled, "CANCELLED")
            .otherwise("FULFILLED")
            .alias("orderStatus"),
            F.struct(
                _item_id().alias("itemId"),
                F.col("p_brand").alias("item"),
                line.alias("assemblyLine"),
            ).alias("lineItem"),
        )
    )
