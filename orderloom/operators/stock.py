"""Component stock: restock history, latest status per SKU, latest quantity per item."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import format_millis, keep, latest, stock_event_type

#: Microseconds that stand for no time, before the year 1; both fit a code of 38 digits.
_NO_TIME = -4 * 10**17
#: Room for a quantity in a code, and what makes every quantity positive.
_ROOM, _SHIFT = Decimal(10**20), Decimal(2**63 + 1)


def inventory_events(inventory_out: DataFrame, random_ids: bool = False) -> DataFrame:
    """Restock events with published type codes.

    Ids hash the content so that a replay repeats them; ``random_ids`` asks for
    a random UUID per row instead.
    """
    parts = [
        F.coalesce(c, F.lit(""))
        for c in (
            F.col("skuId"),
            F.col("item"),
            F.col("eventType"),
            F.col("quantity").cast("string"),
            format_millis(F.col("event_time")),
        )
    ]
    new_id = F.uuid() if random_ids else F.md5(F.concat_ws("|", *parts))
    return inventory_out.select(
        new_id.alias("event_id"),
        F.col("skuId").alias("sku_id"),
        "item",
        stock_event_type(F.col("eventType")).alias("event_type"),
        F.col("event_time").alias("event_timestamp"),
        F.lit("inventory-out").alias("source_topic"),
    )


def stock_current(inventory_out: DataFrame) -> DataFrame:
    """Newest restock status per SKU."""
    rows = inventory_out.select(
        F.col("skuId").alias("sku_id"),
        "item",
        stock_event_type(F.col("eventType")).alias("latest_status"),
        F.col("event_time").alias("last_event_at"),
    )
    newest = rows.groupBy("sku_id").agg(
        latest("last_event_at", "latest_status", "item").alias("row")
    )
    return newest.select("sku_id", "row.item", "row.latest_status", "row.last_event_at")


def stock_quantity(inventory_out: DataFrame, decrement: DataFrame) -> DataFrame:
    """Newest quantity per item, from completed restocks and consumption alike.

    Requested restocks do not count. At equal times consumption, which follows a
    restock, wins, then the higher quantity; NULL comes before all else.

    Time, rank and quantity are packed into one number of 38 digits. Its maximum has
    a buffer of fixed width, so rows are aggregated by hash, before the shuffle too;
    a struct would be sorted by item first. Needs the session zone UTC.
    """
    completed = keep(
        inventory_out, F.col("eventType") == "RESTOCK_COMPLETED_EVENT", "event_time"
    )
    reports = completed.select(
        "item", "quantity", "event_time", F.lit(0).alias("source_rank")
    ).unionByName(
        decrement.select("item", "quantity", "event_time", F.lit(1).alias("source_rank"))
    )
    when = reports.schema["event_time"].dataType
    codes = reports.select("item", _code("event_time", "source_rank", "quantity").alias("code"))
    newest = codes.groupBy("item").agg(F.max("code").alias("code"))
    low = F.pmod("code", F.lit(_ROOM))
    parts = newest.select("item", low.alias("low"), (F.col("code") - low).alias("rest"))
    high = F.expr(f"rest div {_ROOM}BD")
    micros = F.expr(f"(rest div {_ROOM}BD - pmod(rest div {_ROOM}BD, 2)) div 2")
    return parts.select(
        "item",
        F.when(F.col("low") > 0, (F.col("low") - F.lit(_SHIFT)).cast("long")).alias("quantity"),
        F.when(high >= 2 * _NO_TIME + 2, F.timestamp_micros(micros).cast(when)).alias("last_restocked_at"),
    )


def _code(ts: str, rank: str, value: str) -> Column:
    """(ts, rank 0 or 1, value) as a number that sorts as they do."""
    micros = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(_NO_TIME))
    high = (2 * micros + F.col(rank)).cast("decimal(18,0)")
    low = F.coalesce(F.col(value).cast("decimal(20,0)") + F.lit(_SHIFT), F.lit(Decimal(0)))
    return (high * F.lit(_ROOM) + low).cast("decimal(38,0)")
