"""Customer profiles from placed orders, with a masked variant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import keep, last_value, latest

FULL_ACCESS_GROUPS = ("customer360-full",)


def _placed(events: DataFrame) -> DataFrame:
    name = F.col("lineItem.name")
    named = (F.col("eventType") == "ORDER_PLACED") & name.isNotNull() & (name != "")
    return keep(events, named, "eventTimestamp")


def customer_history(events: DataFrame) -> DataFrame:
    """Placed lines that name a customer."""
    return _placed(events).select(
        F.col("lineItem.name").alias("customer_name"),
        F.col("loyaltyMemberId").alias("loyalty_member_id"),
        "location",
        F.col("orderId").alias("order_id"),
        F.col("eventTimestamp").alias("event_timestamp"),
    )


def last_seen(history: DataFrame) -> DataFrame:
    """Newest non-NULL loyalty id, location and order per customer, without the order count."""
    return history.groupBy("customer_name").agg(*_last_values())


def order_counts(orders: DataFrame) -> DataFrame:
    """Orders per customer, from rows that are already distinct on customer and order."""
    return orders.groupBy("customer_name").agg(F.count("order_id").alias("totalOrders"))


def _last_values() -> list:
    ts = "event_timestamp"
    return [
        last_value("loyalty_member_id", ts).alias("loyaltyMemberId"),
        last_value("location", ts).alias("lastLocation"),
        last_value("order_id", ts).alias("lastOrderId"),
        F.max(ts).alias("lastOrderAt"),
    ]


def customer_360_current(events: DataFrame, with_updated_at: bool = True) -> DataFrame:
    """Profile per customer: distinct orders, newest non-NULL values.

    The distinct count is planned as a first aggregation by customer and order,
    so a customer with very many orders is spread over all tasks.
    """
    grouped = customer_history(events).groupBy("customer_name")
    profile = grouped.agg(
        *_last_values(), F.count_distinct("order_id").alias("totalOrders")
    ).withColumnRenamed("customer_name", "customerName")
    return profile.withColumn("updatedAt", F.current_timestamp()) if with_updated_at else profile


def profile_full(history: DataFrame) -> DataFrame:
    """Newest row and number of placed lines per customer.

    One aggregation instead of ranking every row of a customer in one task. At
    equal times the higher order id wins.
    """
    newest = history.groupBy("customer_name").agg(
        latest("event_timestamp", "order_id", "location", "loyalty_member_id").alias("row"),
        F.count("*").alias("total_orders"),
    )
    return newest.select(
        "customer_name",
        "row.loyalty_member_id",
        F.col("row.location").alias("last_location"),
        F.col("row.order_id").alias("last_order_id"),
        F.col("row.event_timestamp").alias("last_order_at"),
        "total_orders",
    )


def profile_masked(full: DataFrame) -> DataFrame:
    """First letter of the name; a loyalty id only shows whether there is one."""
    return full.select(*[value.alias(name) for name, value in _masked(full).items()])


def _masked(full: DataFrame) -> dict[str, Column]:
    hidden = F.lit("***")
    return {c: F.col(c) for c in full.columns} | {
        "customer_name": F.concat(F.substring("customer_name", 1, 1), hidden),
        "loyalty_member_id": F.when(F.col("loyalty_member_id").isNotNull(), hidden),
    }


def profiles_for_groups(full: DataFrame, groups: Sequence[str]) -> DataFrame:
    """What each group sees, with its name as ``caller_group``. The profile is built once."""
    each = []
    for group in groups:
        open_ = group in FULL_ACCESS_GROUPS
        values = {c: F.col(c) for c in full.columns} if open_ else _masked(full)
        each.append(F.struct(F.lit(group).alias("caller_group"), *[v.alias(c) for c, v in values.items()]))
    return full.select(F.explode(F.array(*each)).alias("seen")).select("seen.*")


def profile_for_group(full: DataFrame, group: str) -> DataFrame:
    """Unmasked profiles for groups with full access, masked ones for everybody else."""
    return full if group in FULL_ACCESS_GROUPS else profile_masked(full)
