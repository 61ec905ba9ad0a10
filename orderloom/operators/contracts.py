"""Published contracts: required fields and allowed values, counted per product."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.schemas import (
    ASSEMBLY_LINES,
    EVENT_TYPES,
    LINE_ITEM_STATUSES,
    LOCATIONS,
    ORDER_SOURCES,
    ORDER_STATUSES,
    STOCK_EVENT_TYPES,
)


@dataclass(frozen=True)
class Contract:
    """Fields that must not be NULL and the values enumerated fields may take.

    A dotted required field only counts where its parent struct is present.
    """

    product: str
    required: tuple[str, ...]
    allowed: dict[str, tuple[str, ...]]

    def rules(self) -> list[tuple[str, str, Column]]:
        out = []
        for name in self.required:
            missing = F.col(name).isNull()
            if "." in name:
                missing = missing & F.col(name.rsplit(".", 1)[0]).isNotNull()
            out.append((name, "required", missing))
        for name, values in self.allowed.items():
            out.append((name, "allowed values", ~F.col(name).isin(*values)))
        return out


# --- fixed values: the published contracts ------------------------------------
ORDER_EVENT = Contract(
    "order_event",
    required=(
        "eventId",
        "orderId",
        "eventType",
        "eventTimestamp",
        "lineItem.itemId",
        "lineItem.item",
        "lineItem.name",
        "lineItem.price",
        "lineItem.lineItemStatus",
        "sourceDomain",
        "sourceTopic",
    ),
    allowed={
        "eventType": EVENT_TYPES,
        "orderSource": ORDER_SOURCES,
        "location": LOCATIONS,
        "orderStatus": ORDER_STATUSES,
        "lineItem.lineItemStatus": LINE_ITEM_STATUSES,
        "lineItem.assemblyLine": ASSEMBLY_LINES,
    },
)
STOCK_EVENT = Contract(
    "stock_event",
    required=("event_id", "sku_id", "item", "event_type", "event_timestamp", "source_topic"),
    allowed={"event_type": STOCK_EVENT_TYPES},
)
STOCK_QUANTITY = Contract(
    "stock_quantity", required=("item", "quantity", "last_restocked_at"), allowed={}
)
SALES_TREND = Contract(
    "sales_trend",
    required=("item", "window_start", "window_end", "order_count", "revenue"),
    allowed={},
)
TURNOVER = Contract(
    "turnover",
    required=(
        "item",
        "window_start",
        "window_end",
        "restock_requested_count",
        "stockout_cancelled_count",
    ),
    allowed={},
)
STOCKOUT_RISK = Contract(
    "stockout_risk", required=("item", "at_risk", "last_stockout_event_at"), allowed={}
)
LEAD_TIME = Contract(
    "lead_time",
    required=(
        "item_id",
        "order_id",
        "placed_at",
        "fulfilled_at",
        "lead_time_seconds",
        "assembly_line",
    ),
    allowed={},
)
CUSTOMER_PROFILE = Contract(
    "customer_profile", required=("customerName", "totalOrders", "updatedAt"), allowed={}
)
COMPLETION = Contract(
    "completion", required=("orderId", "lineItemId", "item", "name", "timestamp"), allowed={}
)
# --- end of fixed values ------------------------------------------------------


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows breaking each rule, for rules that are broken at all. One scan, no shuffle
    beyond one row per task."""
    rules = contract.rules()
    counted = df.agg(*[F.count_if(broken).alias(f"r{i}") for i, (_, _, broken) in enumerate(rules)])
    per_rule = F.array(
        *[
            F.struct(
                F.lit(name).alias("field"),
                F.lit(rule).alias("rule"),
                F.col(f"r{i}").alias("violations"),
            )
            for i, (name, rule, _) in enumerate(rules)
        ]
    )
    return (
        counted.select(F.explode(per_rule).alias("rule"))
        .select(F.lit(contract.product).alias("product"), "rule.*")
        .where(F.col("violations") > 0)
    )


def completion_contract(messages: DataFrame) -> DataFrame:
    """Completion messages conformed to their contract, with the ISO-8601 time parsed.

    A time that cannot be read is NULL, and ``conforms`` tells whether the
    required fields are all there and readable.
    """
    completed_at = F.try_to_timestamp(F.col("timestamp"))
    missing = [F.col(c).isNull() for c in COMPLETION.required]
    broken = completed_at.isNull()
    for m in missing:
        broken = broken | m
    return messages.select(
        F.col("orderId").alias("order_id"),
        F.col("lineItemId").alias("line_item_id"),
        "item",
        "name",
        completed_at.alias("completed_at"),
        F.col("madeBy").alias("made_by"),
        (~broken).alias("conforms"),
    )
