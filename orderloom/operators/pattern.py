"""Assembly lead time: the row pattern PLACED, optional IN_PROGRESS, FULFILLED per item.

Rows of one item are taken in event-time order and nothing is filtered first: any
other row in between breaks the match. The three statuses exclude each other, so
matches cannot overlap and a look at the next two rows decides every match.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.schemas import ASSEMBLY_LINES

STATUS_CHANGED = "LINE_ITEM_STATUS_CHANGED"
SLICE = "1 hour"
PLACED, IN_PROGRESS, FULFILLED, OTHER = 0, 1, 2, 3
# Rows at equal times are taken in life-cycle order; beyond that equal rows are interchangeable.
_ORDER = ["ts", "step", "order_id", "item"]
ROW_COLUMNS = ["item_id", "order_id", "item", "ts", "step", "line"]


def pattern_rows(events: DataFrame, start_types: Sequence[str] = (STATUS_CHANGED,)) -> DataFrame:
    """Flat rows with the pattern step each may play. ``start_types`` lists the event
    types a PLACED row may have. Rows without a time have no place in the order and are
    dropped."""
    line = F.col("lineItem.assemblyLine")
    status, kind = F.col("orderStatus"), F.col("eventType")
    known = line.isin(*ASSEMBLY_LINES)
    changed = kind == STATUS_CHANGED
    step = (
        F.when(known & kind.isin(*start_types) & (status == "PLACED"), PLACED)
        .when(known & changed & (status == "IN_PROGRESS"), IN_PROGRESS)
        .when(known & changed & (status == "FULFILLED"), FULFILLED)
        .otherwise(OTHER)
    )
    return events.where(F.col("eventTimestamp").isNotNull()).select(
        F.col("lineItem.itemId").alias("item_id"),
        F.col("orderId").alias("order_id"),
        F.col("lineItem.item").alias("item"),
        F.col("eventTimestamp").alias("ts"),
        step.alias("step"),
        line.alias("line"),
    )


def _look_ahead(rows: DataFrame, *partition: str) -> DataFrame:
    """Adds the completing time, if the next one or two rows complete a match, and
    whether the rows ended before that could be told."""
    w = Window.partitionBy(*partition).orderBy(*_ORDER)

    def ahead(n: int, step: int) -> Column:
        same_line = F.lead("line", n).over(w) == F.col("line")
        return (F.lead("step", n).over(w) == step) & same_line

    is_start = F.col("step") == PLACED
    nothing_next = F.lead("step", 1).over(w).isNull()
    nothing_after = F.lead("step", 2).over(w).isNull()
    return rows.withColumns(
        {
            "done_at": F.when(is_start & ahead(1, FULFILLED), F.lead("ts", 1).over(w)).when(
                is_start & ahead(1, IN_PROGRESS) & ahead(2, FULFILLED), F.lead("ts", 2).over(w)
            ),
            "open": is_start & (nothing_next | (ahead(1, IN_PROGRESS) & nothing_after)),
            "last_progress": (F.col("step") == IN_PROGRESS) & nothing_next,
            # all that an unfinished match before these rows could need of them
            "leads": F.lag("step", 1).over(w).isNull()
            | ((F.lag("step", 1).over(w) == IN_PROGRESS) & F.lag("step", 2).over(w).isNull()),
        }
    )


def decide(rows: DataFrame, slice_size: str | None) -> DataFrame:
    """Decides the pattern rows: ``done_at`` completes a match; ``open`` and
    ``last_progress`` mark the start of one that the rows given do not finish.

    An item id that holds a large share of all rows (a missing id, say) must not
    end up in one task. Rows are therefore matched within time slices first. Only
    what a slice cannot decide goes on to a second pass over the whole item: its
    first row, the second one if the first is IN_PROGRESS, and an unfinished match at
    its end. ``slice_size=None`` skips
    the slicing where item ids are known to be spread evenly.
    """
    if slice_size is None:
        return _look_ahead(rows, "item_id")
    sliced = rows.withColumn("slice", F.window("ts", slice_size)["start"])
    first = _look_ahead(sliced, "item_id", "slice")
    undecided = F.col("open") | F.col("last_progress") | F.col("leads")
    carried = first.where(F.col("done_at").isNotNull() | undecided).select(
        *ROW_COLUMNS,
        F.col("done_at").alias("done_in_slice"),
        F.col("open").alias("was_open"),
        F.col("last_progress").alias("was_last"),
        # decided rows keep their slice, so they stay spread out
        F.when(~undecided, F.col("slice")).alias("group"),
    )
    second = _look_ahead(carried, "item_id", "group")
    return second.select(
        *ROW_COLUMNS,
        F.coalesce("done_in_slice", F.when(F.col("was_open"), F.col("done_at"))).alias("done_at"),
        (F.col("was_open") & F.col("open")).alias("open"),
        (F.col("was_last") & F.col("last_progress")).alias("last_progress"),
    )


def lead_time_columns(decided: DataFrame) -> DataFrame:
    """Published columns of the completed matches."""
    return decided.where(F.col("done_at").isNotNull()).select(
        "item_id",
        "order_id",
        "item",
        F.col("ts").alias("placed_at"),
        F.col("done_at").alias("fulfilled_at"),
        # whole seconds, cut not rounded
        F.timestamp_diff("SECOND", F.col("ts"), F.col("done_at")).alias("lead_time_seconds"),
        F.col("line").alias("assembly_line"),
    )


def lead_times(
    events: DataFrame,
    lines: Sequence[str] = ASSEMBLY_LINES,
    start_types: Sequence[str] = (STATUS_CHANGED,),
    slice_size: str | None = SLICE,
) -> DataFrame:
    """Lead time per completed item, for all ``lines`` in one pass."""
    decided = decide(pattern_rows(events, start_types), slice_size)
    return lead_time_columns(decided.where(F.col("line").isin(*lines)))


def lead_times_enriched(events: DataFrame, **options) -> DataFrame:
    """Lead times on hub data, where an item starts with its ORDER_PLACED event."""
    return lead_times(events, start_types=(STATUS_CHANGED, "ORDER_PLACED"), **options)
