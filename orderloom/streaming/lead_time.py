"""Streaming form of the assembly row pattern, on keyed state.

An item's rows wait in its own state until event time has passed them, and are then
taken in event-time order by the pattern: a start waits for its end, whatever else
comes in between ends the start. Items share buckets of state, in columns (see
:mod:`orderloom.streaming.segments`): a batch writes the rows of its own items and of
those whose time has come, however many items are in assembly.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from orderloom.operators.pattern import (
    FULFILLED,
    IN_PROGRESS,
    PLACED,
    STATUS_CHANGED,
    lead_time_columns,
    pattern_rows,
)
from orderloom.streaming import segments
from orderloom.streaming.segments import Segments, Wake, table_of

# --- fixed value: how late an event may be ------------------------------------
PATTERN_DELAY = "30 seconds"
#: More than elsewhere: a start whose end comes batches later has its segment written again.
BUCKETS = 1536
# --- end of fixed value -------------------------------------------------------

_TEXT, _LONG = T.StringType(), T.LongType()
_OUT = T.StructType().add("item_id", _TEXT).add("order_id", _TEXT).add("item", _TEXT)
_OUT = _OUT.add("start", _LONG).add("done", _LONG).add("line", _TEXT)
_WAITING = pa.schema(
    {"item_id": pa.string(), "at": pa.int64(), "step": pa.int64(), "order_id": pa.string(), "item": pa.string(),
     "line": pa.string()}
)
_STARTS = pa.schema(
    {"item_id": pa.string(), "at": pa.int64(), "order_id": pa.string(), "item": pa.string(), "line": pa.string(),
     "progress": pa.int64()}
)


def in_order(row: tuple) -> tuple:
    """Event time, then life-cycle order, order and item, NULL first: the batch form's order."""
    at, step, order_id, item, _ = row
    return at, step, order_id is not None, order_id or "", item is not None, item or ""


def follow(start: tuple | None, rows: list[tuple], steps: tuple) -> tuple[tuple | None, list[tuple]]:
    """The unfinished start after ``rows`` (in order), and (start, end time) of what they complete."""
    placed, progress, fulfilled = steps
    found = []
    for at, step, order_id, item, line in rows:
        goes_on = start is not None and line == start[3]
        if step == placed:
            start = (at, order_id, item, line, 0)
        elif step == progress and goes_on and not start[4]:
            start = (*start[:4], 1)
        else:
            if step == fulfilled and goes_on:
                found.append((start, at))
            start = None
    return start, found


class LeadTimeProcessor(StatefulProcessor):
    """One key is a bucket of items. Times are microseconds, timers milliseconds."""

    def __init__(self, steps: tuple):
        self.steps = steps

    def init(self, handle) -> None:
        self.wake = Wake(handle)
        self.waiting = Segments(handle, "waiting", _WAITING)
        self.starts = Segments(handle, "starts", _STARTS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self._wait(table_of(rows, _WAITING))
        return iter(())

    def _wait(self, rows: pa.Table) -> None:
        """Come back when event time has passed the first of ``rows``."""
        if rows.num_rows:
            self.waiting.add(rows)
            self.wake.at(-(-pc.min(rows["at"]).as_py() // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        tables = self.waiting.tables()
        waiting = self.waiting.whole(tables)
        is_due = pc.less_equal(waiting["at"], passed)
        due = waiting.filter(is_due)
        self.wake.done()
        self.waiting.drop(tables)
        self._wait(waiting.filter(pc.invert(is_due)).combine_chunks())
        rows = defaultdict(list)
        for item_id, *row in zip(*(c.to_pylist() for c in due.columns), strict=True):
            rows[item_id].append(tuple(row))
        items = pa.array(list(rows), pa.string())
        tables = self.starts.tables()
        known = self.starts.whole(tables)
        known = known.filter(pc.is_in(known["item_id"], value_set=items))
        before = {item: tuple(start) for item, *start in zip(*(c.to_pylist() for c in known.columns), strict=True)}
        found, starts = [], []
        for item_id, own in rows.items():
            start, done = follow(before.get(item_id), sorted(own, key=in_order), self.steps)
            found += [(item_id, s[1], s[2], s[0], at, s[3]) for s, at in done]
            if start is not None and start == before.get(item_id):
                del before[item_id]
            elif start is not None:
                starts.append((item_id, *start))
        if before:
            tables = self.starts.remove(tables, "item_id", pa.array(list(before), pa.string()))
        columns = zip(*starts, strict=True) if starts else [[]] * len(_STARTS)
        self.starts.add(pa.table([pa.array(c, t) for c, t in zip(columns, _STARTS.types, strict=True)], _STARTS), tables)
        if found:
            yield pd.DataFrame(found, columns=_OUT.names)

    def close(self) -> None:
        pass


def lead_time_stream(
    events: DataFrame,
    start_types: Sequence[str] = (STATUS_CHANGED,),
    delay: str = PATTERN_DELAY,
) -> DataFrame:
    """Append: lead times of completed items, once event time has passed their last row.

    Rows behind the watermark are late and dropped. Items without an id are one item,
    as in the batch form. The session must use the RocksDB state store
    (``session.state_in_rocksdb``).
    """
    # the processor itself goes to the workers, which need not have this package
    for module in (segments, sys.modules[__name__]):
        cloudpickle.register_pickle_by_value(module)
    rows = pattern_rows(events.withWatermark("eventTimestamp", delay), start_types)
    rows = rows.withColumn("at", F.unix_micros("ts")).withColumn("step", F.col("step").cast("long"))
    found = rows.withColumn("bucket", segments.bucket("item_id", buckets=BUCKETS)).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=LeadTimeProcessor((PLACED, IN_PROGRESS, FULFILLED)),
        outputStructType=_OUT,
        outputMode="Append",
        timeMode="EventTime",
    )
    return lead_time_columns(
        found.withColumns({"ts": F.timestamp_micros("start"), "done_at": F.timestamp_micros("done")})
    )
