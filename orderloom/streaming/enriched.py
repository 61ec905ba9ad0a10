"""Keyed state behind the enriched trends stream: a line's newest placement, without a time bound.

A fulfilment waits until event time has passed it and is then emitted with the
newest placement known, or with none. Placements stay, so a line may be fulfilled
any time later. Lines share buckets of state, in columns (see
:mod:`orderloom.streaming.segments`); a batch writes its own rows only.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from orderloom.schemas import PRICE
from orderloom.streaming import segments
from orderloom.streaming.segments import Segments, Wake, table_of

_OUT = (
    T.StructType()
    .add("done_at", T.TimestampType())
    .add("item", T.StringType())
    .add("assembly_line", T.StringType())
    .add("cents", T.LongType())
    .add("location", T.StringType())
)
_KEY = ["order_id", "item_id"]
_PLACEMENTS = pa.schema(
    {"order_id": pa.string(), "item_id": pa.string(), "at": pa.int64(), "cents": pa.int64(), "location": pa.string()}
)
_WAITING = pa.schema(
    {"order_id": pa.string(), "item_id": pa.string(), "at": pa.int64(), "item": pa.string(), "line": pa.string()}
)


class PlacementProcessor(StatefulProcessor):
    """One key is a bucket of order lines. Times are milliseconds, prices cents."""

    def init(self, handle) -> None:
        self.wake = Wake(handle)
        self.placements = Segments(handle, "placements", _PLACEMENTS)
        self.waiting = Segments(handle, "waiting", _WAITING)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        placed, done = [], []
        for frame in rows:
            placed.append(frame[frame["placed"]])
            done.append(frame[~frame["placed"]])
        self.placements.add(table_of(placed, _PLACEMENTS))
        self._wait(table_of(done, _WAITING))
        return iter(())

    def _wait(self, done: pa.Table) -> None:
        """Come back when event time has passed the first of ``done``."""
        if done.num_rows:
            self.waiting.add(done)
            self.wake.at(pc.min(done["at"]).as_py())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        tables = self.waiting.tables()
        waiting = self.waiting.whole(tables)
        is_due = pc.less_equal(waiting["at"], timerValues.getCurrentWatermarkInMs())
        due = waiting.filter(is_due).combine_chunks()
        self.wake.done()
        self.waiting.drop(tables)
        self._wait(waiting.filter(pc.invert(is_due)).combine_chunks())
        if not due.num_rows:
            return
        known = self.placements.whole(self.placements.tables())
        known = known.filter(pc.is_in(known["item_id"], value_set=due["item_id"].combine_chunks()))
        # equal times fall back to the values, as in the batch form; NULL comes first
        order = pc.sort_indices(
            known, [(c, "ascending") for c in ("at", "cents", "location")], null_placement="at_start"
        )
        known = known.take(order).to_pandas(integer_object_nulls=True).drop_duplicates(_KEY, keep="last")
        found = due.to_pandas().merge(known.drop(columns="at"), "left", _KEY)
        at = pd.Series(found["at"].to_numpy().astype("datetime64[ms]")).dt.tz_localize("UTC")
        cents = found["cents"].astype("Int64")
        yield pd.DataFrame(
            {"done_at": at, "item": found["item"], "assembly_line": found["line"], "cents": cents,
             "location": found["location"]}
        )

    def close(self) -> None:
        pass


def with_placements(done: DataFrame, placed: DataFrame) -> DataFrame:
    """Fulfilments with price and location of their placement, once event time has passed them.

    ``done``: order_id, item_id, item, line, ts. ``placed``: order_id, item_id, price,
    location, ts. Both carry a watermark. A fulfilment without a complete key has
    no placement; those are spread over keys of their own. The session must use the
    RocksDB state store.
    """
    # the processor itself goes to the workers, which need not have this package
    for module in (segments, sys.modules[__name__]):
        cloudpickle.register_pickle_by_value(module)
    complete = F.col("order_id").isNotNull() & F.col("item_id").isNotNull()
    at = F.unix_millis("ts")
    rows = done.select(
        "order_id", "item_id", "ts", at.alias("at"), F.lit(False).alias("placed"),
        F.lit(None).cast("long").alias("cents"), F.lit(None).cast("string").alias("location"),
        "item", "line",
    ).unionByName(
        placed.where(complete).select(
            "order_id", "item_id", "ts", at.alias("at"), F.lit(True).alias("placed"),
            (F.col("price") * 100).cast("long").alias("cents"), "location", F.lit(None).cast("string").alias("item"),
            F.lit(None).cast("string").alias("line"),
        )
    )
    spread = F.when(complete, 0).otherwise(F.hash("ts", "item", "line"))
    found = (
        rows.withColumn("spread", spread)
        .withColumn("bucket", segments.bucket(*_KEY, "spread"))
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=PlacementProcessor(),
            outputStructType=_OUT,
            outputMode="Append",
            timeMode="EventTime",
            eventTimeColumnName="done_at",
        )
    )
    price = (F.col("cents").cast("decimal(12,0)") / 100).cast(PRICE).alias("price")
    return found.select("done_at", "item", "assembly_line", price, "location")
