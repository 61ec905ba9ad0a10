"""Keyed state behind the customer profile stream: customers share buckets of state.

The orders seen and the newest values of a customer change together, in one
processor, so no reader ever finds a count that its values don't belong to.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from orderloom.operators.customer import customer_history
from orderloom.streaming import segments
from orderloom.streaming.segments import Segments, table_of

_TEXT, _LONG = T.StringType(), T.LongType()
#: What a profile keeps the newest non-NULL value of.
VALUES = ("loyalty_member_id", "location", "order_id")
#: The time of rows without one: before all others.
NO_TIME = -(1 << 62)

_ORDERS = pa.schema({"customer_name": pa.string(), "order_id": pa.string()})
_NEWEST = pa.schema(
    {"customer_name": pa.string(), "orders": pa.int64(), "newest": pa.int64()}
    | {k: t for v in VALUES for k, t in ((f"{v}_at", pa.int64()), (v, pa.string()))}
)
_OUT = T.StructType().add("customerName", _TEXT).add("loyaltyMemberId", _TEXT).add("lastLocation", _TEXT)
_OUT = _OUT.add("lastOrderId", _TEXT).add("at", _LONG).add("totalOrders", _LONG)


class ProfileProcessor(StatefulProcessor):
    """One key is a bucket of customers. Times are microseconds."""

    def init(self, handle) -> None:
        self.orders = Segments(handle, "orders", _ORDERS)
        self.newest = Segments(handle, "newest", _NEWEST)

    def _count_new(self, rows: pd.DataFrame) -> pd.Series:
        """Orders that each customer has for the first time; they are remembered."""
        named = rows[rows["order_id"].notna()][_ORDERS.names].drop_duplicates()
        tables = self.orders.tables()
        seen = self.orders.whole(tables)
        seen = seen.filter(pc.is_in(seen["order_id"], value_set=pa.array(named["order_id"], pa.string())))
        both = named.merge(seen.to_pandas(), "left", _ORDERS.names, indicator="there")
        new = both[both["there"] == "left_only"][_ORDERS.names]
        self.orders.add(table_of([new], _ORDERS), tables)
        return new.groupby("customer_name").size()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(rows), ignore_index=True)
        new_orders = self._count_new(rows)
        tables = self.newest.tables()
        before = self.newest.whole(tables).to_pandas()
        touched = pd.Index(rows["customer_name"].unique(), name="customer_name")
        known = before[before["customer_name"].isin(touched)].set_index("customer_name")
        out = pd.DataFrame(index=touched)
        out["orders"] = known["orders"].reindex(touched, fill_value=0) + new_orders.reindex(touched, fill_value=0)
        at = rows.groupby("customer_name")["at"].max()
        out["newest"] = np.maximum(known["newest"].reindex(touched, fill_value=NO_TIME), at.reindex(touched))
        for v in VALUES:
            old = known[[f"{v}_at", v]].reset_index().set_axis(["customer_name", "at", v], axis=1)
            each = pd.concat([old, rows[["customer_name", "at", v]]])
            # equal times fall back to the values, as in the batch form
            each = each[each[v].notna()].sort_values(["at", v]).drop_duplicates("customer_name", keep="last")
            each = each.set_index("customer_name")
            out[f"{v}_at"] = each["at"].reindex(touched, fill_value=NO_TIME).astype("int64")
            out[v] = each[v].reindex(touched)
        out = out.reset_index()
        self.newest.drop(tables)
        untouched = before[~before["customer_name"].isin(touched)]
        self.newest.add(table_of([untouched, out], _NEWEST), {})
        yield pd.DataFrame(
            {"customerName": out["customer_name"], "loyaltyMemberId": out["loyalty_member_id"],
             "lastLocation": out["location"], "lastOrderId": out["order_id"], "at": out["newest"],
             "totalOrders": out["orders"]}
        )

    def close(self) -> None:
        pass


def customer_profile_stream(events: DataFrame) -> DataFrame:
    """Update, keyed by customer: the whole profile of each customer that a batch names.

    ``updatedAt`` is the time of the batch. A customer's rows of one batch go through
    one task; of the orders seen before only the batch's own leave Arrow.
    The session must use the RocksDB state store (``session.state_in_rocksdb``).
    """
    # the processor itself goes to the workers, which need not have this package
    for module in (segments, sys.modules[__name__]):
        cloudpickle.register_pickle_by_value(module)
    at = F.coalesce(F.unix_micros("event_timestamp"), F.lit(NO_TIME)).alias("at")
    rows = customer_history(events).select("customer_name", *VALUES, at)
    profiles = rows.withColumn("bucket", segments.bucket("customer_name")).groupBy("bucket")
    profiles = profiles.transformWithStateInPandas(
        statefulProcessor=ProfileProcessor(),
        outputStructType=_OUT,
        outputMode="Update",
        timeMode="None",
    )
    last = F.when(F.col("at") != NO_TIME, F.timestamp_micros("at")).alias("lastOrderAt")
    return profiles.select(
        "customerName", "loyaltyMemberId", "lastLocation", "lastOrderId", last, "totalOrders",
        F.current_timestamp().alias("updatedAt"),
    )
