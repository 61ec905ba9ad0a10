"""Keyed state in columns: a bucket of keys has its rows as a few Arrow tables.

A state call for each key and row costs far more than the row itself. Keys are
therefore dealt over some hundreds of buckets, and what a batch adds to a bucket is one
more table, a segment. Rows are looked up in a bucket's segments without leaving Arrow;
only segments that lose rows are written again.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A batch takes some milliseconds for each bucket that it touches, whatever is in it.
BUCKETS = 512
#: Segments that a bucket may have before they become one.
MOST = 16

_NUMBER = T.StructType([T.StructField("n", T.LongType())])
_TABLE = T.StructType([T.StructField("t", T.BinaryType())])


def bucket(*keys: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def table_of(frames: Iterable[pd.DataFrame], schema: pa.Schema) -> pa.Table:
    """The columns of ``schema`` of all ``frames``."""
    found = [pa.Table.from_pandas(f[schema.names], schema, preserve_index=False) for f in frames]
    return pa.concat_tables([schema.empty_table(), *found]).combine_chunks()


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="lz4")
    with pa.ipc.new_stream(sink, table.schema, options=options) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


class Segments:
    """The rows of the current bucket under one state name."""

    def __init__(self, handle, name: str, schema: pa.Schema):
        self.schema = schema
        self.state = handle.getMapState(name, _NUMBER, _TABLE)

    def tables(self) -> dict[int, pa.Table]:
        """Segment number -> rows."""
        return {k[0]: pa.ipc.open_stream(v[0]).read_all() for k, v in self.state.iterator()}

    def drop(self, tables: dict[int, pa.Table]) -> None:
        for n in tables:
            self.state.removeKey((n,))

    def whole(self, tables: dict[int, pa.Table]) -> pa.Table:
        return pa.concat_tables([self.schema.empty_table(), *tables.values()])

    def add(self, rows: pa.Table, tables: dict[int, pa.Table] | None = None) -> None:
        """One more segment; ``tables`` are those there, where they are known."""
        if not rows.num_rows:
            return
        numbers = list(tables) if tables is not None else [k[0] for k in self.state.keys()]  # noqa: SIM118
        if len(numbers) >= MOST:
            rows = pa.concat_tables([*(tables or self.tables()).values(), rows]).combine_chunks()
            self.drop(dict.fromkeys(numbers))
        self.state.updateValue((max(numbers, default=-1) + 1,), (_packed(rows),))

    def remove(self, tables: dict[int, pa.Table], column: str, values: pa.Array) -> dict[int, pa.Table]:
        """What is left without the rows that have one of ``values``, NULL being one too."""
        left = {}
        for n, table in tables.items():
            own = table.filter(pc.invert(pc.is_in(table[column], value_set=values)))
            if own.num_rows:
                left[n] = own
            if not own.num_rows:
                self.state.removeKey((n,))
            elif own.num_rows < table.num_rows:
                self.state.updateValue((n,), (_packed(own),))
        return left


class Wake:
    """The one timer of the current bucket, in milliseconds: the soonest one asked for."""

    def __init__(self, handle):
        self.handle = handle
        self.state = handle.getValueState("wake", _NUMBER)

    def at(self, millis: int) -> None:
        known = self.state.get()
        if known is not None and known[0] <= millis:
            return
        if known is not None:
            self.handle.deleteTimer(known[0])
        self.handle.registerTimer(millis)
        self.state.update((millis,))

    def done(self) -> None:
        self.state.clear()
