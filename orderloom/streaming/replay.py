"""Run a stream over everything that is there, then read what it stored."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom.session import shared_dir
from orderloom.sinks import keyed, lake

_ALL_NOW = {"availableNow": True}
_ended: list[StreamingQuery] | None = None


def finish(query: StreamingQuery) -> None:
    """Wait until the query has read everything."""
    query.awaitTermination()
    if _ended is not None:
        _ended.append(query)


@contextmanager
def ended_queries() -> Iterator[list[StreamingQuery]]:
    """The queries that :func:`finish` waited for inside."""
    global _ended
    before, _ended = _ended, []
    try:
        yield _ended
    finally:
        _ended = before


def summary(queries: Sequence[StreamingQuery]) -> dict[str, float]:
    """Rows read, rows a second of batch time, most state rows held, groups dropped as late."""
    figures = [f for q in queries for f in batch_figures(q)]
    spent = sum(p.durationMs.get("triggerExecution", 0) for q in queries for p in q.recentProgress)
    rows = sum(read for _, read, _, _ in figures)
    return {
        "rows": rows,
        "rows_per_sec": round(1000 * rows / max(spent, 1)),
        "state_rows": max((held for _, _, held, _ in figures), default=0),
        "late_groups": sum(late for _, _, _, late in figures),
    }


def replay_append(
    spark: SparkSession, stream: DataFrame, transforms: Sequence[lake.Transform] = ()
) -> DataFrame:
    """Drive an append-mode stream into a lake table and read the table."""
    path = shared_dir(spark, "tables")
    query = lake.append_stream(
        stream, path, shared_dir(spark, "checkpoints"), transforms, _ALL_NOW
    )
    finish(query)
    schema = lake.partitioned(stream, transforms).schema
    return spark.read.schema(schema).parquet(path).drop(*lake.derived_columns(transforms))


def batch_figures(query: StreamingQuery) -> list[tuple[int, int, int, int]]:
    """(batch, rows read, state rows held, groups dropped as late) of each batch that Spark still
    remembers (``spark.sql.streaming.numRecentProgressUpdates``). Late rows are counted
    where a stateful operator drops them, after partial aggregation: by group, not by row."""
    return [
        (
            p.batchId,
            p.numInputRows,
            sum(s.numRowsTotal for s in p.stateOperators),
            sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
        )
        for p in query.recentProgress
    ]


def replay_measured(spark: SparkSession, stream: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Like :func:`replay_append`, with the figures of the batches that read something."""
    path = shared_dir(spark, "tables")
    query = lake.append_stream(stream, path, shared_dir(spark, "checkpoints"), (), _ALL_NOW)
    finish(query)
    figures = [(b, read, late) for b, read, _, late in batch_figures(query) if read]
    schema = "batch long, rows_read long, groups_dropped long"
    return spark.read.schema(stream.schema).parquet(path), spark.createDataFrame(figures, schema)


def replay_keyed(spark: SparkSession, stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drive an update-mode stream into a keyed table and read its latest rows."""
    path = shared_dir(spark, "tables")
    query = keyed.upsert_stream(
        stream, path, shared_dir(spark, "checkpoints"), _ALL_NOW, keys, compact_every=4
    )
    finish(query)
    return keyed.read_latest(spark, path, keys, T.StructType(stream.schema.fields))
