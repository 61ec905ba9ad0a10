"""Append-only lake tables with derived partition columns.

Parquet has no hidden partitioning: a ``day(ts)`` or ``month(ts)`` transform is
a real column, which readers filter on to prune.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom.session import CODEC, shuffles_removed, state_by_cores


@dataclass(frozen=True)
class Transform:
    """One partition transform: ``day``, ``month`` or ``identity`` of a column."""

    kind: str
    source: str

    @property
    def column(self) -> str:
        return self.source if self.kind == "identity" else f"{self.source}_{self.kind}"

    def value(self) -> Column:
        if self.kind == "day":
            return F.to_date(self.source)
        if self.kind == "month":
            return F.date_format(self.source, "yyyy-MM")
        return F.col(self.source)


def day(column: str) -> Transform:
    return Transform("day", column)


def month(column: str) -> Transform:
    return Transform("month", column)


def identity(column: str) -> Transform:
    return Transform("identity", column)


def partitioned(df: DataFrame, transforms: Sequence[Transform]) -> DataFrame:
    """Adds the derived partition columns."""
    derived = {t.column: t.value() for t in transforms if t.kind != "identity"}
    return df.withColumns(derived) if derived else df


def derived_columns(transforms: Sequence[Transform]) -> list[str]:
    return [t.column for t in transforms if t.kind != "identity"]


def append(df: DataFrame, path: str, transforms: Sequence[Transform] = ()) -> None:
    """Batch append. A rebalance hint sizes the files per partition value: small values
    share a task, a value with very many rows is split over several."""
    out = partitioned(df, transforms)
    if transforms:
        out = out.hint("rebalance", *[t.column for t in transforms])
    writer = out.write.mode("append").option("compression", CODEC)
    with shuffles_removed(df.sparkSession):
        writer.partitionBy(*[t.column for t in transforms]).parquet(path)


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    transforms: Sequence[Transform] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Exactly-once append of a stream through the file sink's commit log. As in
    :func:`append` a batch's rows meet by partition value before they are written, or each
    task would add a file to every day and month."""
    out = partitioned(df, transforms)
    if derived_columns(transforms):
        out = out.hint("rebalance", *[t.column for t in transforms])
    writer = (
        out.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("compression", CODEC)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*[t.column for t in transforms])
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
    )
    with state_by_cores(df.sparkSession), shuffles_removed(df.sparkSession):
        return writer.start()


def stored_schema(schema: T.StructType, transforms: Sequence[Transform] = ()) -> T.StructType:
    """Declared columns and the derived ones. Types are never taken from folder names: a
    partition value like ``007`` stays text."""
    types = {"day": T.DateType(), "month": T.StringType()}
    derived = [T.StructField(t.column, types[t.kind]) for t in transforms if t.kind != "identity"]
    return T.StructType([*schema.fields, *derived])


def read(
    spark: SparkSession, path: str, schema: T.StructType, transforms: Sequence[Transform] = ()
) -> DataFrame:
    """The table without its derived partition columns, in the declared order of columns."""
    stored = spark.read.schema(stored_schema(schema, transforms)).parquet(path)
    return stored.select(*schema.names)


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, transforms: Sequence[Transform] = ()
) -> DataFrame:
    """The table as a stream of what is appended to it. Where a stream writes it, only files of
    finished batches are read, each once."""
    stored = spark.readStream.schema(stored_schema(schema, transforms)).parquet(path)
    return stored.select(*schema.names)


def read_days(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    transforms: Sequence[Transform],
    first: str,
    last: str,
) -> DataFrame:
    """Rows of whole days or months of the first transform, inclusive; only their partitions
    are listed and read."""
    stored = spark.read.schema(stored_schema(schema, transforms)).parquet(path)
    part = F.col(transforms[0].column)
    return stored.where(part.between(F.lit(first), F.lit(last))).select(*schema.names)
