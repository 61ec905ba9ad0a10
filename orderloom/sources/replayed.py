"""Batch topics as streams: written once, cut at fixed times, and read cut by cut.

All topics of one calendar are cut at the same times, so that every micro-batch of
a query sees the same stretch of event time of each topic. All cuts have the same
number of files, some of them empty, and a micro-batch reads so many.
"""

from __future__ import annotations

import math
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.session import CODEC, settings, shared_dir, shuffles_removed

CUTS = 8
#: Rows of a file at most. A file may be one task of the batch that reads it.
ROWS_PER_FILE = 250_000
# topics that this process has written already: (application, folder, topic) -> path, files a cut
_written: dict[tuple[str, str, str], tuple[str, int]] = {}


def _zoned(df: DataFrame) -> DataFrame:
    """Event time of a stream must be zoned; the session zone is UTC."""
    zoned = {
        f.name: F.col(f.name).cast("timestamp")
        for f in df.schema.fields
        if isinstance(f.dataType, T.TimestampNTZType)
    }
    return df.withColumns(zoned) if zoned else df


def write_cut(
    df: DataFrame,
    ts: str,
    first: datetime,
    last: datetime,
    cuts: int = CUTS,
    rows_per_file: int | None = None,
) -> tuple[str, int]:
    """Parquet files of equal stretches of time from ``first`` to ``last``, in order, and how many
    of them are one stretch. Rows outside or without a time go to the nearest stretch, or the first
    one. A stretch with fewer files than the others gets empty ones, so that files never have to be
    told apart by name.

    Rows are written once and without a shuffle: each task writes its own rows of all stretches at
    the same time, ``ROWS_PER_FILE`` to a file at most. With ``rows_per_file`` a stretch's rows are
    dealt anew over as many files as the largest stretch needs. The files then get the times of the
    order in which they are to be read."""
    spark = df.sparkSession
    start, end = F.unix_micros(F.lit(first).cast("timestamp")), F.unix_micros(F.lit(last).cast("timestamp"))
    place = F.floor((F.unix_micros(ts) - start) * cuts / (end - start))
    part = F.coalesce(F.greatest(F.lit(0), F.least(F.lit(cuts - 1), place)), F.lit(0))
    staged, path = shared_dir(spark, "topics"), shared_dir(spark, "topics")
    writer = df.withColumn("part", part.cast("int")).write.option("maxRecordsPerFile", ROWS_PER_FILE)
    writer = writer.option("compression", CODEC)
    # a task has a file of each stretch open and need not sort its rows by stretch
    with settings(spark, maxConcurrentOutputFileWriters=str(cuts)), shuffles_removed(spark):
        writer.partitionBy("part").parquet(staged)
    if rows_per_file is None:
        parts, files = [f"{staged}/part={k}" for k in range(cuts)], 1
    else:
        parts, files = _dealt(spark, staged, df.schema, cuts, rows_per_file)
    return path, _in_order(spark, parts, path, df.schema, files)


def _dealt(
    spark: SparkSession, staged: str, schema: T.StructType, cuts: int, rows_per_file: int
) -> tuple[list[str], int]:
    """The stretches' rows in other folders, and the number of files that each is dealt over."""
    stored = T.StructType([*schema.fields, T.StructField("part", T.IntegerType())])
    rows = spark.read.schema(stored).parquet(staged)
    largest = rows.groupBy("part").count().agg(F.max("count")).first()[0] or 0
    files = max(1, math.ceil(largest / rows_per_file))
    own = [rows.where(F.col("part") == k).drop("part") for k in range(cuts)]
    # a stretch's scan has a task for each of its staged files or more, unless these are too few
    few = [files > 1 and 0 < o.rdd.getNumPartitions() < files for o in own]
    dealt = [o.repartition(files) if short else o.coalesce(files) for o, short in zip(own, few, strict=True)]
    parts = [shared_dir(spark, "topics") for _ in dealt]
    with ThreadPoolExecutor(cuts) as pool:
        list(pool.map(lambda job: job[0].write.parquet(job[1]), zip(dealt, parts, strict=True)))
    return parts, files


def _in_order(spark: SparkSession, parts: list[str], path: str, schema: T.StructType, files: int) -> int:
    """Move the files of each of ``parts`` to ``path``, with times after those of the part before
    it: a stream reads its files by time. Empty ones are added, so that all parts have the number
    of the largest, or ``files`` if that is more; this number is returned."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    new_path = jvm.org.apache.hadoop.fs.Path
    fs = new_path(path).getFileSystem(conf)
    fs.mkdirs(new_path(path))

    def listed(folder: str) -> list:
        if not fs.exists(new_path(folder)):
            return []
        found = [s.getPath() for s in fs.listStatus(new_path(folder))]
        return [f for f in found if f.getName().endswith(".parquet")]

    nothing, now = None, int(time.time()) * 1000
    there = [listed(folder) for folder in parts]
    files = max(files, *map(len, there))
    for k, own in enumerate(there):
        if len(own) < files and nothing is None:
            empty = shared_dir(spark, "topics")
            spark.createDataFrame([], schema).coalesce(1).write.parquet(empty)
            nothing = listed(empty)[0]
        at = now - 1000 * (len(parts) - k)
        for i in range(files):
            file = new_path(path, f"cut-{k:05}-{i:05}.parquet")
            if i < len(own):
                fs.rename(own[i], file)
            else:
                jvm.org.apache.hadoop.fs.FileUtil.copy(fs, nothing, fs, file, False, conf)
            fs.setTimes(file, at, -1)
            if fs.getFileStatus(file).getModificationTime() != at:
                raise RuntimeError("spark.checkpoint.dir must keep the times that are set for files")
    return files


def as_stream(
    batch: DataFrame, name: str, folder: str, ts: str, first: datetime, last: datetime
) -> DataFrame:
    """The topic as a stream of one cut for each micro-batch. Written once per process."""
    df = _zoned(batch)
    spark = df.sparkSession
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _written:
        _written[key] = write_cut(df, ts, first, last)
    path, files = _written[key]
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)
