"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.session import shared_dir, shuffles_removed

#: The white space that separates words, as a character class for regular expressions.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


#: Folders stored since each of the running :func:`store_last` began, innermost last.
_on_the_way: list[list[str]] = []


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and what was
    shuffled for it is removed."""
    path = shared_dir(df.sparkSession, f"llm-{purpose}")
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    if _on_the_way:
        _on_the_way[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_last(build: Callable[[], DataFrame], purpose: str) -> DataFrame:
    """What ``build`` returns, stored; what it has stored on the way is then deleted. No frame
    that is read later may depend on that."""
    _on_the_way.append([])
    try:
        df = build()
        spark = df.sparkSession
        path = shared_dir(spark, f"llm-{purpose}")
        with shuffles_removed(spark):
            df.write.parquet(path)
    finally:
        made = _on_the_way.pop()
    for folder in made:
        old = spark._jvm.org.apache.hadoop.fs.Path(folder)
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    if _on_the_way:
        _on_the_way[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, with NULL as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def raw(column: str = "text") -> Column:
    """The text's UTF-8 bytes; Python then need not decode and encode them."""
    return text_of(column).cast("binary")


def crc_mod(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``. A NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % modulus


def sample(df: DataFrame, id_col: str, rows: int) -> DataFrame:
    """About ``rows`` rows, chosen by the id's hash; all of them if there are no more.

    Every task keeps its share, so nothing is sent to be compared, whatever the
    number of tasks.
    """
    total = df.count()
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 40)) < int((1 << 40) * rows / total))


def numbered(rows: DataFrame, *keys: str, per_task: int = 100_000) -> DataFrame:
    """``rows`` with ``number``: the place from 0 in the order of ``keys``, NULL last. Keys are distinct.

    Rows are range-partitioned and numbered within their partition; the driver
    sees the partitions' sizes only.
    """
    parts = max(1, math.ceil(rows.count() / per_task))
    order = [F.col(key).asc_nulls_last() for key in keys]
    ranged = rows.repartitionByRange(parts, *order) if parts > 1 else rows.coalesce(1)
    ranged = store(ranged.withColumn("_part", F.spark_partition_id()), "ranged")
    sizes = dict(ranged.groupBy("_part").count().collect())
    before, start = 0, []
    for part in sorted(sizes):
        start += [F.lit(part), F.lit(before).cast("long")]
        before += sizes[part]
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    offset = F.create_map(*start)[F.col("_part")] if start else F.lit(0)
    return ranged.withColumn("number", (place + offset).cast("long")).drop("_part")
