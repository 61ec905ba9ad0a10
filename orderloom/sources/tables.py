"""Parquet tables."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@lru_cache(maxsize=256)
def _schema(spark: SparkSession, path: str) -> T.StructType:
    """Read once per session: finding it takes a Spark job over the file footers."""
    return spark.read.parquet(path).schema


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)
