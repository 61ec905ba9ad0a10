"""The corpus pipeline over ``documents``: each stage's result is written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import exact_dedup, near_copies, packing, secrets, toxicity
from orderloom.llm.common import crc_mod, store, table
from orderloom.llm.queries import TOXIC, find_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that score as toxic go. The tagger learns from ``labels``."""
    find_package(spark)
    labels = table(spark, folder, "labels", "doc_id", "toxic")
    model = toxicity.train(docs, labels, crc_mod("doc_id", 3) != 1)
    return toxicity.reject(docs, model, TOXIC)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents with equal text one stays."""
    find_package(spark)
    return exact_dedup.one_of_each(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents linked by verified similarity the one with the smallest id stays. What is
    verified are the links of SimHash and the pairs of a prefix filter that loses none."""
    find_package(spark)
    return near_copies.one_per_component(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays, with its new length."""
    hidden = secrets.redact(docs, secrets.train(docs))
    return hidden.withColumn("n_chars", F.length("text").cast("long"))


def packing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Whole documents are packed into sequences; the result has one row per piece."""
    find_package(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: SQL can't express the tagger, the fingerprints or the packer.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
