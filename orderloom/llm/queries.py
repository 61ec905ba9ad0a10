"""The queries of this subpackage: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    curriculum,
    divergence,
    exact_dedup,
    html_text,
    lm,
    packing,
    periodic,
    pieces,
    quality_model,
    quality_rules,
    secrets,
    simhash,
    toxicity,
)
from orderloom.llm.common import SPACE, crc_mod, table, text_of

Query = Callable[[SparkSession, str], DataFrame]

#: Score from which a document counts as toxic, and as good.
TOXIC, GOOD = 0.7, 0.3


def toxicity_model(spark: SparkSession, folder: str) -> toxicity.Model:
    docs = table(spark, folder, "documents", "doc_id", "text")
    labels = table(spark, folder, "labels", "doc_id", "toxic")
    return toxicity.train(docs, labels, crc_mod("doc_id", 3) != 1)


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    found = toxicity.score(docs, toxicity_model(spark, folder))
    return found.select(
        "doc_id",
        (crc_mod("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
        F.array_join(
            F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["end"])), ","
        ).alias("spans"),
    )


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    found = secrets.scan(docs, secrets.train(docs))

    def count(kind: int) -> Column:
        return F.size(F.filter("_base", lambda span: span["kind"] == kind)).cast("long")

    counts = [count(i).alias(f"n_{name}") for i, name in enumerate(secrets.KINDS[:3])]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.digest_of(F.col("_base")), 256).alias("base_sha256"),
        secrets.digest_of(F.col("_spans")).alias("spans"),
    )


def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return lm.score(docs, crc_mod("doc_id", 7) != 2).withColumn(
        "held_out", ~F.col("trained")
    ).drop("trained")


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return exact_dedup.exact_duplicates(docs).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents", "doc_id", "text"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.rules(table(spark, folder, "documents", "doc_id", "text", "source"))


def op7_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    labels = table(spark, folder, "labels", "doc_id", "quality")
    model = quality_model.train(docs, labels, crc_mod("doc_id", 5) != 0)
    return quality_model.score(docs, model).select(
        "doc_id",
        (crc_mod("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages", "page_id", "url", "html")
    found = html_text.main_text(pages, html_text.train(pages))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return pieces.encode(docs, with_ids=False)


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op11_curriculum(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "source")
    return curriculum.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "position")


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) where a tenth of the texts, by the id's crc32 h, repeat: from word
    a = g % n on, the p = 1 + (n - a) // (3 + g % 8) words there over and over (g = h // 10)."""
    h = crc_mod("doc_id", 1 << 32)
    words = F.filter(F.split(text_of(), f"{SPACE}+"), lambda w: w != "")
    some = docs.withColumns({"_h": h, "_words": F.when(h % 10 == 0, words)})
    g, n = F.floor(F.col("_h") / 10), F.size("_words")
    some = some.withColumn("_a", F.when(n > 0, g % n).cast("int"))
    kinds = (3 + g % 8).cast("int")
    some = some.withColumn("_p", (1 + F.floor((n - F.col("_a")) / kinds)).cast("int"))
    part = F.slice("_words", F.col("_a") + 1, F.col("_p"))
    often = (F.ceil((n - F.col("_a")) / F.col("_p"))).cast("int")
    rest = F.slice(F.flatten(F.array_repeat(part, often)), F.lit(1), n - F.col("_a"))
    text = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_a")), rest), " ")
    return some.select("doc_id", F.when(F.col("_p").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    found = periodic.runs(planted(docs))

    def greater(best: Column, x: Column) -> Column:
        better = x["length"] * best["period"] > best["length"] * x["period"]
        return F.when(best.isNull() | better, x).otherwise(best)

    none = F.lit(None).cast(periodic.RUN)
    found = found.withColumn("_best", F.aggregate("runs", none, greater))
    line = lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col("_best")[c].alias(c) for c in periodic.RUN.names],
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents", "text", "lang", "source"))


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it is used from a checkout."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        find_package(spark)
        return query(spark, folder)

    return run


def queries() -> dict[str, Query]:
    all_queries = (
        op1_toxicity,
        op2_secret_scan,
        op3_lm_scoring,
        op4_exact_dedup,
        op5_packing,
        op6_quality_rules,
        op7_quality_model,
        op8_html_text,
        op9_pieces,
        op10_simhash,
        op11_curriculum,
        op12_periodic_runs,
        op13_source_divergence,
    )
    return {q.__name__: _prepared(q) for q in all_queries}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_exact_dedup": exact_dedup.SQL,
        "op6_quality_rules": quality_rules.SQL,
        "op11_curriculum": curriculum.SQL,
        "op13_source_divergence": divergence.SQL,
    }
