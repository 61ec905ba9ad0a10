"""Exact deduplication behind a two-pass Bloom filter.

Pass one sets, for every row, k bits of a filter that tells bits met once from
bits met again. Pass two looks at each row's bits: if any was met once only, no
other row has the same text, and the row passes straight through. Only the other
rows are shuffled and compared by digest, so a false positive costs a little
shuffle and never changes a result.

The filter has 16 bits a row, at most 2^27 (16 MB), whatever the input: that is
what is broadcast. Past 8 million rows false positives grow, at most to all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import SPACE, store, text_of

MAX_BITS = 1 << 27
_BUCKET = 1 << 15  # bits in one bitmap of Spark's bitmap functions
_OWN = ("_row", "_chars", "_sha")


def _positions(bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64("_sha", F.lit(i)), F.lit(bits)) for i in range(hashes)]


def _repeated_bits(rows: DataFrame, bits: int, hashes: int) -> np.ndarray:
    """The filter: bits that at least two rows set. Its size is bounded by ``bits``."""
    each = rows.select(F.explode(F.array_distinct(F.array(*_positions(bits, hashes)))).alias("p"))
    again = each.groupBy("p").count().where("count > 1").select((F.col("p") + 1).alias("p"))
    maps = again.groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("map")
    )
    out = np.zeros(bits // 8, np.uint8)
    for bucket, bitmap in maps.collect():
        start = (bucket - 1) * (_BUCKET // 8)
        out[start : start + len(bitmap)] = np.frombuffer(bitmap, np.uint8)[: len(out) - start]
    return out


def _maybe_repeated(rows: DataFrame, hashes: int, max_bits: int) -> tuple[Column, int]:
    bits = _BUCKET
    while bits < min(max_bits, 16 * rows.count()):
        bits *= 2
    shared = rows.sparkSession.sparkContext.broadcast(_repeated_bits(rows, bits, hashes))

    @F.pandas_udf("boolean")
    def test(columns: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        filled = shared.value
        for frame in columns:
            out = np.ones(len(frame), bool)
            for name in frame.columns:
                p = frame[name].to_numpy()
                out &= (filled[p >> 3] >> (p & 7) & 1).astype(bool)
            yield pd.Series(out)

    packed = F.struct(*[p.alias(f"p{i}") for i, p in enumerate(_positions(bits, hashes))])
    return test(packed), bits


def _order(id_col: str) -> Column:
    return F.struct((-F.col("_chars")).alias("c"), F.col(id_col).alias("i"), F.col("_row").alias("r"))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_text: bool = False,
    hashes: int = 3,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """All columns of ``docs`` (the text only with ``keep_text``) plus, per row:
    keep_id, group_size, kept and text_sha256.

    Texts are equal when they are identical after all white space is deleted (by
    SHA-256 of the rest). Of a group the row with the most code points in its
    original text, then the smallest id stays; of rows that agree in both, one
    stays. NULL is the empty text, a NULL id comes first. Columns of ``docs``
    named like a result column are replaced.
    """
    results = ("keep_id", "group_size", "kept", "text_sha256")
    text = text_of(text_col)
    rows = docs.withColumns(
        {
            "_row": F.monotonically_increasing_id(),
            "_chars": F.length(text),
            "_sha": F.sha2(F.regexp_replace(text, f"{SPACE}+", ""), 256),
        }
    )
    rows = rows.drop(*[c for c in results if c not in (id_col, text_col)])
    rows = store(rows if keep_text else rows.drop(text_col), "digests")
    carried = [c for c in rows.columns if c not in _OWN]

    maybe, _ = _maybe_repeated(rows.select("_sha"), hashes, max_bits)
    flagged = rows.withColumn("_maybe", maybe)
    alone = flagged.where(~F.col("_maybe")).select(
        *carried,
        F.col(id_col).alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
    some = flagged.where("_maybe").drop("_maybe")
    best = some.groupBy("_sha").agg(F.min(_order(id_col)).alias("_best"), F.count("*").alias("_n"))
    compared = some.join(best, "_sha").select(
        *carried,
        F.col("_best.i").alias("keep_id"),
        F.col("_n").alias("group_size"),
        (F.col("_row") == F.col("_best.r")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
    return alone.unionByName(compared)


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hashes: int = 3,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever those are called.

    Rows are compared without their texts; what stays is then found by its row
    number, so that no task receives the texts of a whole group of copies.
    """
    text = text_of(text_col)
    packed = docs.select(
        F.struct(*docs.columns).alias("_doc"),
        F.col(id_col).alias("_id"),
        F.monotonically_increasing_id().alias("_row"),
        F.length(text).alias("_chars"),
        F.sha2(F.regexp_replace(text, f"{SPACE}+", ""), 256).alias("_sha"),
    )
    rows = store(packed, "digests")
    maybe, _ = _maybe_repeated(rows.select("_sha"), hashes, max_bits)
    flagged = rows.withColumn("_maybe", maybe)
    best = flagged.where("_maybe").groupBy("_sha").agg(F.min(_order("_id")).alias("_best"))
    stay = flagged.where("_maybe").join(best.select(F.col("_best.r").alias("_row")), "_row", "left_semi")
    return flagged.where(~F.col("_maybe")).select("_doc.*").unionByName(stay.select("_doc.*"))


#: The same in DuckDB's SQL.
SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), r AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
    row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS FIRST) AS place,
    first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS FIRST) AS keep_id
  FROM d
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r
"""
