"""Quality rules by cross-document line frequency, in DataFrame expressions only.

Lines are normalised and hashed. A line that stands in too many documents of its
host is boilerplate there; it counts as removed, and a document that loses too
much is rejected. Simple rules over the document alone come first.

Everything about one document is computed in its own row, without a shuffle of
words: the windows of five words are hashed into an array, and only texts whose
array holds a repeat are looked at more closely. What is shuffled is one hash for
each distinct line of a document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import NOT_SPACE, SPACE, store, text_of

WINDOW = 5


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def _windows(words: Column) -> Column:
    """Hash of each run of five words."""

    def of(hashes: Column) -> Column:
        last = F.size(hashes) - (WINDOW - 1)
        found = F.transform(
            F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(hashes, i, F.lit(WINDOW)))
        )
        return F.when(last > 0, found).otherwise(F.array().cast("array<bigint>"))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), of)


def repeated_words(words: Column) -> Column:
    """Words inside five-word windows that occur at least twice, the first ones included."""

    def covered(starts: Column) -> Column:
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

        def step(s: Column, at: Column) -> Column:
            end = at + WINDOW
            return F.struct((s["n"] + end - F.greatest(at, s["end"])).alias("n"), end.alias("end"))

        return F.aggregate(F.sort_array(starts), zero, step)["n"]

    def repeats(rows: Column) -> Column:
        """Positions of sorted (hash, position) whose neighbour has the same hash."""
        hash_at = lambda k: F.get(rows, k)["h"]
        twin = lambda k: (hash_at(k) == hash_at(k - 1)) | (hash_at(k) == hash_at(k + 1))
        chosen = F.filter(F.sequence(F.lit(0), F.size(rows) - 1), twin)
        return F.transform(chosen, lambda k: F.get(rows, k)["i"])

    def count(windows: Column) -> Column:
        pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        found = _let(F.sort_array(pairs), lambda rows: covered(repeats(rows)))
        alone = F.size(F.array_distinct(windows)) == F.size(windows)
        return F.when(alone, F.lit(0)).otherwise(found)

    return _let(_windows(words), count).cast("long")


def normal_line(words: Column) -> Column:
    """A line's words in lower case, one space between, each digit as 0."""
    return F.regexp_replace(F.lower(F.array_join(words, " ")), "[0-9]", "0")


def rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    least_documents: int = 10,
    share: float = 0.05,
    least_words: int = 10,
    most_removed: float = 0.5,
) -> DataFrame:
    """One row per input row: the id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, n_removed_words and kept.

    A line is boilerplate in a host if more than ``least_documents`` of its
    documents, and more than the ``share`` of them, hold it. A document that passes
    the base rules is kept if at least ``least_words`` words remain and at most
    ``most_removed`` of its words were removed. NULL texts and texts without words
    fail the base rules; documents with a NULL host form one host; each row counts
    as a document, repeated rows too.
    """
    text = text_of(text_col)
    chars = F.length(F.array_join("_words", ""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE))

    def hashed(line: Column) -> Column:
        return _let(
            _words(line),
            lambda w: F.struct(F.xxhash64(normal_line(w)).alias("h"), F.size(w).alias("n")),
        )

    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("_host"),
        F.col(host_col).isNull().alias("_no_host"),
        text.alias("_text"),
        _words(text).alias("_words"),
        lines.alias("_lines"),
    )
    base = rows.select(
        "_row",
        id_col,
        "_host",
        "_no_host",
        F.size("_words").cast("long").alias("n_words"),
        chars.cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", "[#*$%&|<>]", "")))
        .cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.transform("_lines", hashed).alias("_hashed"),
    )
    base = store(base, "line-rules")

    host = ["_host", "_no_host"]
    held = base.select(*host, F.explode(F.array_distinct("_hashed.h")).alias("h"))
    often = held.groupBy(*host, "h").agg(F.count("*").alias("n")).where(F.col("n") > least_documents)
    sizes = base.groupBy(*host).agg(F.count("*").alias("docs"))
    often = often.join(sizes, host).where(F.col("n") > share * F.col("docs")).select(*host, "h")
    each = base.select("_row", *host, F.explode("_hashed").alias("x"))
    each = each.select("_row", *host, F.col("x.h").alias("h"), F.col("x.n").alias("n"))
    removed = (
        each.join(often, [*host, "h"], "left_semi")
        .groupBy("_row").agg(F.sum("n").alias("n_removed_words"))
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    good = (left >= least_words) & (F.col("n_removed_words") <= most_removed * F.col("n_words"))
    return (
        base.drop("_hashed", *host)
        .join(removed, "_row", "left")
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & good)
        .drop("_row")
    )


#: The same in DuckDB's SQL, for the production parameters.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), win AS (
  SELECT rid, i, list_aggregate(ws[i:i + 4], 'string_agg', ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
), rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1
), cov AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY rid
), ln AS (
  SELECT rid, source, x,
    regexp_replace(lower(array_to_string(regexp_extract_all(x, '[^\x20\x09-\x0D]+'), ' ')), '[0-9]', '0', 'g') AS h,
    len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT rid, source, unnest(ls) AS x FROM w)
), often AS (
  SELECT l.source, l.h
  FROM (SELECT source, h, count(DISTINCT rid) AS n FROM ln GROUP BY source, h) l
  JOIN (SELECT source, count(*) AS docs FROM d GROUP BY source) s ON l.source IS NOT DISTINCT FROM s.source
  WHERE l.n > 10 AND l.n > 0.05 * docs
), rem AS (
  SELECT rid, sum(n) AS n FROM ln JOIN often o ON ln.source IS NOT DISTINCT FROM o.source AND ln.h = o.h
  GROUP BY rid
), m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(rem.n, 0) AS BIGINT) AS n_removed_words
  FROM w LEFT JOIN cov USING (rid) LEFT JOIN rem USING (rid)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
    AND n_words - n_removed_words >= 10 AND n_removed_words <= 0.5 * n_words AS kept
FROM m
"""
