"""Secret scanning with character Markov models, in DataFrame expressions only.

Three fixed patterns find known kinds of secrets. Beside them, every long run of
key characters that holds both a letter and a digit is a candidate: a first-order
Markov model of random strings and one of ordinary identifiers, both over
characters, give its log-likelihood ratio, and candidates above the threshold are
secrets of kind ``markov``.

The random model is trained on what the patterns find, the identifier model on
long words of documents without a find. Both samples are bounded by parameters,
so the model is a table of fixed size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import sample, text_of

# --- fixed values: kinds, patterns and least lengths -------------------------
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
# --- end of fixed values ------------------------------------------------------

KINDS = ("assign", "access", "hex", "markov")
#: Characters with a place of their own in the models; all others share one more.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SIZE = len(ALPHABET) + 1
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"


_TYPE = "array<struct<start:int,kind:int,end:int>>"
# A run that is too short can't hold a longer one, so these two find the same
# spans as the fixed pattern and a test of the length.
_LONG_ACCESS = rf"AKIA[A-Z0-9]{{{ACCESS_LENGTH - 4},}}"
_LONG_HEX = rf"[0-9a-f]{{{HEX_LENGTH},}}"


@dataclass(frozen=True)
class Models:
    """ratio[SIZE * a + b]: log P(b after a | random) - log P(b after a | identifier)."""

    ratio: list[float]
    start: list[float]


def _spans(text: Column, pattern: str, kind: int, keep) -> Column:
    """Matches from left to right as (start, kind, end), code points, without overlap.

    Positions follow from the lengths of the matches and of the text between them.
    ``keep`` tells from the whole match which ones count.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    zero = F.struct(
        F.lit(0).alias("at"),
        _none().alias("spans"),
    )

    def step(state: Column, i: Column) -> Column:
        match = F.get(found, i)
        start = state["at"] + F.length(F.get(between, i))
        end = start + F.length(match)
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        more = F.when(keep(match), F.array(span)).otherwise(_none())
        return F.struct(end.alias("at"), F.concat(state["spans"], more).alias("spans"))

    return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), zero, step)["spans"]


def _none() -> Column:
    return F.array().cast(_TYPE)


def _has_assign(text: Column) -> Column:
    """Most texts hold neither sign, and looking for a sign is cheap."""
    return (text.contains("=") | text.contains(":")) & text.rlike(ASSIGN)


def _has_access(text: Column) -> Column:
    return text.contains("AKIA") & text.rlike(_LONG_ACCESS)


def _has_hex(text: Column) -> Column:
    return text.rlike(_LONG_HEX)


def _has_any(text: Column) -> Column:
    return _has_assign(text) | _has_access(text) | _has_hex(text)


def _base_spans(text: Column) -> Column:
    """Spans of the three fixed patterns by start, then kind."""
    value = lambda m: F.length(F.regexp_extract(m, f"^{ASSIGN}", 2)) >= ASSIGN_VALUE
    always = lambda m: F.lit(True)
    parts = [
        F.when(_has_assign(text), _spans(text, ASSIGN, 0, value)).otherwise(_none()),
        F.when(_has_access(text), _spans(text, _LONG_ACCESS, 1, always)).otherwise(_none()),
        F.when(_has_hex(text), _spans(text, _LONG_HEX, 2, always)).otherwise(_none()),
    ]
    return F.sort_array(F.concat(*parts))


def with_base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_text`` (NULL as empty) and ``_base``, the fixed patterns' spans."""
    return docs.withColumn("_text", text_of(text_col)).withColumn("_base", _base_spans(F.col("_text")))


def _places(chars: Column) -> Column:
    """Each character's place in ALPHABET from 0; SIZE - 1 for others."""
    place = lambda c: F.call_function("instr", F.lit(ALPHABET), c)
    return F.transform(chars, lambda c: F.when(place(c) > 0, place(c) - 1).otherwise(SIZE - 1))


def _counts(strings: DataFrame) -> tuple[list[int], list[int]]:
    """Character pairs and first characters of a column ``s`` of strings."""
    places = strings.select(_places(F.split("s", "")).alias("p"))
    pair = F.transform(
        F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.get("p", i - 1) * SIZE + F.get("p", i)
    )
    first = F.transform(F.slice("p", 1, 1), lambda c: c + SIZE * SIZE)
    keys = places.where(F.size("p") > 1).select(F.explode(F.concat(first, pair)).alias("k"))
    out = [0] * (SIZE * SIZE + SIZE)
    for k, n in keys.groupBy("k").count().collect():  # at most SIZE * (SIZE + 1) rows
        out[k] = n
    return out[: SIZE * SIZE], out[SIZE * SIZE :]


def _log_model(pairs: list[int], firsts: list[int], weight: float) -> tuple[list[float], list[float]]:
    """Log-probabilities: ``weight`` observations for each state, spread as single characters are."""
    rows = [pairs[a * SIZE : (a + 1) * SIZE] for a in range(SIZE)]
    seen = [sum(column) + n for column, n in zip(zip(*rows, strict=True), firsts, strict=True)]
    single = [(n + 0.5) / (sum(seen) + 0.5 * SIZE) for n in seen]

    def smooth(row: list[int]) -> list[float]:
        total = sum(row) + weight
        return [math.log((n + weight * p) / total) for n, p in zip(row, single, strict=True)]

    return [x for row in rows for x in smooth(row)], smooth(firsts)


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    random_docs: int = 60_000,
    ordinary_docs: int = 2_000,
    least_word: int = 6,
    weight: float = 20.0,
) -> Models:
    """Fit both models on labelled samples.

    Random strings are the values found by the fixed patterns in about
    ``random_docs`` documents, ordinary identifiers the words of at least
    ``least_word`` characters in those of about ``ordinary_docs`` documents that
    are without a find, both chosen by the id's hash. Without any sample both models are uniform or one is, and few
    candidates or none pass the threshold.
    """
    rows = docs.select(id_col, text_col)
    has = F.col("_base")
    likely = sample(rows, id_col, random_docs).where(_has_any(text_of(text_col)))
    some = with_base_spans(likely, text_col)
    span = F.struct(F.col("x.start").alias("a"), (F.col("x.end") - F.col("x.start")).alias("n"))
    values = (
        some.where(F.size(has) > 0)
        .select("_text", F.explode(has).alias("x")).where("x.kind < 3")
        .select("_text", span.alias("y"), "x.kind")
        .select(F.substring(F.col("_text"), F.col("y.a") + 1, F.col("y.n")).alias("m"), "kind")
        .select(
            F.when(F.col("kind") == 0, F.regexp_extract("m", f"^{ASSIGN}", 2))
            .otherwise(F.col("m")).alias("s")
        )
        .where(F.length("s") >= 16)
    )
    clean = sample(rows, id_col, ordinary_docs).where(~_has_any(text_of(text_col)))
    words = F.regexp_extract_all(text_of(text_col), F.lit(rf"[A-Za-z0-9+/_=-]{{{least_word},}}"), F.lit(0))
    ordinary = clean.select(F.explode(words).alias("s"))
    random_pairs, random_first = _counts(values)
    word_pairs, word_first = _counts(ordinary)
    a, b = _log_model(random_pairs, random_first, weight), _log_model(word_pairs, word_first, weight)
    return Models(*[[x - y for x, y in zip(p, q, strict=True)] for p, q in zip(a, b, strict=True)])


def log_ratio(string: Column, models: Models) -> Column:
    """Log-likelihood ratio of random against ordinary, per character."""
    ratio, start = F.lit(models.ratio), F.lit(models.start)
    places = _places(F.split(string, ""))
    zero = F.struct(F.lit(-1).alias("before"), F.lit(0.0).alias("sum"))
    total = F.aggregate(
        places,
        zero,
        lambda s, c: F.struct(
            c.alias("before"),
            (
                s["sum"]
                + F.when(s["before"] < 0, F.get(start, c)).otherwise(
                    F.get(ratio, s["before"] * SIZE + c)
                )
            ).alias("sum"),
        ),
    )["sum"]
    return total / F.length(string)


def scan(
    docs: DataFrame,
    models: Models,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.5,
) -> DataFrame:
    """``docs`` with ``_text`` and ``_spans``: (start, kind, end) by start, then kind.

    Base spans are all there. A candidate run counts as ``markov`` if its ratio per
    character is at least ``threshold`` and no base span overlaps it. NULL is the
    empty text. Offsets are code points, ends are exclusive.
    """
    rows = with_base_spans(docs, text_col)
    text = F.col("_text")

    def mixed(match: Column) -> Column:
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]") & (log_ratio(match, models) >= threshold)

    added = F.when(text.rlike(CANDIDATE), _spans(text, CANDIDATE, 3, mixed)).otherwise(_none())
    free = F.filter(
        "_added",
        lambda x: ~F.exists("_base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])),
    )
    rows = rows.withColumn("_added", added)
    spans = F.when(F.size("_added") > 0, F.sort_array(F.concat("_base", free))).otherwise(F.col("_base"))
    return rows.withColumn("_spans", spans).drop("_added")


def digest_of(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])
    return F.array_join(F.transform(spans, one), ",")


def redact(docs: DataFrame, models: Models, text_col: str = "text", mark: str = "<SECRET>") -> DataFrame:
    """``docs`` with each secret in the text replaced by ``mark``; overlapping spans are one.

    Rows without a secret are unchanged, a NULL text stays NULL.
    """
    packed = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(text_col).alias("_raw"))
    rows = scan(packed, models, text_col="_raw")
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(F.col("_text"), state["at"] + 1, span["start"] - state["at"])
        fresh = span["start"] >= state["at"]
        return F.struct(
            F.when(fresh, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"]).alias("out"),
            F.greatest(state["at"], span["end"]).alias("at"),
        )

    done = F.aggregate("_spans", zero, step)
    rest = F.substring(F.col("_text"), done["at"] + 1, F.length("_text"))
    hidden = F.when(F.size("_spans") > 0, F.concat(done["out"], rest)).otherwise(F.col("_raw"))
    columns = {c: F.col("_doc").getField(c) for c in docs.columns} | {text_col: hidden}
    return rows.select(*[value.alias(name) for name, value in columns.items()])
