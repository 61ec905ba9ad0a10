"""Near copies: word-shingle Jaccard of at least a bound, all pairs of them, by an exact prefix filter.

All shingles have one order: by hash, those in very many documents (``frequent``)
after all others. Two sets of a and b shingles at the bound share more than
``a - ceil(BOUND * a)`` of a's, so the first ``a - ceil(BOUND * a) + 1`` shingles of
each in this order (its prefix) have one in common. Whatever the order, no pair is
lost by that; that common passages come last only makes groups of rows with a
prefix shingle in common small.

A group's rows are first paired with its smallest and its largest row, so m rows make
O(m) pairs, and a large group of near copies becomes one component. What a group then
still has in different components is paired in full (:func:`rest`): a group loses none of
its pairs, and no two rows of one component are compared for an answer that changes nothing.

The links of the SimHash operator (``simhash.py``) are candidates too: a fingerprint says
nothing certain about the texts, so they are verified like all others.

A candidate is a link only if the exact Jaccard of the two whole texts says so.
Most candidates share a passage and are no near copies. Each row therefore has the
number of its shingles in each of BUCKETS hash buckets: two texts share no more than
the smaller numbers add up to, and candidates that can't reach the bound by that go
before any text is moved. No pair at the bound is lost by it.

Texts are compared in rounds: each row with its smallest candidate, then with its
largest, then all others, then the rest of the groups. Candidates that a round has left
in one component are not compared any more, as no answer would change the components.
A round takes passes of so many pairs that the texts in motion stay below the input; what
a step has shuffled or stored on its way is removed when it ends.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from orderloom.llm import simhash
from orderloom.llm.common import raw, sample, store, store_last
from orderloom.llm.components import connected_components
from orderloom.session import shuffles_removed

WORDS, BOUND = 5, 0.8
#: A shingle that is in more rows than this is frequent, as far as so many rows tell.
MANY, SAMPLE = 400, 30_000
#: Frequent shingles that are put last at most; others only make larger groups.
FREQUENT = 1 << 20
#: Hash buckets in which a row's shingles are counted.
BUCKETS = 128
_AT_ONCE = 512
#: Pairs that share one copy of a row's text while they are verified.
PAIRS_PER_TEXT = 100
#: Pairs whose texts move in one pass: this many, or a quarter of the rows if that is more.
PAIRS_PER_PASS = 50_000
#: Bits of the filter that spares rows without a candidate the shuffle.
_FILTER_BITS, _BUCKET = 1 << 27, 1 << 15


def shingles(text: bytes | None, words: int = WORDS) -> set[bytes]:
    """The distinct word shingles; a shorter text is one shingle, an empty one has none."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return set()
    if len(tokens) < words:
        return {b" ".join(tokens)}
    return set(map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False)))


def jaccard(a: set[bytes], b: set[bytes]) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both) if a or b else 1.0


def shingle_hashes(text: bytes | None) -> np.ndarray:
    found = shingles(text)
    return np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))


def bucket_counts(hashes: np.ndarray) -> bytes:
    """How many hashes are in each bucket, in the fewest bytes a bucket that hold all counts."""
    counts = np.bincount((hashes % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
    return counts.astype(f"<u{1 if counts.max() < 1 << 8 else 2 if counts.max() < 1 << 16 else 4}").tobytes()


def most_jaccard(x: bytes, y: bytes) -> float:
    """No smaller than the Jaccard of two texts with these bucket counts."""
    a, b = (np.frombuffer(c, f"<u{len(c) // BUCKETS}").astype(np.int64) for c in (x, y))
    both = int(np.minimum(a, b).sum())
    either = int(a.sum() + b.sum()) - both
    return both / either if either else 1.0


def prefix_length(shingles: int) -> int:
    """How many of its first shingles a text must offer, so that no text at the bound shares none."""
    return shingles - math.ceil(BOUND * shingles - 1e-9) + 1


def prefix(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first distinct hashes of a text in the common order; ``frequent`` is sorted. A text
    without a word has one that all such texts share."""
    if not len(hashes):
        return np.zeros(1, np.uint64)
    own = np.sort(hashes)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
        late = frequent[at] == own
        own = np.concatenate([own[~late], own[late]])
    return own[: prefix_length(len(own))]


def _signatures(rows: DataFrame, frequent: np.ndarray, whole: bool = False) -> DataFrame:
    """(row, n, tokens, counts) of ``rows`` (_row, _text): the number of shingles, the prefix or,
    if ``whole``, all of them, and the bucket counts."""
    schema = StructType(
        [
            StructField("row", LongType()),
            StructField("n", LongType()),
            StructField("tokens", ArrayType(LongType())),
            StructField("counts", BinaryType()),
        ]
    )
    shared = rows.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _AT_ONCE):
                some = batch.slice(start, _AT_ONCE)
                hashes = [shingle_hashes(t.as_py()) for t in some.column(1)]
                found = [h if whole else prefix(h, shared.value) for h in hashes]
                sizes = np.cumsum([0] + [len(x) for x in found])
                flat = np.concatenate(found).astype(np.uint64).view(np.int64)
                tokens = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, pa.int64()))
                counts = pa.array(map(bucket_counts, hashes), pa.binary())
                n = pa.array([len(h) for h in hashes], pa.int64())
                yield pa.RecordBatch.from_arrays([some.column(0), n, tokens, counts], names=schema.names)
        pa.default_memory_pool().release_unused()

    return rows.select("_row", raw("_text").alias("text")).mapInArrow(run, schema)


def _each(sigs: DataFrame) -> DataFrame:
    return sigs.select("row", "n", F.explode("tokens").alias("token"))


def frequent_shingles(rows: DataFrame) -> np.ndarray:
    """Sorted hashes of the shingles that go last: by a sample of ``rows`` (_row, _text) those in
    more than MANY of all rows. This decides how large groups are, not which pairs are found."""
    share = min(1.0, SAMPLE / max(rows.count(), 1))
    whole = _signatures(sample(rows, "_row", SAMPLE), np.zeros(0, np.uint64), whole=True)
    often = _each(whole).groupBy("token").count().where(F.col("count") > max(MANY * share, 8))
    most = store(often.orderBy(F.desc("count"), "token").limit(FREQUENT).select("token"), "near-frequent")
    return np.sort(most.toArrow().column(0).to_numpy().view(np.uint64))


def grouped(sigs: DataFrame) -> DataFrame:
    """(token, row, n, lo, hi): rows with a prefix shingle in common, its smallest and largest row."""
    each = _each(sigs)
    ends = each.groupBy("token").agg(F.min("row").alias("lo"), F.max("row").alias("hi")).where("lo < hi")
    ends = store(ends, "near-groups")
    few = each.where(_among(ends.select("token"), each, "token"))
    return few.join(ends, "token")


def candidates(members: DataFrame) -> DataFrame:
    """(a, b) with a < b: each of ``members`` with the smallest and the largest row of its group."""
    pairs = members.select("row", F.explode(F.array("lo", "hi")).alias("end")).where("row <> end")
    return pairs.select(F.least("row", "end").alias("a"), F.greatest("row", "end").alias("b")).distinct()


def fingerprint_pairs(rows: DataFrame) -> DataFrame:
    """(a, b) with a < b: links between ``rows`` (_row, _text) by SimHash. Rows of one fingerprint
    are linked to the smallest of them, and these where fingerprints are at most three bits apart."""
    prints = store(simhash.with_fingerprints(rows, "_row", "_text"), "near-fingerprints")
    low = store(prints.groupBy("fp").agg(F.min("_row").alias("low")), "near-distinct")
    equal = prints.join(low, "fp").select(F.col("low").alias("a"), F.col("_row").alias("b"))
    found = simhash.links(low.select("fp"), simhash.prefix_bits(low.count()))
    for side in ("a", "b"):
        found = found.join(low.select(F.col("fp").alias(side), F.col("low").alias(f"_{side}")), side)
    found = found.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
    return equal.unionByName(found).where("a <> b").distinct()


def rest(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b) with a < b: all pairs of a group that :func:`candidates` has not paired and that are
    in different components of ``labels`` (node, component)."""
    own = labels.select(F.col("node").alias("row"), "component")
    # rows at the ends of a group are paired with all others already
    inner = members.where("row <> lo and row <> hi").join(own, "row", "left")
    inner = inner.select("token", "row", "n", F.coalesce("component", "row").alias("c"))
    apart = inner.groupBy("token").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x < y")
    inner = store(inner.join(apart.select("token"), "token", "left_semi"), "near-rest")
    first = inner.select("token", F.col("row").alias("a"), F.col("n").alias("m"), F.col("c").alias("d"))
    long_enough = F.least("n", "m") >= BOUND * F.greatest("n", "m") - 1e-6
    pairs = first.join(inner, "token").where((F.col("a") < F.col("row")) & (F.col("c") != F.col("d")) & long_enough)
    return pairs.select("a", F.col("row").alias("b")).distinct()


def _among(ids: DataFrame, rows: DataFrame, row_col: str = "_row") -> Column:
    """Whether a row may be one of ``ids`` (one column): a filter of fixed size, never false for one."""
    bits = _BUCKET
    while bits < min(_FILTER_BITS, 16 * ids.count()):
        bits *= 2

    def place(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(bits))

    at = place(F.col(ids.columns[0])) + 1
    maps = ids.select(at.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("map")
    )
    filled = np.zeros(bits // 8, np.uint8)
    for bucket, bitmap in maps.collect():
        start = (bucket - 1) * (_BUCKET // 8)
        filled[start : start + len(bitmap)] = np.frombuffer(bitmap, np.uint8)[: len(filled) - start]
    shared = rows.sparkSession.sparkContext.broadcast(filled)

    @F.pandas_udf("boolean")
    def test(at: pd.Series) -> pd.Series:
        p = at.to_numpy()
        return pd.Series((shared.value[p >> 3] >> (p & 7) & 1).astype(bool))

    return test(place(F.col(row_col)))


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, x, y): ``pairs`` (a, b) with the ``text`` of both rows in ``texts`` (_row, text)."""
    one = _with_text(pairs, "b", pairs, texts, "y")
    return _with_text(one, "a", pairs, texts, "x").select("a", "b", "x", "y")


def _with_text(rows: DataFrame, side: str, pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """``rows``, which are ``pairs`` with more columns, with the text of their row ``side``.

    A row in many pairs, as the first of a large group is, gets its text in as many
    places as it has hundreds of pairs, and its pairs are dealt over these.
    """
    times = pairs.groupBy(side).agg(F.ceil(F.count("*") / PAIRS_PER_TEXT).cast("int").alias("_times"))
    own = texts.select(F.col("_row").alias(side), F.col("text").alias(name)).join(times, side)
    own = own.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)))
    dealt = rows.join(times, side).withColumn("_salt", F.pmod(F.xxhash64("a", "b"), F.col("_times")).cast("int"))
    return dealt.drop("_times").join(own.drop("_times"), [side, "_salt"]).drop("_salt")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("i")).unionByName(pairs.select("b").toDF("i")).distinct()


def plausible(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """Those (a, b) that can reach the bound by the bucket counts in ``sigs`` (row, counts)."""
    counts = sigs.select(F.col("row").alias("_row"), F.col("counts").alias("text"))
    few = counts.where(_among(_ends(pairs), counts))
    both = _with_texts(pairs, few)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column(2), batch.column(3), strict=True)
            hit = [most_jaccard(x.as_py(), y.as_py()) >= BOUND for x, y in sides]
            yield batch.select([0, 1]).filter(pa.array(hit, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Those (a, b) whose texts in ``rows`` (_row, _text) reach the bound."""
    ids = _ends(pairs)
    few = rows.where(_among(ids, rows)).select("_row", raw("_text").alias("text"))
    few = store(few, "near-texts")
    both = _with_texts(pairs, few)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                hit.append(jaccard(shingles(x.as_py()), shingles(y.as_py())) >= BOUND)
            chosen = pa.array(hit, pa.bool_())
            yield batch.select([0, 1]).filter(chosen)
        pa.default_memory_pool().release_unused()

    return both.mapInArrow(run, "a long, b long")


def verified_in_passes(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """:func:`verified` of all stored ``pairs``, pass by pass: a pair moves a text, and what a pass has
    moved is removed before the next, so that pairs of many times the rows don't take their disk."""
    at_once = max(PAIRS_PER_PASS, rows.count() // 4)
    passes = max(1, math.ceil(pairs.count() / at_once))
    found = None
    for k in range(passes):
        some = pairs.where(F.pmod(F.xxhash64("b", "a"), F.lit(passes)) == k)
        own = store_last(lambda: verified(some, rows), "near-links")  # noqa: B023
        found = own if found is None else found.unionByName(own)
    return found


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Those (a, b) that are not in one component of ``labels`` (node, component)."""
    for side in ("a", "b"):
        own = labels.select(F.col("node").alias(side), F.col("component").alias(f"_{side}"))
        pairs = pairs.join(own, side, "left").withColumn(f"_{side}", F.coalesce(f"_{side}", side))
    return pairs.where("_a <> _b").select("a", "b")


def near_links(rows: DataFrame) -> DataFrame:
    """(a, b): links between ``rows`` (_row, _text) that connect all near copies, verified."""
    sigs = store(_signatures(rows, frequent_shingles(rows)), "near-signatures")
    members = store_last(lambda: grouped(sigs), "near-members")

    def first() -> DataFrame:
        pairs = candidates(members).unionByName(fingerprint_pairs(rows)).distinct()
        return plausible(store(pairs, "near-candidates"), sigs)

    left = store_last(first, "near-pairs")
    links, labels = left.limit(0), left.limit(0).toDF("node", "component")
    rounds = (
        lambda: left.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"),
        lambda: left.groupBy("a").agg(F.max("b").alias("b")),
        lambda: left,
    )
    for chosen in rounds:
        if not left.take(1):
            break
        now = store(chosen(), "near-chosen")
        found = verified_in_passes(now, rows)
        labels = store_last(lambda: connected_components(links.unionByName(found)), "near-labels")  # noqa: B023
        left = store(_apart(left.join(now, ["a", "b"], "left_anti"), labels), "near-pairs")
        links = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    others = store(rest(members, labels), "near-candidates")
    if not others.take(1):
        return links
    others = store(plausible(others, sigs), "near-pairs")
    if not others.take(1):
        return links
    return links.unionByName(verified_in_passes(others, rows))


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their component of links: the smallest id of each.

    A NULL id comes last, of rows with equal ids one stays.
    """
    packed = docs.select(
        F.struct(*docs.columns).alias("_doc"), F.monotonically_increasing_id().alias("_row")
    )
    rows = store(packed, "near-dedup")
    row_id, text = F.col("_doc").getField(id_col), F.col("_doc").getField(text_col)
    named = rows.select("_row", text.alias("_text"))
    with shuffles_removed(docs.sparkSession):
        labels = store_last(lambda: connected_components(near_links(named)), "near-labels")
    if not labels.take(1):
        return rows.select("_doc.*")
    roots = labels.select(F.col("component").alias("node"), "component").distinct()
    linked = labels.unionByName(roots).select(F.col("node").alias("_row"), "component")
    maybe = rows.withColumn("_maybe", _among(linked.select("_row"), rows))
    key = F.struct(row_id.isNull().alias("n"), row_id.alias("i"), F.col("_row").alias("r"))
    keyed = maybe.where("_maybe").select("_row", key.alias("k")).join(linked, "_row")
    best = keyed.groupBy("component").agg(F.min("k").alias("best")).select(F.col("best.r").alias("_row"))
    gone = store(linked.select("_row").join(best, "_row", "left_anti"), "near-gone")
    alone = maybe.where(~F.col("_maybe")).select("_doc.*")
    judged = maybe.where("_maybe").join(gone, "_row", "left_anti").select("_doc.*")
    return alone.unionByName(judged)


def ball_pairs(
    key: np.ndarray, prefix: np.ndarray, row: np.ndarray, check: np.ndarray, low: int
) -> tuple[np.ndarray, np.ndarray]:
    """Not used by the stage, which has no balls of SimHashes any more.

    Pairs (row, smallest, largest or next row) of values that share a variant under ``prefix``.

    ``key`` is table and value in one number; ``prefix`` is the key's leading
    part as routed, at most one flip from the key's own.
    """
    own = key >> low == prefix
    flips = np.append(0, 1 << np.arange(low, dtype=np.int64))
    at = np.flatnonzero(own)
    moved = np.flatnonzero(~own)
    z = np.concatenate(
        [(key[at, None] ^ flips[None, :]).ravel(), (prefix[moved] << low) | (key[moved] & ((1 << low) - 1))]
    )
    owner = np.concatenate([np.repeat(at, len(flips)), moved])
    order = np.lexsort((row[owner], z))
    z, owner = z[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], z[1:] != z[:-1]])) if len(z) else z
    size = np.diff(np.append(starts, len(z)))
    first = np.repeat(owner[starts], size)
    last = np.repeat(owner[starts + size - 1], size)
    following = np.append(owner[1:], owner[-1:])
    inner = np.repeat(size <= 4, size)
    inner[np.append(starts[1:], len(z))[: len(starts)] - 1] = False
    a, b = np.concatenate([owner, owner, owner[inner]]), np.concatenate([first, last, following[inner]])
    near = (row[a] != row[b]) & (np.bitwise_count((check[a] ^ check[b]).view(np.uint64)) <= 24)
    pairs = np.unique(np.stack([row[a[near]], row[b[near]]], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]
