"""How far each source's terms diverge from other sources and from their language.

Only terms in enough documents of their language count, and they are found by
prefix refinement: the documents with a term that has a prefix are at least as
many as those with the term, so a prefix in too few documents is discarded with
all terms under it. Prefixes of one length are counted over all documents, those
that stay are extended to the next length, and so on until no prefix that stays
is cut: what is left is the terms kept. A term no longer than the length is
counted as itself.

Prefixes that stay pass on by a bitmap of fixed size; the next level counts
exactly, so a false hit costs a little work and never changes a result. Every
task adds up its documents before anything is shuffled, so frequent terms are one
row per task and no key is hot.

Sums over pairs of sources have a closed part (what two sources would give that
share no term, from how many terms occur how often) and a correction for shared
terms, which tasks add up into one number per pair.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import raw, store

#: Documents of a language that a term must occur in, and ranks of the terms' report.
DOCUMENTS, RANKS = 3, 200
#: Bytes of the shortest prefixes; each level has twice as many.
FIRST_PREFIX = 6
SCALE = 1_000_000_000
#: Bytes of terms: letters A-Z, lower-cased, and all beyond ASCII; the others separate them.
_TO_TERMS = bytes(i if i > 127 else (i | 32 if chr(i).isalpha() else 32) for i in range(256))
#: How often a group has a term, as tasks pass it on.
_ENTRY = np.dtype([("g", "<i8"), ("n", "<i8")])
#: Distinct terms, and terms of documents, of one block; pairs of sources added up at once.
_ENTRIES, _WAITING, _PAIRS = 200_000, 1_000_000, 1 << 20
#: Terms times groups of a block that are added up in a table; if there are more, sorted.
_TABLE = 1 << 22
_MAX_BITS, _BUCKET = 1 << 27, 1 << 15
#: Groups at most: four numbers of each are sent to the tasks, and every pair of a language is a row.
MOST_GROUPS = 1 << 20
_BLOCK = "lang string, sources array<string>, source binary, size binary, terms binary, at binary, n binary"


class _Block:
    """Documents of one language: their distinct terms once, and where each document has them."""

    def __init__(self, lang: str):
        self.lang = lang
        self.terms: dict[bytes, int] = defaultdict(count().__next__)
        self.sources: dict[str, int] = {}
        self.source, self.size, self.at, self.n = [], [], [], []
        self.total = 0

    def add(self, source: str, text: bytes) -> None:
        found = Counter(text.translate(_TO_TERMS).split())
        self.source.append(self.sources.setdefault(source, len(self.sources)))
        self.size.append(len(found))
        self.at.append(np.fromiter(map(self.terms.__getitem__, found), "<i4", len(found)))
        self.n.append(np.fromiter(found.values(), "<i4", len(found)))
        self.total += len(found)

    def full(self) -> bool:
        return self.total >= _WAITING or len(self.terms) >= _ENTRIES

    def row(self) -> pa.RecordBatch:
        numbers = [np.array(x, "<i4") for x in (self.source, self.size)]
        at, n = (np.concatenate(x).astype("<i4") for x in (self.at, self.n))
        blobs = [numbers[0], numbers[1], b" ".join(self.terms), at, n]
        arrays = [pa.array([self.lang], pa.string()), pa.array([list(self.sources)], pa.list_(pa.string()))]
        arrays += [pa.array([x if isinstance(x, bytes) else x.tobytes()], pa.binary()) for x in blobs]
        return pa.RecordBatch.from_arrays(arrays, names=["lang", "sources", "source", "size", "terms", "at", "n"])


def _blocks(docs: DataFrame) -> DataFrame:
    """The terms of ``docs`` (lang, source, text), in blocks of documents of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[str, _Block] = {}
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, batch.column(2), strict=True):
                block = open_blocks.get(lang) or open_blocks.setdefault(lang, _Block(lang))
                block.add(source, text.as_py())
                if block.full():
                    yield open_blocks.pop(lang).row()
                elif len(open_blocks) > 1 and sum(b.total for b in open_blocks.values()) >= 2 * _WAITING:
                    yield from (b.row() for b in open_blocks.values())
                    open_blocks = {}
        yield from (b.row() for b in open_blocks.values())

    return docs.select("lang", "source", raw("text").alias("text")).mapInArrow(run, _BLOCK)


def _numbers_of(blob: pa.Scalar) -> np.ndarray:
    return np.frombuffer(blob.as_py(), "<i4").astype(np.int64)


def _bitmap(kept: DataFrame) -> np.ndarray:
    """Places of ``kept`` (lang, prefix): 16 bits each, at most 2^27 in all."""
    bits = _BUCKET
    while bits < min(_MAX_BITS, 16 * kept.count()):
        bits *= 2
    key = F.concat(F.col("lang").cast("binary"), F.lit(b"\0"), F.col("prefix"))
    at = (F.crc32(key) % bits + 1).alias("p")
    maps = kept.select(at).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("map")
    )
    out = np.zeros(bits // 8, np.uint8)
    for bucket, bitmap in maps.collect():
        start = (bucket - 1) * (_BUCKET // 8)
        out[start : start + len(bitmap)] = np.frombuffer(bitmap, np.uint8)[: len(out) - start]
    return out


def _hits(filled: np.ndarray | None, lang: str, prefixes: list[bytes]) -> np.ndarray:
    """Which of the prefixes may have stayed."""
    if filled is None:
        return np.ones(len(prefixes), bool)
    start, crc = zlib.crc32(lang.encode() + b"\0"), zlib.crc32
    at = np.fromiter([crc(p, start) for p in prefixes], np.int64, len(prefixes)) % (8 * len(filled))
    return (filled[at >> 3] >> (at & 7) & 1).astype(bool)


def _prefixes(blocks: DataFrame, length: int, parent: int, above: DataFrame | None, documents: int) -> DataFrame:
    """(lang, prefix): the prefixes of ``length`` bytes, and shorter terms, in enough documents.

    Terms shorter than ``parent`` are done with.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(None if above is None else _bitmap(above))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, size, terms, at in zip(*batch.columns, strict=True):
                lang, terms = lang.as_py(), terms.as_py().split()
                long = np.flatnonzero(np.fromiter(map(len, terms), np.int64, len(terms)) >= parent)
                some = [terms[i] for i in long.tolist()]
                hit = _hits(shared.value, lang, [t[:parent] for t in some])
                known: dict[bytes, int] = defaultdict(count().__next__)
                prefix_of = np.full(len(terms), -1)
                chosen = [t[:length] for t, h in zip(some, hit.tolist(), strict=True) if h]
                prefix_of[long[hit]] = np.fromiter(map(known.__getitem__, chosen), np.int64, len(chosen))
                # a document counts once for each of its distinct prefixes; those of one term can't repeat in it
                repeats = np.append(np.bincount(prefix_of[prefix_of >= 0], minlength=len(known)) > 1, False)
                prefix = prefix_of[_numbers_of(at)]
                n = np.bincount(prefix[(prefix >= 0) & ~repeats[prefix]], minlength=len(known))
                size = _numbers_of(size)
                more = np.flatnonzero(repeats[prefix])
                document = np.repeat(np.arange(len(size)), size)[more]
                key = np.unique(document * len(known) + prefix[more])
                n += np.bincount(key % max(len(known), 1), minlength=len(known))
                arrays = [pa.repeat(pa.scalar(lang, pa.string()), len(n)), pa.array(list(known), pa.binary()), pa.array(n)]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "prefix", "n"])

    counted = blocks.select("lang", "size", "terms", "at").mapInArrow(run, "lang string, prefix binary, n long")
    summed = counted.groupBy("lang", "prefix").agg(F.sum("n").alias("n"))
    return summed.where(F.col("n") >= documents).select("lang", "prefix")


def kept_terms(blocks: DataFrame, documents: int = DOCUMENTS, first: int = FIRST_PREFIX) -> DataFrame:
    """(lang, prefix): the complete terms in at least ``documents`` documents of their language."""
    done, above, parent, length = None, None, 0, first
    while True:
        level = store(_prefixes(blocks, length, parent, above, documents), "divergence-level")
        # those shorter than the length are complete and need no further level
        own = level.where(F.octet_length("prefix") < length)
        done = own if done is None else done.unionByName(own.where(F.octet_length("prefix") >= parent))
        cut = level.where(F.octet_length("prefix") == length)
        if not cut.take(1):
            return done
        above, parent, length = cut, length, 2 * length


def _lists(counts: np.ndarray, size: np.ndarray) -> pa.Array:
    """Entries, ``size`` of them per row, as bytes."""
    offsets = np.append(0, np.cumsum(size * _ENTRY.itemsize)).astype("<i4")
    return pa.Array.from_buffers(
        pa.binary(), len(size), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(counts.tobytes())]
    )


def _summed(row: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and total of each row's entries, by row and group."""
    groups, place = np.unique(entries["g"], return_inverse=True)
    key = row * max(len(groups), 1) + place
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.append(True, np.diff(key) != 0)[: len(key)])
    out = np.empty(len(new), _ENTRY)
    out["g"] = entries["g"][order[new]]
    out["n"] = np.add.reduceat(entries["n"][order], new) if len(new) else 0
    return key[new] // max(len(groups), 1), out


def _by_key(key: np.ndarray, n: np.ndarray, keys: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, of 0 to ``keys``, and the total of each one's ``n``, none of which is 0."""
    at = None
    if keys > _TABLE:
        found, at = np.unique(key, return_inverse=True)
    # totals of a block are far below 2^53, so that doubles hold them exactly
    total = np.bincount(key if at is None else at, weights=n)
    if at is None:
        found = np.flatnonzero(total)
        total = total[found]
    return found, total.astype(np.int64)


def _group(lang: Column, source: Column, seed: int) -> Column:
    return F.xxhash64(lang, F.lit(seed), source)


def _counts(blocks: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, term, entries): how often each group has the kept terms (and a few others), by block.

    ``blocks`` has the number ``groups`` of each of its sources.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(_bitmap(kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, groups, source, size, terms, at, n in zip(*batch.columns, strict=True):
                lang, own = lang.as_py(), terms.as_py().split()
                numbers = np.sort(np.array(groups.as_py(), np.int64))
                place = np.searchsorted(numbers, np.array(groups.as_py(), np.int64))[_numbers_of(source)]
                term = _numbers_of(at)
                hit = _hits(shared.value, lang, own)[term]
                key = term[hit] * len(numbers) + np.repeat(place, _numbers_of(size))[hit]
                key, total = _by_key(key, _numbers_of(n)[hit], len(own) * len(numbers))
                term, entries = key // max(len(numbers), 1), np.empty(len(key), _ENTRY)
                entries["g"], entries["n"] = numbers[key % max(len(numbers), 1)], total
                first = np.flatnonzero(np.append(True, np.diff(term) != 0)[: len(term)])
                names = pa.array(own, pa.binary()).take(pa.array(term[first]))
                lists = _lists(entries, np.diff(np.append(first, len(term))))
                arrays = [pa.repeat(pa.scalar(lang, pa.string()), len(first)), names, lists]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "term", "entries"])

    columns = blocks.select("lang", "groups", "source", "size", "terms", "at", "n")
    return columns.mapInArrow(run, "lang string, term binary, entries binary")


def _merged(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, term, x): one row per kept term; x: array of (g, n) of the groups that have it.

    Kept terms come along as entries that count nothing. A term's rows meet in order and
    are added up as they come, so none of them waits for all others.
    """
    mark = np.array([(0, 0)], _ENTRY).tobytes()
    marks = kept.select("lang", F.col("prefix").alias("term"), F.lit(mark).alias("entries"))
    rows = counts.unionByName(marks).repartition("lang", "term").sortWithinPartitions("lang", "term")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the last term may go on in the next batch

        def reduced(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
            """First row, place and entries of each term."""
            lists = batch.column(2)
            offsets = np.frombuffer(lists.buffers()[1], "<i4")[lists.offset :][: len(lists) + 1]
            entries = np.frombuffer(lists.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(_ENTRY)
            change = np.zeros(batch.num_rows, bool)
            for c in (0, 1):
                column = batch.column(c)
                change[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            term = np.cumsum(change)
            size = np.diff(offsets) // _ENTRY.itemsize
            first = np.flatnonzero(np.append(True, change[1:])[: batch.num_rows])
            return (batch.take(pa.array(first)), *_summed(np.repeat(term, size), entries))

        def out(named: pa.RecordBatch, term: np.ndarray, entries: np.ndarray) -> pa.RecordBatch:
            size = np.bincount(term, minlength=named.num_rows)
            chosen = np.bincount(term[entries["n"] == 0], minlength=named.num_rows) > 0
            own = np.repeat(chosen, size) & (entries["n"] > 0)
            offsets = np.append(0, np.cumsum((size - 1)[chosen])).astype(np.int32)
            values = [pa.array(np.ascontiguousarray(entries[c][own])) for c in ("g", "n")]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(values, ["g", "n"]))
            mask = pa.array(chosen)
            arrays = [named.column(0).filter(mask), named.column(1).filter(mask), lists]
            return pa.RecordBatch.from_arrays(arrays, names=["lang", "term", "x"])

        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch if last is None else pa.concat_batches([last, batch])
            named, term, entries = reduced(batch)
            cut = int(np.searchsorted(term, named.num_rows - 1))
            end = named.slice(named.num_rows - 1)
            tail = [end.column(0), end.column(1), _lists(entries[cut:], np.array([len(entries) - cut]))]
            last = pa.RecordBatch.from_arrays(tail, schema=batch.schema)
            if cut:
                yield out(named.slice(0, named.num_rows - 1), term[:cut], entries[:cut])
        if last is not None:
            yield out(*reduced(last))

    return rows.mapInArrow(run, "lang string, term binary, x array<struct<g: long, n: long>>")


def _p(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / total), exactly."""
    whole = (count + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return 1 + F.call_function("div", whole, total.cast("decimal(19,0)"))


def _gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); values reach 10^9, their squares fit a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def _scaled(n: np.ndarray, d: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * n / d), exactly for n <= d < 9 * 10^15: three digits at a time."""
    whole, rest = np.divmod(n, d)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, d)
        whole = whole * 1000 + digits
    return 1 + whole


class _Numbers:
    """By group: N + V of its own and of its language, and p of terms it hasn't."""

    def __init__(self, groups: DataFrame):
        columns = groups.select("number", "own", "whole", "base").toPandas().sort_values("number")
        self.number, self.own, self.whole, self.base = (
            columns[c].to_numpy(np.int64) for c in ("number", "own", "whole", "base")
        )

    def of(self, batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """size of each term's list, and group (its place among all), count, p of each entry."""
        lists = batch.column("x")
        size = np.diff(lists.offsets.to_numpy())
        entries = lists.flatten()
        group, n = np.searchsorted(self.number, entries.field("g").to_numpy()), entries.field("n").to_numpy()
        return size, group, n, _scaled(n + 1, self.own[group])


def _shared(table: DataFrame, numbers: Callable[[], _Numbers]) -> DataFrame:
    """(a, b, more): what the terms that two groups share add to their closed sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers()
        groups = len(known.own)
        keys, values, waiting = [], [], 0
        whole = np.zeros(groups**2 if groups**2 <= _PAIRS else 0, np.int64)

        def summed() -> tuple[np.ndarray, np.ndarray]:
            key, at = np.unique(np.concatenate([*keys, np.zeros(0, np.int64)]), return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, at, np.concatenate([*values, np.zeros(0, np.int64)]))
            return key, total

        def out(key: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
            arrays = [pa.array(known.number[key // groups]), pa.array(known.number[key % groups]), pa.array(total)]
            return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "more"])

        for batch in batches:
            size, group, _, p = known.of(batch)
            start = np.cumsum(size) - size
            for m in np.unique(size[size > 1]).tolist():
                rows = start[size == m]
                step, part = max(1, _PAIRS // m**2), max(1, _PAIRS // m)
                for i in range(0, len(rows), step):
                    at = rows[i : i + step, None] + np.arange(m)
                    g, y = group[at], p[at]
                    base = known.base[g]
                    for j in range(0, m, part):
                        s = (slice(None), slice(j, j + part), None)
                        here, none = y[s], base[s]
                        y2, base2 = y[:, None, :], base[:, None, :]
                        more = (here - y2) ** 2 // y2 - (here - base2) ** 2 // base2
                        more += (none - base2) ** 2 // base2 - (none - y2) ** 2 // y2
                        key = (g[s] * groups + g[:, None, :]).ravel()
                        if len(whole):
                            np.add.at(whole, key, more.ravel())
                            continue
                        keys.append(key)
                        values.append(more.ravel())
                        waiting += more.size
                        if waiting > _PAIRS:
                            key, total = summed()
                            keys, values, waiting = [key], [total], len(key)
                            if waiting > _PAIRS // 2:
                                yield out(key, total)
                                keys, values, waiting = [], [], 0
        if len(whole):
            key = np.flatnonzero(whole)
            yield out(key, whole[key])
        yield out(*summed())

    parts = table.select("x").mapInArrow(run, "a long, b long, more long")
    return parts.where("a <> b").groupBy("a", "b").agg(F.sum("more").alias("more"))


def _above(table: DataFrame, numbers: Callable[[], _Numbers], ranks: int) -> DataFrame:
    """(g, item, value) of the terms that a group has more often than its language.

    Of each batch only what may be among a group's first ``ranks`` is sent on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers()
        for batch in batches:
            size, group, n, p = known.of(batch)
            if not len(n):
                continue
            start = np.cumsum(size) - size
            q = _scaled(np.add.reduceat(n, start) + 1, known.whole[group[start]])
            term, q = np.repeat(np.arange(len(size)), size), np.repeat(q, size)
            value = (p - q) ** 2 // q
            at = np.flatnonzero(p > q)
            at = at[np.lexsort((-value[at], group[at]))]
            first = np.flatnonzero(np.append(True, np.diff(group[at]) != 0)[: len(at)])
            length = np.diff(np.append(first, len(at)))
            last = value[at[first + np.minimum(length, ranks) - 1]]
            at = at[value[at] >= np.repeat(last, length)]
            arrays = [pa.array(known.number[group[at]]), batch.column("term").take(pa.array(term[at])), pa.array(value[at])]
            yield pa.RecordBatch.from_arrays(arrays, names=["g", "item", "value"])

    return table.select("term", "x").mapInArrow(run, "g long, item binary, value long")


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    documents: int = DOCUMENTS,
    ranks: int = RANKS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): per group of a language and source how far it
    is from each other source of the language (part ``pair``), and which terms it has more
    often than its language (part ``term``, ``ranks`` at most).

    Terms are runs of letters A-Z, lower-cased, and of characters beyond ASCII. A
    language keeps the terms in at least ``documents`` of its rows. A group gives
    each kept term p = 1 + floor(10^9 (count + 1) / (N + V)); the value of a term
    is floor((p - q)^2 / q) against the other side's q, a pair's value the sum over
    all V kept terms, 0 if there are none. NULL text, language and source count as
    empty; repeated rows count as often as they occur. An empty table has no rows,
    a language with one source no pairs. Other columns are not read. All numbers
    are whole and exact.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    own = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    blocks = store(_blocks(own), "divergence-blocks")
    kept = store(kept_terms(blocks, documents), "divergence-kept")
    names = store(blocks.select("lang", F.explode("sources").alias("source")).distinct(), "divergence-groups")
    known, seed = names.count(), 0
    if known > MOST_GROUPS:
        raise ValueError(f"{known} groups of language and source; their pairs are too many to write")
    while True:  # a group's number is a hash; with this seed all are distinct, and none is 0
        groups = names.withColumn("number", _group(F.col("lang"), F.col("source"), seed))
        if groups.where("number <> 0").select("number").distinct().count() == known:
            break
        seed += 1

    of_group = blocks.withColumn("groups", F.transform("sources", lambda x: _group(F.col("lang"), x, seed)))
    table = store(_merged(_counts(of_group, kept), kept), "divergence-terms-of-groups")

    often = table.select(F.explode("x").alias("x")).groupBy("x.g", "x.n").agg(F.count("*").alias("times"))
    often = store(often, "divergence-often")
    totals = often.groupBy(F.col("g").alias("number")).agg(
        F.sum(F.col("n") * F.col("times")).alias("total"), F.sum("times").alias("types")
    )
    sizes = table.groupBy("lang").agg(F.count("*").alias("v"))
    groups = groups.join(totals, "number", "left").join(sizes, "lang", "left").na.fill(0, ["total", "types", "v"])
    whole = groups.groupBy("lang").agg((F.sum("total") + F.max("v")).alias("whole"))
    groups = groups.join(whole, "lang").withColumn("own", F.col("total") + F.col("v"))
    base = F.when(F.col("v") > 0, _p(F.lit(0).cast("long"), F.col("own"))).otherwise(1)
    groups = store(groups.withColumn("base", base), "divergence-numbers")
    shared = docs.sparkSession.sparkContext.broadcast(_Numbers(groups))

    order = Window.partitionBy("g").orderBy(F.col("value").desc(), "item")
    top = _above(table, lambda: shared.value, ranks)
    top = top.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    top = top.join(groups.select(F.col("number").alias("g"), "lang", "source"), "g")

    one = groups.select(
        "lang", "source", F.col("number").alias("a"), F.col("base").alias("p"), F.col("types").alias("n"), "v"
    )
    two = groups.select(
        "lang", F.col("source").alias("item"), F.col("number").alias("b"), F.col("base").alias("q"), F.col("types").alias("m")
    )
    # one row per pair and distinct count: what a's terms give where b has none, and the other way
    held = often.join(groups.select(F.col("number").alias("g"), "lang", "own"), "g")
    held = held.select("lang", F.col("g").alias("a"), _p(F.col("n"), F.col("own")).alias("x"), "times")
    closed = held.join(two.select("lang", "b", "q"), "lang").where("a <> b").groupBy("a", "b").agg(
        F.sum(F.col("times") * _gap(F.col("x"), F.col("q"))).alias("here"),
        F.sum(F.col("times") * _gap(F.col("q"), F.col("x"))).alias("there"),
    )
    back = closed.select(F.col("a").alias("b"), F.col("b").alias("a"), "there")
    pairs = one.join(two, "lang").where("a <> b").join(closed.select("a", "b", "here"), ["a", "b"], "left")
    pairs = pairs.join(back, ["a", "b"], "left").join(_shared(table, lambda: shared.value), ["a", "b"], "left")
    pairs = pairs.na.fill(0, ["here", "there", "more"])
    neither = (F.col("v") - F.col("n") - F.col("m")) * _gap(F.col("p"), F.col("q"))
    value = F.when(F.col("v") > 0, F.col("here") + F.col("there") + F.col("more") + neither).otherwise(0)
    pairs = pairs.select("lang", "source", "item", value.alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    columns = ["lang", "source", "part", "item", "value", "rank"]
    first = pairs.withColumn("part", F.lit("pair")).select(*columns)
    second = top.withColumns({"part": F.lit("term"), "item": F.col("item").cast("string")}).select(*columns)
    return first.unionByName(second)


#: The same in DuckDB's SQL, term by term.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), t AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT g.lang, g.source, coalesce(sum(n), 0) AS total, coalesce(any_value(v), 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN counts c USING (lang, source)
    LEFT JOIN (SELECT lang, count(*) AS v FROM kept GROUP BY lang) USING (lang)
  GROUP BY g.lang, g.source
), own AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
    (1 + 1000000000::HUGEINT * (coalesce(n, 0) + 1) // (total + v))::HUGEINT AS p
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
), lang_totals AS (
  SELECT lang, sum(total) AS total, any_value(v) AS v FROM groups GROUP BY lang
), whole AS (
  SELECT lang, term, (1 + 1000000000::HUGEINT * (sum(n) + 1) // any_value(total + v))::HUGEINT AS q
  FROM counts JOIN lang_totals USING (lang) GROUP BY lang, term
), pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN own x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN own y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
), term AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value
  FROM own JOIN whole USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL SELECT lang, source, 'term', item, value FROM term
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM ranked
)
SELECT lang, source, part, item, value::BIGINT AS value, rank FROM numbered WHERE part = 'pair' OR rank <= 200
"""
