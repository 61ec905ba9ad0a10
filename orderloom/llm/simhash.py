"""Near-duplicate detection by SimHash fingerprints and meet-in-the-middle ball hashing.

Every distinct fingerprint stands for all variants of itself within half the
radius. Two fingerprints at most 3 bits apart share a variant: one reaches it by
at most one flip, the other by at most two. Only pairs of different parity can
be 3 apart, so two flips are needed from fingerprints of even parity alone.

The shuffle key of a variant is its leading bits, so a fingerprint is sent once
to each prefix that its variants can have, and the variants with that prefix are
made there. That keeps the shuffle at tens of bytes a fingerprint where writing
each of its 1,100 variants would take ten thousand.

All fingerprints that share a variant z are linked through one of them that is
at most one flip from z. Those links are always true (1 + 2 <= 3), so no pair has
to be spelled out, and a dense group of m fingerprints yields O(m) links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from orderloom.llm.common import raw, store
from orderloom.llm.components import connected_components

#: Variants one group should hold, and the longest prefix.
VARIANTS_PER_GROUP = 1 << 19
MAX_PREFIX = 20


def fingerprint(text: bytes | None, words: int = 3, seed: int = 42) -> int:
    """SimHash over the XXH64 of all ``words``-word shingles, repeats included."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = iter((b" ".join(tokens),))
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 15):
        block = hashes[start : start + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3
) -> DataFrame:
    """(id, fp): one row per input row; fp is the fingerprint's 64 bits as a signed number."""
    schema = StructType([docs.schema[id_col], StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), words) for t in batch.column(1)]
            column = pa.array(np.array(fps, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), column], names=[id_col, "fp"])

    return docs.select(id_col, raw(text_col).alias("text")).mapInArrow(run, schema)


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of ``n`` positions over the links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(label, before):
            break
    return label


def links_of_prefix(fps: np.ndarray, prefix: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest member) among ``fps`` that share a variant with this prefix."""
    low_bits = 64 - bits
    low_mask = np.uint64((1 << low_bits) - 1)
    high = fps >> np.uint64(low_bits) if bits else np.zeros_like(fps)
    apart = np.bitwise_count(high ^ np.uint64(prefix))
    even = np.bitwise_count(fps) % 2 == 0
    low = fps & low_mask
    one = np.uint64(1) << np.arange(low_bits, dtype=np.uint64)
    first, second = np.triu_indices(low_bits, 1)
    two = one[first] | one[second]
    zero = np.zeros(1, np.uint64)

    def variants(chosen: np.ndarray, flips: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(chosen)
        return (low[at, None] ^ flips[None, :]).ravel(), np.repeat(at, len(flips))

    near = [
        variants(apart == 0, np.concatenate([zero, one])),
        variants(apart == 1, zero),
    ]
    keys, owner = (np.concatenate(x) for x in zip(*near, strict=True))
    if not len(keys):
        return fps[:0], fps[:0]
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    distinct = keys[starts]
    leader = np.repeat(owner[starts], np.diff(np.append(starts, len(keys))))
    a, b = [owner[owner != leader]], [leader[owner != leader]]
    far = [(apart == 0, two), (apart == 1, one), (apart == 2, zero)]
    for chosen, flips in far:
        at = np.flatnonzero(chosen & even)
        step = max(1, VARIANTS_PER_GROUP // len(flips))
        for i in range(0, len(at), step):
            some = (low[at[i : i + step], None] ^ flips[None, :]).ravel()
            place = np.minimum(np.searchsorted(distinct, some), len(distinct) - 1)
            hit = np.flatnonzero(distinct[place] == some)
            a.append(at[i + hit // len(flips)])
            b.append(owner[starts[place[hit]]])
    label = local_components(len(fps), np.concatenate(a), np.concatenate(b))
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return fps[linked], fps[label[linked]]


def prefix_bits(fingerprints: int) -> int:
    """Leading bits to shuffle on, so that a group makes a bounded number of variants."""
    wanted = fingerprints * 1073 / VARIANTS_PER_GROUP
    return min(MAX_PREFIX, max(0, math.ceil(math.log2(max(wanted, 1)))))


def links(fps: DataFrame, bits: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints at most 3 bits apart; enough to connect them."""
    masks = [0] + [1 << i for i in range(bits)]
    more = [(1 << i) | (1 << j) for i, j in combinations(range(bits), 2)]
    even = F.bit_count("fp") % 2 == 0
    prefix = F.shiftrightunsigned("fp", 64 - bits) if bits else F.lit(0).cast("long")

    def routes(flips: list[int]):
        return F.array(*[F.lit(x).cast("long") for x in flips])

    sent = fps.select(
        "fp", F.explode(F.when(even, routes(masks + more)).otherwise(routes(masks))).alias("m")
    ).select(prefix.bitwiseXOR(F.col("m")).alias("prefix"), "fp")

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        own = np.sort(group.column("fp").to_numpy().view(np.uint64))
        a, b = links_of_prefix(own, key[0].as_py(), bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return sent.groupBy("prefix").applyInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3
) -> DataFrame:
    """(id, fp, component_id): documents linked over fingerprints at most 3 bits apart.

    component_id is the smallest id reachable, the own one included. One row per
    input row. NULL and empty texts have fingerprint zero and are linked like any
    other; repeated rows have equal results; a NULL id is never a component id
    unless its whole component has none. Other columns of ``docs`` are not read.
    """
    rows = store(with_fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = store(rows.groupBy("fp").agg(F.min(id_col).alias("low_id")), "distinct")
    found = links(distinct.select("fp"), prefix_bits(distinct.count()))
    labels = connected_components(found).withColumnRenamed("node", "fp")
    roots = labels.select(F.col("component").alias("fp"), "component").distinct()
    member = distinct.join(labels.unionByName(roots), "fp", "left")
    member = member.withColumn("component", F.coalesce("component", "fp"))
    lowest = member.groupBy("component").agg(F.min("low_id").alias("component_id"))
    linked = member.join(lowest, "component").select("fp", "component_id")
    return rows.join(linked, "fp").select(id_col, "fp", "component_id")


def one_per_component(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3
) -> DataFrame:
    """The rows of ``docs`` that stand for their component: the smallest id of each.

    Of repeated rows with that id one stays. A component without any id keeps one
    of its rows.
    """
    packed = docs.select(
        F.struct(*docs.columns).alias("_doc"), F.monotonically_increasing_id().alias("_row")
    )
    rows = store(packed, "near-dedup")
    row_id, text = F.col("_doc").getField(id_col), F.col("_doc").getField(text_col)
    # a NULL id comes last, and equal ids are told apart by the row
    key = F.struct(row_id.isNull().alias("n"), row_id.alias("i"), F.col("_row").alias("r"))
    named = rows.select(key.alias("_key"), text.alias("_text"))
    found = near_duplicates(named, "_key", "_text", words)
    keep = found.where("_key.r = component_id.r").select(F.col("_key.r").alias("_row"))
    return rows.join(keep, "_row", "left_semi").select("_doc.*")
