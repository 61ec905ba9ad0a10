"""Mixing sources to target weights by a curriculum that changes over the training.

Each source has a weight schedule over training time 0 to 1. Its integral is the
source's weight in the whole mix: the weights share the words to be taken, no
source gives more than ``most_passes`` times what it has, and what is above that
goes to the others by weight. A source's cumulative demand at time t is its
target times the integral of its schedule up to t, so the document that begins at
word u of the source's demand is trained at the time where the demand reaches u:
the integral, inverted. Documents range-sorted by that time are the mix.

Within a source documents follow a hash of id and size, so neither file order nor
the number of tasks plays a part. Their places are running totals over 256-way
prefixes of the hash: no task sums up a source, only its children of one prefix.
Rows alike in source, id and size are one row with a count until the places are
known, so copies are no hot key either.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import NOT_SPACE, numbered, store, text_of

#: Items that one prefix of the hash holds on average at most, and rows alike kept in one item.
LEAF, ALIKE = 1024, 1 << 16
#: Sources in one task while they are numbered; rows and bytes of names up to which their table is broadcast.
PER_TASK, BROADCAST, BROADCAST_BYTES = 100_000, 100_000, 4 << 20


@dataclass(frozen=True)
class Schedule:
    """Piecewise linear weight: (time, weight) from time 0 to time 1."""

    knots: tuple[tuple[float, float], ...]

    def segments(self) -> list[tuple[float, float, float, float]]:
        """(start, weight there, slope, integral up to there) of each segment."""
        out, area = [], 0.0
        for (t0, w0), (t1, w1) in zip(self.knots, self.knots[1:], strict=False):
            out.append((t0, w0, (w1 - w0) / (t1 - t0), area))
            area += (w0 + w1) * (t1 - t0) / 2
        return out

    def weight(self) -> float:
        """The integral over the whole training."""
        return sum((w0 + w1) * (t1 - t0) / 2 for (t0, w0), (t1, w1) in zip(self.knots, self.knots[1:], strict=False))

    def time_of(self, share: Column) -> Column:
        """The time by which ``share`` (0 to 1) of the integral is reached."""
        area, out = share * F.lit(self.weight()), None
        for t0, w0, slope, before in self.segments():
            part = area - F.lit(before)
            root = F.sqrt(F.lit(w0 * w0) + F.lit(2 * slope) * part)
            time = F.when(part <= 0, F.lit(t0)).otherwise(F.lit(t0) + F.lit(2.0) * part / (F.lit(w0) + root))
            out = time if out is None else F.when(area >= F.lit(before), time).otherwise(out)
        return out


#: Steady, rising and falling: integrals 1, 2 and 3.
SCHEDULES = (
    Schedule(((0.0, 1.0), (1.0, 1.0))),
    Schedule(((0.0, 1.0), (1.0, 3.0))),
    Schedule(((0.0, 4.5), (1.0, 1.5))),
)


def words_in(text_col: str) -> Column:
    return F.regexp_count(text_of(text_col), F.lit(f"{NOT_SPACE}+")).cast("long")


def targets(sources: DataFrame, schedules: Sequence[Schedule], total: int | None, most_passes: int) -> DataFrame:
    """``sources`` (source, source_size, ...) with kind, weight, target and limit (whole words).

    Round by round the sources that are above ``most_passes`` times their size are
    held there and the rest is shared anew; a round is one aggregation, and the
    set of those held only grows.
    """
    ranked = numbered(sources, "source", per_task=PER_TASK).withColumn("kind", (F.col("number") % len(schedules)).cast("int"))
    weights = F.array(*[F.lit(s.weight()) for s in schedules])
    weighed = store(ranked.withColumn("weight", F.get(weights, F.col("kind"))), "mix-sources")
    sums = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    free, weight = total if total is not None else sums[0] or 0, sums[1] or 0.0
    whole, held = free, 0
    most = F.col("source_size") * most_passes

    def above(free: int, weight: float) -> Column:
        return F.col("weight") * F.lit(float(free)) > most * F.lit(weight)

    while weight > 0:
        now = weighed.agg(
            F.count_if(above(free, weight)),
            F.coalesce(F.sum(F.when(above(free, weight), most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above(free, weight), F.col("weight"))), F.lit(0.0)),
        ).first()
        if now[0] == held:
            break
        held, free, weight = now[0], whole - now[1], now[2]
    if weight > 0:
        share = F.col("weight") * F.lit(float(free)) / F.lit(weight)
        target = F.when(above(free, weight), most.cast("double")).otherwise(share)
    else:
        target = most.cast("double")
    return weighed.withColumn("target", target).withColumn("limit", F.floor(F.col("target") + 0.5))


def _with_sources(items: DataFrame, sources: DataFrame, rows: int, size: int) -> DataFrame:
    """Each item with its source's row; the table is broadcast if it is known to be small."""
    if rows <= BROADCAST and size <= BROADCAST_BYTES:
        return items.join(F.broadcast(sources), "_key")
    return items.join(sources, "_key")


def _running(items: DataFrame, levels: int) -> DataFrame:
    """``items`` (_key, hash, words, ...) with ``before``: the words before it in its source."""

    def prefix(level: int) -> Column:
        return F.substring("hash", 1, 2 * level)

    leaf = items.withColumn("_p", prefix(levels))
    within = Window.partitionBy("_key", "_p").orderBy("hash", "id").rowsBetween(Window.unboundedPreceding, -1)
    out = leaf.withColumn("before", F.coalesce(F.sum("words").over(within), F.lit(0)))
    if not levels:
        return out.drop("_p")
    sums = leaf.groupBy("_key", "_p").agg(F.sum("words").alias("words"))
    start = None
    for level in range(1, levels + 1):
        own = sums.groupBy("_key", F.substring("_p", 1, 2 * level).alias("_p")).agg(F.sum("words").alias("words"))
        own = own.withColumn("_up", F.substring("_p", 1, 2 * (level - 1)))
        within = Window.partitionBy("_key", "_up").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
        own = own.withColumn("start", F.coalesce(F.sum("words").over(within), F.lit(0)))
        if start is not None:
            up = start.select("_key", F.col("_p").alias("_up"), F.col("start").alias("_more"))
            own = own.join(up, ["_key", "_up"]).withColumn("start", F.col("start") + F.col("_more"))
        start = own.select("_key", "_p", "start")
    return out.join(start, ["_key", "_p"]).withColumn("before", F.col("before") + F.col("start")).drop("_p", "start")


def mix(
    docs: DataFrame,
    schedules: Sequence[Schedule] = SCHEDULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    total: int | None = None,
    most_passes: int = 3,
) -> DataFrame:
    """One row per row of ``docs``, range-sorted by first position: the id, source, size,
    source_size, target, taken, position, positions (one for each pass that takes some of it,
    times from 0 to 1) and copy (a number that tells rows alike in source, id and size apart).

    Sizes are words. Sources are numbered by code point, NULL last, and take the
    ``schedules`` in turn; ``total`` words are shared (as many as there are, if None).
    A source gives whole passes over its documents and the first of them in hash
    order once more; the document where its demand ends is taken up to that word,
    so a source's taken words are its target, rounded. ``taken`` is at most
    ``most_passes`` times the size. A document without words is taken 0 times and
    has no position: those come last. NULL texts are empty, NULL ids and sources
    are values like any other. Repeated rows are documents of their own. Other
    columns are not read. The same rows give the same mix, however they are dealt.
    """
    source = F.col(source_col)
    sizes = docs.select(
        F.col(id_col).alias("id"), source.alias("source"), words_in(text_col).alias("size")
    )
    alike = sizes.groupBy("id", "source", "size").agg(F.count("*").alias("_n"))
    alike = alike.withColumn("_chunk", F.explode(F.sequence(F.lit(0), ((F.col("_n") - 1) / ALIKE).cast("int"))))
    alike = alike.withColumn("_n", F.least(F.lit(ALIKE), F.col("_n") - F.col("_chunk") * ALIKE))
    name = F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("-")), "size", "_chunk")
    items = store(
        alike.withColumns(
            {
                "hash": F.md5(name),
                "words": F.col("size") * F.col("_n"),
                "_key": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")),
            }
        ),
        "mix-items",
    )
    sums = items.groupBy("_key", "source").agg(
        F.sum("words").alias("source_size"), F.count("*").alias("_items")
    )
    sources = store(targets(store(sums, "mix-sums"), schedules, total, most_passes), "mix-targets")
    rows, size, most = sources.agg(F.count("*"), F.sum(F.octet_length("_key")), F.max("_items")).first()
    levels = max(0, math.ceil(math.log((most or 1) / LEAF, 256)))
    placed = _with_sources(
        _running(items, levels).drop("source"),
        sources.select("_key", "source", "source_size", "target", "limit", "kind"),
        rows,
        size or 0,
    )
    each = placed.withColumn("_i", F.explode(F.sequence(F.lit(0), (F.col("_n") - 1).cast("int"))))
    # the source's words are a circle that the demand goes round ``limit`` words far
    each = each.withColumn("before", F.col("before") + F.col("_i") * F.col("size"))
    circle = F.greatest(F.col("source_size"), F.lit(1))
    full = F.floor(F.col("limit") / circle).cast("long")
    full = full - F.when(full * circle > F.col("limit"), 1).otherwise(0)
    rest = F.col("limit") - full * circle
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    passes = F.when(F.col("size") > 0, full + F.when(part > 0, 1).otherwise(0)).otherwise(0).cast("int")
    each = each.withColumns({"taken": full * F.col("size") + part, "_passes": passes})

    def time(i: Column) -> Column:
        share = (i * F.col("source_size") + F.col("before")).cast("double") / F.greatest(F.col("limit"), F.lit(1))
        out = None
        for kind, schedule in enumerate(schedules):
            at = schedule.time_of(share)
            out = at if out is None else F.when(F.col("kind") == kind, at).otherwise(out)
        return out

    turns = F.filter(F.sequence(F.lit(0), F.lit(most_passes)), lambda i: i < F.col("_passes"))
    each = each.withColumn("positions", F.transform(turns, lambda i: time(i)))
    each = each.withColumn("position", F.get("positions", F.lit(0)))
    each = each.withColumn("copy", F.col("_chunk").cast("long") * ALIKE + F.col("_i"))
    ordered = each.orderBy(F.col("position").asc_nulls_last(), "hash", "_key", "copy")
    return ordered.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        F.col("taken").cast("long").alias("taken"), "position", "positions", "copy",
    )


def curriculum(
    docs: DataFrame,
    schedules: Sequence[Schedule] = SCHEDULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    total: int | None = None,
    most_passes: int = 3,
) -> DataFrame:
    """The mix itself: ``doc`` (all columns of ``docs``), pass, words and position, one row for
    each pass that takes some of a document, range-sorted by position.

    ``words`` is the document's size but for the one where its source's demand ends.
    """
    alike = ["_id", "_source", "_size"]
    packed = docs.select(
        F.struct(*docs.columns).alias("doc"), F.col(id_col).alias("_id"), F.col(source_col).alias("_source"),
        words_in(text_col).alias("_size"), F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = store(packed, "mix-rows")
    # the copy's number: of the tasks before, then within the task, so that copies are no hot key
    parts = rows.groupBy(*alike, "_part").count()
    up = Window.partitionBy(*alike).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_start", F.coalesce(F.sum("count").over(up), F.lit(0))).drop("count")
    within = Window.partitionBy(*alike, "_part").orderBy("_row")
    numbers = rows.select("_row", "_part", *alike).withColumn("_i", F.row_number().over(within) - 1)
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"p.{c}")) for c in [*alike, "_part"]]
    numbers = numbers.alias("n").join(parts.alias("p"), same).select(
        "n._row", *[f"n.{c}" for c in alike], (F.col("_i") + F.col("_start")).alias("copy")
    )
    plan = mix(docs, schedules, id_col, text_col, source_col, total, most_passes)
    plan = plan.where("taken > 0").select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.col("size").alias("_size"),
        "copy", "taken", "positions",
    )
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"m.{c}")) for c in [*alike, "copy"]]
    taken = numbers.alias("n").join(plan.alias("m"), same).select("_row", "m._size", "taken", "positions")
    each = taken.select("_row", "_size", "taken", F.posexplode("positions").alias("pass", "position"))
    words = F.least(F.col("_size"), F.col("taken") - F.col("pass") * F.col("_size"))
    each = each.select("_row", "pass", words.alias("words"), "position")
    return rows.select("_row", "doc").join(each, "_row").orderBy("position", "_row").select(
        "doc", "pass", "words", "position"
    )


#: The rows of ``mix`` in DuckDB's SQL, without the arrays.
SQL = r"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
), items AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, source, size) - 1 AS copy FROM rows
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS number, 1 + (number - 1) % 3 AS weight
  FROM rows GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / weight, number) AS place,
    coalesce(sum(3 * source_size) OVER (ORDER BY 3.0 * source_size / weight, number
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
    sum(weight) OVER (ORDER BY 3.0 * source_size / weight DESC, number DESC) AS others,
    sum(source_size) OVER () AS whole
  FROM sums
), cut AS (
  SELECT (whole - held)::DOUBLE AS free, others::DOUBLE AS others FROM ranked
  WHERE weight * (whole - held) <= 3 * source_size * others ORDER BY place LIMIT 1
), targets AS (
  SELECT source, source_size, weight, CASE WHEN weight * c.free > 3 * source_size * c.others
    THEN (3 * source_size)::DOUBLE ELSE weight::DOUBLE * c.free / c.others END AS target
  FROM sums, cut c
), placed AS (
  SELECT i.*, t.source_size, t.weight, t.target, floor(t.target + 0.5)::BIGINT AS top,
    md5(concat(coalesce(doc_id::VARCHAR, '-'), ':', size, ':', copy // 65536)) AS h,
    coalesce(sum(size) OVER (PARTITION BY i.source ORDER BY
      md5(concat(coalesce(doc_id::VARCHAR, '-'), ':', size, ':', copy // 65536)), copy
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM items i JOIN targets t ON i.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, top // greatest(source_size, 1) * size
    + greatest(0, least(size, top % greatest(source_size, 1) - before)) AS taken
  FROM placed
), timed AS (
  SELECT *, before::DOUBLE / top * weight AS area FROM taken
)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
  CASE WHEN taken = 0 THEN NULL WHEN area <= 0 THEN 0.0
    WHEN weight = 1 THEN 2.0 * area / (1.0 + sqrt(1.0))
    WHEN weight = 2 THEN 2.0 * area / (1.0 + sqrt(1.0 + 4.0 * area))
    ELSE 2.0 * area / (4.5 + sqrt(20.25 - 6.0 * area)) END AS position
FROM timed
"""
