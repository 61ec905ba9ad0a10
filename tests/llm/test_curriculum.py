import math
import random
from collections import Counter, defaultdict

import duckdb
import pytest
from orderloom.llm import curriculum, queries
from pyspark.sql import functions as F


def brute_targets(sizes, weights, most=3):
    """Share, hold those above, share the rest anew."""
    total, held = sum(sizes.values()), {}
    while True:
        free = total - sum(held.values())
        weight = sum(w for s, w in weights.items() if s not in held)
        share = {s: weights[s] * free / weight for s in sizes if s not in held}
        above = {s: most * sizes[s] for s in share if share[s] > most * sizes[s]}
        if not above:
            return share | held
        held |= above


def test_targets_are_met_and_nothing_is_taken_too_often(docs, doc_rows):
    got = curriculum.mix(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in doc_rows)
    sizes = defaultdict(int)
    for r in doc_rows:
        sizes[r[3]] += len((r[1] or "").encode().split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: 1 + i % 3 for i, s in enumerate(names)}
    want, taken = brute_targets(dict(sizes), weights), defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        assert len(r.positions) == (math.ceil(r.taken / r.size) if r.size else 0)
        assert r.positions == sorted(r.positions) and all(0 <= p <= 1 for p in r.positions)
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
    order = [r.position for r in got]
    placed = [p for p in order if p is not None]
    assert placed == sorted(placed) == order[: len(placed)]


def test_small_sources_are_held_at_three_passes(spark):
    rows = [(i, "w " * 10, "big") for i in range(500)] + [(1000 + i, "w " * 5, f"s{i:02}") for i in range(40)]
    got = curriculum.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += len(r[1].split())
    weights = {s: 1 + i % 3 for i, s in enumerate(sorted(sizes))}
    want = brute_targets(sizes, weights)
    assert all(r.target == pytest.approx(want[r.source]) for r in got)
    assert sum(r.taken == 15 for r in got) == 40 and sum(r.taken for r in got) == sum(sizes.values())


def test_position_is_where_the_demand_reaches_the_document(docs):
    """Integrated numerically, the schedule up to a position is the words taken before it."""
    got = curriculum.mix(docs.where("source is not null")).collect()
    names = sorted({r.source for r in got})
    for k, name in enumerate(names):
        knots = curriculum.SCHEDULES[k % 3].knots
        rows = [r for r in got if r.source == name and r.size]
        limit = round(rows[0].target)
        before = 0
        for position, words in sorted((p, min(r.size, r.taken - i * r.size)) for r in rows for i, p in enumerate(r.positions)):
            steps = 2000
            at = [(i + 0.5) / steps * position for i in range(steps)]
            area = sum(knots[0][1] + (knots[1][1] - knots[0][1]) * t for t in at) / steps * position
            assert area / curriculum.SCHEDULES[k % 3].weight() == pytest.approx(before / limit, abs=1e-3)
            before += words
        assert before == limit


def test_many_segments_invert(spark):
    schedule = curriculum.Schedule(((0, 2), (0.25, 0), (0.5, 0), (0.75, 4), (1, 1)))
    shares = [i / 50 for i in range(51)]
    df = spark.createDataFrame([(s,) for s in shares], "s double").select("s", schedule.time_of(F.col("s")).alias("t"))
    for s, t in df.collect():
        area = 0.0
        for t0, w0, slope, before in schedule.segments():
            if t >= t0:
                d = t - t0
                area = before + w0 * d + slope * d * d / 2
        assert area == pytest.approx(s * schedule.weight(), abs=1e-9)


def plain(rows):
    return Counter((r.doc_id, r.source, r.size, r.taken, r.position) for r in rows)


def test_deal_and_levels_dont_matter(docs, monkeypatch):
    want = plain(curriculum.mix(docs).collect())
    assert plain(curriculum.mix(docs.repartition(7, "n_chars")).collect()) == want
    monkeypatch.setattr(curriculum, "LEAF", 0.01)  # two levels of prefixes
    monkeypatch.setattr(curriculum, "PER_TASK", 2)  # sources numbered in several tasks
    monkeypatch.setattr(curriculum, "BROADCAST", 0)
    assert plain(curriculum.mix(docs).collect()) == want


def test_rows_alike_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(curriculum, "ALIKE", 10)
    rows = [(None, "a b c", None)] * 95 + [(1, "a b c", "x")] * 30 + [(i, "d e", "x") for i in range(40)]
    got = curriculum.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.taken <= 3 * r.size
    targets = {r.source: r.target for r in got}
    assert len(got) == len(rows) and all(abs(taken[s] - t) <= 0.5 for s, t in targets.items())
    assert sorted(r.copy for r in got if r.doc_id is None) == list(range(95))


def test_curriculum_rows(docs, doc_rows):
    plan = curriculum.mix(docs).collect()
    got = curriculum.curriculum(docs).collect()
    words = defaultdict(int)
    for r in got:
        assert r.doc.asDict().keys() == set(docs.columns)
        words[r.doc.doc_id, r.doc.source] += r.words
    want = defaultdict(int)
    for r in plan:
        if r.taken:
            want[r.doc_id, r.source] += r.taken
    assert words == want and len(got) == sum(len(r.positions) for r in plan)
    assert [r.position for r in got] == sorted(r.position for r in got)


def test_empty_tables(spark, no_docs):
    assert curriculum.mix(no_docs).count() == 0 and curriculum.curriculum(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert [(r.taken, r.target, r.position) for r in curriculum.mix(blank).collect()] == [(0, 0.0, None)] * 2


def test_query_is_the_sql(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(["a", "b", "c", "d", None, "tiny"])) for i in range(300)]
    rows = [r for i, r in enumerate(rows) if r[2] != "tiny" or i % 9 == 0] + [(5, "x", "a"), (5, "x", "a"), (None, "y", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    frame.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.queries()["op11_curriculum"](spark, str(tmp_path)).toPandas()
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = db.sql(curriculum.SQL).df()[list(got.columns)]
    key = list(got.columns)
    assert got.sort_values(key).round(9).fillna(-1).values.tolist() == want.sort_values(key).round(9).fillna(-1).values.tolist()
