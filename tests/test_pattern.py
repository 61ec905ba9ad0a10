import random

import pytest
from conftest import at, event, placed, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orderloom import schemas
from orderloom.operators import pattern

KINDS = {
    "P": ("LINE_ITEM_STATUS_CHANGED", "PLACED", "QDCA10"),
    "I": ("LINE_ITEM_STATUS_CHANGED", "IN_PROGRESS", "QDCA10"),
    "F": ("LINE_ITEM_STATUS_CHANGED", "FULFILLED", "QDCA10"),
    "C": ("ORDER_CANCELLED", "CANCELLED", None),
    "p": ("LINE_ITEM_STATUS_CHANGED", "PLACED", "QDCA10PRO"),
    "i": ("LINE_ITEM_STATUS_CHANGED", "IN_PROGRESS", "QDCA10PRO"),
    "f": ("LINE_ITEM_STATUS_CHANGED", "FULFILLED", "QDCA10PRO"),
    "O": ("ORDER_PLACED", "PLACED", "QDCA10"),
}


def sequence(text, item_id="i1", times=None):
    out = []
    for n, c in enumerate(text):
        kind, status, line = KINDS[c]
        ts = times[n] if times else 10 * n
        out.append(event(kind=kind, status=status, line=line, item_id=item_id, ts=ts))
    return out


def greedy(text, times):
    """Skip-past-last matching by hand: (start time, end time, line)."""
    found, i = [], 0
    while i < len(text):
        for p, mid, f in (("P", "I", "F"), ("p", "i", "f")):
            if text[i] == p:
                tail = text[i + 1 :]
                length = 1 if tail[:1] == f else 2 if tail[:2] == mid + f else 0
                if length:
                    line = "QDCA10" if p == "P" else "QDCA10PRO"
                    found.append((at(times[i]), at(times[i + length]), line))
                    i += length
        i += 1
    return found


def matches(spark, events, **options):
    df = spark.createDataFrame(events, schemas.ORDER_EVENT)
    return pattern.lead_times(df, **options)


@pytest.mark.parametrize("size", [None, "15 seconds", "10 minutes"])
@pytest.mark.parametrize(
    "text,count",
    [
        ("PF", 1),
        ("PIF", 1),
        ("PIIF", 0),
        ("PPF", 1),
        ("PCF", 0),
        ("IF", 0),
        ("P", 0),
        ("PFPF", 2),
        ("Pf", 0),
        ("PpF", 0),
        ("PiF", 0),
        ("OF", 0),
        ("pif", 1),
    ],
)
def test_cases(spark, text, count, size):
    assert matches(spark, sequence(text), slice_size=size).count() == count


def test_measures(spark):
    got = rows(matches(spark, sequence("PIF", times=[0, 1, 61.9])))
    assert got == [("i1", "o1", "X", at(0), at(61.9), 61, "QDCA10")]


def test_equal_times_follow_the_life_cycle(spark):
    assert matches(spark, sequence("FIP", times=[5, 5, 5])).count() == 1


def test_lines_can_be_chosen_and_null_ids_form_one_group(spark):
    events = sequence("PF", item_id=None) + sequence("pf", item_id="i2")
    both = matches(spark, events)
    assert sorted(rows(both.select("item_id", "assembly_line")), key=str) == [
        ("i2", "QDCA10PRO"),
        (None, "QDCA10"),
    ]
    assert matches(spark, events, lines=("QDCA10",)).count() == 1


def test_enriched_starts_with_order_placed(spark):
    df = spark.createDataFrame([placed(ts=0), event(ts=60)], schemas.ORDER_EVENT)
    assert pattern.lead_times(df).count() == 0
    assert pattern.lead_times_enriched(df).first()["lead_time_seconds"] == 60


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    texts=st.lists(st.text(alphabet="PPIFFCpif", min_size=1, max_size=12), min_size=5, max_size=30),
    seed=st.integers(0, 999),
)
def test_sliced_look_ahead_equals_greedy_matching(spark, texts, seed):
    rng = random.Random(seed)
    events, want = [], []
    for n, text in enumerate(texts):
        times = sorted(rng.sample(range(200), len(text)))
        events += sequence(text, item_id=f"i{n}", times=times)
        want += [(f"i{n}", *m) for m in greedy(text, times)]
    columns = ["item_id", "placed_at", "fulfilled_at", "assembly_line"]
    for size in ("7 seconds", "40 seconds"):
        got = matches(spark, events, slice_size=size).select(*columns)
        assert sorted(rows(got)) == sorted(want)


def test_one_item_with_many_rows_over_many_slices(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("PPIFFC") for _ in range(4000))
    times = sorted(rng.sample(range(100000), len(text)))
    got = matches(spark, sequence(text, item_id=None, times=times), slice_size="60 seconds")
    want = greedy(text, times)
    assert sorted(rows(got.select("placed_at", "fulfilled_at", "assembly_line"))) == sorted(want)


@pytest.mark.parametrize("size", [None, "10 minutes", "1 hour"])
def test_rows_without_a_time_are_dropped_at_any_slice_size(spark, size):
    start = event(status="PLACED", ts=0)
    timeless = (*start[:3], None, *start[4:])
    events = spark.createDataFrame([timeless, event(ts=60)], schemas.ORDER_EVENT)
    assert pattern.lead_times(events, slice_size=size).count() == 0
