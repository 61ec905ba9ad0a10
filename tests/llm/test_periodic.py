import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from orderloom.llm import periodic, queries


def brute_runs(w, least=6, periods=4):
    """Every maximal stretch whose smallest period is q, tried one by one."""
    out = []
    for q in range(1, len(w) // periods + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            start, length = i, j - i + q
            if length >= max(least, periods * q):
                part = w[start : start + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((start, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


@st.composite
def periodic_words(draw):
    """Repeats within repeats, in a small alphabet."""
    out = []
    for _ in range(draw(st.integers(1, 4))):
        block = draw(st.lists(st.integers(0, 2), min_size=1, max_size=5))
        out += block * draw(st.integers(1, 6))
        out = out * draw(st.integers(1, 5)) if len(out) < 60 else out
    return out


@settings(max_examples=400, deadline=None)
@given(periodic_words())
def test_runs_are_those_found_one_by_one(words):
    found = periodic.periodic_runs(np.array(words, np.int64))
    assert [tuple(r) for r in found.tolist()] == brute_runs(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=80))
def test_runs_of_two_words(words):
    found = periodic.periodic_runs(np.array(words, np.int64))
    assert [tuple(r) for r in found.tolist()] == brute_runs(words)


def test_frequent_words_and_very_long_texts_take_little_time():
    one = np.zeros(2_000_000, np.int64)
    assert periodic.periodic_runs(one).tolist() == [[0, 2_000_000, 1]]
    block = np.append(np.tile([0, 1], 500), 2)
    many = np.tile(block, 300)
    found = periodic.periodic_runs(many).tolist()
    assert [0, len(many), len(block)] in found and len(found) == 301


def test_pieces_give_the_same_words(monkeypatch):
    rng = random.Random(2)
    text = b"".join(rng.choice([b"a", b"bb", b" ", b"\n", b"  ", "é".encode()]) for _ in range(5000))
    text += b" x y" * 40
    whole = periodic.word_numbers(text)
    runs = periodic.periodic_runs(whole)
    short = periodic.collapsed(text, runs)
    monkeypatch.setattr(periodic, "PIECE", 50)
    assert [w for p in periodic.pieces(text) for w in p] == text.split()
    assert (periodic.word_numbers(text) == whole).all()
    assert periodic.collapsed(text, runs) == short
    assert short.decode() == brute_collapsed(text.decode().split(), runs.tolist())


def test_documents(spark, docs, doc_rows):
    more = [(900, "a b " * 50 + "c " * 9 + "tail", "en", "s", 1, "x", 1), (901, "z " * 5, "en", "s", 1, "x", 1)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    got = periodic.runs(docs).collect()
    want = []
    for r in [*doc_rows, *more]:
        w = split(r[1])
        runs = brute_runs(w) if len(w) < 5000 else []
        want.append((r[0], len(w), tuple(runs), brute_collapsed(w, runs)))
    assert Counter((r[0], r[1], tuple(map(tuple, r[2])), r[3]) for r in got) == Counter(want)


def test_empty_table_and_too_few_periods(no_docs):
    assert periodic.runs(no_docs).collect() == []
    with pytest.raises(ValueError):
        periodic.runs(no_docs, periods=3)


def brute_query(doc_id, text):
    words = split(text)
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, milli, sha(lines), sha(brute_collapsed(words, runs)))


def test_query(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=rng.randint(0, 120)))) for i in range(400)]
    rows += [(None, "a b c"), (None, None), (1000, None), (1001, ""), (1002, " \n "), (3, "x " * 9), (3, "x " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.queries()["op12_periodic_runs"](spark, str(tmp_path)).collect()
    want = Counter(brute_query(*r) for r in rows)
    assert Counter(map(tuple, got)) == want and sum(r[1] > 0 for r in want) > 10
