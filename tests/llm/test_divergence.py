import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from orderloom.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, documents=3, ranks=200):
    """Every group against every other and its language, term by term."""
    per_doc, groups = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall(lower(text or ""))
        per_doc[lang or ""].update(set(found))
        groups[lang or "", source or ""].update(found)
    kept = {lang: {t for t, n in c.items() if n >= documents} for lang, c in per_doc.items()}

    def p_of(counts, lang):
        total = sum(n for t, n in counts.items() if t in kept[lang])
        return {t: 1 + 1_000_000_000 * (counts[t] + 1) // (total + len(kept[lang])) for t in kept[lang]}

    p = {g: p_of(c, g[0]) for g, c in groups.items()}
    out = []
    for (lang, source), own in p.items():
        whole = Counter()
        for (other, _), counts in groups.items():
            if other == lang:
                whole.update(counts)
        q = p_of(whole, lang)
        pair = [
            (s, sum((own[t] - b[t]) ** 2 // b[t] for t in own))
            for (other, s), b in p.items() if other == lang and s != source
        ]
        term = [(t, (own[t] - q[t]) ** 2 // q[t]) for t in own if groups[lang, source][t] and own[t] > q[t]]
        for part, items, most in (("pair", pair, None), ("term", term, ranks)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, t, v, i + 1) for i, (t, v) in enumerate(items[:most])]
    return Counter(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["".join(rng.choices("abé日", k=rng.randint(1, 5))) for _ in range(120)]
    words += ["prefix", "prefixed", "prefixes", "abcd", "abcdefgh", "abcdefghi", "x" * 300, "y" * 40_000, "Ünder_bar-x"]
    out = []
    for _ in range(300):
        source = rng.choice(["a", "b", "c", None, "", "d"])
        text = " ".join(rng.choices(words, k=rng.randint(0, 20)))
        out.append((text, rng.choice(["en", "de", None]), source))
    out += [(None, "en", "quiet"), ("", "none", "s"), ("once", "few", "s"), ("Twice twice twice", "few", "t")] + [out[0]] * 9
    return out


@pytest.mark.parametrize("documents, entries, pairs", [(3, 1 << 20, 1 << 20), (12, 50, 7)])
def test_against_brute_force(spark, rows, docs, monkeypatch, documents, entries, pairs):
    """Also with tables that fill up and pairs in several blocks."""
    monkeypatch.setattr(divergence, "_ENTRIES", entries)
    monkeypatch.setattr(divergence, "_WAITING", entries)
    monkeypatch.setattr(divergence, "_PAIRS", pairs)
    frame = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    got = divergence.audit(frame, documents=documents, ranks=20)
    assert Counter(map(tuple, got.collect())) == brute(rows, documents, 20)


def test_documents_with_other_columns(docs, doc_rows):
    got = divergence.audit(docs)
    assert Counter(map(tuple, got.collect())) == brute([(r[1], r[2], r[3]) for r in doc_rows])


def test_kept_terms_level_by_level(spark, rows, docs):
    frame = spark.createDataFrame(rows, "text string, lang string, source string").na.fill("")
    blocks = divergence._blocks(frame)
    want = set()
    for lang in {r[1] or "" for r in rows}:
        found = Counter(t for r in rows if (r[1] or "") == lang for t in set(TERM.findall(lower(r[0] or ""))))
        want |= {(lang, t.encode()) for t, n in found.items() if n >= 3}
    for first in (1, 4, 64):
        got = divergence.kept_terms(blocks, 3, first).collect()
        assert len(got) == len(want) and {(r[0], bytes(r[1])) for r in got} == want


def test_whole_numbers(spark):
    """Counts beyond 2^53 / 10^9 lose nothing."""
    from pyspark.sql import functions as F

    n, total = 3_333_333_333_333_333, 8_999_999_999_999_992
    got = spark.range(1).select(divergence._p(F.lit(n), F.lit(total + 7))).first()[0]
    want = 1 + 1_000_000_000 * (n + 1) // (total + 7)
    assert got == want
    assert divergence._scaled(np.array([n + 1]), np.array([total + 7])).tolist() == [want]


def test_empty_table(no_docs):
    assert divergence.audit(no_docs).count() == 0


@pytest.mark.parametrize("table", [0, 1 << 22])
def test_totals_by_key_are_the_same_from_a_table_and_sorted(monkeypatch, table):
    monkeypatch.setattr(divergence, "_TABLE", table)
    rng = np.random.default_rng(3)
    key, n = rng.integers(0, 50, 400), rng.integers(1, 2**31, 400)
    want = Counter()
    for k, v in zip(key.tolist(), n.tolist(), strict=True):
        want[k] += v
    found, total = divergence._by_key(key, n, 60)
    assert list(zip(found.tolist(), total.tolist(), strict=True)) == sorted(want.items())
    assert [len(x) for x in divergence._by_key(key[:0], n[:0], 60)] == [0, 0]
