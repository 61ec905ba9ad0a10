import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from orderloom.llm import components, exact_dedup, simhash


def brute_exact(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", row[1] or "")].append(row)
    out = []
    for norm, group in groups.items():
        sha = hashlib.sha256(norm.encode()).hexdigest()
        low = -1  # a NULL id comes first
        order = sorted(group, key=lambda r: (-len(r[1] or ""), low if r[0] is None else r[0]))
        out += [(r[0], order[0][0], len(group), i == 0, sha) for i, r in enumerate(order)]
    return Counter(out)


@pytest.mark.parametrize("max_bits", [1 << 15, exact_dedup.MAX_BITS])
def test_exact_duplicates(docs, doc_rows, max_bits):
    got = exact_dedup.exact_duplicates(docs, max_bits=max_bits, keep_text=True)
    assert "text" in got.columns and got.schema["kept"].dataType.simpleString() == "boolean"
    got = got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert Counter(map(tuple, got.collect())) == brute_exact(doc_rows)


@pytest.mark.parametrize("max_bits", [1 << 15, exact_dedup.MAX_BITS])
def test_one_of_each_joins_rows_by_number(docs, doc_rows, max_bits):
    """Texts of a group of copies don't meet by digest."""
    got = exact_dedup.one_of_each(docs, max_bits=max_bits)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not [line for line in joins if "_sha" in line]
    kept = [(r[0], r[4]) for r in brute_exact(doc_rows).elements() if r[3]]
    sha = lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest()
    assert Counter((r.doc_id, sha(r.text)) for r in got.collect()) == Counter(kept)


def test_full_filter_changes_nothing(docs, doc_rows, monkeypatch):
    """With every bit set all rows are compared; the result is the same."""
    monkeypatch.setattr(
        exact_dedup, "_repeated_bits", lambda rows, bits, hashes: np.full(bits // 8, 255, np.uint8)
    )
    got = exact_dedup.exact_duplicates(docs)
    got = got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert Counter(map(tuple, got.collect())) == brute_exact(doc_rows)


def test_empty_tables(no_docs):
    assert exact_dedup.exact_duplicates(no_docs).count() == 0
    assert simhash.near_duplicates(no_docs).count() == 0


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids_of_fp):
    fps = list(ids_of_fp)
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    low = defaultdict(list)
    for f, ids in ids_of_fp.items():
        low[root(f)] += [i for i in ids if i is not None]
    return {f: min(low[root(f)], default=None) for f in fps}


def test_near_duplicates(docs, doc_rows):
    ids = defaultdict(list)
    for row in doc_rows:
        ids[brute_fingerprint(row[1])].append(row[0])
    component = brute_components(ids)
    want = Counter((i, f, component[f]) for f, own in ids.items() for i in own)
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r[0], r[1] % 2**64, r[2]) for r in got) == want


@pytest.mark.parametrize("bits", [0, 4, 9])
def test_links_of_dense_and_sparse_fingerprints(spark, docs, bits):
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 2**63, 40, np.uint64)
    fps = {0, *map(int, centre)}
    for c in centre:
        for flips in (1, 2, 3, 4, 3, 3):
            at = rng.choice(64, flips, replace=False)
            fps.add(int(c) ^ sum(1 << int(i) for i in at))
    frame = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in fps], "fp long")
    labels = components.connected_components(simhash.links(frame, bits)).collect()
    of = {r[0] % 2**64: r[1] % 2**64 for r in labels}
    want = brute_components({f: [i] for i, f in enumerate(sorted(fps))})
    classes = defaultdict(set), defaultdict(set)
    for f in fps:
        classes[0][of.get(f, f)].add(f)
        classes[1][want[f]].add(f)
    assert sorted(map(sorted, classes[0].values())) == sorted(map(sorted, classes[1].values()))


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (1, 0)]
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    want = {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 140)}
    assert dict(map(tuple, got.collect())) == want
