"""Near copies by five-word Jaccard, against a plain comparison of all pairs."""

import random

import numpy as np
from orderloom.llm import near_copies, simhash
from orderloom.llm.queries import find_package

SCHEMA = "doc_id long, text string"


def planted():
    """(rows, ids that go): groups of copies with a few words changed, and pairs just below the bound."""
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    rows, gone = [], set()
    for _ in range(60):
        base = rng.choices(words, k=200)
        first = len(rows)
        rows.append((first, " ".join(base)))
        for changes in (1, 2, 3):  # Jaccard 191/201 and less, down to 181/211
            own = list(base)
            for at in rng.sample(range(10, 190), changes):
                own[at] = "other"
            gone.add(len(rows))
            rows.append((len(rows), " ".join(own)))
    for _ in range(30):  # far below the bound, though most 3-word shingles agree
        base = rng.choices(words, k=60)
        rows.append((len(rows), " ".join(base)))
        for at in range(5, 60, 10):
            base[at] = "changed"
        rows.append((len(rows), " ".join(base)))
    return rows, gone


def brute(rows):
    sets = [near_copies.shingles((t or "").encode()) for _, t in rows]
    n = len(rows)
    return {
        (i, j)
        for i in range(n)
        for j in range(i + 1, n)
        if near_copies.jaccard(sets[i], sets[j]) >= near_copies.BOUND
    }


def test_planted_copies_go_and_others_stay(spark):
    find_package(spark)
    rows, gone = planted()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    left = {r.doc_id for r in near_copies.one_per_component(docs).collect()}
    true = brute(rows)
    assert {j for _, j in true} >= gone
    assert {i for i, _ in rows} - left == {j for _, j in true}
    # the three-bit rule finds only some of them
    old = {r.doc_id for r in simhash.one_per_component(docs).collect()}
    assert len(old & gone) > len(gone) / 4


def test_odd_rows(spark):
    find_package(spark)
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(1, None), (2, ""), (3, "a b"), (4, "A  b"), (5, "a c"), (None, long), (7, long + " x"), (9, long), (9, long)]
    left = near_copies.one_per_component(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.doc_id for r in left) == [1, 3, 5, 7]
    assert near_copies.one_per_component(spark.createDataFrame([], SCHEMA)).count() == 0


def test_balls_link_all_values_at_most_two_bits_apart():
    low, bits = 4, 10
    rng = np.random.default_rng(3)
    key = np.unique(rng.integers(0, 1 << bits, 60))
    check, found = np.zeros(len(key), np.int64), set()
    for prefix in range(1 << (bits - low)):
        apart = np.bitwise_count((key >> low) ^ prefix)
        own = np.flatnonzero(apart <= 1)
        a, b = near_copies.ball_pairs(key[own], np.full(len(own), prefix), own, check[own], low)
        found |= set(zip(a.tolist(), b.tolist(), strict=True))
    near = [(i, j) for i in range(len(key)) for j in range(len(key)) if 0 < int(key[i] ^ key[j]).bit_count() <= 2]
    assert all(int(key[i] ^ key[j]).bit_count() <= 2 for i, j in found)
    label = list(range(len(key)))
    for _ in key:
        for i, j in found:
            label[i] = label[j] = min(label[i], label[j])
    assert all(label[i] == label[j] for i, j in near)


def test_a_large_group_is_compared_in_proportion_to_its_rows(spark, monkeypatch):
    """Not every candidate of a dense group is compared, and none of its rows is lost."""
    find_package(spark)
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(500)]
    base, rows = rng.choices(words, k=150), []
    for i in range(600):
        own = list(base)
        own[rng.randrange(10, 140)] = f"w{i}"
        rows.append((i, " ".join(own)))
    compared = []
    plain = near_copies.verified

    def counted(pairs, texts):
        compared.append(pairs.count())
        return plain(pairs, texts)

    monkeypatch.setattr(near_copies, "verified", counted)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert [r.doc_id for r in near_copies.one_per_component(docs).collect()] == [0]
    assert compared[0] < 600 and sum(compared) <= 3 * 600


def test_a_ball_of_four_makes_all_its_pairs():
    key = np.array([5, 5 ^ 1, 5 ^ 2, 5 ^ 4], np.int64)
    row, check = np.arange(4, dtype=np.int64), np.zeros(4, np.int64)
    a, b = near_copies.ball_pairs(key, np.zeros(4, np.int64), row, check, 4)
    pairs = {tuple(sorted(x)) for x in zip(a.tolist(), b.tolist(), strict=True)}
    assert pairs == {(i, j) for i in range(4) for j in range(i + 1, 4)}


def test_bucket_counts_never_judge_below_the_jaccard():
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.choice([0, 1, 4, 6, 60, 400]))) for _ in range(60)]
    texts += [" ".join(f"w{i}" for i in range(k)) for k in (40_000, 45_000, 49_000)]  # counts beyond a byte
    sets = [near_copies.shingles(t.encode()) for t in texts]
    counts = [near_copies.bucket_counts(near_copies.shingle_hashes(t.encode())) for t in texts]
    assert {len(c) for c in counts} == {near_copies.BUCKETS, 2 * near_copies.BUCKETS}
    for i, x in enumerate(counts):
        for j, y in enumerate(counts):
            assert near_copies.most_jaccard(x, y) >= near_copies.jaccard(sets[i], sets[j])


def test_texts_that_only_share_a_passage_are_not_compared(spark, monkeypatch):
    find_package(spark)
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(5000)]
    passage = rng.choices(words, k=90)
    rows = [(i, " ".join(passage + rng.choices(words, k=60))) for i in range(300)]
    rows += [(300 + i, rows[i][1] + " end") for i in range(3)]
    sizes, plain = [], near_copies.plausible

    def counted(pairs, sigs):
        out = plain(pairs, sigs)
        sizes.append((pairs.count(), out.count()))
        return out

    monkeypatch.setattr(near_copies, "plausible", counted)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    left = {r.doc_id for r in near_copies.one_per_component(docs).collect()}
    assert left == set(range(300))
    before, after = sizes[0]
    assert after < before / 4


def test_no_pair_of_a_dense_group_is_lost(spark):
    """Texts that are all alike, though below the bound, and far from their group's ends pairs above it."""
    find_package(spark)
    rng = random.Random(13)
    base = [f"w{i}" for i in range(400)]

    def changed(words, times):
        own = list(words)
        for at in rng.sample(range(400), times):
            own[at] = f"x{rng.random()}"
        return own

    firsts = [changed(base, 7) for _ in range(200)]
    rows = [(i, " ".join(words)) for i, words in enumerate([*firsts, *[changed(w, 8) for w in firsts]])]
    true = brute(rows)
    assert len(true) == 200
    label = list(range(len(rows)))
    for _ in range(10):
        for i, j in true:
            label[i] = label[j] = min(label[i], label[j])
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    left = {r.doc_id for r in near_copies.one_per_component(docs).collect()}
    assert left == set(label)


def test_the_prefix_keeps_every_pair_whatever_is_frequent():
    rng = random.Random(17)
    rows, _ = planted()
    hashes = [near_copies.shingle_hashes(t.encode()) for _, t in rows]
    every = sorted({int(h) for own in hashes for h in own})
    for share in (0.0, 0.3, 1.0):
        frequent = np.array(sorted(rng.sample(every, int(share * len(every)))), np.uint64)
        first = [set(near_copies.prefix(h, frequent).tolist()) for h in hashes]
        assert all(first[i] & first[j] for i, j in brute(rows))
    assert near_copies.prefix(np.zeros(0, np.uint64), np.zeros(0, np.uint64)).tolist() == [0]


def test_links_of_the_simhash_operator_are_verified(spark, monkeypatch):
    """The stage takes all links of SimHash, and of these alone only those at the bound."""
    find_package(spark)
    rows, _ = planted()
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " ")]
    named = spark.createDataFrame(rows, "_row long, _text string").repartition(3)
    found = {tuple(r) for r in near_copies.fingerprint_pairs(named).collect()}
    prints = [simhash.fingerprint((t or "").encode()) for _, t in rows]
    close = lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3
    assert found and all(i < j for i, j in found)

    def joined(pairs):
        label = list(range(len(rows)))
        for _ in rows:
            for i, j in pairs:
                label[i] = label[j] = min(label[i], label[j])
        return label

    every = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if close(i, j)]
    assert joined(found) == joined(every)
    # without the pairs of the prefix filter
    monkeypatch.setattr(near_copies, "candidates", lambda members: members.select("lo", "hi").toDF("a", "b").limit(0))
    monkeypatch.setattr(near_copies, "rest", lambda members, labels: members.select("lo", "hi").toDF("a", "b").limit(0))
    docs = named.toDF("doc_id", "text")
    left = {r.doc_id for r in near_copies.one_per_component(docs).collect()}
    assert left == set(joined(found & brute(rows)))
