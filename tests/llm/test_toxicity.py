import itertools
import random
import zlib

import numpy as np
import pytest
from orderloom.llm import toxicity
from orderloom.llm.common import crc_mod
from pyspark.sql import functions as F


def test_marginals_match_enumeration():
    """Every labelling of short chains, with words repeated and chains of unequal length."""
    rng = np.random.default_rng(3)
    model = toxicity.Model(
        {"bad": 5, "odd": 2},
        *[rng.normal(size=toxicity.OWN) for _ in range(3)],
        rng.normal(size=(2, 2)),
    )
    texts = ["Bad odd bad x1. UPPER bad\nno", "", "...", "a b c d e f g bad", "lonely!"]
    documents = [toxicity.tokens_of(t) for t in texts]
    rows = toxicity._Rows(model.words)
    chains = toxicity.Chains(documents, rows)
    table = rows.table()
    emission = toxicity.emissions(model, chains, table)
    got = toxicity.marginals(emission, chains, model.transition)
    assert chains.length.tolist() == [4, 2, 1, 8, 1]
    for start, n in zip(chains.start, chains.length, strict=True):
        weights = {}
        for labels in itertools.product((0, 1), repeat=int(n)):
            total = sum(emission[start + i] for i, y in enumerate(labels) if y)
            total += sum(model.transition[a, b] for a, b in itertools.pairwise(labels))
            weights[labels] = np.exp(total)
        whole = sum(weights.values())
        for i in range(n):
            want = sum(w for y, w in weights.items() if y[i]) / whole
            assert got[start + i] == pytest.approx(want)


def test_long_chains_are_cut_and_do_not_overflow():
    model = toxicity.Model({}, *[np.full(toxicity.OWN, 9.0)] * 3, np.full((2, 2), 3.0))
    (score, spans), (nothing, none) = toxicity.tag(model, ["w " * 100_000, ""], toxicity._Rows({}))
    assert score == pytest.approx(1.0) and spans[0] == (0, 2 * toxicity.LONGEST - 1)
    assert (nothing, none) == (0.0, [])


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("aeiourstln", k=rng.randint(3, 8))) for _ in range(400)]
    rows = []
    for i in range(900):
        words, bad = rng.choices(vocabulary, k=60), i % 4 == 0
        for _ in range(rng.randint(1, 4) if bad else 0):
            words[rng.randrange(60)] = rng.choice(["vileé", "nasty", "Grim"])
        noisy = not bad and i % 29 == 0
        rows.append((i, "é€ " + " ".join(words) + ".", int(bad or noisy), int(bad)))
    rows += [(1000 + i, rows[58][1], 1, 0) for i in range(300)]  # copies of one wrong label
    return rows


def test_held_out_documents_and_spans(spark, no_docs, labelled):
    docs = spark.createDataFrame([(i, t, "z") for i, t, _, _ in labelled], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y, _ in labelled], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, crc_mod("doc_id", 3) != 1)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [r for r in labelled if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    right = sum((got[i].score >= 0.7) == bool(bad) for i, _, _, bad in held)
    assert right / len(held) > 0.97
    for i, text, _, bad in held:
        if bad:
            words = {text[s.start : s.end].lower() for s in got[i].spans}
            assert words and {w for x in words for w in x.split()} <= {"vileé", "nasty", "grim"}
    assert toxicity.score(no_docs, model).count() == 0


def test_a_long_labelled_text_is_skipped(spark, labelled):
    """The first text in the order of training is longer than all that may be read."""
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in labelled[:900]], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y, _ in labelled[:900]], "doc_id long, toxic int")
    first = docs.orderBy(F.xxhash64("doc_id"), "doc_id").first().doc_id
    long = F.when(F.col("doc_id") == first, F.repeat(F.lit("plain "), 200_000)).otherwise(F.col("text"))
    docs = docs.withColumn("text", long)
    model = toxicity.train(docs, labels, F.lit(True), most_chars=1_000_000)
    assert any(r.score >= 0.7 for r in toxicity.score(docs, model).collect())
    # the weights' sample is a parameter
    few = toxicity.train(docs, labels, F.lit(True), most_chars=1_000_000, most_weight=20)
    assert not np.array_equal(few.own, model.own)


def test_odd_texts_and_no_labels(spark, docs, doc_rows, no_docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, crc_mod("doc_id", 3) != 1)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(doc_rows) and all(0 <= r.score < 0.7 and r.spans == [] for r in got)
