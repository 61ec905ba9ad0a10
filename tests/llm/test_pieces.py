import random

import numpy as np
import pytest
from orderloom.llm import pieces
from orderloom.llm.queries import find_package


def brute(vocabulary, text):
    """Best score over all segmentations, position by position and without an automaton."""
    normal, n = vocabulary.normal, len(text)
    best = [0.0] + [None] * n
    longest = max(map(len, normal))
    for end in range(1, n + 1):
        options = [
            best[start] + normal[text[start:end]][1]
            for start in range(max(0, end - longest), end)
            if text[start:end] in normal
        ]
        if text[end - 1] not in normal:
            options.append(best[end - 1] + vocabulary.unknown)
        best[end] = max(options)
    return best[n]


TEXTS = [
    "", " ", "  two  spaces ", "Hello world, here we are.", "tabs\tand\nlines\n\n", "naïve 梦 𝄞 \x00 end",
    "a" * 500, " nbsp wide", "x" * 20 + " " * 40 + "y", "mixed 123-456 e-mail@host.example",
]


@pytest.fixture(scope="module")
def public():
    return pieces.load()


@pytest.mark.parametrize("text", TEXTS)
def test_best_segmentation_and_round_trip(public, text):
    ids, score = public.encode(text)
    marked = (pieces.SPACE_MARK + text).replace(" ", pieces.SPACE_MARK)
    assert score == pytest.approx(brute(public, marked), rel=1e-12)
    assert public.decode(ids) == text
    whole, total = public.segment(marked)
    assert np.frombuffer(ids, "<u4").tolist() == whole and total == pytest.approx(score, rel=1e-12)


def test_small_vocabularies_with_ties_and_gaps():
    rng = random.Random(8)
    for _ in range(200):
        texts = {"".join(rng.choices("abc▁", k=rng.randint(1, 4))) for _ in range(rng.randint(1, 9))}
        own = [(t, -float(rng.randint(1, 3)), pieces.NORMAL) for t in sorted(texts)]
        own += [(f"<0x{i:02X}>", 0.0, pieces.BYTE) for i in range(256)]
        vocabulary = pieces.Pieces(own)
        for _ in range(10):
            text = "".join(rng.choices("abcd \n", k=rng.randint(0, 12)))
            ids, score = vocabulary.encode(text)
            assert score == pytest.approx(brute(vocabulary, ("▁" + text).replace(" ", "▁")))
            assert vocabulary.decode(ids) == text


def test_frames(spark, docs, doc_rows, no_docs):
    find_package(spark)
    coded = pieces.encode(docs)
    rows = coded.collect()
    assert len(rows) == len(doc_rows) and all(r.round_trip for r in rows)
    assert all(r.n_ids * 4 == len(r.ids) for r in rows)
    texts = sorted((r[1] or "") for r in doc_rows)
    assert sorted(r.text for r in pieces.decode(coded).collect()) == texts
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert pieces.decode(nothing).first().text == ""
    assert pieces.encode(no_docs).count() == 0 and pieces.decode(pieces.encode(no_docs)).count() == 0
