import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from orderloom.llm import lm
from orderloom.llm.common import crc_mod


def tokens_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def trained_on(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 7 != 2


def brute(rows, left):
    """A dictionary model; a walk that carries a state and follows failure arcs one by one."""
    count, n, begin = Counter(), 0, "<begin>"
    for key, text, *_ in rows:
        if trained_on(key):
            own = tokens_of(text)
            n += len(own)
            count[begin,] += 1
            for i, w in enumerate(own):
                history = (begin, *own[:i])
                count[w,] += 1
                for k in (1, 2):
                    if len(history) >= k:
                        count[(*history[-k:], w)] += 1
    v = sum(len(g) == 1 and g != (begin,) for g in count)
    out = []
    for key, text, *_ in rows:
        own, state, base, total, falls = tokens_of(text), (begin,), 0.0, 0.0, 0
        for w in own:
            root = math.log10((count[w,] + 1) / (n + v + 1))
            base += root
            while state and not count[(*state, w)]:
                total += math.log10(left / (count[state] + left))
                state, falls = state[1:], falls + 1
            if state:
                total += math.log10(count[(*state, w)] / (count[state] + left))
            else:
                total += root
            state = (*state, w)[-2:] if count[w,] else ()
        known = sum(count[w,] > 0 for w in own)
        out.append((key, trained_on(key), len(own), known, n, base, total, falls))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 30, 20_000])
def test_scores(docs, doc_rows, block_bytes):
    got = lm.score(docs, crc_mod("doc_id", 7) != 2, left=0.7, block_bytes=block_bytes).collect()
    order = lambda r: (r[0] is None, r[0] or 0)
    want = sorted(brute(doc_rows, 0.7), key=order)
    assert len(got) == len(want)
    assert sum(w[7] for w in want) > 500  # failure arcs are followed
    for g, w in zip(sorted(map(tuple, got), key=order), want, strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:7], rel=1e-9)


def test_nothing_to_learn_from_and_no_rows(docs, no_docs):
    from pyspark.sql import functions as F

    got = lm.score(docs, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.base_score == 0 and r.score == 0 for r in got)
    assert lm.score(no_docs, F.lit(True)).count() == 0


def test_one_id_for_all_rows_is_dealt_over_blocks(spark, docs):
    """Repeated and missing ids aren't hot, and every copy is scored alike."""
    from pyspark.sql import functions as F

    same = spark.range(400).select(
        F.when(F.col("id") % 2 == 0, 5).alias("doc_id"), F.lit("a b c " * 50).alias("text")
    )
    got = lm.score(same, F.lit(True), block_bytes=4000).collect()
    assert len(got) == 400 and len({r.score for r in got}) == 1
    assert got[0].train_tokens == 400 * 151


def model_of(texts, left):
    block = lm.Block(texts, np.ones(len(texts)), 1)
    n, v = int(block.sizes.sum()), len(set(block.words.tolist()))
    return block, lm.automaton(block, block.counts, n, v, left)


def test_next_words_sum_to_at_most_one():
    """In every state, over the known words and one unknown word; at the root to one."""
    block, model = model_of([b"a b a c a b", b"b a c c", b""], 0.5)
    words = np.unique(block.words)
    unknown = 1 / (block.sizes.sum() + len(words) + 1)
    states = [model.root, model.begin, *words, *np.unique(block.pairs)]
    for state in states:
        weight, _ = model.read(np.full(len(words), state), words.copy())
        path, at = 0.0, state
        while at != model.root:
            path, at = path + model.fail_weights[at], model.fail_to[at]
        total = (10**weight).sum() + 10**path * unknown
        assert total <= 1 + 1e-12
        assert (state == model.root) == (total == pytest.approx(1.0))


def test_a_long_text_is_read_as_in_one_walk():
    rng = np.random.default_rng(1)
    words = [b"w%d" % i for i in rng.integers(0, 40, 3 * lm.STRETCH + 7)]
    block, model = model_of([b" ".join(words), b"w1 w2"], 1.0)
    state, total = np.array([model.begin]), 0.0
    for word in block.words[: block.sizes[0]]:
        weight, state = model.read(state, np.array([word]))
        total += weight[0]
    assert lm.walk(block, model)[0] == pytest.approx(total, rel=1e-12)


def test_a_walk_knows_its_arcs_without_a_search(monkeypatch):
    """The n-grams that end where a word is read tell the arc that a search would find."""
    rng = np.random.default_rng(3)
    texts = [b" ".join(b"w%d" % i for i in rng.integers(0, 30, n)) for n in (0, 1, 2, 900, 40)]
    block = lm.Block(texts, np.ones(len(texts)), 1)
    total = np.where(rng.random(len(block.counts)) < 0.3, 0, block.counts)
    model = lm.automaton(block, total, 1000, 31, 1.0)
    read = model.read
    monkeypatch.setattr(model, "read", lambda state, word, ended=None: read(state, word))
    searched = lm.walk(block, model)
    monkeypatch.undo()
    monkeypatch.setattr(lm.Automaton, "find", None)
    assert lm.walk(block, model) == pytest.approx(searched, rel=1e-12)


def test_messages_grow_with_the_input_and_not_its_square():
    texts = [b"one two three", b"four five"]
    sent = [lm.Block(texts, np.ones(2), shards).questions(0).num_rows for shards in (10**4, 10**5)]
    assert max(sent) <= len(lm.Block(texts, np.ones(2), 1).keys)


def test_keys_and_numbers_round_trip():
    keys = np.unique(np.random.default_rng(2).integers(0, 1 << 40, 5000).astype(np.uint64))
    assert (lm.unpack_keys(lm.pack_keys(keys), len(keys)) == keys).all()
    for most in (0, 255, 70_000):
        values = np.array([0, most, 1])
        assert (lm.unpack_numbers(lm.pack_numbers(values)) == values).all()
