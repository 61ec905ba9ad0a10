import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from orderloom.llm import packing
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def check(got, want_ids, limits):
    """Every id lies in one piece, sequences are gapless and within all limits."""
    sequences, examples = defaultdict(list), defaultdict(list)
    for r in got:
        own = np.frombuffer(r.ids, "<u4")
        assert len(own) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        sequences[r.sequence_id].append((r.offset, r.length, r.loss_tokens))
        examples[r.doc_id].append((r.start, r.doc_tokens, own))
    for pieces in sequences.values():
        at = 0
        for offset, length, _ in sorted(pieces):
            assert offset == at
            at += length
        assert at <= limits.tokens and len(pieces) <= limits.segments
        assert sum(p[2] for p in pieces) <= limits.loss
    for key, ids in want_ids.items():
        pieces = sorted(examples.pop(key), key=lambda p: p[0])
        joined = np.concatenate([p[2] for p in pieces])
        assert joined.tolist() == ids and all(p[1] == len(ids) for p in pieces)
        assert [p[0] for p in pieces] == np.cumsum([0] + [len(p[2]) for p in pieces])[:-1].tolist()
    assert not examples
    return {k: sum(p[1] for p in v) for k, v in sequences.items()}


def test_documents(docs, doc_rows, tokenizer):
    rows = {r[0]: r[1] for r in doc_rows if r[0] is not None}
    unique = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    want = {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for k, t in rows.items()}
    got = packing.pack(unique, with_ids=True).collect()
    totals = check(got, want, packing.Limits())
    padding = sum(1024 - t for t in totals.values() if t & (t - 1))
    assert padding == 0


def test_three_limits_and_prompts(spark, docs, tokenizer):
    rows = [(i, "ask " * (i % 40), "answer me " * (i % 23)) for i in range(300)] + [(300, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, prompt string, text string").repartition(2)
    limits = packing.Limits(tokens=64, segments=3, loss=20)
    got = packing.pack(frame, prompt_col="prompt", limits=limits, waiting=16, with_ids=True).collect()
    encode = lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids
    check(got, {i: [*encode(p), *encode(t), 0] for i, p, t in rows}, limits)


def test_repeated_rows_and_empty_table(docs, no_docs, doc_rows):
    got = packing.pack(docs).where("start = 0").count()
    assert got == len(doc_rows)
    assert packing.pack(no_docs).count() == 0
