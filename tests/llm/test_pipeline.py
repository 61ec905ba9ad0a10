"""The pipeline on a small corpus, each stage against a plain version of it."""

import random
import re
from collections import defaultdict
from itertools import combinations

import __spark_entry__ as driver
import corpus_pipeline
import public_tokenizers
import pytest
from orderloom.llm import near_copies
from orderloom.llm.queries import find_package
from tokenizers import Tokenizer


BAD = ["vile", "nasty", "grim"]
SECRET = 'token = "0123456789abcdef0123456789abcdef"'


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    words = ["".join(rng.choices("aeiourstlnm", k=rng.randint(3, 8))) for _ in range(400)]
    rows, toxic = [], {}
    for i in range(600):
        own = rng.choices(words, k=rng.randint(5, 120))
        toxic[i] = int(i % 4 == 0)
        for _ in range(3 * toxic[i]):
            own[rng.randrange(len(own))] = rng.choice(BAD)
        rows.append([i, " ".join(own)])
    for i in range(600, 640):  # copies, exact but for white space, and near
        text = rows[i - 599][1]
        rows.append([i, text.replace(" ", "\n", 1) if i % 2 else text + " indeed"])
    for i in range(640, 660):
        rows.append([i, " ".join(rng.choices(words, k=40)) + f" {SECRET} tail"])
    rows += [[660, None], [661, ""], [662, "  "], [663, rows[1][1]], [663, rows[1][1]], [None, "no id here"]]
    # columns of other names stay, also where the operators use such names themselves
    more = ("_row", "_text", "kept", "score", "_sha")
    docs = [(i, t, "en", "src0", None if t is None else len(t), *more) for i, t in rows]
    path = str(tmp_path_factory.mktemp("corpus"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    schema += "".join(f", {c} string" for c in more)
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int").write.parquet(
        f"{path}/labels.parquet"
    )
    find_package(spark)
    return path, rows


def test_stages_and_result(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.store(stage(spark, docs, path), "test")
        assert docs.columns == columns and all(r._row == "_row" and r.kept == "kept" for r in docs.collect())
        seen[name] = [(r.doc_id, r.text) for r in docs.collect()]

    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    clean = [r for r in rows if not set((r[1] or "").split()) & set(BAD)]
    assert sorted(seen["toxicity"], key=key) == sorted(map(tuple, clean), key=key)

    groups = defaultdict(list)
    for r in clean:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    order = lambda r: (-len(r[1] or ""), -1 if r[0] is None else r[0])
    kept = [tuple(min(g, key=order)) for g in groups.values()]
    assert sorted(seen["exact_dedup"], key=key) == sorted(kept, key=key)

    sets = [near_copies.shingles((r[1] or "").encode()) for r in kept]
    root = list(range(len(kept)))
    for i, j in combinations(range(len(kept)), 2):
        if sets[i] and sets[j] and near_copies.jaccard(sets[i], sets[j]) >= near_copies.BOUND:
            low, high = sorted((root[i], root[j]))
            root = [low if x == high else x for x in root]
    members = defaultdict(list)
    for i, r in zip(root, kept, strict=True):
        members[i].append(r)
    near = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in members.values()]
    assert sorted(seen["near_dedup"], key=key) == sorted(near, key=key)
    assert len(near) < len(kept)

    hidden = [(i, t and t.replace(SECRET[:-1], "<SECRET>")) for i, t in near]
    assert sorted(seen["secrets"], key=key) == sorted(hidden, key=key)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in hidden}
    found = defaultdict(int)
    for r in corpus_pipeline.run(spark, path).collect():
        found[r.doc_id] += r.length
    assert dict(found) == want


def test_entry_registers_all_and_works_without(monkeypatch):
    names = [n for n in driver.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in driver.queries()
    monkeypatch.setattr(driver.importlib.util, "find_spec", lambda name: None)
    assert not [n for n in driver.queries() if n.startswith("op") and n[2].isdigit()]
    assert driver.oracle_sql().keys() <= driver.queries().keys()
