import re
from collections import Counter, defaultdict

import pytest
from orderloom.llm import quality_rules


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, least_documents, share):
    hosts, held = Counter(), defaultdict(set)
    normal = lambda line: re.sub("[0-9]", "0", " ".join(words_of(line)).lower())
    for i, (_, text, _, host, *_) in enumerate(rows):
        hosts[host] += 1
        for line in (text or "").split("\n"):
            if words_of(line):
                held[host, normal(line)].add(i)
    out = []
    for key, text, _, host, *_ in rows:
        words, text = words_of(text), text or ""
        seen = defaultdict(list)
        for i in range(len(words) - 4):
            seen[tuple(words[i : i + 5])].append(i)
        covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
        lines = [x for x in text.split("\n") if words_of(x)]
        removed = sum(
            len(words_of(x))
            for x in lines
            if len(held[host, normal(x)]) > max(least_documents, share * hosts[host])
        )
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        kept = not failed and len(words) - removed >= 10 and removed <= 0.5 * len(words)
        out.append((
            key, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered), failed, removed, kept,
        ))
    return Counter(out)


COLUMNS = (
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "base_failed", "n_removed_words", "kept",
)


@pytest.mark.parametrize("least, share", [(10, 0.05), (3, 0.0)])
def test_rules(spark, docs, doc_rows, least, share):
    more = [
        (900 + i, f"Read more {i} here\n{'w ' * i}\n#a|b# <x>\nRead  more {i % 3} HERE", None, h, None, None, None)
        for i, h in enumerate(["a", "a", "b", None] * 10)
    ]
    more += [(990, "a b c d e f a b c d e f a b c d e", None, "b", None, None, None)]
    frame = docs.unionByName(spark.createDataFrame(more, docs.schema))
    got = quality_rules.rules(frame, least_documents=least, share=share).select(*COLUMNS)
    assert Counter(map(tuple, got.collect())) == brute(doc_rows + more, least, share)


def test_empty_table(no_docs):
    assert quality_rules.rules(no_docs).count() == 0
