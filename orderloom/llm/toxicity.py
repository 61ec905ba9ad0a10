"""Toxic spans and document scores from a linear-chain conditional random field.

Each sentence (or 256 tokens of a longer one) is a chain with one label a token,
clean or toxic. A token's weight
for ``toxic`` comes from features of the word itself and of its two neighbours;
two-by-two transition weights tie neighbouring labels. Forward-backward gives the
marginal probability of every token. Runs of tokens above one half are the
offending spans; a document's score is its most toxic token's marginal.

With two labels the recursions can be written in odds, toxic against clean. These
stay within bounds that the transition weights set, so no length overflows, and
one step serves all sentences of a batch at once.

Only documents are labelled. Token labels are derived from them on the training
sample: a word is toxic if the number of labelled documents that hold it differs
from chance by more than the number of words tried can explain, and its tokens in
toxic documents are toxic. Near copies in the sample count once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    StructField,
    StructType,
)

from orderloom.llm.common import sample, text_of

TOKEN = re.compile(r"\w+|[.!?\n]+")
_END = frozenset(".!?\n")
#: Features of a word: evidence bins, then shapes.
BINS = 8
SHAPES = ("bias", "short", "long", "capital", "upper", "digit")
OWN = BINS + len(SHAPES)
LARGEST = 30.0
#: Tokens of a chain at most; a longer sentence is several chains.
LONGEST = 256
#: Documents of either label that the gradient is taken over.
WEIGHT_DOCUMENTS = 400
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.array([0, 0x5BD1E995A3C59AC3, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@dataclass(frozen=True)
class Model:
    """words: evidence bin of the words that have any; weights for own, left and right features;
    transition[i, j]: from label i to label j."""

    words: dict[str, int]
    own: np.ndarray
    left: np.ndarray
    right: np.ndarray
    transition: np.ndarray


def tokens_of(text: str) -> list[str]:
    return TOKEN.findall(text)


def shape_of(word: str) -> list[int]:
    """Positions of a word's shape features that are on."""
    on = (
        True,
        len(word) <= 3,
        len(word) >= 12,
        word[:1].isupper() and not word.isupper(),
        word.isupper() and len(word) > 1,
        any(c.isdigit() for c in word),
    )
    return [BINS + i for i, x in enumerate(on) if x]


def _signature(tokens: list[str]) -> list[int]:
    """Smallest hash of the document's three-word windows under each of four mixings."""
    low = [w.lower() for w in tokens]
    grams = {" ".join(low[i : i + 3]) for i in range(max(1, len(low) - 2))}
    hashes = np.array([xxhash.xxh64_intdigest(g) for g in grams], np.uint64)
    return [int(((hashes ^ m) * _ODD >> np.uint64(20)).min()) for m in _MIX]


def one_of_each(documents: list[list[str]]) -> list[int]:
    """Positions of documents that share no smallest hash with an earlier one."""
    seen: set[tuple[int, int]] = set()
    out = []
    for i, tokens in enumerate(documents):
        keys = set(enumerate(_signature(tokens)))
        if not keys & seen:
            out.append(i)
        seen |= keys
    return out


def evidence(documents: list[list[str]], labels: list[int]) -> dict[str, float]:
    """Log-likelihood ratio of each word for a toxic document, less what chance explains."""
    toxic, clean = Counter(), Counter()
    for tokens, label in zip(documents, labels, strict=True):
        (toxic if label else clean).update({w.lower() for w in tokens})
    n1 = sum(labels)
    base = (n1 + 1) / (len(labels) + 2)
    words = {w for w in toxic if w[0] not in _END}
    chance = math.log(1 + sum(1 for w in words if toxic[w] + clean[w] > 1))
    out = {}
    for w in words:
        a, n = toxic[w], toxic[w] + clean[w]
        rate = (a + 0.01) / (n + 0.02)
        if rate > base:
            ratio = a * math.log(rate / base) + (n - a) * math.log((1 - rate) / (1 - base))
            out[w] = ratio - chance
    return out


def _bins(found: dict[str, float]) -> dict[str, int]:
    """Words by strength of evidence; bin 0 is for all the others."""
    edges = [-2.0, -1.0, 0.0, 2.0, 5.0, 10.0]
    return {w: 1 + int(np.searchsorted(edges, x, side="right")) for w, x in found.items() if x > -4}


class Chains:
    """Sentences of a batch of token lists: features and positions as flat arrays."""

    def __init__(self, documents: list[list[str]], rows: dict[str, int]):
        lengths = [len(d) for d in documents]
        self.doc = np.repeat(np.arange(len(documents)), lengths)
        row = np.array([rows[w] for d in documents for w in d], np.int64)
        stop = row < 0
        self.keep = np.flatnonzero(~stop)  # a stop mark ends a chain and isn't part of one
        self.row = row[self.keep]
        doc = self.doc[self.keep]
        chain = np.cumsum(stop)[self.keep] + doc
        first = np.append(True, chain[1:] != chain[:-1])[: len(chain)]
        at = np.arange(len(chain))
        since = at - np.maximum.accumulate(np.where(first, at, 0))
        self.start = np.flatnonzero(since % LONGEST == 0)
        self.length = np.diff(np.append(self.start, len(chain)))
        self.doc = doc

    def steps(self) -> tuple[np.ndarray, np.ndarray]:
        """Chain starts from the longest to the shortest, and how many are longer than t."""
        order = np.argsort(-self.length, kind="stable")
        sizes = self.length[order]
        longest = int(sizes[0]) if len(sizes) else 0
        return self.start[order], np.searchsorted(-sizes, -np.arange(longest), side="left")


class _Rows(dict):
    """Row of the feature table of each word; -1 for marks that end a sentence."""

    def __init__(self, words: dict[str, int]):
        super().__init__()
        self._words, self.features = words, []
        self._known: dict[tuple[int, ...], int] = {}

    def __missing__(self, word: str) -> int:
        if word[0] in _END:
            row = -1
        else:
            on = (self._words.get(word.lower(), 0), *shape_of(word))
            row = self._known.get(on)
            if row is None:
                row = self._known[on] = len(self.features)
                self.features.append(on)
        if len(self) > 300_000:
            self.clear()
        self[word] = row
        return row

    def table(self) -> np.ndarray:
        out = np.zeros((len(self.features), OWN))
        for i, on in enumerate(self.features):
            out[i, list(on)] = 1
        return out


def neighbours(chains: Chains) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the left and right neighbour in the chain, -1 where there is none."""
    at = np.arange(len(chains.row))
    left, right = at - 1, at + 1
    left[chains.start] = -1
    right[chains.start + chains.length - 1] = -1
    return left, right


def emissions(model: Model, chains: Chains, table: np.ndarray) -> np.ndarray:
    """Log-odds weight of ``toxic`` for each token, before transitions."""
    left, right = neighbours(chains)
    own, to_right, to_left = table @ model.own, table @ model.left, table @ model.right
    row = chains.row
    return (
        own[row]
        + np.where(left < 0, 0.0, to_right[row[left]])
        + np.where(right < 0, 0.0, to_left[row[right]])
    )


def marginals(emission: np.ndarray, chains: Chains, transition: np.ndarray) -> np.ndarray:
    """P(toxic) of each token."""
    forward, backward = odds(emission, chains, transition)
    both = forward * backward
    return both / (1 + both)


def odds(
    emission: np.ndarray, chains: Chains, transition: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Forward odds (with the token's own weight) and backward odds (without it)."""
    t = np.exp(transition)
    weight = np.exp(np.clip(emission, -LARGEST, LARGEST))
    forward, backward = np.empty_like(weight), np.ones_like(weight)
    starts, many = chains.steps()
    for i, n in enumerate(many):
        at = starts[:n] + i
        if i:
            f = forward[at - 1]
            forward[at] = weight[at] * (t[0, 1] + f * t[1, 1]) / (t[0, 0] + f * t[1, 0])
        else:
            forward[at] = weight[at]
    for i in range(len(many) - 1, 0, -1):
        at = starts[: many[i]] + i
        b = weight[at] * backward[at]
        backward[at - 1] = (t[1, 0] + t[1, 1] * b) / (t[0, 0] + t[0, 1] * b)
    return forward, backward


def pair_marginals(
    forward: np.ndarray, backward: np.ndarray, weight: np.ndarray, right: np.ndarray, transition
) -> np.ndarray:
    """Summed P(label of a token, label of its right neighbour), two by two."""
    at = np.flatnonzero(right >= 0)
    f, b = forward[at], (weight * backward)[right[at]]
    t = np.exp(transition)
    cells = np.stack([t[0, 0] + 0 * f, t[0, 1] * b, t[1, 0] * f, t[1, 1] * f * b])
    return (cells / cells.sum(axis=0)).sum(axis=1).reshape(2, 2)


def fit(
    documents: list[list[str]], labels: list[int], steps: int = 80, most_weight: int = WEIGHT_DOCUMENTS
) -> Model:
    """Train on documents of tokens; the gradient is observed less expected counts."""
    chosen = one_of_each(documents)
    documents, labels = [documents[i] for i in chosen], [labels[i] for i in chosen]
    found = evidence(documents, labels)
    lexicon = {w for w, x in found.items() if x > 0}
    words = _bins(found)
    # the evidence comes from all documents; so many of either label teach the few weights
    toxic = [d for d, y in zip(documents, labels, strict=True) if y][:most_weight]
    clean = [d for d, y in zip(documents, labels, strict=True) if not y][:most_weight]
    rows = _Rows(words)
    chains = Chains(toxic + clean, rows)
    table = rows.table()
    flat = [w for d in toxic + clean for w in d]
    gold = np.array([flat[i].lower() in lexicon for i in chains.keep], bool)
    gold &= chains.doc < len(toxic)
    left, right = neighbours(chains)
    row, last = chains.row, len(table)
    has_left, has_right = np.flatnonzero(left >= 0), np.flatnonzero(right >= 0)
    prior = np.zeros(3 * OWN + 4)
    prior[BINS] = -4.0  # without evidence a word is clean
    params, first, second = prior.copy(), np.zeros_like(prior), np.zeros_like(prior)
    observed = np.zeros((2, 2))
    np.add.at(observed, (gold[has_right].astype(int), gold[right[has_right]].astype(int)), 1)
    scale = max(1.0, float(gold.sum()))

    def model() -> Model:
        own, l, r = params[: 3 * OWN].reshape(3, OWN)  # noqa: E741
        return Model(words, own, l, r, params[3 * OWN :].reshape(2, 2))

    for step in range(1, steps + 1):
        now = model()
        emission = emissions(now, chains, table)
        forward, backward = odds(emission, chains, now.transition)
        p = forward * backward
        p = p / (1 + p)
        gap = gold - p
        weight = np.exp(np.clip(emission, -LARGEST, LARGEST))
        expected = pair_marginals(forward, backward, weight, right, now.transition)
        grad = np.concatenate([
            table.T @ np.bincount(row, gap, last),
            table.T @ np.bincount(row[left[has_left]], gap[has_left], last),
            table.T @ np.bincount(row[right[has_right]], gap[has_right], last),
            (observed - expected).ravel(),
        ])
        grad = grad / scale - 0.001 * (params - prior)
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        params += 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return model()


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    most_rows: int = 6_000,
    most_chars: int = 12_000_000,
    most_weight: int = WEIGHT_DOCUMENTS,
) -> Model:
    """Fit on labelled rows that ``learn`` allows: at most ``most_rows`` of them, chosen by
    the id's hash, and of these as many as have ``most_chars`` characters together; a text
    that doesn't fit is skipped. ``most_weight`` documents of either label teach the weights.

    Without labelled rows every word has the prior's score.
    """
    known = labels.where(learn & F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")
    )
    chosen = sample(known, "_id", most_rows)
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    found = rows.join(chosen, "_id").withColumn("_n", F.length("_text"))
    found = found.withColumn("_order", F.xxhash64("_id"))
    texts, ys, chars, same = [], [], 0, {}
    for row in found.orderBy("_order", "_id").limit(most_rows).toLocalIterator():
        if chars + row._n > most_chars:
            continue
        chars += row._n
        texts.append([same.setdefault(w, w) for w in tokens_of(row._text)])
        ys.append(int(bool(row._label)))
    return fit(texts, ys, most_weight=most_weight)


def tag(model: Model, texts: list[str], rows: _Rows) -> list[tuple[float, list[tuple[int, int]]]]:
    """Score and spans (code points, end exclusive) of each text."""
    documents = [tokens_of(t) for t in texts]
    chains = Chains(documents, rows)
    emission = emissions(model, chains, rows.table())
    p = marginals(emission, chains, model.transition)
    best = np.zeros(len(texts))
    np.maximum.at(best, chains.doc, p)
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    begin = np.cumsum([0] + [len(d) for d in documents])
    hot = np.flatnonzero(p >= 0.5)
    new_chain = set(chains.start[np.isin(chains.start, hot)].tolist())
    for doc in np.unique(chains.doc[hot]).tolist():
        places = [m.span() for m in TOKEN.finditer(texts[doc])]
        before = -2
        for i in hot[chains.doc[hot] == doc].tolist():
            start, end = places[chains.keep[i] - begin[doc]]
            if i == before + 1 and i not in new_chain:
                spans[doc][-1] = (spans[doc][-1][0], end)
            else:
                spans[doc].append((start, end))
            before = i
    return list(zip(best.tolist(), spans, strict=True))


def _tagged(model: Model, rows: _Rows, texts: Iterable[str]) -> list:
    """``tag`` over about a megabyte at a time."""
    found, part, size = [], [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size > 1 << 20:
            found += tag(model, part, rows)
            part, size = [], 0
    return found + (tag(model, part, rows) if part else [])


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score, spans) of each row; spans: array of (start, end) in code points.

    NULL and empty texts, and texts without a word, have score 0 and no span.
    Nothing but the text is looked at.
    """
    span = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
    schema = StructType([
        docs.schema[id_col], StructField("score", DoubleType()), StructField("spans", ArrayType(span))
    ])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    pair = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        rows = _Rows(model.words)
        for batch in batches:
            found = _tagged(model, rows, batch.column(1).to_pylist())
            spans = [[{"start": a, "end": b} for a, b in s] for _, s in found]
            scores = pa.array([x for x, _ in found], pa.float64())
            arrays = [batch.column(0), scores, pa.array(spans, pair)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select(id_col, text_of(text_col).alias("text")).mapInArrow(run, schema)


def reject(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        rows = _Rows(shared.value.words)
        for some in texts:
            found = _tagged(shared.value, rows, (t.as_py() or "" for t in some))
            yield pa.array([score < threshold for score, _ in found], pa.bool_())
        pa.default_memory_pool().release_unused()

    # only the text goes to Python, and one answer per row comes back
    return docs.where(clean(F.col(text_col)))
