"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (64 words each), and only documents are labelled.
Every passage is encoded as a short vector of what its words look like and how
they repeat. Gated attention weighs the passages, a_k ~ exp(w . (tanh(V h_k) *
sigmoid(U h_k))), and a logistic unit scores the weighted passage representation.
Attention and scorer are learned together from the documents' labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from orderloom.llm.common import raw, sample

PASSAGE = 64
HIDDEN = 12
_PUNCTUATION = frozenset(".,;:!?\"'()")
#: Of a word; a passage has their means, and the features of repetition below.
WORD_FEATURES = (
    "chars", "short", "long", "lower", "capital", "upper", "digits", "non_ascii",
    "stop", "comma", "shout", "symbol", "symbols", "no_letter",
)
PASSAGE_FEATURES = (*WORD_FEATURES, "same_as_before", "distinct", "words", "in_document")
SIZE = len(PASSAGE_FEATURES)


def word_features(word: str) -> tuple[float, ...]:
    letters = sum(c.isalpha() for c in word)
    marks = sum(not c.isalnum() and c not in _PUNCTUATION for c in word)
    return (
        min(len(word), 40) / 10,
        len(word) <= 3,
        len(word) >= 12,
        word.islower(),
        word[0].isupper() and not (letters > 1 and word.isupper()),
        letters > 1 and word.isupper(),
        any(c.isdigit() for c in word),
        not word.isascii(),
        word[-1] == ".",
        word[-1] == ",",
        word[-1] in "!?",
        marks > 0,
        marks > 2,
        letters == 0,
    )


class _Words(dict):
    """Row of the feature table of each word met, remembered."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[tuple[float, ...]] = []

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self.rows)
        self.rows.append(word_features(word.decode(errors="replace")))
        return value


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors of all texts, and the number of passages of each. No text has fewer
    than one: a text without words is one passage of zeros."""
    known = _Words()
    lists = [t.split() for t in texts]
    sizes = np.array([len(x) for x in lists], np.int64)
    row = np.fromiter((known[w] for x in lists for w in x), np.int64, int(sizes.sum()))
    table = np.array(known.rows, np.float32).reshape(-1, len(WORD_FEATURES))
    passages = np.maximum(1, -(-sizes // PASSAGE))
    out = np.zeros((int(passages.sum()), SIZE), np.float32)
    if not len(row):
        return out, passages
    doc = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    passage = np.repeat(np.cumsum(passages) - passages, sizes) + place // PASSAGE
    starts = np.flatnonzero(np.diff(passage, prepend=-1))
    at, count = passage[starts], np.diff(np.append(starts, len(row)))
    n = len(WORD_FEATURES)
    out[at, :n] = np.add.reduceat(table[row], starts, axis=0) / count[:, None]
    again = np.append(False, (row[1:] == row[:-1]) & (place[1:] > 0))
    out[at, n] = np.add.reduceat(again, starts, dtype=np.int64) / count

    def distinct(group: np.ndarray, groups: int) -> np.ndarray:
        found = np.unique(group * len(table) + row)
        return np.bincount(found // len(table), minlength=groups)

    out[at, n + 1] = distinct(passage, len(out))[at] / count
    out[at, n + 2] = count / PASSAGE
    share = distinct(doc, len(texts)) / np.maximum(sizes, 1)
    out[at, n + 3] = share[doc[starts]]
    return out, passages


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    spread: np.ndarray
    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    score: np.ndarray
    bias: float


def forward(model: Model, passages: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    """Score of each bag, and what the gradient needs."""
    h = np.clip((passages - model.mean) / model.spread, -6, 6)
    bag = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.cumsum(sizes) - sizes
    t, g = np.tanh(h @ model.v), 1 / (1 + np.exp(-(h @ model.u)))
    e = (t * g) @ model.w
    e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
    a = e / np.add.reduceat(e, starts)[bag]
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    p = 1 / (1 + np.exp(-np.clip(z @ model.score + model.bias, -30, 30)))
    return {"h": h, "bag": bag, "starts": starts, "t": t, "g": g, "a": a, "z": z, "p": p}


def fit(
    passages: np.ndarray, sizes: np.ndarray, labels: np.ndarray, steps: int = 200, seed: int = 7
) -> Model:
    """Full-batch Adam on the log loss. Without both labels present, a constant model."""
    rng = np.random.default_rng(seed)
    shapes = {"v": (SIZE, HIDDEN), "u": (SIZE, HIDDEN), "w": (HIDDEN,), "score": (SIZE,)}
    params = {k: rng.normal(size=s) * (0.0 if k == "score" else 0.3) for k, s in shapes.items()}
    rate = (labels.sum() + 1) / (len(labels) + 2)
    params["bias"] = np.array(np.log(rate / (1 - rate)))
    mean = passages.mean(axis=0) if len(passages) else np.zeros(SIZE)
    spread = passages.std(axis=0) + 0.05 if len(passages) else np.ones(SIZE)
    model = Model(mean, spread, **params)
    if len(set(labels.tolist())) < 2:
        return model
    first = {k: np.zeros_like(x) for k, x in params.items()}
    second = {k: np.zeros_like(x) for k, x in params.items()}
    for step in range(1, steps + 1):
        x = forward(Model(mean, spread, **params), passages, sizes)
        h, bag, starts, t, g, a = (x[k] for k in ("h", "bag", "starts", "t", "g", "a"))
        miss = (x["p"] - labels) / len(labels)
        to_z = miss[:, None] * params["score"]
        to_a = (to_z[bag] * h).sum(axis=1)
        to_e = a * (to_a - np.add.reduceat(a * to_a, starts)[bag])
        to_tg = to_e[:, None] * params["w"]
        grads = {
            "score": x["z"].T @ miss,
            "bias": miss.sum(),
            "w": (t * g).T @ to_e,
            "v": h.T @ (to_tg * g * (1 - t**2)),
            "u": h.T @ (to_tg * t * g * (1 - g)),
        }
        for k, grad in grads.items():
            grad = grad + (0 if k == "bias" else 1e-4 * params[k])
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.99 * second[k] + 0.01 * grad**2
            by = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            params[k] = params[k] - 0.05 * by
    return Model(mean, spread, **params)


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    most_rows: int = 5_000,
    most_passages: int = 40_000,
) -> Model:
    """Fit on labelled rows that ``learn`` allows: at most ``most_rows``, chosen by the id's
    hash, and of these as many as have ``most_passages`` together; a text that doesn't fit
    is skipped. The passages are encoded in tasks; the driver sees vectors only."""
    known = labels.where(learn & F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("_id"), (F.col(label_col) != 0).cast("double").alias("_label")
    )
    chosen = sample(known, "_id", most_rows)
    rows = docs.select(F.col(id_col).alias("_id"), raw(text_col).alias("_text")).join(chosen, "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                vectors, sizes = encode(part.column(2).to_pylist())
                bags = np.split(vectors, np.cumsum(sizes)[:-1])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([b.tobytes() for b in bags])],
                    names=["order", "label", "bag"],
                )

    bags = rows.select(F.xxhash64("_id").alias("order"), "_label", "_text").mapInArrow(
        run, "order long, label double, bag binary"
    )
    parts, ys, total = [], [], 0
    for row in bags.orderBy("order", "bag").limit(most_rows).toLocalIterator():
        part = np.frombuffer(row.bag, np.float32).reshape(-1, SIZE)
        if parts and total + len(part) > most_passages:
            continue
        total += len(part)
        parts.append(part)
        ys.append(row.label)
    vectors = np.concatenate(parts) if parts else np.zeros((0, SIZE), np.float32)
    return fit(vectors, np.array([len(x) for x in parts], np.int64), np.array(ys))


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score) of each row: the probability of label 1. NULL is the empty text, which is
    scored as one passage without words. Nothing but the text is looked at."""
    schema = StructType([docs.schema[id_col], StructField("score", DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, part, size = [], [], 0
            for text in batch.column(1).to_pylist():
                part.append(text)
                size += len(text)
                if size > 1 << 20:
                    found.append(forward(shared.value, *encode(part))["p"])
                    part, size = [], 0
            if part:
                found.append(forward(shared.value, *encode(part))["p"])
            p = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], names=[id_col, "score"])

    return docs.select(id_col, raw(text_col).alias("text")).mapInArrow(run, schema)
