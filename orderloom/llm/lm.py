"""Language-model scoring with a weighted backoff automaton.

The model is an automaton whose states are what was last read: two words, one
word, the begin of a text, or nothing (the root). A state's arcs are the words
seen after it in training. The arc of w from state h weighs c(hw) / (c(h) + left)
and leads to the state of the last two words. A word without an arc takes the
failure arc, which weighs left / (c(h) + left) and leads to the state with the
first word forgotten, and from there again; the root has an arc for every word,
its smoothed single-word probability, and one for all unknown words, which leads
back to the root. A text is read once from left to right: the state is carried
and the log10 weights add up.

``left`` is the discount: what a state keeps for words it hasn't seen. The failure
weight isn't raised by the share that lower orders give to words with an arc of
their own, so a state's probabilities sum to at most one and a text's score is a
lower bound of the rescaled model's. All n-grams up to three words count, single
ones too.

The automaton grows with the corpus and is never in one place. Documents are dealt
into blocks of bounded size, row by row, so neither a repeated id nor a missing one
is hot. A block asks for the counts of just the n-grams that occur in it: it sends
its own training counts to the shards that own a range of the hashes. A shard adds
up and answers each block in the order asked. From the answers the block builds its
part of the automaton and walks its texts. An n-gram that occurs everywhere is one
entry in each block's message, and a block writes only to shards that own something
of it, so messages grow with the input and not with its square.

An n-gram is known by its shard and 40 bits of its hash. Shards have a bounded size,
about two million n-grams each by default, so one n-gram in 500,000 meets another,
at any size of the corpus.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StructField,
    StructType,
)

from orderloom.llm.common import raw, text_of

#: Hashes of marks that no word can have: words hold no white space.
END = xxhash.xxh64_intdigest(b" ")
BEGIN = xxhash.xxh64_intdigest(b"\t")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Texts are walked in stretches of so many tokens, side by side.
STRETCH = 512
_OWN_BITS = np.uint64(40)
_REMEMBERED = 500_000
_COUNTED = 200_000
_ASK = "shard int, block int, keys binary, counts binary"
_ANSWER = "block int, shard int, others binary"


class _Hashes(dict):
    """Hash of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def token_hashes(text: bytes | None, known: _Hashes) -> list[int]:
    """Hashes of the lower-cased words and of the end mark."""
    return [known[w] for w in (text or b"").lower().split()] + [END]


def _joined(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    key = (before * _A + after) * _B
    return key ^ (key >> np.uint64(29))


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, a place of each, and each place's number among them."""
    order = np.argsort(values)
    found = values[order]
    new = np.ones(len(found), bool)
    new[1:] = found[1:] != found[:-1]
    number = np.empty(len(found), np.int64)
    number[order] = np.cumsum(new) - 1
    return found[new], order[new], number


def pack_numbers(values: np.ndarray) -> bytes:
    """Non-negative numbers in the smallest type that holds them, which comes first."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return kind.char.encode() + zstandard.compress(values.astype(kind).tobytes(), 1)


def unpack_numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data[1:]), np.dtype(data[:1].decode())).astype(np.int64)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted 40-bit keys as steps, byte by byte: three low bytes, which hardly compress, and the rest."""
    planes = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    return planes[:3].tobytes() + zstandard.compress(planes[3:5].tobytes(), 1)


def unpack_keys(data: bytes, n: int) -> np.ndarray:
    planes = np.zeros((8, n), np.uint8)
    planes[:3] = np.frombuffer(data, np.uint8, 3 * n).reshape(3, n)
    planes[3:5] = np.frombuffer(zstandard.decompress(data[3 * n :]), np.uint8).reshape(2, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel())


class Block:
    """N-grams of one block's texts, sorted by shard and own bits, with training counts.

    ``words``, ``pairs`` and ``triples`` tell for each position which n-gram ends
    there. A text's first word ends no triple: the entry there is that of its pair.
    """

    def __init__(self, texts: list[bytes | None], train: np.ndarray, shards: int):
        known = _Hashes()
        lists = [np.array(token_hashes(t, known), np.uint64) for t in texts]
        self.sizes = np.array([len(x) for x in lists], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        tokens = np.concatenate([*lists, np.zeros(0, np.uint64)])
        self.first = np.zeros(len(tokens), bool)
        self.first[self.starts] = True
        before = np.where(self.first, np.uint64(BEGIN), np.roll(tokens, 1))
        pairs = _joined(before, tokens)
        triples = np.where(self.first, pairs, _joined(np.roll(pairs, 1), tokens ^ _A))
        every = np.concatenate([tokens, pairs, triples])
        shard = ((every >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
        every = (shard << _OWN_BITS) | (every & ((np.uint64(1) << _OWN_BITS) - np.uint64(1)))
        self.keys, self.seen_at, at = _numbered(every)
        self.seen_at[at[len(tokens) + self.starts]] = len(tokens) + self.starts
        self.words, self.pairs, self.triples = np.split(at, 3)
        counted = np.repeat(train, self.sizes)
        counted = np.concatenate([counted, counted, np.where(self.first, 0, counted)])
        self.counts = np.bincount(at, weights=counted, minlength=len(self.keys)).astype(np.int64)
        bounds = np.arange(shards + 1, dtype=np.uint64) << _OWN_BITS
        self.bounds = np.searchsorted(self.keys, bounds)

    def questions(self, block: int) -> pa.Table:
        own = self.keys & ((np.uint64(1) << _OWN_BITS) - np.uint64(1))
        asked = np.flatnonzero(np.diff(self.bounds))
        parts = [slice(self.bounds[s], self.bounds[s + 1]) for s in asked]
        return pa.table({
            "shard": pa.array(asked, pa.int32()),
            "block": pa.array([block] * len(asked), pa.int32()),
            "keys": pa.array([pack_keys(own[p]) for p in parts], pa.binary()),
            "counts": pa.array([pack_numbers(self.counts[p]) for p in parts], pa.binary()),
        })

    def totals(self, answers: list[tuple[int, bytes]]) -> np.ndarray:
        """Corpus counts of the block's n-grams, from each shard's answer."""
        total = self.counts.copy()
        for shard, others in answers:
            total[self.bounds[shard] : self.bounds[shard + 1]] += unpack_numbers(others)
        return total


def add_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> list[np.ndarray]:
    """Totals of each list's keys over all lists."""
    if not keys:
        return []
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
    return np.split(total[at], np.cumsum([len(k) for k in keys])[:-1])


def _answers(asked: pa.Table) -> pa.Table:
    """One shard: what the other blocks have counted, told to each block in the order it asked."""
    own = [unpack_numbers(x) for x in asked.column("counts").to_pylist()]
    data = asked.column("keys").to_pylist()
    total = add_up([unpack_keys(x, len(n)) for x, n in zip(data, own, strict=True)], own)
    others = [pack_numbers(x - y) for x, y in zip(total, own, strict=True)]
    return pa.table({
        "block": asked.column("block"),
        "shard": asked.column("shard"),
        "others": pa.array(others, pa.binary()),
    })


@dataclass
class Automaton:
    """A block's part of the model. States are numbers of n-grams; then the begin, then the root.

    An arc has the number of the n-gram that it completes."""

    arcs: np.ndarray  #: whether an n-gram has one
    weights: np.ndarray
    sources: np.ndarray
    words: np.ndarray
    targets: np.ndarray
    of_pair: np.ndarray  #: whether a state is that of a pair
    fail_to: np.ndarray
    fail_weights: np.ndarray
    root_weights: np.ndarray  #: of each word
    root_targets: np.ndarray
    begin: int
    root: int

    @functools.cached_property
    def _sorted(self) -> tuple[np.ndarray, np.ndarray]:
        arc = np.flatnonzero(self.arcs)
        key = self.sources[arc].astype(np.int64) * (self.root + 1) + self.words[arc]
        order = np.argsort(key)
        return key[order], arc[order]

    def find(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The arc of each word from its state, -1 without one."""
        keys, arcs = self._sorted
        if not len(keys):
            return np.full(len(state), -1)
        key = state * (self.root + 1) + word
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, arcs[at], -1)

    def read(
        self, state: np.ndarray, word: np.ndarray, ended: tuple[np.ndarray, np.ndarray] | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """The weight of reading each word in its state, and the state after it.

        ``ended`` are the pairs and the triples that the words end where they are read: these
        tell the arcs, which then needn't be searched for."""
        weight, after = np.zeros(len(state)), np.empty(len(state), np.int64)
        open_ = np.arange(len(state))
        while len(open_):
            s, w = state[open_], word[open_]
            at_root = s == self.root
            done, w_done = open_[at_root], w[at_root]
            weight[done] += self.root_weights[w_done]
            after[done] = self.root_targets[w_done]
            open_, s, w = open_[~at_root], s[~at_root], w[~at_root]
            if ended is None:
                arc = self.find(s, w)
                found = arc >= 0
            else:
                arc = np.where(self.of_pair[s], ended[1][open_], ended[0][open_])
                found = self.arcs[arc]
            weight[open_[found]] += self.weights[arc[found]]
            after[open_[found]] = self.targets[arc[found]]
            open_, s = open_[~found], s[~found]
            weight[open_] += self.fail_weights[s]
            state[open_] = self.fail_to[s]
        return weight, after


def automaton(block: Block, total: np.ndarray, tokens: int, types: int, left: float) -> Automaton:
    """States, arcs and failure arcs for the n-grams of a block, from their corpus counts."""
    n, begin, root = len(block.words), len(total), len(total) + 1
    order, place = np.divmod(block.seen_at, max(n, 1))  # 0: word, 1: pair, 2: triple
    known = total > 0
    ends = total[block.words[block.starts + block.sizes - 1][:1]] if n else np.zeros(1, np.int64)
    times = np.append(total, ends)  # how often a state was left in training
    to_word = lambda at: block.words[at]
    pair, triple = known & (order == 1), known & (order == 2)
    p, t = place[pair], place[triple]
    sources, words, targets = np.zeros((3, begin), np.int32)
    weights = np.zeros(begin)
    sources[pair], sources[triple] = np.where(block.first[p], begin, to_word(p - 1)), block.pairs[t - 1]
    words[pair], words[triple] = to_word(p), to_word(t)
    targets[pair], targets[triple] = block.pairs[p], block.pairs[t]
    arcs = pair | triple
    weights[arcs] = np.log10(total[arcs] / (times[sources[arcs]] + left))
    fail_to = np.full(root + 1, root)
    fail_to[:begin][order == 1] = to_word(place[order == 1])
    return Automaton(
        arcs=arcs,
        weights=weights,
        sources=sources,
        words=words,
        targets=targets,
        of_pair=np.append(order == 1, [False, False]),
        fail_to=fail_to,
        fail_weights=np.log10(left) - np.log10(np.append(times, 0) + left),
        root_weights=np.log10((total + 1) / (tokens + types + 1)),
        root_targets=np.where(known, np.arange(begin), root),
        begin=begin,
        root=root,
    )


def walk(block: Block, model: Automaton) -> np.ndarray:
    """log10 probability of each text.

    Long texts are read in stretches, side by side. A stretch that isn't its text's
    first reads the two words before it from the root: two words always lead to the
    state that a single walk would carry, so the sum is the same.
    """
    per_text = -(-block.sizes // STRETCH)
    text = np.repeat(np.arange(len(per_text)), per_text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    ahead = np.where(number > 0, 2, 0)
    start = block.starts[text] + number * STRETCH - ahead
    size = np.minimum(STRETCH, block.sizes[text] - number * STRETCH) + ahead
    longest = np.argsort(-size, kind="stable")
    text, start, size, ahead = text[longest], start[longest], size[longest], ahead[longest]
    state = np.where(ahead > 0, model.root, model.begin)
    total = np.zeros(len(text))
    for step in range(int(size.max(initial=0))):
        n = int(np.searchsorted(-size, -step, side="left"))
        at = start[:n] + step
        weight, state[:n] = model.read(state[:n].copy(), block.words[at], (block.pairs[at], block.triples[at]))
        total[:n] += np.where(step >= ahead[:n], weight, 0.0)
    return np.bincount(text, weights=total, minlength=len(per_text))


def vocabulary(rows: DataFrame, text_col: str) -> tuple[int, int]:
    """Number of tokens and of distinct ones, end marks included.

    Words are counted in each task, in tables of bounded size, and their counts are
    added up by hash; the driver gets the two numbers.
    """

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def told() -> pa.RecordBatch:
            hashes = map(xxhash.xxh64_intdigest, counts)
            words = np.fromiter(hashes, np.uint64, len(counts)).view(np.int64)
            values = np.fromiter(counts.values(), np.int64, len(counts))
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array(values)], ["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                counts.update((text.as_py() or b"").lower().split())
                counts[b" "] += 1
                if len(counts) > _COUNTED:
                    yield told()
                    counts.clear()
        yield told()

    words = rows.select(text_col).mapInArrow(tables, "word long, n long")
    found = words.groupBy("word").agg(F.sum("n").alias("n")).agg(F.sum("n"), F.count("*")).first()
    return found[0] or 0, found[1]


def score(
    docs: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    left: float = 20.0,
    block_bytes: int = 6 << 20,
) -> DataFrame:
    """(id, trained, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    ``train`` tells the rows to learn from. Words are lower-cased (A-Z) runs
    without white space; an end mark follows as a token. base_score is the root's
    log10 probability with one added to each count, score the automaton's. NULL is
    the empty text, which has the end mark alone. Repeated rows count and are
    scored as often as they occur. Without training rows all counts are zero.
    Rows are dealt by their place in ``docs``, which should be a scan of a table: its
    rows come in the same order if a task is repeated.
    """
    rows = docs.select(F.col(id_col).alias("id"), train.alias("trained"), raw(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length(text_of(text_col)) + 8)).first()[0] or 0
    blocks = shards = max(1, math.ceil(size / block_bytes))
    tokens, types = vocabulary(rows.where("trained"), "text")
    place = F.xxhash64("id", F.monotonically_increasing_id())
    dealt = rows.select(
        F.pmod(place, F.lit(blocks)).cast("int").alias("block"), "id", "trained", "text"
    )

    def block_of(group: pa.Table) -> Block:
        train_rows = group.column("trained").to_numpy().astype(np.float64)
        return Block(group.column("text").to_pylist(), train_rows, shards)

    def ask(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        return block_of(group).questions(key[0].as_py())

    def traverse(group: pa.Table, answers: pa.Table) -> pa.Table:
        if not group.num_rows:
            return empty
        block = block_of(group)
        told = [answers.column(c).to_pylist() for c in ("shard", "others")]
        total = block.totals(list(zip(*told, strict=True)))
        model = automaton(block, total, tokens, types, left)
        add = lambda x: np.add.reduceat(x[block.words], block.starts)
        return pa.table({
            id_col: group.column("id"),
            "trained": group.column("trained"),
            "n_tokens": block.sizes,
            "n_known": add((total > 0).astype(np.int64)),
            "train_tokens": np.full(len(block.sizes), tokens, np.int64),
            "base_score": add(model.root_weights),
            "score": walk(block, model),
        })

    schema = StructType([
        StructField(id_col, docs.schema[id_col].dataType),
        StructField("trained", BooleanType()),
        *[StructField(c, LongType()) for c in ("n_tokens", "n_known", "train_tokens")],
        *[StructField(c, DoubleType()) for c in ("base_score", "score")],
    ])
    empty = to_arrow_schema(schema).empty_table()
    asked = dealt.groupBy("block").applyInArrow(ask, _ASK)
    answered = asked.groupBy("shard").applyInArrow(_answers, _ANSWER)
    blocks_and_answers = dealt.groupBy("block").cogroup(answered.groupBy("block"))
    return blocks_and_answers.applyInArrow(traverse, schema)
