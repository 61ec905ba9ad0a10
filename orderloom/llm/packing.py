"""Vector bin packing of token sequences.

A sequence has three limits at once: tokens, segments and loss-bearing tokens.
The dot-product heuristic fills one sequence after another: of the waiting
examples that fit, the one whose demand has the largest dot product with the
room left (each measured in units of its limit) goes in. Where nothing fits whole
any more, the best example is cut at the room that is left.

Every task packs the rows it reads, a bounded number of examples at a time;
nothing is shuffled. What a task has left at its end is cut into sequences whose
lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from orderloom.llm.bpe import encoder
from orderloom.llm.common import text_of

END_ID = 0
#: Sequences a task can number.
PER_TASK = 1 << 40
_NUMBERS = (
    "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens",
)


@dataclass
class Limits:
    """Of one sequence."""

    tokens: int = 1024
    segments: int = 128
    loss: int = 1024


@dataclass
class Example:
    """ids of an example and the running count of loss-bearing ones; ``at`` is the cut so far."""

    key: object
    ids: np.ndarray
    loss: np.ndarray
    at: int = 0

    def left(self) -> tuple[int, int]:
        return len(self.ids) - self.at, int(self.loss[-1] - self.loss[self.at])

    def room_for(self, tokens: int, loss: int) -> int:
        """Tokens that can be cut off the front within both limits."""
        last = int(np.searchsorted(self.loss, self.loss[self.at] + loss, side="right")) - 1
        return min(tokens, last - self.at, len(self.ids) - self.at)


@dataclass
class Bin:
    """A sequence being filled: (example, start, length) in order."""

    tokens: int = 0
    loss: int = 0
    pieces: list[tuple[Example, int, int]] = field(default_factory=list)

    def add(self, example: Example, length: int) -> None:
        start = example.at
        self.pieces.append((example, start, length))
        self.tokens += length
        self.loss += int(example.loss[start + length] - example.loss[start])
        example.at += length


class Packer:
    """Packs examples in the order of arrival, ``waiting`` at a time."""

    def __init__(self, limits: Limits, waiting: int = 256):
        self.limits, self.waiting = limits, waiting
        self._rest: list[Example] = []
        self._open = Bin()

    def add(self, example: Example) -> Iterator[Bin]:
        """Whole sequences are cut off a long example at once; its rest waits."""
        most = self.limits
        while example.left()[0] >= most.tokens or example.left()[1] > most.loss:
            full = Bin()
            full.add(example, example.room_for(most.tokens, most.loss))
            yield full
        if example.left()[0]:
            self._rest.append(example)
        if len(self._rest) >= self.waiting:
            yield from self._fill(self.waiting // 4)

    def _fill(self, keep: int) -> Iterator[Bin]:
        """Fill sequences until ``keep`` examples wait."""
        most, rest = self.limits, self._rest
        demand = np.array([e.left() for e in rest], np.int64).reshape(-1, 2)
        alive, count = np.ones(len(rest), bool), len(rest)
        while count > keep:
            bin_ = self._open
            tokens, loss = most.tokens - bin_.tokens, most.loss - bin_.loss
            segments = most.segments - len(bin_.pieces)
            if tokens and segments:
                dot = (
                    demand[:, 0] * (tokens / most.tokens**2)
                    + demand[:, 1] * (loss / max(most.loss, 1) ** 2)
                    + segments / most.segments**2
                )
                fits = alive & (demand[:, 0] <= tokens) & (demand[:, 1] <= loss)
                if fits.any():
                    i = int(np.argmax(np.where(fits, dot, -1)))
                    length = int(demand[i, 0])
                else:
                    i = int(np.argmax(np.where(alive, dot, -1)))
                    length = rest[i].room_for(tokens, loss)
                if length:
                    bin_.add(rest[i], length)
                    demand[i] = rest[i].left()
                    if not demand[i, 0]:
                        alive[i], count = False, count - 1
                    continue
            yield bin_
            self._open = Bin()
        self._rest = [e for e, x in zip(rest, alive, strict=True) if x]

    def finish(self) -> Iterator[Bin]:
        yield from self._fill(0)
        pieces, self._open = self._open.pieces, Bin()
        total = sum(length for _, _, length in pieces)
        sizes = [1 << i for i in reversed(range(total.bit_length())) if total >> i & 1]
        if total == self.limits.tokens:
            sizes = [total]
        cut = Bin()
        for example, start, length in pieces:
            example.at = start
            while length:
                part = min(length, sizes[0] - cut.tokens)
                cut.add(example, part)
                length -= part
                if cut.tokens == sizes[0]:
                    yield cut
                    cut = Bin()
                    sizes.pop(0)


def pack(
    examples: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    limits: Limits | None = None,
    waiting: int = 256,
    path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and loss_tokens, with ``with_ids`` also the piece's ids (little-endian, 32 bits).

    An example is the ids of its prompt (not loss-bearing), of its text
    (loss-bearing) and an end id (loss-bearing). NULL is empty: such an example is
    its end id alone. Repeated rows are examples of their own. ``sequence_id`` is
    unique over the result and the same when a task is repeated on the same rows.
    """
    limits = limits or Limits()
    fields = [examples.schema[id_col]] + [StructField(c, LongType()) for c in _NUMBERS]
    schema = StructType(fields + ([StructField("ids", BinaryType())] if with_ids else []))

    def example(key: object, prompt: str | None, text: str) -> Example:
        encode = encoder(path).ids
        head = encode(prompt) if prompt else b""
        ids = np.frombuffer(head + encode(text) + END_ID.to_bytes(4, "little"), "<u4")
        loss = np.arange(len(ids) + 1) - len(head) // 4
        return Example(key, ids, np.maximum(loss, 0) if head else loss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() * PER_TASK
        packer, done, kind = Packer(limits, waiting), 0, None

        def rows(bins: Iterator[Bin]) -> pa.RecordBatch:
            nonlocal done
            keys, numbers, ids = [], [], []
            for bin_ in bins:
                offset = 0
                for e, start, length in bin_.pieces:
                    own = e.ids[start : start + length].tobytes()
                    lossy = int(e.loss[start + length] - e.loss[start])
                    keys.append(e.key)
                    numbers.append(
                        (start, length, zlib.crc32(own), len(e.ids), first + done, offset, lossy)
                    )
                    if with_ids:
                        ids.append(own)
                    offset += length
                done += 1
            columns = np.array(numbers, np.int64).reshape(-1, len(_NUMBERS)).T
            arrays = [pa.array(keys, kind)] + [pa.array(c, pa.int64()) for c in columns]
            arrays += [pa.array(ids, pa.binary())] if with_ids else []
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        for batch in batches:
            kind = batch.column(0).type
            for start in range(0, batch.num_rows, 512):
                some = zip(*[c.to_pylist() for c in batch.slice(start, 512).columns], strict=True)
                yield rows(x for row in some for x in packer.add(example(*row)))
        if kind is not None:
            yield rows(packer.finish())

    prompt = F.col(prompt_col) if prompt_col else F.lit(None).cast("string")
    return examples.select(id_col, prompt.alias("prompt"), text_of(text_col).alias("text")).mapInArrow(
        run, schema
    )
