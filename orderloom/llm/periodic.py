"""Runs of words that repeat with a period, by a sparse DP over diagonals.

A cell (i, lag) of the DP exists where word i equals the word ``lag`` before it;
its match length is that of the cell before it on the same diagonal plus one. A
diagonal that ends after enough matches is a run: ``length = matches + lag``.

Frequent words have too many earlier occurrences to open a cell for each. A run
of period q and at least 3 q matches shows in the words around each cell, too, so
of the earlier occurrences only those count that agree in the next k words, k the
least power of two above the lag, and of these the nearest: inside a run that one
lies exactly one smallest period back (a nearer one would give the run a smaller
period), so no run is lost, every diagonal kept has the smallest period, and each
power of two opens at most one cell per word. Agreement in 2 k words is agreement
in k words here and k words on, so the numbers of longer stretches come from those
of the shorter ones; where no stretch occurs twice any more, the search ends.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from orderloom.llm.common import raw

#: A run has at least so many words, and so many periods.
WORDS, PERIODS = 6, 4
#: Bytes of text split into words at once, and of results sent back at once.
PIECE, SENT = 1 << 20, 4 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")

RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of ``text``, about a megabyte of text at a time."""
    at = 0
    while at < len(text):
        space = _SPACE.search(text, at + PIECE)
        end = space.start() if space else len(text)
        yield text[at:end].split()
        at = end


def word_numbers(text: bytes) -> np.ndarray:
    """A number for each word of the text, equal for equal words."""
    known: dict[bytes, int] = defaultdict(count().__next__)
    found = [np.fromiter(map(known.__getitem__, words), np.int64, len(words)) for words in pieces(text)]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def periodic_runs(numbers: np.ndarray, words: int = WORDS, periods: int = PERIODS) -> np.ndarray:
    """(start, length, period) of each run, by start, then period. ``periods`` is 4 at least."""
    n, width, names, found = len(numbers), 1, numbers, []
    while 2 * width <= n and periods * width <= n:
        # stretches of 2 width words: one number for equal ones, and the way back to the nearest
        here = names[: n - 2 * width + 1]
        both = here * (int(names.max()) + 1) + names[width:]
        order = np.argsort(both, kind="stable")
        same = both[order[1:]] == both[order[:-1]]
        if not same.any():
            break
        lag = np.zeros(len(both), np.int64)
        lag[order[1:][same]] = (order[1:] - order[:-1])[same]
        names = np.empty(len(both), np.int64)
        names[order] = np.cumsum(np.append(0, ~same))
        # cells of the diagonals of this width, in order: a diagonal goes on with the next word
        at = np.flatnonzero((lag >= width) & (lag < 2 * width))
        width *= 2
        if not len(at):
            continue
        ends = np.flatnonzero((np.diff(at) != 1) | (np.diff(lag[at]) != 0))
        first, last = at[np.append(0, ends + 1)], at[np.append(ends, len(at) - 1)]
        period = lag[first]
        length = last + width - first + period
        long = length >= np.maximum(words, periods * period)
        found.append(np.stack([first - period, length, period], axis=1)[long])
    runs = np.concatenate([*found, np.zeros((0, 3), np.int64)])
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed(text: bytes, runs: np.ndarray) -> bytes:
    """The words joined by one space, without those that a run has after its first period."""
    if not len(runs):
        return b" ".join([b" ".join(words) for words in pieces(text)])
    out, at, drop = [], 0, runs[:, 0] + runs[:, 2]
    until = runs[:, 0] + runs[:, 1]
    for words in pieces(text):
        gone = np.zeros(len(words) + 1, np.int64)
        inside = (until > at) & (drop < at + len(words))
        np.add.at(gone, np.maximum(drop[inside] - at, 0), 1)
        np.add.at(gone, np.minimum(until[inside] - at, len(words)), -1)
        kept = np.cumsum(gone[:-1]) == 0
        out.append(b" ".join([w for w, k in zip(words, kept.tolist(), strict=True) if k]))
        at += len(words)
    return b" ".join([part for part in out if part])


def runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    periods: int = PERIODS,
) -> DataFrame:
    """(id, n_words, runs, collapsed) of each row of ``docs``.

    Words are runs without white space, numbered from 0. A run is a stretch with
    smallest period q and at least ``words`` words and ``periods`` q words that no
    neighbouring word extends; runs: array of (start, length, period) by start,
    then period. ``collapsed`` is the text's words, joined by one space, without
    those that any run contains after its first q words. NULL and empty texts have
    no words, no runs and an empty collapsed text. Repeated rows have equal results;
    a NULL id stays NULL; other columns are not read.
    """
    if periods < 4:
        raise ValueError("the nearest occurrence finds runs of four periods and more")
    schema = StructType([
        StructField(id_col, docs.schema[id_col].dataType),
        StructField("n_words", LongType()),
        StructField("runs", ArrayType(RUN)),
        StructField("collapsed", StringType()),
    ])
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in RUN.names]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, size, rows = 0, 0, []
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                numbers = word_numbers(text)
                found = periodic_runs(numbers, words, periods)
                each = [dict(zip(RUN.names, x, strict=True)) for x in found.tolist()]
                rows.append((len(numbers), each, collapsed(text, found)))
                size += len(text)
                if size > SENT or i + 1 == batch.num_rows:
                    n, each, texts = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(first, len(rows)),
                            pa.array(n, pa.int64()),
                            pa.array(each, kind),
                            pa.array(texts, pa.binary()).cast(pa.string()),
                        ],
                        names=schema.names,
                    )
                    first, size, rows = i + 1, 0, []

    return docs.select(id_col, raw(text_col).alias("text")).mapInArrow(run, schema)
