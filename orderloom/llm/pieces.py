"""SentencePiece encoding by Aho-Corasick and Viterbi, and decoding.

An Aho-Corasick automaton over all pieces reads a text once. At every position
its output links give the pieces that end there, and each relaxes the best score
of that position: when the text ends, the best segmentation is known. Of equally
good segmentations the one whose last piece is longest is taken, at every
position.

No piece crosses from other characters into a space mark, nor holds a character
like the line feed that only occurs as bytes, so a text is cut there without
changing the result, and the segmentation of each part is remembered.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)
from sentencepiece import sentencepiece_model_pb2

from orderloom.llm.common import text_of

FILE = "piece_bpe_32k.model"
SPACE_MARK = "▁"
#: What an unknown character costs beyond the worst piece, and piece kinds of the format.
UNKNOWN_COST, NORMAL, BYTE, USER = 10.0, 1, 6, 4
REMEMBERED = 700_000


class Pieces:
    """A vocabulary with scores, and its automaton."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        """pieces: (text, score, kind) in order of their ids."""
        self.bytes = {}
        self.decoded = []
        self._automaton = ahocorasick.Automaton()
        self.normal: dict[str, tuple[int, float]] = {}
        for i, (piece, score, kind) in enumerate(pieces):
            if kind in (NORMAL, USER):
                self.normal[piece] = (i, score)
                self._automaton.add_word(piece, (len(piece), score, i))
                self.decoded.append(piece.replace(SPACE_MARK, " ").encode())
            elif kind == BYTE:
                self.bytes[int(piece[3:5], 16)] = i
                self.decoded.append(bytes([int(piece[3:5], 16)]))
            else:
                self.decoded.append(b"")
        self._automaton.make_automaton()
        self.unknown = min((s for _, s in self.normal.values()), default=0.0) - UNKNOWN_COST
        inner = any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.normal)
        feed = any("\n" in p for p in self.normal)
        part = f"{SPACE_MARK}*[^{SPACE_MARK}" + ("]*" if feed else "\n]*|\n")
        self._parts = None if inner else re.compile(part)
        self._known: dict[str, tuple[bytes, float]] = {}

    def segment(self, text: str) -> tuple[list[int], float]:
        """Ids and score of the best segmentation; unknown characters become their bytes."""
        n, normal, unknown = len(text), self.normal, self.unknown
        best = [0.0] * (n + 1)
        back, taken = [0] * (n + 1), [-1] * (n + 1)  # length and id of the last piece
        done = 0
        for last, (length, score, piece) in self._automaton.iter(text) if normal else ():
            while done < last:  # an unknown character may end at each position passed
                done += 1
                if text[done - 1] not in normal:
                    other = best[done - 1] + unknown
                    if not back[done] or other > best[done]:
                        best[done], back[done], taken[done] = other, 1, -1
            end = last + 1
            score += best[end - length]
            before = back[end]
            if not before or score > best[end] or (score == best[end] and length > before):
                best[end], back[end], taken[end] = score, length, piece
        while done < n:
            done += 1
            if text[done - 1] not in normal:
                other = best[done - 1] + unknown
                if not back[done] or other > best[done]:
                    best[done], back[done], taken[done] = other, 1, -1
        ids: list[int] = []
        at = n
        while at:
            if taken[at] >= 0:
                ids.append(taken[at])
            else:
                ids += [self.bytes.get(b, 0) for b in reversed(text[at - 1].encode())]
            at -= back[at]
        return ids[::-1], best[n]

    def encode(self, text: str) -> tuple[bytes, float]:
        """Ids (little-endian, 32 bits) and score of a text, which gets a space put before it."""
        marked = (SPACE_MARK + text).replace(" ", SPACE_MARK)
        known, out, total = self._known, [], 0.0
        for part in self._parts.findall(marked) if self._parts else [marked]:
            if not part:
                continue
            found = known.get(part)
            if found is None:
                ids, score = self.segment(part)
                found = (struct.pack(f"<{len(ids)}I", *ids), score)
                if len(known) >= REMEMBERED:
                    known.clear()
                if len(part) < 100:
                    known[part] = found
            out.append(found[0])
            total += found[1]
        return b"".join(out), total

    def decode(self, ids: bytes) -> str:
        """The text of ids; a space put before it is taken away again."""
        table = self.decoded
        text = b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])
        return text.decode(errors="replace").replace(SPACE_MARK, " ").removeprefix(" ")


@functools.cache
def load(path: str | None = None) -> Pieces:
    """One vocabulary for each Python worker. ``path``: a model file, the public one if None."""
    model = sentencepiece_model_pb2.ModelProto()
    with open(path or public_tokenizers.path(FILE), "rb") as file:
        model.ParseFromString(file.read())
    return Pieces([(p.piece, p.score, p.type) for p in model.pieces])


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """(id, n_ids, ids_crc32, score, round_trip[, ids]) of each row.

    ``round_trip`` tells whether decoding the ids gives the text again; it does
    unless the text holds the space mark itself. NULL is the empty text, which is
    one space mark. Repeated rows have equal results.
    """
    fields = [
        docs.schema[id_col], StructField("n_ids", LongType()), StructField("ids_crc32", LongType()),
        StructField("score", DoubleType()), StructField("round_trip", BooleanType()),
    ]
    schema = StructType(fields + ([StructField("ids", BinaryType())] if with_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = part.column(1).to_pylist()
                found = [pieces.encode(t) for t in texts]
                ids = [x for x, _ in found]
                same = [pieces.decode(x) == t for x, t in zip(ids, texts, strict=True)]
                arrays = [
                    part.column(0),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    pa.array([s for _, s in found], pa.float64()),
                    pa.array(same, pa.bool_()),
                ]
                arrays += [pa.array(ids, pa.binary())] if with_ids else []
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select(id_col, text_of(text_col).alias("text")).mapInArrow(run, schema)


def decode(
    encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None
) -> DataFrame:
    """(id, text) of each row of ids. NULL ids have an empty text."""
    schema = StructType([encoded.schema[id_col], StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            texts = [pieces.decode(x or b"") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=schema.names
            )

    return encoded.select(id_col, ids_col).mapInArrow(run, schema)
