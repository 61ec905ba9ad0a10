"""Byte-level BPE ids of whole texts, from a public rank file.

The rank file holds the vocabulary of ``byte_bpe_50k.json``. A single space
between two words always starts a new piece of text for the merges, so each word
can be encoded alone and remembered; only words not met before reach the encoder.
"""

from __future__ import annotations

import base64
import functools
import struct

import numpy as np
import public_tokenizers
import tiktoken

RANKS = "byte_bpe_50k.tiktoken"
#: Words remembered in a Python worker at most.
REMEMBERED = 600_000
MARKS = ".,;:!?"


class Encoder:
    def __init__(self, path: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        own = tiktoken.Encoding(
            "public",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens={},
        )
        self._encode, self._piece = own.encode_ordinary, own._encode_single_piece
        self._first: dict[str, bytes] = {}
        self._later: dict[str, bytes] = {}

    def _new(self, word: str, space: str, known: dict[str, bytes]) -> bytes:
        letters = word.rstrip(MARKS)
        if letters.isalpha():  # one piece by the pattern, and the marks another one
            ids = self._piece(space + letters) + self._encode(word[len(letters) :])
        else:
            ids = self._encode(space + word)
        ids = struct.pack(f"<{len(ids)}I", *ids)
        if len(known) >= REMEMBERED:
            known.clear()
        known[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """All ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if "  " in text or text[-1] == " " or text[0] == " ":
            return np.array(self._encode(text), "<u4").tobytes()
        first, *rest = text.split(" ")
        head = self._first.get(first) or self._new(first, "", self._first)
        later = self._later
        get, new = later.get, self._new
        return head + b"".join([get(w) or new(w, " ", later) for w in rest])


@functools.cache
def encoder(path: str | None = None) -> Encoder:
    """One encoder for each Python worker. ``path``: a rank file, the public one if None."""
    return Encoder(path or public_tokenizers.path(RANKS))
