"""Token ids of whole texts with a public byte-level BPE vocabulary.

The vocabulary file is a parameter and is never copied.  Texts are cut at single
spaces that stand between two other characters: there the vocabulary's
pre-tokenizer always cuts, so the ids of each chunk don't depend on what
surrounds it and can be kept in a bounded table.

The vocabulary's special token is cut out before anything else and becomes its one
id, as the tokenizer file says; ``specials=False`` takes it for ordinary text.
"""

from __future__ import annotations

import base64
import sys
from array import array
from functools import cache

import numpy as np

# The vocabulary's special tokens and their ids.
SPECIALS = {"<|endoftext|>": 50_256}

#: Chunks kept by a worker, and the longest chunk that is kept.
KEPT_CHUNKS, KEPT_CHARS = 200_000, 48


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class _Context(Exception):
    """A chunk whose white space needs the text around it."""


class _Chunks(dict):
    """Ids of chunks that stand behind ``before``: a space, or nothing (after a line's end)."""

    def __init__(self, encode, before: str, after_line: _Chunks | None = None) -> None:
        super().__init__()
        self.encode, self.before = encode, before
        self.after_line = self if after_line is None else after_line
        self.line = encode("\n")
        self.marks = {mark: encode(mark) for mark in ",."}

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Context
        if "\n" in chunk:
            # A lone line's end between other characters is a token of its own.
            first, *rest = chunk.split("\n")
            return self.line.join([self[first], *map(self.after_line.__getitem__, rest)])
        mark = self.marks.get(chunk[-1])
        if mark and chunk[:-1].isalpha():
            # So is a mark behind letters.
            ids = self[chunk[:-1]] + mark
        else:
            ids = self.encode(self.before + chunk)
        if len(chunk) <= KEPT_CHARS:
            if len(self) >= KEPT_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids


class Codec:
    """Texts to little-endian unsigned 32-bit ids."""

    def __init__(self, ranks: str, specials: bool = True) -> None:
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        bpe = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self._ids = bpe.encode_ordinary
        self._chunks = _Chunks(self._whole, " ", _Chunks(self._whole, ""))
        self._specials = {mark: np.array([i], "<u4").tobytes() for mark, i in SPECIALS.items()} if specials else {}

    def _whole(self, text: str) -> bytes:
        ids = array("I", self._ids(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        for mark, ids in self._specials.items():
            if mark in text:
                return ids.join(map(self.encode, text.split(mark)))
        if not text:
            return b""
        first, *rest = text.split(" ")
        try:
            return self._chunks.after_line[first] + b"".join(map(self._chunks.__getitem__, rest))
        except _Context:
            return self._whole(text)


@cache
def codec(ranks: str, specials: bool = True) -> Codec:
    """One for each worker process."""
    return Codec(ranks, specials)
