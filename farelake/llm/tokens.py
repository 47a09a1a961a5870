"""Token ids of whole texts, one cached word group at a time.

Both public vocabularies split a text before any merge, and always in front
of a space that stands between two non-space characters. So a text cut at
such spaces encodes piece by piece to the ids of the whole text, and pieces
repeat: a worker encodes a piece once and looks it up afterwards. A text with
other white space at a cut is cut more carefully.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from struct import pack

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Pieces in each of a worker's two cache generations, and the longest piece kept (characters).
CACHE_PIECES = 300_000
LONGEST_CACHED = 48

_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def vocabulary_text(path: str) -> str:
    """The tokenizer file's content (a couple of MB), read on the driver and sent along with the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def library_tokenizer(vocabulary: str) -> Tokenizer:
    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class _Unsafe(Exception):
    """White space beside a cut."""


class PieceEncoder(dict):
    """Maps a piece that follows a space to the ids of space and piece, as little-endian uint32 bytes.

    Two generations bound the memory: when the young one is full it becomes
    the old one, and pieces that are seen again move up.
    """

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.old: dict[str, bytes] = {}
        self.encode_piece = encode

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Unsafe
        if len(piece) > LONGEST_CACHED:
            return self.encode_piece(" " + piece)
        ids = self.old.pop(piece, None)
        if ids is None:
            ids = self.encode_piece(" " + piece)
        if len(self) >= CACHE_PIECES:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if first and not first[-1].isspace():
            try:
                return self.encode_piece(first) + b"".join(map(self.__getitem__, rest))
            except _Unsafe:
                pass
        first, *rest = _SAFE_SPACE.split(text)
        return (self.encode_piece(first) if first else b"") + b"".join(self.encode_piece(" " + p) for p in rest)


def library_encoder(tokenizer: Tokenizer) -> PieceEncoder:
    return PieceEncoder(lambda piece: np.array(tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes())


def byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one character: printable Latin-1 as itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def ranked_encoder(vocabulary: str, pattern: str) -> PieceEncoder:
    """A byte-level vocabulary's encoder that merges by rank in tiktoken, several times as fast on unseen pieces.

    Characters outside Latin scripts, where the libraries' Unicode tables may
    differ, and special tokens go to the ``tokenizers`` library itself.
    """
    parsed = json.loads(vocabulary)
    alphabet = byte_alphabet()
    special = [t["content"] for t in parsed["added_tokens"]]
    ranks = {bytes(alphabet[c] for c in token): i for token, i in parsed["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    slow = library_encoder(library_tokenizer(vocabulary)).encode_piece

    def encode(piece: str) -> bytes:
        if not piece.isascii() and max(piece) > "ɏ":
            return slow(piece)
        for token in special:
            if token in piece:
                return slow(piece)
        ids = fast.encode_ordinary(piece)
        return pack(f"<{len(ids)}I", *ids)

    return PieceEncoder(encode)


_ENCODERS: dict[tuple, PieceEncoder] = {}


def encoder_for(vocabulary: str, pattern: str | None = None) -> PieceEncoder:
    """The worker's encoder of a vocabulary, kept from task to task; by rank if the byte-level ``pattern`` is given."""
    key = (vocabulary, pattern)
    if key not in _ENCODERS:
        if len(_ENCODERS) >= 2:
            _ENCODERS.clear()
        _ENCODERS[key] = ranked_encoder(vocabulary, pattern) if pattern else library_encoder(library_tokenizer(vocabulary))
    return _ENCODERS[key]
