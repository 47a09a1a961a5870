"""Word shingles of whole texts as 64-bit hashes, and their MinHash signatures, in numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A text's set holds its
distinct 5-word shingles; a text with fewer words has one, the whole sequence;
a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .words import parts

WORDS = 5
MINIMA, BANDS = 128, 32
#: Bytes of text hashed at once; a longer text is hashed in parts cut at white space.
BLOCK = 1 << 20

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_SLOT = _rng.integers(1, 2**63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_A = _rng.integers(1, 2**31, MINIMA, np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 2**32, MINIMA, np.uint32)
_BAND_SLOT = _rng.integers(1, 2**63, (BANDS, MINIMA // BANDS), np.uint64) * np.uint64(2) + np.uint64(1)


def _power_table(base: int, n: int) -> np.ndarray:
    table = np.ones(1, np.uint64)
    step = base
    while len(table) < n:
        table = np.concatenate([table, table * np.uint64(step)])
        step = step * step % 2**64
    return table[:n]


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i up to n."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << (n - 1).bit_length()
        _POWERS["up"], _POWERS["down"] = _power_table(_BASE, size), _power_table(pow(_BASE, -1, 2**64), size)
    return _POWERS["up"], _POWERS["down"]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word's hash and start, in order; the data ends with white space."""
    white = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    word = ~white
    before = np.concatenate([[True], white[:-1]])
    starts = np.flatnonzero(word & before)
    ends = np.flatnonzero(white & ~before)
    up, down = _powers(len(data) + 1)
    upper = (data >= 0x41) & (data <= 0x5A)
    lower = np.where(upper, data | 0x20, data)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[lower] * up[: len(data)])])
    # a word's sum, moved to the start of the power table; with its length no other word of the same bytes can match
    return _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def _shingles(words: np.ndarray) -> np.ndarray:
    """The hash of each ``WORDS`` words in a row."""
    whole = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
    for j in range(WORDS):
        whole += words[j : j + len(whole)] * _SLOT[j]
    return _mixed(whole)


def _few(words: np.ndarray) -> np.ndarray:
    """The set of a text with less than ``WORDS`` words."""
    return _mixed((words * _SLOT[: len(words)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(words))) if len(words) else np.zeros(0, np.uint64)


def _long_set(text: bytes) -> np.ndarray:
    words = np.concatenate([_word_hashes(np.frombuffer(part + b"\n", np.uint8))[0] for part in parts(text)])
    return np.unique(_shingles(words)) if len(words) >= WORDS else _few(words)


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Each text's set, sorted."""
    begin = 0
    while begin < len(texts):
        end, size = begin, 0
        while end < len(texts) and (end == begin or size + len(texts[end]) <= BLOCK):
            size += len(texts[end]) + 1
            end += 1
        if size > BLOCK + 1:
            yield _long_set(texts[begin])
            begin = end
            continue
        part = texts[begin:end]
        data = np.frombuffer(b"\n".join(part) + b"\n", np.uint8)
        words, starts = _word_hashes(data)
        bounds = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in part]))
        whole = _shingles(words)
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield np.unique(whole[a : b - WORDS + 1]) if b - a >= WORDS else _few(words[a:b])
        begin = end


def signature(shingles: np.ndarray) -> np.ndarray:
    """``MINIMA`` universal hash minima (multiply-add modulo 2**32) of a non-empty set."""
    folded = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(folded), 2048):
        np.minimum(out, (folded[None, i : i + 2048] * _A[:, None] + _B[:, None]).min(1), out=out)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """Rows x ``BANDS`` keys, as signed 64-bit numbers."""
    grouped = signatures.reshape(len(signatures), BANDS, -1).astype(np.uint64)
    return _mixed((grouped * _BAND_SLOT).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 75 * union, of two sorted sets."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")  # merges the two sorted runs
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= 75 * (len(a) + len(b) - common)
