"""Words and terms of whole texts, split in C and held part by part."""

from __future__ import annotations

import re
from collections.abc import Iterator

#: Bytes of text that are split at once, up to the next white space.
PART = 1 << 20
_WHITE = re.compile(rb"[\x20\x09-\x0D]")

#: A term's bytes are digits, letters (A-Z lower-cased) and all bytes beyond ASCII; others part terms.
TERM_BYTES = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def parts(data: bytes) -> Iterator[bytes]:
    """The text cut at white space into parts of about ``PART`` bytes."""
    at = 0
    while at < len(data):
        found = _WHITE.search(data, at + PART) if at + PART < len(data) else None
        end = found.end() if found else len(data)
        yield data if end - at == len(data) else data[at:end]
        at = end


def words(data: bytes) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+``: ``bytes.split`` parts at just these bytes."""
    return data.split()


def terms(data: bytes) -> list[bytes]:
    """The terms ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z lower-cased."""
    return data.translate(TERM_BYTES).split()
