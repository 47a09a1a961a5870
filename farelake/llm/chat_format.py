"""Chat formatting by columnar byte assembly.

A turn becomes ``### role``, a line break, the text, a line break and
``</turn>``. Inside roles and texts ``\\``, ``#`` and ``<`` are written as
``\\\\``, ``\\h`` and ``\\l`` (and a role's line break as ``\\n``), so neither
control string can occur there and the output reads back to the input exactly.

Per batch, numpy computes all segments' lengths, their running offsets and the
scatter indices, and copies headers and contents into one buffer that becomes
the Arrow column.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed strings of the template.
START, MIDDLE, END = b"### ", b"\n", b"\n</turn>\n"
TRAINED_ROLE = "assistant"
#: Bytes of input that are assembled at once.
BLOCK = 1_000_000

_CODES = {0x5C: 0x5C, 0x23: 0x68, 0x3C: 0x6C, 0x0A: 0x6E}
_CODE = np.zeros(256, np.uint8)
for _byte, _letter in _CODES.items():
    _CODE[_byte] = _letter
_IN_TEXT = _CODE.copy()
_IN_TEXT[0x0A] = 0


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data and row offsets of a string column without nulls."""
    strings = strings.cast(pa.large_string())
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    if strings.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(strings) + 1, np.int64)
    return np.frombuffer(strings.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _escaped(data: np.ndarray, offsets: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    special = code[data] != 0
    if not special.any():
        return data, offsets
    shift = np.concatenate([[0], np.cumsum(special)])
    at = np.arange(len(data)) + shift[:-1]
    out = np.empty(len(data) + shift[-1], np.uint8)
    out[at] = np.where(special, 0x5C, data)
    out[at[special] + 1] = code[data[special]]
    return out, offsets + shift[offsets]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All turns' bytes in one buffer, the turns' offsets, and where each turn's text starts and ends."""
    role, role_at = _escaped(*_bytes_of(roles), _CODE)
    text, text_at = _escaped(*_bytes_of(texts), _IN_TEXT)
    pool = np.concatenate([np.frombuffer(START + MIDDLE + END, np.uint8), role, text])
    n, fixed = len(roles), len(START + MIDDLE + END)
    lengths = np.empty((n, 5), np.int64)
    sources = np.empty((n, 5), np.int64)
    lengths[:, 0], sources[:, 0] = len(START), 0
    lengths[:, 1], sources[:, 1] = np.diff(role_at), fixed + role_at[:-1]
    lengths[:, 2], sources[:, 2] = len(MIDDLE), len(START)
    lengths[:, 3], sources[:, 3] = np.diff(text_at), fixed + len(role) + text_at[:-1]
    lengths[:, 4], sources[:, 4] = len(END), len(START + MIDDLE)
    offsets = np.concatenate([[0], np.cumsum(lengths.ravel())])
    out = np.empty(offsets[-1], np.uint8)
    # the k-th output byte comes from the pool at its segment's source, as far in as it is into the segment
    out[:] = pool[np.repeat(sources.ravel() - offsets[:-1], lengths.ravel()) + np.arange(offsets[-1])]
    begins = offsets[:-1].reshape(n, 5)
    return out, np.append(begins[:, 0], offsets[-1]), begins[:, 3], begins[:, 4]


def _list_of_longs(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, pa.int64()))


def _format_block(ids: pa.Array, turns: pa.ListArray) -> pa.RecordBatch:
    flat = turns.flatten()
    rows_at = np.concatenate([[0], np.cumsum(turns.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    roles, texts = flat.field("role"), flat.field("text")
    data, turn_at, text_from, text_to = assemble(roles, texts)
    offsets = turn_at[rows_at]
    formatted = pa.LargeStringArray.from_buffers(len(ids), pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data))
    row = np.repeat(np.arange(len(ids)), np.diff(rows_at))
    trained = np.asarray(roles.cast(pa.large_string()).to_pandas() == TRAINED_ROLE, bool)
    counts = np.bincount(row[trained], minlength=len(ids))
    spans = [_list_of_longs((x - offsets[row])[trained], counts) for x in (text_from, text_to)]
    return pa.RecordBatch.from_arrays([ids, formatted.cast(pa.string()), *spans], ["_id", "formatted", "loss_start", "loss_end"])


def format_chats(turns: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """One row per conversation: id, ``formatted``, ``loss_start``, ``loss_end``.

    The last two are byte offsets of each assistant text (escaped) within
    ``formatted``, in order. Rows follow their turn, then role and text, nulls
    first, so ties and repeated rows have one order. Null roles and texts
    count as empty; null ids form one conversation; an empty table gives no
    rows; other columns are ignored. A conversation is one training sample, and
    is held whole by the task that writes it, like a text.
    """
    order = F.struct(
        F.col(turn_column).alias("turn"), F.coalesce(F.col(role_column), F.lit("")).alias("role"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    gathered = (
        turns.groupBy(F.col(id_column).alias("_id")).agg(F.sort_array(F.collect_list(order)).alias("_turns"))
        .select("_id", F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("_turns"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([sum(len(t["text"]) for t in x) for x in batch.column(1).to_pylist()])
            block = np.cumsum(sizes) // BLOCK
            for b in np.unique(block):
                rows = np.flatnonzero(block == b)
                part = batch.slice(int(rows[0]), len(rows))
                yield _format_block(part.column(0), part.column(1))

    kind = gathered.schema["_id"].dataType.simpleString()
    out = gathered.mapInArrow(run, f"_id {kind}, formatted string, loss_start array<long>, loss_end array<long>")
    return out.withColumnRenamed("_id", id_column)


_NAMES = {chr(letter): chr(byte) for byte, letter in _CODES.items()}


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _NAMES[m[1]], text) if "\\" in text else text


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs that a formatted conversation holds."""
    out = []
    for turn in formatted.split(END.decode())[:-1]:
        role, _, text = turn.removeprefix(START.decode()).partition(MIDDLE.decode())
        out.append((unescape(role), unescape(text)))
    return out


def read_loss(formatted: str, starts: list[int], ends: list[int]) -> list[str]:
    """The unescaped texts under the loss mask."""
    data = formatted.encode()
    return [unescape(data[a:b].decode()) for a, b in zip(starts, ends)]
