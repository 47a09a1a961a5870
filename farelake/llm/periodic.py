"""Periodic runs of words by online dyadic square catching.

A run is a stretch of consecutive words with smallest period q, of at least
``EXPONENT`` periods and ``LEAST`` words, that no neighbouring word extends.

1. On level k, each completed block of B = 2**k words holds a catcher, which
   waits for its block to come again at a distance of 2B-1 to 4B-2 words. A run
   of period q holds, in its first period, a completed block of the one level
   with 2B-1 <= q <= 4B-2, so that block's catcher meets the run.
2. Each appended word advances one suffix comparison a live catcher: the hash
   of the last B words against the catcher's block. On each level just two
   catchers are live for a word. Suffix hashes of a level come from those of the
   level below. Numpy takes all words of a stream of documents at once, level
   by level; the comparisons are those that word after word would make.
3. A catch is a square of period d. One whose copies do not go on for three
   periods cannot be part of a run; block hashes tell. The others are extended
   word by word both ways, and the squares that share a stretch merge into one
   run. Periods rise, so a square within a run of a smaller period is a power of
   it and is left out.

Words are compared by 64-bit hashes. Work is in proportion to words times the
logarithm of the longest document's, memory to the words of a stream, whose
documents are whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .words import parts, words

EXPONENT, LEAST = 4, 6
#: Words of one stream (whole documents) and bytes of one output batch, about.
STREAM = 1 << 19
OUTPUT = 32 << 20
_FACTORS = np.random.default_rng(20250311).integers(1, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def _stretch(words: np.ndarray, at: int, period: int, low: int, high: int) -> tuple[int, int]:
    """The longest stretch around ``at``, from ``low`` up to ``high``, whose words ``period`` apart are equal: start and end."""
    end, step = at, 64
    while end + period < high:
        n = min(step, high - period - end)
        differ = np.flatnonzero(words[end : end + n] != words[end + period : end + period + n])
        if len(differ):
            end += int(differ[0])
            break
        end, step = end + n, min(2 * step, 1 << 16)
    start, step = at, 64
    while start > low:
        n = min(step, start - low)
        differ = np.flatnonzero(words[start - n : start] != words[start - n + period : start + period])
        if len(differ):
            start += int(differ[-1]) + 1 - n
            break
        start, step = start - n, min(2 * step, 1 << 16)
    return start, end + period


def catch(hashes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run in a stream of documents, document k being words ``bounds[k]`` to ``bounds[k + 1]``."""
    suffix = hashes.view(np.uint64)  # hash of the ``block`` words from each word on
    found: list[tuple[int, int, int]] = []
    inside: np.ndarray | None = None  # where a run with period q around a word ends, less q
    longest, block, level = int(np.diff(bounds).max(initial=0)), 1, 0
    while EXPONENT * (2 * block - 1) <= longest:
        near = 2 * block - 1
        catchers = np.repeat(suffix[::block], block)
        squares = []
        for wait in (near, near + block):  # the two live catchers of each word
            meets = np.flatnonzero(suffix[wait:] == catchers[: max(0, len(suffix) - wait)])
            start = meets // block * block
            squares.append((start, meets + wait - start))
        start, period = (np.concatenate(x) for x in zip(*squares))
        high = bounds[np.searchsorted(bounds, start, "right")]
        ok = start + 3 * period + block <= high
        if inside is not None:
            ok &= start + period > inside[start]
        start, period = start[ok], period[ok]
        for j in range(9):  # three periods from the block on, in steps of a block
            at = start + np.minimum(j * block, 2 * period)
            same = suffix[at] == suffix[at + period]
            start, period = start[same], period[same]
        if len(start):
            if inside is None:
                inside = np.zeros(len(hashes), np.int64)
            _merge(hashes, bounds, start, period, inside, found)
        if len(suffix) <= block:
            break
        suffix = suffix[:-block] * _FACTORS[level] + suffix[block:]
        block, level = 2 * block, level + 1
    return found


def _merge(hashes: np.ndarray, bounds: np.ndarray, start: np.ndarray, period: np.ndarray, inside: np.ndarray, found: list[tuple[int, int, int]]) -> None:
    """Adds the runs of these squares, periods rising."""
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    cuts = np.flatnonzero(np.diff(period)) + 1
    for at in np.split(start, cuts):
        q = int(period[0])
        period = period[len(at):]
        at = at[at + q > inside[at]]
        while len(at):
            k = int(np.searchsorted(bounds, at[0], "right"))
            begin, end = _stretch(hashes, int(at[0]), q, int(bounds[k - 1]), int(bounds[k]))
            if end - begin >= max(LEAST, EXPONENT * q):
                found.append((begin, end, q))
                np.maximum(inside[begin:end], end - q, out=inside[begin:end])
            at = at[np.searchsorted(at, max(end - q, int(at[0]) + 1)):]


def word_hashes(data: bytes) -> np.ndarray:
    pieces = [np.fromiter(map(hash, w), np.int64, len(w)) for w in map(words, parts(data))]
    return pieces[0] if len(pieces) == 1 else np.concatenate([np.zeros(0, np.int64), *pieces])


def collapse(data: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that repeat a run's first period."""
    if not runs:
        return b" ".join(filter(None, (b" ".join(words(part)) for part in parts(data))))
    out, at = [], 0
    gone = np.zeros(max(end for _, end, _ in runs), bool)
    for start, end, period in runs:
        gone[start + period : end] = True
    for part in parts(data):
        mine = words(part)
        mask = gone[at : at + len(mine)]
        out.append(b" ".join([*compress(mine, ~mask), *mine[len(mask):]]))
        at += len(mine)
    return b" ".join(filter(None, out))


def find_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: id, ``n_words``, ``runs`` (start, length, period in words; by start, then period), ``collapsed``.

    ``collapsed`` is the text's words joined by one space, where each run keeps
    its first period. Null and empty texts, and texts without words, have no
    runs and an empty ``collapsed``. Null ids and repeated rows are rows like
    others, an empty table gives none, and other columns are ignored. A text is
    held whole by one task, with 8 bytes a word and level beside it.
    """
    rows = docs.select(F.col(id_column), text_or_empty(text_column).alias("_text"))
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def batch_of(ids: pa.Array, counts: list[int], runs: list[list[dict]], texts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(counts, pa.int64()), pa.array(runs, pa.list_(struct)), pa.array(texts, pa.binary()).cast(pa.string())],
            [id_column, "n_words", "runs", "collapsed"])

    def stream(ids: pa.Array, texts: list[bytes], hashes: list[np.ndarray]) -> pa.RecordBatch:
        counts = [len(h) for h in hashes]
        bounds = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        mine: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for start, end, period in catch(np.concatenate(hashes), bounds):
            k = int(np.searchsorted(bounds, start, "right")) - 1
            mine[k].append((start - int(bounds[k]), end - int(bounds[k]), period))
        lists = [[{"start": s, "length": e - s, "period": q} for s, e, q in sorted(r, key=lambda x: (x[0], x[2]))] for r in mine]
        return batch_of(ids, counts, lists, [collapse(t, r) for t, r in zip(texts, mine)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, hashes, begin, size, held = [], [], 0, 0, 0
            for i, value in enumerate(batch.column(1).cast(pa.binary())):
                texts.append(value.as_py())
                hashes.append(word_hashes(texts[-1]))
                size, held = size + len(hashes[-1]), held + len(texts[-1])
                if size >= STREAM or held >= OUTPUT or i + 1 == len(batch):
                    yield stream(batch.column(0).slice(begin, len(texts)), texts, hashes)
                    texts, hashes, begin, size, held = [], [], i + 1, 0, 0

    kind = rows.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_column}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
