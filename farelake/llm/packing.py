"""Best-fit packing of token pieces into sequences, with a swap-based local search.

``token_pieces`` encodes the documents and cuts the long ones. ``pack`` deals
the pieces at random into groups of about ``GROUP`` pieces, packs each group
on its own and never looks at the tokens again. A group wastes at most part of
one sequence more than all pieces together would, so groups of thousands cost
next to nothing, and a task holds one group however large the corpus is.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, written
from .tokens import encoder_for, vocabulary_text

GROUP = 8192
END_OF_DOCUMENT = 0


def token_pieces(
    docs: DataFrame, vocabulary_path: str, pattern: str | None = None, capacity: int = 2048,
    id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32`` (and ``ids``, little-endian uint32).

    A document is its ids and one id 0 after them; null and empty texts are
    that id alone. Only documents over ``capacity`` are cut, and only their
    first piece is shorter. Repeated rows give their pieces each time; an
    empty table gives none. Other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary_text(vocabulary_path))
    rows = docs.select(F.col(id_column), text_or_empty(text_column).alias("_text"))
    kind = rows.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    end = END_OF_DOCUMENT.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_for(sent.value, pattern).encode
        for batch in batches:
            source, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                data = memoryview(encode(text.as_py()) + end)
                n = len(data) // 4
                bounds = [0, n] if n <= capacity else [0, *range(n % capacity or capacity, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    source.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(data[4 * a : 4 * b]))
                    if with_ids:
                        ids.append(bytes(data[4 * a : 4 * b]))
            columns = [batch.column(0).take(pa.array(source, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))]
            names = [id_column, "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(ids, pa.binary())] if with_ids else []), names + ["ids"] * with_ids)

    return rows.mapInArrow(cut, schema)


class _Bins:
    """Bins of one group: the piece lengths in each, and the items by bin."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.capacity = capacity
        self.lengths = lengths
        self.items: list[list[int]] = []
        self.gap: list[int] = []

    def best_fit(self) -> None:
        """Longest first, each into the fullest bin that takes it."""
        at: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        open_gaps = 0  # bit g is set when a bin with gap g exists
        for item in np.argsort(-self.lengths, kind="stable").tolist():
            n = int(self.lengths[item])
            fitting = open_gaps >> n
            if fitting:
                gap = n + (fitting & -fitting).bit_length() - 1
                k = at[gap].pop()
                if not at[gap]:
                    open_gaps &= ~(1 << gap)
                self.items[k].append(item)
            else:
                k, gap = len(self.items), self.capacity
                self.items.append([item])
                self.gap.append(gap)
            self.gap[k] = gap - n
            at[gap - n].append(k)
            open_gaps |= 1 << (gap - n)

    def fewest(self) -> int:
        return math.ceil(int(self.lengths.sum()) / self.capacity)

    def used(self) -> int:
        return sum(1 for x in self.items if x)

    def local_search(self) -> None:
        """Exchanges one for one, two for one, one for two, and moves, from emptier bins into fuller ones.

        Each exchange makes the fuller bin fuller, so the sum of squared fills
        rises and the emptiest bins run dry. Of two documents for one, those
        looked at are the longest of up to half the room with any other of its
        bin; the other exchanges are looked for among all documents. Ends when
        none of them helps any bin, or when no fewer bins are possible.
        """
        while self.used() > self.fewest() and self._round():
            pass

    def _round(self) -> bool:
        """Goes once over all bins, fullest first; whether anything changed."""
        order = sorted((k for k, x in enumerate(self.items) if x and self.gap[k]), key=lambda k: (self.gap[k], k))
        # by bin and length, the items; by length, the ranks of the bins that hold it, and the emptiest one
        held: list[dict[int, list[int]]] = [{} for _ in order]
        ranks: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        for r, k in enumerate(order):
            for i in self.items[k]:
                held[r].setdefault(int(self.lengths[i]), []).append(i)
            for n in held[r]:
                ranks[n].append(r)
        emptiest = np.array([x[-1] if x else -1 for x in ranks])
        gaps = [self.gap[k] for k in order]
        changed = False

        def largest(limit: int, above: int) -> int:
            """The greatest length up to ``limit`` in a bin emptier than rank ``above``, or 0."""
            found = np.flatnonzero(emptiest[1 : limit + 1] > above)
            return int(found[-1]) + 1 if len(found) else 0

        def take(r: int, n: int) -> int:
            item = held[r][n].pop()
            if not held[r][n]:
                del held[r][n]
                ranks[n].pop(bisect_left(ranks[n], r))
                emptiest[n] = ranks[n][-1] if ranks[n] else -1
            gaps[r] += n
            return item

        def give(r: int, n: int, item: int) -> None:
            if n not in held[r]:
                held[r][n] = []
                insort(ranks[n], r)
                emptiest[n] = ranks[n][-1]
            held[r][n].append(item)
            gaps[r] -= n

        for r in range(len(order)):
            while held[r] and gaps[r]:
                gap = gaps[r]
                best, out, came, other = 0, (), (), -1
                if n := largest(gap, r):
                    best, out, came, other = n, (), (n,), emptiest[n]
                mine = list(held[r])
                for x, a in enumerate(mine):
                    if best == gap:
                        break
                    if (n := largest(a + gap, r)) - a > best:
                        best, out, came, other = n - a, (a,), (n,), emptiest[n]
                    # one for two: both come from one bin, so that bin has room for what it gets
                    if one := largest(max(1, (a + gap) // 2), r):
                        bin_of = held[emptiest[one]]
                        for b in bin_of:
                            if best < one + b - a <= gap and (b != one or len(bin_of[one]) > 1):
                                best, out, came, other = one + b - a, (a,), (one, b), emptiest[one]
                    for b in mine[x if len(held[r][a]) > 1 else x + 1 :]:
                        if a + b + gap <= self.capacity and (n := largest(a + b + gap, r)) - a - b > best:
                            best, out, came, other = n - a - b, (a, b), (n,), emptiest[n]
                if not best:
                    break
                other = int(other)
                gone, new = [(n, take(r, n)) for n in out], [(n, take(other, n)) for n in came]
                for n, item in gone:
                    give(other, n, item)
                for n, item in new:
                    give(r, n, item)
                changed = True
        for r, k in enumerate(order):
            self.items[k] = [i for x in held[r].values() for i in x]
            self.gap[k] = gaps[r]
        return changed


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length."""
    bins = _Bins(np.asarray(lengths, np.int64), capacity)
    bins.best_fit()
    bins.local_search()
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for number, items in enumerate(x for x in bins.items if x):
        at = 0
        for i in sorted(items):
            sequence[i], offset[i] = number, at
            at += int(lengths[i])
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = 2048, length_column: str = "length") -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: gapless from 0 within a sequence of at most ``capacity``.

    Lengths are from 1 to ``capacity``; a null or other length raises an error.
    Equal rows are packed each on its own.
    """
    length = F.col(length_column)
    wrong = length.isNull() | (length < 1) | (length > capacity)
    checked = F.when(wrong, F.raise_error(F.lit(f"a length is null or not from 1 to {capacity}"))).otherwise(length)
    pieces = written(pieces.withColumn(length_column, checked.cast(pieces.schema[length_column].dataType)), "pieces")
    groups = max(1, math.ceil(pieces.count() / GROUP))
    # the table is written, so a retried task numbers its rows alike
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"

    def one_group(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        sequence, offset = pack_lengths(frame[length_column].to_numpy(), capacity)
        return frame.drop(columns="_group").assign(sequence_id=(int(key[0]) << 32) + sequence, offset=offset)

    return dealt.groupBy("_group").applyInPandas(one_group, schema)
