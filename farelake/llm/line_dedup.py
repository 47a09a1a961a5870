"""Line dedup by pairwise alignment.

1. From each line the shortest run of consecutive lines with ``MIN_WORDS``
   words that starts there, and the shortest that ends there, are hashed. A
   run points to the earliest document that holds it, and each later holder is
   paired with that one. Any block that a document repeats is covered by such
   runs, whatever documents held its lines first. A run in any number of
   documents gives each of them one partner, so pairs grow with the lines, and
   no line needs leaving out.
2. Patience diff aligns the two documents: lines that are unique in both and in
   the same order are anchors, and the ranges between anchors are aligned
   likewise. A range without such lines is anchored on its runs, occurrence by
   occurrence.
3. Aligned blocks of at least ``MIN_WORDS`` words are deleted from the later
   document.
4. An alignment rises in both documents and takes a line once. Blocks in
   another order, or more often in the later document, are left to the next:
   the lines of runs that still hold lines to delete are aligned with the whole
   earlier document again, until none is left. Documents that more than
   ``ROUNDS`` alignments do not finish (thousands of lines made of a few) have
   their last runs aligned one by one.

So exactly those lines leave a document that belong to consecutive lines of
``MIN_WORDS`` words or more that some earlier document holds as consecutive
lines too. Both are taken as they came, before any deletion. A pair takes time
in proportion to its lines, times a logarithm.

Lines are compared without white space at their ends, and runs of lines by
64-bit hashes of their lines' hashes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, written

#: Words that a deleted block has at least. Lines under ``LINE_WORDS`` words repeat by chance; in a run they count like others.
MIN_WORDS = 20
LINE_WORDS = 3
#: Alignments of one pair, and nested ranges of one alignment.
ROUNDS, DEPTH = 8, 32
#: Base of the runs' hashes (odd, so that it has an inverse), and lines that are hashed at once.
BASE = 0x9E3779B97F4A7C13
BLOCK = 200_000


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of pairs with rising second numbers whose first numbers rise too."""
    tails: list[int] = []  # smallest end of a rising part by length
    ends: list[int] = []
    back: list[int] = []
    for k, (i, _) in enumerate(pairs):
        n = bisect_left(tails, i)
        if n == len(tails):
            tails.append(i)
            ends.append(k)
        else:
            tails[n], ends[n] = i, k
        back.append(ends[n - 1] if n else -1)
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _unique_lines(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    in_a, in_b = Counter(a), Counter(b)
    at = {x: i for i, x in enumerate(a) if in_a[x] == 1 and in_b.get(x) == 1}
    return _rising([(at[x], j) for j, x in enumerate(b) if x in at])


def _runs_in_turn(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Runs (by the line where they start, -1: none) that both hold: the first occurrence with the first, and so on."""
    places: dict[int, list[int]] = defaultdict(list)
    for i, x in enumerate(a):
        if x != -1:
            places[x].append(i)
    used: Counter = Counter()
    pairs = []
    for j, x in enumerate(b):
        if x != -1 and used[x] < len(places.get(x, ())):
            pairs.append((places[x][used[x]], j))
            used[x] += 1
    return _rising(pairs)


def aligned(a: list[int], b: list[int], runs_a: list | None = None, runs_b: list | None = None) -> list[tuple[int, int]]:
    """Aligned positions (i, j) with a[i] == b[j], rising in both; the runs are those that start at each line (or two lines)."""
    if runs_a is None:
        runs_a, runs_b = ([*zip(x, x[1:]), -1] for x in (a, b))
    out, ranges = [], [(0, len(a), 0, len(b), 0)]
    while ranges:
        a0, a1, b0, b1, depth = ranges.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1 or depth > DEPTH:
            continue
        anchors, deeper = _unique_lines(a[a0:a1], b[b0:b1]), depth + 1
        if not anchors:
            anchors, deeper = _runs_in_turn(runs_a[a0:a1], runs_b[b0:b1]), DEPTH + 1
        if anchors:
            last = (a0, b0)
            for i, j in [*((a0 + i, b0 + j) for i, j in anchors), (a1, b1)]:
                ranges.append((last[0], i, last[1], j, deeper))
                last = (i, j)
    return sorted(out)


def common_blocks(a: list[int], b: list[int], words: list[int], least: int, runs_a: list | None = None, runs_b: list | None = None) -> list[int]:
    """Positions in ``b`` of the aligned blocks with at least ``least`` of b's words."""
    out, block = [], []
    for i, j in [*aligned(a, b, runs_a, runs_b), (-2, -2)]:
        if block and (i, j) != (block[-1][0] + 1, block[-1][1] + 1):
            if sum(words[y] for _, y in block) >= least:
                out += [y for _, y in block]
            block = []
        block.append((i, j))
    return out


def runs(hashes: np.ndarray, words: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of ``least`` words of documents whose lines lie one after another: document, hash, first and last line.

    From each line the shortest run that starts there and the shortest that
    ends there, each place once. Equal lines give equal runs, so what makes a
    run the shortest in one document does so in any other.
    """
    n = len(hashes)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    before = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    line = np.arange(n)
    to = np.searchsorted(before, before[:-1] + least, "left") - 1
    ok = to < offsets[owner + 1]
    start, end = line[ok], to[ok]
    back = np.searchsorted(before, before[1:] - least, "right") - 1
    ok = back >= offsets[owner]
    ok[ok] = to[back[ok]] != line[ok]  # else it is the one that starts there
    start, end = np.concatenate([start, back[ok]]), np.concatenate([end, line[ok]])
    # sums of hash * BASE ** line, modulo 2 ** 64; divided by the power of the first line they are the same at any place
    power, inverse = (np.cumprod(np.append(np.uint64(1), np.full(n, x, np.uint64))) for x in (BASE, pow(BASE, -1, 1 << 64)))
    sums = np.cumsum(np.append(np.uint64(0), hashes.view(np.uint64) * power[:-1]))
    run = ((sums[end + 1] - sums[start]) * inverse[start]).view(np.int64)
    return owner[start], run, start - offsets[owner[start]], end - offsets[owner[start]]


def _covered(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` lines lie in some run."""
    covers = np.zeros(n + 1, np.int64)
    np.add.at(covers, start, 1)
    np.add.at(covers, end + 1, -1)
    return np.cumsum(covers)[:-1] > 0


def repeated(a: list[int], b: list[int], words: list[int], least: int, rounds: int = ROUNDS) -> list[int]:
    """Positions in ``b`` of the blocks with at least ``least`` of b's words that ``a`` holds, by alignment after alignment."""
    if set(a).isdisjoint(b):
        return []
    number = {x: k for k, x in enumerate(dict.fromkeys(b))}
    known = dict(zip(b, words))
    # a line that b lacks makes no common run, whatever its words
    owner, run, start, end = runs(np.array(a + b, np.int64), np.array([*(known.get(x, least) for x in a), *words]), np.array([0, len(a), len(a) + len(b)]), least)
    _, run = np.unique(run, return_inverse=True)
    mine = (owner == 1) & np.isin(run, run[owner == 0])
    at_a, at_b = np.full(len(a), -1), np.full(len(b), -1)
    shared = (owner == 0) & np.isin(run, run[owner == 1])
    at_a[start[shared]], at_b[start[mine]] = run[shared], run[mine]
    start, end = start[mine], end[mine]
    at_a = at_a.tolist()
    lines_a, lines_b = [number.get(x, -1) for x in a], np.array([number[x] for x in b])
    gone = np.zeros(len(b), bool)
    for _ in range(rounds):
        left = np.concatenate([[0], np.cumsum(~gone)])
        ahead = left[end + 1] > left[start]
        start, end = start[ahead], end[ahead]
        if not len(start):
            break
        # lines and runs outside those that are left match nothing
        view = np.where(_covered(start, end, len(b)), lines_b, len(number) + np.arange(len(b)))
        opens = np.full(len(b), -1)
        opens[start] = at_b[start]
        found = common_blocks(lines_a, view.tolist(), words, least, at_a, opens.tolist())
        if gone[found].all():
            break
        gone[found] = True
    left = np.concatenate([[0], np.cumsum(~gone)])
    ahead = left[end + 1] > left[start]
    if rounds == ROUNDS:
        gone |= _covered(start[ahead], end[ahead], len(b))
    return np.flatnonzero(gone).tolist()


def line_runs(rows: DataFrame, least: int) -> DataFrame:
    """(``doc``, ``run``, ``start``, ``end``) of each document's runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = np.cumsum(batch.column(1).value_lengths().to_numpy(zero_copy_only=False)) // BLOCK
            for b in np.unique(block):
                at = np.flatnonzero(block == b)
                part = batch.slice(int(at[0]), len(at))
                lines = part.column(1)
                offsets = np.concatenate([[0], np.cumsum(lines.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)])
                flat = lines.flatten()
                owner, hashes, start, end = runs(flat.field("line").to_numpy(), flat.field("words").to_numpy(), offsets, least)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(owner)), pa.array(hashes), pa.array(start, pa.int32()), pa.array(end, pa.int32())], ["doc", "run", "start", "end"])

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, run long, start int, end int")


def line_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = MIN_WORDS) -> DataFrame:
    """(id, ``_hash`` of the text, ``deleted``): for each document that repeats earlier ones, its lines to delete, counted from 0."""
    text = text_or_empty(text_column)
    lines = F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\r")))
    rows = docs.where(F.col(id_column).isNotNull()).select(
        F.struct(F.col(id_column).alias("id"), F.xxhash64(text).alias("hash")).alias("doc"),
        F.transform(lines, lambda x: F.struct(
            F.xxhash64(x).alias("line"), F.when(x == "", 0).otherwise(F.size(F.split(x, r"\s+"))).alias("words"))).alias("lines"),
    )
    rows = written(rows.dropDuplicates(["doc"]), "line-rows")  # repeated rows are one document
    known = line_runs(rows, least)
    # written, so that the join below reads two plain shuffles and Spark can split a hot run's rows
    first = written(known.groupBy("run").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first <> last").select("run", "first"), "line-first")
    pairs = known.join(first, "run").where("first <> doc").select("doc", "first").distinct()
    sequences = rows.select("doc", F.col("lines.line").alias("line"), F.col("lines.words").alias("words"))
    both = pairs.join(sequences, "doc").join(sequences.select(F.col("doc").alias("first"), F.col("line").alias("earlier")), "first").select("doc", "earlier", "line", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deleted = [repeated(a.as_py(), b.as_py(), w.as_py(), least) for a, b, w in zip(*(batch.column(c) for c in ("earlier", "line", "words")))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deleted, pa.list_(pa.int32()))], ["doc", "deleted"])

    kind = rows.schema["doc"].dataType.simpleString()
    found = both.mapInArrow(run, f"doc {kind}, deleted array<int>")
    # partners may name the same line, so a document's list is no longer than its lines
    return found.select("doc", F.explode("deleted").alias("line")).distinct().groupBy("doc").agg(
        F.array_sort(F.collect_list("line")).alias("deleted")
    ).select(F.col("doc.id").alias(id_column), F.col("doc.hash").alias("_hash"), "deleted")


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = MIN_WORDS) -> DataFrame:
    """The table with repeated blocks taken out of the text, and ``deleted_lines`` (their numbers from 0; empty if none).

    The earliest document by id keeps a block; of rows that share an id, the
    one with the smaller text hash counts as earlier, and equal rows are one
    document. The other lines stay as they are, joined by line breaks as
    before. Null ids and null texts are left alone; empty texts, tables
    without rows, and other columns pass through. An own column called
    ``deleted_lines`` is replaced.
    """
    found = line_duplicates(docs, id_column, text_column, least).select(
        F.col(id_column).alias("_ld_id"), F.col("_hash").alias("_ld_hash"), F.col("deleted").alias("_ld_deleted"))
    mine = docs.drop("deleted_lines").withColumn("_ld_of", F.xxhash64(text_or_empty(text_column)))
    joined = mine.join(found, (F.col(id_column) == F.col("_ld_id")) & (F.col("_ld_of") == F.col("_ld_hash")), "left")
    lines = F.split(F.col(text_column), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_ld_deleted"))
    rest = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    return (
        joined.withColumn(text_column, F.when(F.col("_ld_deleted").isNull(), F.col(text_column)).otherwise(rest))
        .withColumn("deleted_lines", F.coalesce("_ld_deleted", F.array().cast("array<int>")))
        .drop("_ld_id", "_ld_of", "_ld_hash", "_ld_deleted")
    )
