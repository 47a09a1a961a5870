"""Benchmark decontamination by suffix arrays of the training documents.

1. Each task joins the documents that it reads to shards of about ``SHARD``
   words and sorts the shard's suffixes. A suffix ends before the first word
   that no test item holds, since no match goes on beyond it, and is compared
   no further than the longest item goes.
2. Every suffix of every test item is searched by bisection. Its place in the
   array gives its longest verbatim match in the shard; if that is as long as
   the item's window, a second bisection gives all places of the window.
3. Words of documents inside any of these places are hit, and documents with
   hit words can be removed.

Nothing is shuffled. The items come in blocks of bounded size, broadcast one by
one; a task holds one block's vocabulary at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .item_blocks import item_blocks
from .words import parts, terms

WINDOW = 10
#: Words of one shard (whole documents), about.
SHARD = 1 << 19


@dataclass
class TestItems:
    """The test suffixes of a block of items. Words are numbered from 1; 0 is no word of the block."""

    vocabulary: list[bytes]
    ids: list[str]            # the items' ids, sorted
    codes: np.ndarray         # the items' words, each item followed by a 0
    suffix: np.ndarray        # where each test suffix starts in ``codes``
    item: np.ndarray          # the number of its item
    width: np.ndarray         # words of its window
    window: np.ndarray        # the number of its window; equal windows share one
    depth: int                # words of the longest item
    bits: int                 # of a word's number

    @property
    def packed(self) -> int:
        """Words that one 62-bit key holds."""
        return 62 // self.bits


def test_items(block: list[tuple[object, str]], width: int) -> TestItems:
    rows = sorted((str(item_id), terms(text.encode())) for item_id, text in block)
    rows = [(i, w) for i, w in rows if w]
    vocabulary = sorted({w for _, words in rows for w in words})
    number = {w: i + 1 for i, w in enumerate(vocabulary)}
    ids = sorted({i for i, _ in rows})
    place = {i: k for k, i in enumerate(ids)}
    codes: list[int] = []
    suffix, item, widths, window = [], [], [], []
    windows: dict[tuple[int, ...], int] = {}
    for item_id, words in rows:
        mine = [number[w] for w in words]
        w = min(width, len(mine))
        for j in range(len(mine) - w + 1):
            suffix.append(len(codes) + j)
            item.append(place[item_id])
            widths.append(w)
            window.append(windows.setdefault(tuple(mine[j : j + w]), len(windows)))
        codes += [*mine, 0]
    arrays = [np.array(x, np.int64) for x in (suffix, item, widths, window)]
    return TestItems(vocabulary, ids, np.array(codes, np.int32), *arrays, max((len(w) for _, w in rows), default=0), max(1, len(vocabulary).bit_length()))


def _keys(codes: np.ndarray, at: np.ndarray, room: np.ndarray, bits: int, n: int) -> np.ndarray:
    """The next ``n`` words from each place as one number, 0 for words past its ``room``."""
    key = np.zeros(len(at), np.int64)
    for j in range(n):
        key = (key << bits) | np.where(j < room, codes[np.minimum(at + j, len(codes) - 1)], 0)
    return key


class SuffixArray:
    """The sorted suffixes of ``codes`` with at least ``least`` words before the next 0; codes end with a 0."""

    def __init__(self, codes: np.ndarray, bits: int, depth: int, least: int):
        self.codes = codes
        n, packed = len(codes), 62 // bits
        ends = np.where(codes == 0, np.arange(n), n)
        self.room = np.minimum.accumulate(ends[::-1])[::-1] - np.arange(n)
        places = np.flatnonzero(self.room >= least)
        keys = _keys(codes, places, self.room[places], bits, packed)
        order = keys.argsort(kind="stable")
        self.places, self.heads = places[order], keys[order]
        opens = np.append(True, self.heads[1:] != self.heads[:-1])[: len(order)]  # of a group of equal words so far
        done = packed
        while done < depth:
            alone = opens & np.append(opens[1:], True)[: len(opens)]
            tied = np.flatnonzero(~alone)
            if not len(tied):
                break
            group, at = np.cumsum(opens)[tied], self.places[tied]
            keys = _keys(codes, at + done, self.room[at] - done, bits, packed)
            order = np.lexsort((keys, group))
            self.places[tied], keys = at[order], keys[order]
            opens[tied[1:]] |= keys[1:] != keys[:-1]
            done += packed

    def compare(self, ranks: np.ndarray, test: np.ndarray, at: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal words, and the sign of the difference, of the suffixes of these ranks and up to ``words`` words of ``test`` from ``at`` on."""
        place = self.places[ranks]
        equal, sign = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        going = np.arange(len(ranks))
        while len(going):
            going = going[equal[going] < words[going]]
            mine = self.codes[np.minimum(place[going] + equal[going], len(self.codes) - 1)]
            theirs = test[at[going] + equal[going]]
            same = (mine == theirs) & (mine > 0)
            sign[going[~same]] = np.sign(mine[~same].astype(np.int64) - theirs[~same])
            going = going[same]
            equal[going] += 1
        return equal, sign

    def bisect(self, low: np.ndarray, high: np.ndarray, test: np.ndarray, at: np.ndarray, words: np.ndarray, after: bool = False) -> np.ndarray:
        """The first rank from ``low`` up to ``high`` whose suffix is not less (``after``: is greater) than these words."""
        low, high = low.copy(), high.copy()
        while len(going := np.flatnonzero(low < high)):
            middle = (low[going] + high[going]) // 2
            sign = self.compare(middle, test, at[going], words[going])[1]
            right = sign <= 0 if after else sign < 0
            low[going[right]] = middle[right] + 1
            high[going[~right]] = middle[~right]
        return low


@dataclass
class Found:
    """What a shard holds of a block: each test suffix's longest match, and the places of the windows."""

    length: np.ndarray     # of each test suffix's longest match that fills its window, else 0
    place: np.ndarray      # one place of it
    window: np.ndarray     # windows that occur, by occurrence
    at: np.ndarray         # where
    width: np.ndarray      # its words


def search(codes: np.ndarray, items: TestItems) -> Found:
    """Searches every test suffix in the suffix array of ``codes``."""
    n = len(items.suffix)
    length, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
    none = np.zeros(0, np.int64)
    if not n:
        return Found(length, place, none, none, none)
    array = SuffixArray(codes, items.bits, items.depth, int(items.width.min()))
    zero = np.flatnonzero(items.codes == 0)
    rest = zero[np.searchsorted(zero, items.suffix)] - items.suffix  # words to the item's end
    # by their first words, all suffixes at once; few are left to be compared word by word
    head = np.minimum(items.width, items.packed)
    key = _keys(items.codes, items.suffix, head, items.bits, items.packed)
    low = np.searchsorted(array.heads, key)
    high = np.searchsorted(array.heads, key + (np.int64(1) << (items.bits * (items.packed - head))))
    hope = np.flatnonzero(low < high)
    low, high, at = low[hope], high[hope], items.suffix[hope]
    rank = array.bisect(low, high, items.codes, at, rest[hope])
    for neighbour in (rank - 1, rank):
        ok = np.flatnonzero((neighbour >= low) & (neighbour < high))
        equal = array.compare(neighbour[ok], items.codes, at[ok], rest[hope[ok]])[0]
        better = ok[equal > length[hope[ok]]]
        length[hope[better]], place[hope[better]] = equal[equal > length[hope[ok]]], array.places[neighbour[better]]
    full = length >= items.width
    length[~full] = 0
    full = full[hope]
    _, one = np.unique(items.window[hope[full]], return_index=True)
    chosen = np.flatnonzero(full)[one]
    low, high, at, width = low[chosen], high[chosen], at[chosen], items.width[hope[chosen]]
    first = array.bisect(low, high, items.codes, at, width)
    counts = array.bisect(first, high, items.codes, at, width, after=True) - first
    ranks = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    return Found(length, place, np.repeat(items.window[hope[chosen]], counts), array.places[ranks], np.repeat(width, counts))


def shard_codes(texts: list[bytes], vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The documents' words by number, a 0 after each document, and where each document starts (and the last ends)."""
    number = {w: i + 1 for i, w in enumerate(vocabulary)}.get
    pieces, bounds = [], [0]
    for text in texts:
        mine = [np.fromiter(map(number, t, repeat(0)), np.int32, len(t)) for t in map(terms, parts(text))]
        pieces += [*mine, np.zeros(1, np.int32)]
        bounds.append(bounds[-1] + sum(map(len, mine)) + 1)
    return np.concatenate(pieces), np.array(bounds, np.int64)


def _shards(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """The batch's texts by shards: the first row, and the texts. About 6 bytes are a word."""
    begin, texts, held = 0, [], 0
    for i, value in enumerate(batch.column(column).cast(pa.binary())):
        texts.append(value.as_py())
        held += len(texts[-1])
        if held >= 6 * SHARD or i + 1 == len(batch):
            yield begin, texts
            begin, texts, held = i + 1, [], 0


def _pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((left << 32) | right)
    return both >> 32, both & 0xFFFFFFFF


def _items_of(document: np.ndarray, found: Found, items: TestItems) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, item) pairs from the document of each occurrence."""
    document, window = _pairs(document, found.window)
    of_window, item = _pairs(items.window, items.item)
    first, last = np.searchsorted(of_window, window, "left"), np.searchsorted(of_window, window, "right")
    counts = last - first
    at = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    return _pairs(np.repeat(document, counts), item[at])


def _sent_blocks(docs: DataFrame, items: DataFrame, item_id_column: str, item_text_column: str, width: int) -> list:
    send = docs.sparkSession.sparkContext.broadcast
    return [send(test_items(block, width)) for block in item_blocks(items, item_id_column, item_text_column)]


def _matched(rows: DataFrame, blocks: list) -> DataFrame:
    """``_row`` of each row, and what its ``_text`` holds of the blocks of items."""

    def one_shard(row: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
        names: list[list[str]] = [[] for _ in texts]
        hit = bounds = None
        for sent in blocks:
            items = sent.value
            codes, bounds = shard_codes(texts, items.vocabulary)
            found = search(codes, items)
            covers = np.zeros(len(codes) + 1, np.int64)
            np.add.at(covers, found.at, 1)
            np.add.at(covers, found.at + found.width, -1)
            covered = np.cumsum(covers)[:-1] > 0
            hit = covered if hit is None else hit | covered
            for d, item in zip(*_items_of(np.searchsorted(bounds, found.at, "right") - 1, found, items)):
                names[d].append(items.ids[item])
        edges = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
        start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        owner = np.searchsorted(bounds, start, "right") - 1
        spans = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32()),
            pa.StructArray.from_arrays([pa.array(start - bounds[owner]), pa.array(end - bounds[owner])], ["start", "end"]))
        n_hit = np.bincount(owner, end - start, len(texts)).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [row, pa.array(np.diff(bounds) - 1), pa.array(n_hit), pa.array([sorted(n) for n in names], pa.list_(pa.string())), spans],
            ["_row", "n_words", "n_hit", "items", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in _shards(batch, 1):
                yield one_shard(batch.column(0).slice(begin, len(texts)), texts)

    kind = rows.schema["_row"].dataType.simpleString()
    return rows.mapInArrow(run, f"_row {kind}, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>")


def find_matches(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text",
    item_id_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """One row per row: id, ``n_words``, ``n_hit``, ``items`` (ids as strings, sorted), ``spans`` (hit words: start, end).

    An item of fewer words than ``window`` is a window itself; one without
    words, or without an id, is none. Rows of one item id count as one item.
    Null and empty texts have no words. Null ids and repeated rows are rows like
    others, an empty table gives none, without items nothing is hit, and other
    columns are ignored. A document's words are held by one task.
    """
    rows = docs.select(F.col(id_column).alias("_row"), text_or_empty(text_column).alias("_text"))
    return _matched(rows, _sent_blocks(docs, items, item_id_column, item_text_column, window)).withColumnRenamed("_row", id_column)


def remove_contaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, text_column: str = "text", item_id_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all their columns, that hold no window of any item."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), text_or_empty(text_column).alias("_text"))
    found = _matched(rows, _sent_blocks(docs, items, item_id_column, item_text_column, window))
    return found.where(F.col("n_hit") == 0).select("_row.*")


def longest_matches(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text",
    item_id_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """Each matched item's longest verbatim match: ``item``, ``length`` in words, ``item_start``, the document's id, ``doc_start``.

    Of several as long, one with the smallest start in the item, and of the
    places that the shards name for it, the one with the smallest id.
    """
    rows = docs.select(F.col(id_column).alias("_id"), text_or_empty(text_column).alias("_text"))
    blocks = _sent_blocks(docs, items, item_id_column, item_text_column, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in _shards(batch, 1):
                for sent in blocks:
                    block = sent.value
                    codes, bounds = shard_codes(texts, block.vocabulary)
                    found = search(codes, block)
                    at = np.flatnonzero(found.length)
                    owner = np.searchsorted(bounds, found.place[at], "right") - 1
                    starts = np.append(0, np.flatnonzero(block.codes == 0) + 1)
                    inside = block.suffix[at] - starts[np.searchsorted(starts, block.suffix[at], "right") - 1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block.ids[i] for i in block.item[at]], pa.string()), pa.array(found.length[at]), pa.array(inside),
                         batch.column(0).take(pa.array(owner + begin)), pa.array(found.place[at] - bounds[owner])],
                        ["item", "length", "item_start", id_column, "doc_start"])

    kind = rows.schema["_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"item string, length long, item_start long, `{id_column}` {kind}, doc_start long")
    best = F.min(F.struct((-F.col("length")).alias("less"), "item_start", F.col(id_column), "doc_start")).alias("best")
    return found.groupBy("item").agg(best).select(
        "item", (-F.col("best.less")).alias("length"), "best.item_start", F.col(f"best.`{id_column}`").alias(id_column), "best.doc_start")
