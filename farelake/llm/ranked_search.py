"""Ranked lexical search: a hybrid of term-at-a-time and document-at-a-time evaluation.

1. The items' terms are the vocabulary of a block of items. One pass over the
   documents counts each one's terms, and its occurrences of the vocabulary.
2. Counts over all documents give every term's weight.
3. Each task indexes the documents that it reads, up to ``SHARD`` at a time:
   posting lists by document, each posting with its exact share of a score, and
   each list with its largest share.
4. An item's short lists are summed term by term into accumulators. Their sorted
   documents then act as one iterator, whose bound is the largest accumulator,
   beside the long lists. Document by document, in strides, iterators whose
   bounds together reach the k-th best score so far name the candidates; the
   others are only looked up for candidates that can still get there.
5. The shards' best ``k`` meet in one window per item. Only they are shuffled.

The scores are exact, so the result does not depend on how documents are dealt.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, written
from .item_blocks import item_blocks
from .words import parts, terms

#: Documents and postings of one shard, and documents of one stride.
SHARD, POSTINGS, STRIDE = 1 << 16, 1 << 23, 4096
#: A list of up to this share of a shard's documents is short.
SHORT = 1 / 64
#: Terms whose counts are summed at once.
STREAM = 1 << 19
#: Fixed values of the score: the saturation of occurrences, the share of the length, the scale.
LENGTH_SHARE, LENGTH_SCALE, SATURATION, SCALE = 25, 100, 12, 1_000_000_000


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def count_terms(docs: DataFrame, vocabulary: list[bytes], id_column: str, text_column: str) -> DataFrame:
    """One row per document: id, ``n`` (its terms), ``terms`` (numbers in the vocabulary, rising), ``counts``."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(id_column), text_or_empty(text_column).alias("_text"))

    def summed(ids: pa.Array, sizes: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
        keys = np.concatenate([np.zeros(0, np.int64), *(x[x >= 0] | (i << 32) for i, x in enumerate(found))])
        keys, counts = np.unique(keys, return_counts=True)
        offsets = pa.array(np.searchsorted(keys >> 32, np.arange(len(sizes) + 1)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array((keys & 0xFFFFFFFF).astype(np.int32))),
             pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32)))], [id_column, "n", "terms", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(sent.value)}.get
        for batch in batches:
            begin, sizes, found, held = 0, [], [], 0
            for i, value in enumerate(batch.column(1).cast(pa.binary())):
                pieces = [np.fromiter(map(number, t, repeat(-1)), np.int64, len(t)) for t in map(terms, parts(value.as_py()))]
                sizes.append(sum(map(len, pieces)))
                found.append(np.concatenate([np.zeros(0, np.int64), *(p[p >= 0] for p in pieces)]))
                held += sizes[-1]
                if held >= STREAM or i + 1 == len(batch):
                    yield summed(batch.column(0).slice(begin, len(sizes)), sizes, found)
                    begin, sizes, found, held = i + 1, [], [], 0

    kind = rows.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_column}` {kind}, n long, terms array<int>, counts array<int>")


def document_counts(counted: DataFrame, terms_known: int) -> dict[int, int]:
    """Documents that hold each term; at most one entry a term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(terms_known, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(), minlength=terms_known)
        term = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int32()), pa.array(held[term])], ["term", "n"])

    rows = counted.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    return {r["term"]: r["n"] for r in rows}


class Shard:
    """Posting lists of a shard's documents, which are numbered in the order of their ids."""

    def __init__(self, length_terms: np.ndarray, owner: np.ndarray, term: np.ndarray, count: np.ndarray, weight: np.ndarray):
        """``length_terms``: each document's 12 * m; the other arrays have one entry a posting (``weight`` one a term)."""
        order = np.lexsort((owner, term))
        self.size = len(length_terms)
        self.docs, term, count = owner[order], term[order], count[order].astype(np.int64)
        self.shares = weight[term] * (SCALE * count // (1000 * count + length_terms[self.docs]))
        self.starts = np.searchsorted(term, np.arange(len(weight) + 1))

    def _lists(self, item: list[tuple[int, int]]) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[tuple[np.ndarray, np.ndarray]]]:
        short, long = [], []
        for term, times in item:
            at = slice(self.starts[term], self.starts[term + 1])
            if at.stop > at.start:
                (short if at.stop - at.start <= self.size * SHORT + 8 else long).append((self.docs[at], self.shares[at] * times))
        return short, long

    def best(self, item: list[tuple[int, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the ``k`` best with a score above 0, best first, ties to the smaller number."""
        short, iterators = self._lists(item)
        least = 1  # a candidate scores this much
        if short:
            docs, at = np.unique(np.concatenate([d for d, _ in short]), return_inverse=True)
            sums = np.zeros(len(docs), np.int64)
            np.add.at(sums, at, np.concatenate([s for _, s in short]))
            iterators.append((docs, sums))
            if len(sums) >= k:  # what these documents have already
                least = max(least, int(np.partition(sums, len(sums) - k)[len(sums) - k]))
        iterators.sort(key=lambda x: int(x[1].max()))
        reach = np.concatenate([[0], np.cumsum([int(s.max()) for _, s in iterators], dtype=np.int64)])
        top_docs, top = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for begin in range(0, self.size, STRIDE):
            # the first iterators cannot lift a document to ``least`` by themselves
            first = int(np.searchsorted(reach, least, "left")) - 1
            if first >= len(iterators):
                break
            sums = np.zeros(STRIDE, np.int64)
            for docs, shares in iterators[first:]:
                a, b = np.searchsorted(docs, (begin, begin + STRIDE))
                sums[docs[a:b] - begin] += shares[a:b]
            found = np.flatnonzero((sums + reach[first] >= least) & (sums > 0))
            score, found = sums[found], found + begin
            for i in range(first - 1, -1, -1):
                if not len(found):
                    break
                docs, shares = iterators[i]
                at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                score = score + np.where(docs[at] == found, shares[at], 0)
                hopeful = score + reach[i] >= least
                found, score = found[hopeful], score[hopeful]
            if len(found):
                top_docs, top = np.concatenate([top_docs, found]), np.concatenate([top, score])
                order = np.lexsort((top_docs, -top))[:k]
                top_docs, top = top_docs[order], top[order]
                if len(top) == k:
                    least = max(least, int(top[-1]))
        positive = top > 0
        return top_docs[positive], top[positive]


def best_of_shards(counted: DataFrame, items: list[list[tuple[int, int]]], weight: np.ndarray, documents: int, all_terms: int, k: int, id_column: str) -> DataFrame:
    """(``item``, id, ``score``): the best ``k`` of each shard for each item."""
    sent = counted.sparkSession.sparkContext.broadcast((items, weight))
    kind = counted.schema[id_column].dataType.simpleString()

    def search(rows: pa.Table) -> pa.RecordBatch | None:
        rows = rows.filter(rows.column(id_column).is_valid()).sort_by(id_column).combine_chunks()
        if not len(rows):
            return None
        items, weight = sent.value
        lists = rows.column("terms").combine_chunks()
        owner = np.repeat(np.arange(len(rows)), lists.value_lengths().to_numpy(zero_copy_only=False))
        m = LENGTH_SCALE - LENGTH_SHARE + LENGTH_SHARE * rows.column("n").to_numpy() * documents // all_terms
        shard = Shard(SATURATION * m, owner, lists.flatten().to_numpy(), rows.column("counts").combine_chunks().flatten().to_numpy(), weight)
        found = [shard.best(item, k) for item in items]
        numbers = np.repeat(np.arange(len(items)), [len(d) for d, _ in found])
        docs, scores = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found))
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), rows.column(id_column).combine_chunks().take(pa.array(docs)), pa.array(scores)], ["item", id_column, "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= SHARD or sum(len(b.column(2).flatten()) for b in held) >= POSTINGS:
                if (out := search(pa.Table.from_batches(held))) is not None:
                    yield out
                held = []
        if held and (out := search(pa.Table.from_batches(held))) is not None:
            yield out

    return counted.mapInArrow(run, f"item long, `{id_column}` {kind}, score long")


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = 20, id_column: str = "doc_id", text_column: str = "text",
    item_id_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """Each item's ``k`` best documents: the item's id, ``rank`` (from 1), the document's id, ``score``.

    Only scores above 0 count; equal scores go by the smaller id. Null and
    empty texts have no terms: such documents do not count for the weights, and
    such items give no rows. Documents without an id count for the weights but
    are not ranked; items without one are left out. Repeated rows are documents,
    or items, of their own. Empty tables give no rows; other columns are
    ignored. A document's terms are held by one task, 8 bytes each.
    """
    spark = docs.sparkSession
    kind, item_kind = docs.schema[id_column].dataType.simpleString(), items.schema[item_id_column].dataType.simpleString()
    out = [spark.createDataFrame([], f"`{item_id_column}` {item_kind}, rank int, `{id_column}` {kind}, score long")]
    for block in item_blocks(items, item_id_column, item_text_column):
        bags = [Counter(terms(text.encode())) for _, text in block]
        vocabulary = sorted(set().union(*bags))
        if not vocabulary:
            continue
        counted = written(count_terms(docs, vocabulary, id_column, text_column), "term-counts")
        documents, all_terms = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not all_terms:
            continue
        holding = document_counts(counted, len(vocabulary))
        weight = np.array([term_weight(documents, holding[i]) if i in holding else 0 for i in range(len(vocabulary))], np.int64)
        number = {t: i for i, t in enumerate(vocabulary)}
        asked = [[(number[t], n) for t, n in bag.items() if weight[number[t]] > 0] for bag in bags]
        found = best_of_shards(counted, asked, weight, documents, all_terms, k, id_column)
        best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col(id_column))
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], f"item long, _item_id {item_kind}")
        # one row an item of the block, which the driver held
        out.append(ranked.join(F.broadcast(names), "item").select(F.col("_item_id").alias(item_id_column), "rank", id_column, "score"))
    return reduce(DataFrame.unionByName, out)
