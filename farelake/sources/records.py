"""CSV records that span lines, read by many tasks.

A line break inside quotes does not end a record, so where a record starts
depends on the quotes before it. Lines are read split by split, as any text:

1. Each split's quotes are counted; the running parity over a file's few splits
   tells whether a split begins inside quotes.
2. With that, every split cuts its own lines into records at the line starts
   with even parity. Whole records go straight on.
3. A record that a split's edge cuts comes out in pieces, at most two a split.
   Only these are gathered and joined.

A doubled quote inside quotes changes no parity. A file whose quotes do not
match up has no such records and is refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake.sources.working import working

#: Kinds of rows: a whole record, a piece that a later split goes on with, one that goes on or ends an earlier split's.
WHOLE, OPENS, FOLLOWS = 0, 1, 2


class QuoteError(Exception):
    """A file's quotes do not match up."""


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def split_parities(spark: SparkSession, path: str) -> DataFrame:
    """(``file``, ``block``, ``inside``): whether each split begins inside quotes; one row a split."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    splits = _lines(spark, path).groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    so_far = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    return splits.select(
        "file", "block", (F.coalesce(F.sum("odd").over(so_far), F.lit(0)) % 2 == 1).alias("inside"),
        (F.sum("odd").over(whole) % 2 == 1).alias("unmatched"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (value, file, block, inside) in order, split after split, to rows (file, block, kind, text, head)."""
    split, held, inside, kind, headed = None, [], False, WHOLE, False

    def rows(file: str, block: int, kinds: list[int], texts: list[str]) -> pa.RecordBatch:
        nonlocal headed
        n = len(texts)
        head = np.zeros(n, bool)
        head[0] = block == 0 and not headed
        headed = True
        return pa.RecordBatch.from_arrays(
            [pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64()), pa.array(kinds, pa.int32()), pa.array(texts, pa.string()), pa.array(head)],
            ["file", "block", "kind", "text", "head"])

    def last() -> Iterator[pa.RecordBatch]:
        if split is not None and held:
            # what was begun here and is not closed, or belongs to an earlier split altogether
            yield rows(*split, [FOLLOWS if kind == FOLLOWS else OPENS if inside else WHOLE], ["\n".join(held)])

    for batch in batches:
        values, files, blocks, insides = batch.columns
        block = blocks.to_numpy()
        name = files.dictionary_encode().indices.to_numpy()
        edges = np.flatnonzero((np.diff(block) != 0) | (np.diff(name) != 0)) + 1
        for a, b in zip(np.append(0, edges), np.append(edges, len(block))):
            if a == b:
                continue
            here = (files[int(a)].as_py(), int(block[a]))
            if here != split:
                yield from last()
                split, held, inside, headed = here, [], insides[int(a)].as_py(), False
                kind = FOLLOWS if inside else WHOLE
            lines = values.slice(int(a), int(b - a))
            odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2
            before = (np.cumsum(odd) - odd + inside) % 2 == 1
            starts = np.flatnonzero(~before)
            texts = lines.to_pylist()
            inside = bool((int(odd.sum()) + inside) % 2)
            first = int(starts[0]) if len(starts) else len(texts)
            held += texts[:first]
            if first == len(texts):
                continue
            kinds, out = [], []
            if held:
                kinds.append(kind)
                out.append("\n".join(held))
            ends = np.append(starts[1:], len(texts))
            out += [texts[s] if e - s == 1 else "\n".join(texts[s:e]) for s, e in zip(starts[:-1].tolist(), ends[:-1].tolist())]
            kinds += [WHOLE] * (len(out) - len(kinds))
            held, kind = texts[int(starts[-1]):], WHOLE
            if out:
                yield rows(*here, kinds, out)
    yield from last()


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(``text``, ``head``): the records of the files as text, and whether one is its file's first.

    Line breaks inside a record are ``\n``, whatever the file has. Whole
    records come in the order of the scan, those that a split's edge cuts after
    them. A record is held whole by one task.
    """
    parities = working(split_parities(spark, path), "csv-splits")
    if not parities.where("unmatched").isEmpty():
        raise QuoteError("the quotes do not match up")
    # one row a split
    marked = _lines(spark, path).join(F.broadcast(parities), ["file", "block"], "left").select(
        "value", "file", "block", F.coalesce("inside", F.raise_error(F.lit("the file's splits changed between two passes")).cast("boolean")).alias("inside"))
    pieces = working(marked.mapInArrow(_cut, "file string, block long, kind int, text string, head boolean"), "csv-records")
    cut = pieces.where(F.col("kind") != WHOLE).withColumn("late", F.col("kind") == OPENS)
    # a piece that follows belongs to the last record opened before it; of one split, it comes before what the split opens
    earlier = Window.partitionBy("file").orderBy("block", "late").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = F.last(F.when(F.col("late"), F.col("block")), ignorenulls=True).over(earlier)
    joined = cut.withColumn("opened", opened).groupBy("file", "opened").agg(
        F.sort_array(F.collect_list(F.struct("block", "late", "text"))).alias("_p"), F.bool_or("head").alias("head"))
    return pieces.where(F.col("kind") == WHOLE).select("text", "head").unionByName(
        joined.select(F.array_join(F.transform("_p", lambda x: x["text"]), "\n").alias("text"), "head"))
