"""Balanced shards by multiway Karmarkar-Karp differencing over indivisible groups.

Rows with equal texts form one group, and a group stays in one shard. Groups
are dealt at random into buckets. Within a bucket the differencing repeatedly
takes the two partial partitions with the largest spread and adds them in
opposite order, until one partition into ``shards`` parts is left. Its parts
become the indivisible groups of the next, much smaller level, and so on until
one bucket holds all. Groups too large for a bucket to balance, and the groups
of one bucket kept whole for filling up, rise to the next level as they are.
So every task holds a bucket, whatever the number of rows, and the last level
evens out what the others left.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, written

BUCKET = 16_384
#: A group of at least this share of one shard's part of a bucket is left to the next level.
LARGE = 0.5


def difference(sizes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each size, by largest-spread-first differencing.

    A partial partition is a list of ``shards`` sums in falling order. Joining
    two adds the largest sum of one to the smallest of the other. The joins
    form a tree, and walking it from the top turns places into shards.
    """
    n = len(sizes)
    if n == 0:
        return np.zeros(0, np.int64)
    zeros = [0] * (shards - 1)
    sums: dict[int, list[int]] = {i: [int(s), *zeros] for i, s in enumerate(sizes)}
    heap = [(-s[0], i) for i, s in sums.items()]
    heapq.heapify(heap)
    joined: list[tuple[int, int, list[int], int]] = []  # left, right, order of the sums, new node
    new = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        left, right = sums.pop(a), sums.pop(b)
        added = [x + y for x, y in zip(left, reversed(right))]
        order = sorted(range(shards), key=added.__getitem__, reverse=True)
        sums[new] = [added[k] for k in order]
        joined.append((a, b, order, new))
        heapq.heappush(heap, (sums[new][-1] - sums[new][0], new))
        new += 1
    # the shard that each place of a node's list went to
    shard_of: dict[int, list[int]] = {new - 1: list(range(shards))}
    for a, b, order, node in reversed(joined):
        mine = shard_of.pop(node)
        places = [0] * shards  # by the place before sorting
        for k, place in enumerate(order):
            places[place] = mine[k]
        shard_of[a] = places
        shard_of[b] = places[::-1]
    return np.array([shard_of[i][0] for i in range(n)], np.int64)


def _bucket_level(groups: DataFrame, shards: int, buckets: int) -> tuple[DataFrame, DataFrame]:
    """One level: (atom, parent) of every group, and the next level's groups (atom, size).

    ``groups`` is written, so its rows are dealt alike when a task is retried.
    """
    total = groups.agg(F.sum("size")).first()[0]
    fair = total / buckets / shards
    dealt = groups.withColumn("_bucket", F.when(F.col("size") >= LARGE * fair, -1).otherwise(F.pmod(F.xxhash64("atom"), F.lit(buckets))))

    def differenced(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "atom"], ascending=False)  # ties by atom, not by arrival
        part = difference(frame["size"].to_numpy(), shards)
        return pd.DataFrame({"atom": frame["atom"], "parent": [f"{int(key[0])}/{p}" for p in part], "size": frame["size"]})

    split = dealt.where(F.col("_bucket") > 0).groupBy("_bucket").applyInPandas(differenced, "atom string, parent string, size long")
    risen = dealt.where(F.col("_bucket") <= 0).select("atom", F.concat(F.lit("="), "atom").alias("parent"), "size")
    level = written(split.unionByName(risen), "shard-level")
    return level.select("atom", "parent"), level.groupBy(F.col("parent").alias("atom")).agg(F.sum("size").alias("size"))


def balanced_groups(groups: DataFrame, shards: int) -> DataFrame:
    """``groups`` (atom string, size long; atoms unique) to (atom, shard)."""
    current = written(groups, "shard-groups")
    levels: list[DataFrame] = []
    while (count := current.count()) > BUCKET:
        # a bucket's groups become `shards` atoms, so each level is smaller by far; two buckets at least, one of them kept whole
        buckets = max(2, math.ceil(count / BUCKET))
        level, rest = _bucket_level(current, shards, buckets)
        # at most buckets * shards / LARGE groups are large, so the levels end
        levels.append(level)
        current = written(rest, "shard-groups")

    def last(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "atom"], ascending=False)
        return pd.DataFrame({"atom": frame["atom"], "shard": difference(frame["size"].to_numpy(), shards).astype(np.int32)})

    # written, so that no retried task places an atom anew
    placed = written(current.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(last, "atom string, shard int"), "shard-placed")
    for level in reversed(levels):
        placed = level.join(placed.withColumnRenamed("atom", "parent"), "parent").select("atom", "shard")
    return placed


def shard_documents(docs: DataFrame, shards: int = 16, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``size`` is the text's UTF-8 bytes plus 1; null counts as empty. Equal
    texts share a shard, and the shards' sizes are near equal, as far as the
    groups allow. ``slot`` numbers a shard's rows from 0 without gaps;
    repeated rows get a slot each. ``grown_shard`` is null under this law
    (``bytes``). An empty table gives no rows; other columns are ignored.
    """
    text = text_or_empty(text_column)
    rows = written(
        docs.select(
            F.col(id_column).alias("_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("atom"),
        ), "shard-rows")
    count = rows.count()
    groups = rows.groupBy("atom").agg(F.sum("size").alias("size"))
    placed = balanced_groups(groups, shards)
    # slots: number the rows of (shard, chunk), then add what the shard's earlier chunks hold
    chunks = max(1, math.ceil(count / BUCKET))
    numbered = rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("_chunk", F.pmod(F.xxhash64("_row"), F.lit(chunks)))
    located = written(numbered.join(placed, "atom").select("_id", "size", "text_crc32", "shard", "_chunk", "_row"), "shard-located")
    counts = located.groupBy("shard", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_chunk").orderBy("_row")
    return (
        located.withColumn("_place", F.row_number().over(inside) - 1)
        .join(offsets, ["shard", "_chunk"])
        .select(
            F.col("_id").alias(id_column), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("_before") + F.col("_place")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )
