"""Change detection between a batch and a target table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelake.functions.keys import hash_bytes
from farelake.operators.ids import RANK
from farelake.sources.working import working

#: Batch rows whose keys may be broadcast: some 60 MB of 32-character hashes.
BROADCAST_KEYS = 1_000_000
#: Bitmaps of as many rows each that may be broadcast: some 60 MB, for 256 million rows.
BROADCAST_BITMAPS = 500_000
#: Words of 64 rows in a bitmap, as a power of two; bitmaps in a group, whose running count is one window's, too.
WORDS, GROUP = 3, 12
#: A target is reduced by the batch's keys if it has this many times the batch's rows.
REDUCED_FROM = 4


def target_keys(target: DataFrame, key: str = "row_hash") -> DataFrame:
    """Key-only scan of the target: column pruning leaves one column to read."""
    if key not in target.columns:
        raise ValueError(f"the target has no {key} column to compare with")
    return target.select(key)


def prune(target: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """The target rows whose ``column`` value occurs in the batch.

    ``column`` is a layout column of bounded cardinality (calendar months),
    so its distinct batch values are broadcast, and Spark scans only those
    target partitions (dynamic partition pruning). Nothing is collected, and
    the result is the same whether or not Spark prunes.
    """
    # the comparison drops nothing; it marks the side as worth pruning by
    values = batch.select(column).where(F.col(column) >= "").distinct()
    return target.join(F.broadcast(values), column, "left_semi")


def _reduces(batch: DataFrame, whole: DataFrame) -> bool:
    """Whether the batch's keys, broadcast, reduce the target; both are counted (Parquet footers, for written tables)."""
    rows = batch.count()
    return rows <= BROADCAST_KEYS and whole.count() >= REDUCED_FROM * rows


def known_keys(batch: DataFrame, target: DataFrame, key: str = "row_hash", whole: DataFrame | None = None,
               reduces: bool | None = None) -> DataFrame:
    """The distinct target keys that the batch may hold, all that it does among them.

    A batch of up to :data:`BROADCAST_KEYS` rows and far smaller than the
    ``whole`` target reduces the target where it is scanned, by a broadcast
    semi join: of the target, only keys of the batch are ever shuffled, and the
    result, which is no larger, may be broadcast too. Otherwise the target's
    keys are folded on the map side and shuffled, as the batch's are.
    """
    if _reduces(batch, target if whole is None else whole) if reduces is None else reduces:
        keys = working(batch.select(key).where(F.col(key).isNotNull()).distinct(), "batch-keys")
        return F.broadcast(target_keys(target, key).join(F.broadcast(keys), key, "left_semi").distinct())
    return target_keys(target, key).distinct()


def new_rows(batch: DataFrame, target: DataFrame, key: str = "row_hash",
             prune_by: str | None = None) -> DataFrame:
    """Batch rows whose key is not in the target (C4).

    A left anti join: copies inside the batch are all kept and a NULL batch
    key always counts as new, as with a set-membership test. The target is
    reduced by the batch's keys first (:func:`known_keys`). Of a larger batch
    the keys alone meet the target's distinct keys in a sort-merge join, and
    are written with whether they are known. Where few are new, or few known,
    these are broadcast and no whole row is shuffled; otherwise the batch meets
    its known keys in a sort-merge anti join, whose skewed batch partitions AQE
    splits. So the target's size is bounded by neither driver nor executor
    memory.

    With ``prune_by`` (a non-null layout column that equal keys always share
    and that both sides carry) only the target partitions that the batch
    touches are scanned.
    """
    whole = target
    if prune_by is not None and prune_by in target.columns:
        target = prune(target, batch, prune_by)
    reduces = _reduces(batch, whole)
    known = known_keys(batch, target, key, whole, reduces)
    if reduces:
        return batch.join(known, key, "left_anti")
    marked = batch.select(key).distinct().join(known.withColumn("_seen", F.lit(True)), key, "left")
    marked = working(marked.select(F.col(key).alias("_key"), F.col("_seen").isNotNull().alias("_seen")), "batch-keys")
    new, known = (marked.where(seen).select("_key") for seen in (~F.col("_seen"), F.col("_seen")))
    few_new, few_known = (keys.count() <= BROADCAST_KEYS for keys in (new, known))
    if few_new:
        return batch.join(F.broadcast(new), F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    return batch.join(F.broadcast(known) if few_known else known, F.col(key) == F.col("_key"), "left_anti")


def new_places(batch: DataFrame, target: DataFrame, place: str, key: str = "row_hash", prune_by: str | None = None) -> DataFrame:
    """The ``place`` of each batch row whose key is not in the target, as :func:`new_rows` has them: keys and places alone are shuffled.

    Keys meet as the bytes that they spell. The target's are folded first, so
    a hot key is folded before the shuffle.
    """
    whole = target
    if prune_by is not None and prune_by in target.columns:
        target = prune(target, batch, prune_by)
    rows = batch.select(place, key)
    if _reduces(batch, whole):
        return rows.join(known_keys(batch, target, key, whole, True), key, "left_anti").select(place)
    spelled = target_keys(target, key).select(hash_bytes(key).alias(key)).distinct()
    return rows.select(place, hash_bytes(key).alias(key)).join(spelled, key, "left_anti").select(place)


def _bit(place: str) -> tuple[Column, Column, Column]:
    """The bitmap, the word in it, and the bit in the word, of a place."""
    at = F.col(place)
    return F.shiftright(at, 6 + WORDS), F.shiftright(at, 6).bitwiseAND(2**WORDS - 1).cast("int"), at.bitwiseAND(63).cast("int")


def bitmaps(places: DataFrame, place: str) -> tuple[DataFrame, bool]:
    """Distinct places as bitmaps: ``_map`` (512 places each), a column a word, and ``_before``, the places in earlier bitmaps; and whether they are broadcast.

    An eighth of a byte a row of the batch and some more, so a whole batch's
    can be broadcast. Running counts are taken in groups of bitmaps, whose
    totals (one row for two million places) are summed in one task.
    """
    at, word, bit = _bit(place)
    here = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = [F.coalesce(F.bit_or(F.when(word == i, here)), F.lit(0).cast("long")).alias(f"_word_{i}") for i in range(2**WORDS)]
    maps = working(places.groupBy(at.alias("_map")).agg(*words), "bitmaps")
    in_map = reduce(lambda a, b: a + b, [F.bit_count(f"_word_{i}") for i in range(2**WORDS)]).cast("long")
    group = F.shiftright("_map", GROUP)
    earlier = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = maps.groupBy(group.alias("_group")).agg(F.sum(in_map).alias("_n")).select(
        "_group", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_earlier"))
    so_far = Window.partitionBy("_group").orderBy("_map").rowsBetween(Window.unboundedPreceding, -1)
    counted = maps.withColumn("_group", group).withColumn("_here", F.coalesce(F.sum(in_map).over(so_far), F.lit(0)))
    counted = counted.join(F.broadcast(groups), "_group").select(
        "_map", *[f"_word_{i}" for i in range(2**WORDS)], (F.col("_earlier") + F.col("_here")).alias("_before"))
    few = maps.count() <= BROADCAST_BITMAPS
    return F.broadcast(counted) if few else counted, few


def at_places(batch: DataFrame, places: DataFrame, place: str) -> tuple[DataFrame, bool]:
    """The batch rows at ``places``, numbered from 1 in the order of their places (:data:`RANK`), and whether they stay where they are.

    ``place`` differs from row to row, and ``places`` is a written table. Up to :data:`BROADCAST_BITMAPS` bitmaps are broadcast, and no row of the
    batch is shuffled, however many are new; more meet the batch in a join.
    """
    at, word, bit = _bit(place)
    here = F.get(F.array(*[f"_word_{i}" for i in range(2**WORDS)]), word)
    # bits of earlier words, and the lower ones of its own
    lower = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), bit))
    rank = reduce(lambda a, b: a + b, [F.when(word > i, F.bit_count(f"_word_{i}")).otherwise(0) for i in range(2**WORDS - 1)],
                  F.bit_count(here.bitwiseAND(lower)))
    maps, stay = bitmaps(places, place)
    joined = batch.withColumn("_map", at).join(maps, "_map").where(F.getbit(here, bit) == 1)
    return joined.select(*[F.col(f"`{c}`") for c in batch.columns], (F.col("_before") + rank + F.lit(1)).alias(RANK)), stay


def change_summary(batch: DataFrame, target: DataFrame, key: str = "row_hash") -> DataFrame:
    """One row: ``batch_rows, new_rows, skipped_rows`` (C4 ``rows_skipped``)."""
    known = known_keys(batch, target, key).withColumn("_seen", F.lit(True))
    marked = batch.select(key).join(known, key, "left")
    return marked.agg(
        F.count(F.lit(1)).alias("batch_rows"),
        F.count_if(F.col("_seen").isNull()).alias("new_rows"),
    ).withColumn("skipped_rows", F.col("batch_rows") - F.col("new_rows"))
