"""Exact dedup by content sort, in DataFrame operations only.

Spark's sampled splitters range-partition the rows by content, an external
sort places equal texts side by side, and the window compares the full text
of neighbours.

* The splitters are a short prefix of the normalised text, then a hash of the
  whole text. So the sample that reaches the driver stays small however long
  the texts are, and a common prefix does not pile up in one partition. The
  sort and the comparison use the whole text.
* A text that holds at least ``HOT_SHARE`` of all rows, or a quarter of what a
  shuffle partition holds on average if that is less, is salted: its rows
  spread over ``SALTS`` sort fragments, or as many as keep a fragment at a
  partition's share. With P partitions these are at most 1 / ``HOT_SHARE`` or
  4 P texts, whose fragments' winners, as many short rows times ``SALTS``, are
  then folded by their SHA-256.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, text_or_empty, written

HOT_SHARE = 0.001
SALTS = 64
PREFIX = 24


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as the
    empty text. Of equal texts the row with the smallest (or largest) id is
    kept; of repeated rows with that id, one. Null ids lose against any other,
    and an all-null group keeps one row, with a null ``keep_id``. Empty tables
    give no rows; other columns are ignored.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    rows = docs.select(F.col(id_column).alias("_id"), text_or_empty(text_column).alias("_text"))
    # equal normalised texts are equal under lower(), so no copy escapes its hot key
    rows = rows.withColumn("_key", F.xxhash64(F.lower("_text")))
    total = docs.count()
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = min(HOT_SHARE, 0.25 / partitions)
    hot = (
        rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
        .where((F.col("_n") > 1) & (F.col("_n") >= F.lit(total * share)))
        .select("_key", F.lit(True).alias("_hot"), F.greatest(F.lit(SALTS), F.ceil(F.col("_n") * F.lit(partitions / max(1, total)))).alias("_salts"))
    )  # at most 1 / share rows: a proven bound for the broadcast
    salted = (
        rows.join(F.broadcast(hot), "_key", "left")
        .select(
            "_id", "_hot", ascii_lower(F.col("_text")).alias("_norm"),
            F.when(F.col("_hot"), F.monotonically_increasing_id() % F.col("_salts")).otherwise(F.lit(0)).alias("_salt"),
        )
        .withColumn("_prefix", F.substring("_norm", 1, PREFIX))
        .withColumn("_hash", F.xxhash64("_norm"))
    )
    sort_key = ["_prefix", "_hash", "_salt"]
    best_first = F.col("_id").asc_nulls_last() if keep == "smallest" else F.col("_id").desc_nulls_last()
    same = Window.partitionBy(*sort_key, "_norm")
    ranked = same.orderBy(best_first)
    fragments = salted.repartitionByRange(*sort_key).select(
        "_id", "_salt", F.coalesce("_hot", F.lit(False)).alias("_hot"),
        F.first("_id").over(ranked).alias("_best"),
        F.count(F.lit(1)).over(same).alias("_n"),
        F.row_number().over(ranked).alias("_rank"),
        F.sha2("_norm", 256).alias("text_sha256"),
    )
    fragments = written(fragments, "exact-dedup")
    winners = fragments.where(F.col("_hot") & (F.col("_rank") == 1))
    order = F.struct(F.col("_best").isNull().alias("n"), F.col("_best").alias("b"), F.col("_salt").alias("s"))
    if keep == "largest":
        order = F.struct(F.col("_best").isNotNull().alias("n"), F.col("_best").alias("b"), F.col("_salt").alias("s"))
    pick = F.min(order) if keep == "smallest" else F.max(order)
    totals = (
        winners.groupBy("text_sha256").agg(pick.alias("_pick"), F.sum("_n").alias("_all"))
        .select(F.col("text_sha256"), F.col("_pick.b").alias("_hot_best"), F.col("_pick.s").alias("_hot_salt"), "_all")
    )  # one row per hot text: the same bound
    cold = fragments.where(~F.col("_hot")).select(
        "_id", F.col("_best").alias("keep_id"), F.col("_n").alias("group_size"),
        (F.col("_rank") == 1).alias("kept"), "text_sha256",
    )
    warm = fragments.where("_hot").join(F.broadcast(totals), "text_sha256").select(
        "_id", F.col("_hot_best").alias("keep_id"), F.col("_all").alias("group_size"),
        ((F.col("_rank") == 1) & (F.col("_salt") == F.col("_hot_salt"))).alias("kept"), "text_sha256",
    )
    return cold.unionByName(warm).withColumnRenamed("_id", id_column)
