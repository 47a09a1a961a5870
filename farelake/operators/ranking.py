"""Ranks and shares over a frame of any size.

A window without partitions gathers its frame in one task. That is right for
a frame of known, bounded size; :func:`with_ranks` asks for the count and
beyond :data:`ONE_TASK` rows goes by sampled ranges instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelake.sources.working import working

#: Rows that one task may rank.
ONE_TASK = 1 << 17
#: Distinct values of one range, about.
RANGE = 1 << 17


def with_ranks(df: DataFrame, rows: int, ranks: dict[str, str]) -> DataFrame:
    """``df`` with ``rank()`` columns, name by column, greatest value first (NULLs before all, T9).

    ``df`` reads a written table of ``rows`` rows.
    """
    for name, column in ranks.items():
        if rows <= ONE_TASK:
            by = Window.orderBy(F.col(column).desc_nulls_first())
            df = df.withColumn(name, F.rank().over(by).cast("int"))
        else:
            df = ranked_by_ranges(df, column, name, -(-rows // RANGE))
    return df


def ranked_by_ranges(df: DataFrame, column: str, name: str, ranges: int) -> DataFrame:
    """``rank()`` by sampled ranges of the values and each range's offset.

    Ties fold into (value, rows) first, with map-side combining, so a value
    that most rows share is one row. The values are dealt to ``ranges`` by a
    sample and written; a range's offset is the sum of the rows in the ranges
    before it, one number a range; within it, a running sum gives the rest.
    """
    values = df.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    dealt = values.repartitionByRange(ranges, F.col("_value").desc_nulls_first()).withColumn("_range", F.spark_partition_id())
    dealt = working(dealt, "rank-ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("_range").agg(F.sum("_rows").alias("_size"))
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(F.col("_value").desc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    # one offset a range: at most as many rows as ranges
    placed = dealt.join(F.broadcast(offsets), "_range").select(
        "_value", (F.col("_offset") + F.coalesce(F.sum("_rows").over(inside), F.lit(0)) + 1).alias(name))
    return df.join(placed, F.col(column).eqNullSafe(F.col("_value"))).drop("_value")
