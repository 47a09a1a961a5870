"""Approximate distinct counts by mergeable sketches, kept per load.

Each load adds one row of HyperLogLog sketches, a few kilobytes a metric, to a
table; the counts over all loads so far are the union of these rows, however
large the loads were. A sketch of 2^LG registers errs by
:func:`relative_error`; small counts are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Logarithm of a sketch's registers.
LG = 14
#: Standard errors within which an estimate lies but for one in several hundred.
ERRORS = 3

TABLE = "distinct_sketches"


def relative_error(lg: int = LG) -> float:
    """The standard error of a merged sketch, relative to the count: the HyperLogLog constant over the root of the registers."""
    return 1.04 / 2 ** (lg / 2)


def sketch_row(df: DataFrame, metrics: dict[str, F.Column]) -> DataFrame:
    """One row: ``rows``, and a sketch of each metric's distinct non-null values."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.hll_sketch_agg(c, F.lit(LG)).alias(name) for name, c in metrics.items()])


def estimates(sketches: DataFrame, metrics) -> DataFrame:
    """(``metric``, ``distinct_estimate``, ``error``) over all rows of sketches; ``error`` bounds the estimate's distance from the count."""
    merged = sketches.agg(*[F.hll_sketch_estimate(F.hll_union_agg(F.col(m))).alias(m) for m in metrics])
    pairs = ", ".join(f"'{m}', `{m}`" for m in metrics)
    return merged.selectExpr(f"stack({len(list(metrics))}, {pairs}) as (metric, distinct_estimate)").select(
        "metric", "distinct_estimate", F.ceil(F.lit(ERRORS * relative_error()) * F.col("distinct_estimate")).alias("error"))


def duplicate_hash_estimate(sketches: DataFrame, metric: str = "row_hash") -> DataFrame:
    """Rows, the estimate of distinct hashes, and of the rows that repeat others (C3), over all loads."""
    return sketches.agg(F.sum("rows").alias("total_rows"), F.hll_sketch_estimate(F.hll_union_agg(metric)).alias("distinct_estimate")).withColumn(
        "duplicate_estimate", F.greatest(F.lit(0), F.col("total_rows") - F.col("distinct_estimate")))
