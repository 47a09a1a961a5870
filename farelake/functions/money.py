"""Exact rounded aggregates (G3, G6-G8, L14, L16; traps T1-T3).

Averages and ratios are computed as decimal quotients with at least 14
fractional digits and rounded half away from zero once, so they do not
inherit binary floating-point ties. Outputs are cast to ``double`` last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake import schema as S
from farelake.sources.working import working

SUM_T = T.DecimalType(28, 6)   # sum of MONEY-scaled values
COUNT_T = T.DecimalType(20, 0)
CENTS_T = T.DecimalType(20, 2)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_money(c) -> Column:
    """Exact money scale; a value beyond it (a duration of 10^12 hours, say) counts as missing."""
    return _c(c).try_cast(S.MONEY)


def avg_round(c, scale: int = 2) -> Column:
    """``round(avg(c), scale)`` as exact decimal; NULLs ignored as in ``avg``."""
    x = as_money(c)
    q = F.sum(x).cast(SUM_T) / F.count(x).cast(COUNT_T)
    return F.round(q, scale)


def sum_round(c, scale: int = 2) -> Column:
    return F.round(F.sum(as_money(c)), scale)


def round_money(c, scale: int = 2) -> Column:
    """Round an exact value (decimal or a decimal-castable double)."""
    return F.round(_c(c).try_cast("decimal(38,6)"), scale)


def round_double(c, scale: int = 2) -> Column:
    """Round an inexact double such as a standard deviation.

    The value is fixed to 6 decimals first, which makes the result stable
    under last-bit differences of the double and rounds ties away from zero.
    """
    return F.round(_c(c).cast("decimal(38,6)"), scale)


def ratio_round(num, den, scale: int = 2, factor: int = 1,
                num_t: T.DecimalType = T.DecimalType(24, 6),
                den_t: T.DecimalType = T.DecimalType(24, 6)) -> Column:
    """``round(num * factor / nullif(den, 0), scale)`` exactly.

    ``num`` and ``den`` must be exact (integers or decimals). The factor is
    applied to the numerator before dividing so that Spark's decimal rules
    keep at least 14 fractional digits in the quotient.
    """
    n = _c(num).cast(num_t)
    if factor != 1:
        n = n * F.lit(factor).cast(T.DecimalType(len(str(factor)), 0))
    d = _c(den).cast(den_t)
    return F.round(n / F.when(d != 0, d), scale)


def pct(part, whole, scale: int) -> Column:
    """Percent of a count, ``round(part / nullif(whole, 0) * 100, scale)``."""
    return ratio_round(part, whole, scale, factor=100,
                       num_t=T.DecimalType(18, 0), den_t=T.DecimalType(20, 0))


def dbl(c) -> Column:
    return _c(c).cast("double")


#: The quantile sketch behind an exact median has a rank error of one row in this many.
SKETCH_ACCURACY = 2000


def median_bracket(value: str, accuracy: int = SKETCH_ACCURACY) -> list[Column]:
    """Aggregates for any group-by: the count of values, and two values between which the median lies.

    A mergeable quantile sketch of bounded size gives the values at four times
    its rank error below and above the middle.
    """
    v = as_money(value)
    ends = [F.lit(0.5 + side * 4 / accuracy) for side in (-1, 1)]
    return [F.count(v).alias("_median_n"), F.percentile_approx(v, F.array(*ends), accuracy).alias("_median_ends")]


def exact_median(df: DataFrame, keys: list[str], value: str, out: str = "median",
                 bucket_width: int | None = None) -> DataFrame:
    """Exact ``percentile_cont(0.5)`` per group: a sketch, then a selection (:func:`median_within`)."""
    brackets = working(df.groupBy(*keys).agg(*median_bracket(value)), "median")
    return median_within(df, brackets, keys, value, out, bucket_width)


def median_within(df: DataFrame, brackets: DataFrame, keys: list[str], value: str, out: str = "median",
                  bucket_width: int | None = None) -> DataFrame:
    """The median of each group of ``df``, by the sketch's ``brackets`` (a written table with :func:`median_bracket`).

    One narrow scan of ``df``, with the brackets joined in by their measured
    size. Values below a bracket are only counted, values above it are left
    out, and values inside are counted by value; all of that is combined on the
    map side, so what is shuffled are a group's distinct values inside, some
    thousandths of its rows, and one count. A running count over these finds
    the two middle values. Their mean is exact in decimal. NULL keys form
    groups like others; groups without values are left out.

    The sketch works in doubles, so its ends are moved out by more than they
    can err. ``bucket_width`` widens them to its multiples, which are the same
    in every run over slightly different data. A bracket that misses the middle
    would raise an error, not give another value.
    """
    ends = [F.col("_median_ends")[i].cast("decimal(28,6)") for i in (0, 1)]
    slack = [F.abs(e) * F.lit("0.000000001").cast("decimal(10,9)") + F.lit("0.000001").cast("decimal(7,6)") for e in ends]
    low, high = ends[0] - slack[0], ends[1] + slack[1]
    if bucket_width:
        low, high = F.floor(low / bucket_width) * bucket_width, F.ceil(high / bucket_width) * bucket_width
    b = brackets.select(*[F.col(k).alias(f"_of_{i}") for i, k in enumerate(keys)], "_median_n",
                        low.cast("decimal(38,6)").alias("_low"), high.cast("decimal(38,6)").alias("_high"))
    rows = df.select(*keys, as_money(value).alias("_v")).where(F.col("_v").isNotNull())
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_of_{i}")) for i, k in enumerate(keys)])
    near = rows.join(b, same).where(F.col("_v") <= F.col("_high"))
    counted = near.groupBy(*keys, F.when(F.col("_v") >= F.col("_low"), F.col("_v")).alias("_in")).agg(
        F.count(F.lit(1)).alias("_c"), F.max("_median_n").alias("_n"))
    running = (Window.partitionBy(*keys).orderBy(F.col("_in").asc_nulls_first())
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    lo_pos, hi_pos = F.expr("(_n + 1) div 2"), F.expr("_n div 2 + 1")
    picked = (counted.withColumn("_cum", F.sum("_c").over(running)).where(F.col("_in").isNotNull())
              .groupBy(*keys).agg(
                  F.min(F.when(F.col("_cum") >= lo_pos, F.col("_in"))).alias("_lo"),
                  F.min(F.when(F.col("_cum") >= hi_pos, F.col("_in"))).alias("_hi"),
                  F.min(F.col("_cum") - F.col("_c") - lo_pos).alias("_missed")))
    median = (F.col("_lo").cast(SUM_T) + F.col("_hi").cast(SUM_T)) / F.lit(2)
    missed = (F.col("_missed") >= 0) | F.col("_hi").isNull()
    return picked.select(*keys, F.when(missed, F.raise_error(F.lit("the median lies outside its bracket"))).otherwise(median).alias(out))


def approx_median_of(value: str, accuracy: int = 100000) -> Column:
    """Bounded-memory approximate median as an aggregate (``percentile_approx``)."""
    return F.percentile_approx(F.col(value).cast("double"), 0.5, accuracy).cast(SUM_T)


def approx_median(df: DataFrame, keys: list[str], value: str, out: str = "median",
                  accuracy: int = 100000) -> DataFrame:
    """Approximate median per group."""
    return df.groupBy(*keys).agg(approx_median_of(value, accuracy).alias(out))
