"""Exact rounding helpers against Python's Decimal arithmetic."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farelake.functions import money as M

cents = st.integers(min_value=-10**9, max_value=10**9).map(lambda c: Decimal(c) / 100)


def q(x: Decimal, places: int) -> Decimal:
    return x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


@settings(max_examples=25, deadline=None)
@given(st.lists(cents, min_size=1, max_size=40))
def test_avg_round_is_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v decimal(18,6)")
    row = df.agg(M.avg_round("v", 2).alias("a"), M.avg_round("v", 1).alias("b"),
                 M.sum_round("v").alias("s")).first()
    exact = sum(values) / len(values)
    assert row.a == q(exact, 2) and row.b == q(exact, 1) and row.s == q(sum(values), 2)


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10**7), st.integers(1, 10**7), st.sampled_from([1, 2]))
def test_pct_is_exact(spark, part, whole, places):
    df = spark.createDataFrame([(part, whole)], "p long, w long")
    got = df.select(M.pct(F.col("p"), F.col("w"), places)).first()[0]
    assert got == q(Decimal(part) * 100 / Decimal(whole), places)


@settings(max_examples=15, deadline=None)
@given(st.lists(cents, min_size=1, max_size=30))
def test_exact_median(spark, values):
    df = spark.createDataFrame([("k", v) for v in values], "k string, v decimal(18,6)")
    s = sorted(values)
    n = len(s)
    want = s[n // 2] if n % 2 else (s[n // 2 - 1] + s[n // 2]) / 2
    for width in (1000, 1, None):
        assert M.exact_median(df, ["k"], "v", "m", bucket_width=width).first().m == want


def test_exact_median_keeps_null_group(spark):
    df = spark.createDataFrame([(None, Decimal("1")), (None, Decimal("3")), ("a", Decimal("2"))],
                               "k string, v decimal(18,6)")
    got = {r.k: float(r.m) for r in M.exact_median(df, ["k"], "v", "m").collect()}
    assert got == {None: 2.0, "a": 2.0}
