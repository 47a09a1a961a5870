"""Booking-shaped test data derived from the TPC-H-like driver tables.

The derivation is the one declared in FIXTURES.md section 2, written with
the DataFrame API: every bronze rejection rule is triggered by a modulus of
a key, money is exact decimal, and ``id + 500`` copies with a valid duration
are added so that rank-before-filter dedupe is observable.

At scale every join here is an equi-join Spark plans by itself: lineitem is
hash-partitioned by ``l_orderkey`` once for the per-order line counter and
the orders join reuses that partitioning; the 25-row nation table, with the
codes spelled there, is broadcast by file size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.sources.tables import table

DEC = "decimal(12,2)"


def _code(prefix: str, nationkey) -> F.Column:
    return F.concat(F.lit(prefix), F.lpad(nationkey.cast("string"), 2, "0"))


def booking_fixture(spark: SparkSession, sf_dir: str, fanout: bool = False) -> DataFrame:
    """Columns ``id`` + the 17 engine columns (typed as in the fixture text)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                               "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # codes are spelled once a nation, not once or twice a line
    sn = nation.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("sn_name"),
                       _code("S", F.col("n_nationkey")).alias("sn_code"))
    cn = nation.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cn_name"),
                       _code("C", F.col("n_nationkey")).alias("cn_code"))

    line_order = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    ep = F.col("l_extendedprice").cast(DEC)
    numbered = li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount",
        "l_returnflag", "l_shipdate", "l_extendedprice", "l_tax", F.row_number().over(line_order).alias("k"))
    b = numbered.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_discount", "l_returnflag", "l_shipdate",
        ep.alias("ep"),
        F.round(ep * F.col("l_tax").cast("decimal(4,2)"), 2).cast(DEC).alias("tx"),
        "k",
    )
    # the orders meet their customers first, so that no line is shuffled for these
    oc = o.join(c, F.col("o_custkey") == c.c_custkey)
    j = (b.join(oc, b.l_orderkey == F.col("o_orderkey"))
          .join(s, b.l_suppkey == s.s_suppkey)
          .join(p, b.l_partkey == p.p_partkey)
          .join(sn, F.col("s_nationkey") == sn.sn_key)
          .join(cn, F.col("c_nationkey") == cn.cn_key))

    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    ln = F.col("l_linenumber")
    zero = F.lit(0).cast(DEC)
    ship = F.col("l_shipdate").cast("date").cast("string")
    qty = F.col("l_quantity")
    source_name = F.col("sn_name")
    if fanout:
        source_name = F.when(sk % 10 == 1, F.concat(source_name, F.lit(" Intl"))).otherwise(source_name)
    base = j.select(
        (ok * 1000 + F.col("k")).alias("id"),
        F.when(pk % 197 == 0, None)
         .when(pk % 7 == 0, F.concat(F.lit(" "), F.col("p_brand"), F.lit(" ")))
         .otherwise(F.col("p_brand")).alias("airline"),
        F.when(sk % 89 == 0, None).otherwise(F.col("sn_code")).alias("source_code"),
        source_name.alias("source_name"),
        F.when(ok % 113 == 0, None).otherwise(F.col("cn_code")).alias("destination_code"),
        F.col("cn_name").alias("destination_name"),
        F.when(pk % 211 == 0, None).otherwise(F.concat(ship, F.lit(" 06:30:00"))).alias("departure_datetime"),
        F.when(pk % 211 == 0, None).otherwise(F.concat(ship, F.lit(" 09:30:00"))).alias("arrival_datetime"),
        F.when(ok % 101 == 0, None).when(ok % 103 == 0, -qty).otherwise(qty).alias("duration_hours"),
        F.when(ln <= 3, "Direct").when(ln <= 5, "1 Stop").otherwise("2 Stops").alias("stopovers"),
        F.col("p_type").alias("aircraft_type"),
        F.when(F.col("l_returnflag") == "A", "Economy")
         .when(F.col("l_returnflag") == "N", "business class")
         .otherwise("First Class").alias("booking_class"),
        F.when(F.col("o_orderstatus") == "F", "Online Website")
         .when(F.col("o_orderstatus") == "O", "Travel Agency")
         .otherwise("Direct Booking").alias("booking_source"),
        F.when(ok % 107 == 0, -F.col("ep")).when(ok % 109 == 0, None)
         .when(ok % 127 == 0, zero).otherwise(F.col("ep")).alias("base_fare_bdt"),
        F.when(ok % 127 == 0, zero).otherwise(F.col("tx")).alias("tax_surcharge_bdt"),
        F.when((F.col("l_discount") == 0) | (ok % 127 == 0), zero)
         .when(ok % 109 == 0, None)
         .otherwise((F.col("ep") + F.col("tx")).cast(DEC)).alias("total_fare_bdt"),
        F.when(F.substring("o_orderpriority", 1, 1) == "1", "Eid ul-Fitr")
         .when(F.substring("o_orderpriority", 1, 1) == "2", "Winter Holidays")
         .when(F.substring("o_orderpriority", 1, 1) == "3", "Hajj")
         .when(F.substring("o_orderpriority", 1, 1) == "4", "Regular")
         .alias("seasonality"),
        (pk % 91).cast("int").alias("days_before_departure"),
    )
    # Every 13th id also yields a copy with id + 500 and a valid duration; the
    # copy is generated in the same pass (explode) instead of a union that
    # would run the joins above twice.
    copy = F.explode(F.when(F.col("id") % 13 == 0, F.array(F.lit(False), F.lit(True)))
                      .otherwise(F.array(F.lit(False)))).alias("_copy")
    cols = [c for c in base.columns]
    rows = base.select("*", copy)
    is_copy = F.col("_copy")
    return rows.select(*[
        F.when(is_copy, F.col("id") + 500).otherwise(F.col("id")).alias("id") if c == "id"
        else F.when(is_copy, F.lit(5.0)).otherwise(F.col(c)).alias(c) if c == "duration_hours"
        else F.col(c)
        for c in cols])


def fixture_bronze(spark: SparkSession, sf_dir: str, fanout: bool = False) -> DataFrame:
    """The fixture typed as the bronze table (ids given, no hash or audit columns)."""
    from farelake.operators.bronze import enforce_types
    return enforce_types(booking_fixture(spark, sf_dir, fanout))


def fixture_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture in the source file's shape: CSV header names, text values."""
    fx = booking_fixture(spark, sf_dir)
    return fx.select(*[F.col(e).alias(src) for src, e in S.RENAME.items()])
