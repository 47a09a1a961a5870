"""CSV records with line breaks, whatever the splits; ranks by ranges; sketches; working tables."""

import csv
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.operators import quality, ranking, sketches
from farelake.operators import profile as N
from farelake.plans import pipeline as P
from farelake.sources.csv import SourceError, read_text_csv
from farelake.sources.lake import Lake
from farelake.sources.working import working, working_tables
from tests.test_ingest import HEADER, ROW


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _write(path, rows, header=("a", "b", "c")):
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(header)
        w.writerows(rows)


def test_breaks_at_every_split_edge(spark, scratch, small_splits):
    rnd = random.Random(3)
    rows = []
    for i in range(120):
        text = "".join(rnd.choice(["x", "yy", "\n", '"', ",", " z", "\n\n"]) for _ in range(rnd.choice((1, 3, 30))))
        rows.append((str(i), f"t{text}t", f"n{i}"))
    rows[7] = ("7", "long " + "line\n" * 200 + "end", "n7")  # over several splits
    for name in ("one.csv", "two.csv"):
        _write(os.path.join(scratch, name), rows, ("a", "b\nhead", "c"))
    df = read_text_csv(spark, scratch, multiline=True)
    assert df.columns[:3] == ["a", "b\nhead", "c"]
    assert spark.read.text(scratch).rdd.getNumPartitions() > 20
    got = sorted((r[0], r[1], r[2]) for r in df.collect())
    assert got == sorted(rows + rows)


def test_multiline_agrees_with_the_reader_of_whole_files(spark, scratch, small_splits):
    rows = [("1", "a\nb", "x"), ("2", 'say ""hi""', ""), ("3", "NA", "plain"), ("4", "", "é\n\nü")]
    _write(os.path.join(scratch, "t.csv"), rows)
    whole = spark.read.csv(scratch, header=True, multiLine=True, quote='"', escape='"')
    got = read_text_csv(spark, scratch, multiline=True).select("a", "b", "c").fillna("")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.fillna("").replace("NA", "").collect()))


def test_quotes_that_do_not_match_are_refused(spark, scratch):
    with open(os.path.join(scratch, "t.csv"), "w") as f:
        f.write('a,b\n1,"open\n2,x\n')
    with pytest.raises(SourceError, match="quotes do not match"):
        read_text_csv(spark, scratch, multiline=True)


def test_rows_too_wide_are_marked(spark, scratch):
    _write(os.path.join(scratch, "t.csv"), [("1", "x\ny", "z"), ("2", "x", "y", "more\nof it"), ("3", "x")])
    df = read_text_csv(spark, scratch, multiline=True)
    rows = {r.a: r for r in df.collect()}
    assert rows["2"]._malformed_line and not rows["1"]._malformed_line and not rows["3"]._malformed_line and rows["3"].c is None


def test_ingest_of_a_file_with_breaks(spark, scratch, small_splits):
    row = list(ROW)
    row[HEADER.index("Source Name")] = "Dhaka\nAirport"
    path = os.path.join(scratch, "lines.csv")
    _write(path, [row, ROW, row], HEADER)
    lake = Lake(spark, scratch + "/lake")
    assert P.ingest(spark, path, lake, multiline=True).rows_loaded == 3
    assert sorted(r["Source Name"] for r in lake.read(P.STAGING).collect()) == ["Dhaka", "Dhaka\nAirport", "Dhaka\nAirport"]
    assert lake.read(sketches.TABLE).count() == 1


# ---------------------------------------------------------------- ranks
def test_ranks_by_ranges_are_ranks(spark, monkeypatch):
    df = working(spark.range(3000).select("id", F.when(F.col("id") % 50 > 0, F.floor(F.sqrt("id")) % 37).alias("v"), F.lit(1).alias("w")), "t")
    want = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_first()))).collect()
    monkeypatch.setattr(ranking, "ONE_TASK", 100)
    monkeypatch.setattr(ranking, "RANGE", 300)
    got = ranking.with_ranks(df, 3000, {"r": "v", "s": "w"}).collect()
    assert {(x.id, x.r) for x in got} == {(x.id, x.r) for x in want} and {x.s for x in got} == {1}
    assert len(got) == 3000


def test_top_values_and_counts_stay_spread_out(spark, scratch):
    """One value a row: nothing but one-row totals and the top-k itself comes together in one task."""
    spark.range(20_000).select(F.col("id").cast("string").alias("Airline"), F.lit("x").alias("Class")).write.parquet(scratch + "/t")
    df = spark.read.parquet(scratch + "/t")
    top = N.top_values(df)
    assert [r.value for r in top.collect()] == ["0", "1", "10", "100", "1000"]
    counts = N.value_counts(df, ("Airline", "Class"))
    assert counts.count() == 20_001
    for q in (top, counts):
        text = q._jdf.queryExecution().sparkPlan().toString()
        assert "Window" not in text


# ---------------------------------------------------------------- one scan
def test_one_scan_for_all_checks_of_a_model(spark, scratch):
    spark.range(10).selectExpr("id % 4 as k", "nullif(id, 3) as v", "'a' as c").write.parquet(scratch + "/t")
    df = spark.read.parquet(scratch + "/t")
    checks = [quality.Check("m", "unique", "k"), quality.Check("m", "not_null", "v"), quality.Check("m", "accepted_values", "c", ("b",)), quality.Check("m", "not_null", "k")]
    q = quality.run_checks({"m": df}, checks)
    assert {(r.check_name, r.column_name): r.failures for r in q.collect()} == {
        ("unique", "k"): 4, ("not_null", "v"): 1, ("accepted_values", "c"): 10, ("not_null", "k"): 0}
    assert q._jdf.queryExecution().sparkPlan().toString().count("Scan parquet") == 1
    two = quality.run_checks({"m": df}, [*checks, quality.Check("m", "unique", "v")])
    assert {(r.check_name, r.column_name): r.failures for r in two.collect()}[("unique", "v")] == 0
    assert two._jdf.queryExecution().sparkPlan().toString().count("Scan parquet") == 1
    empty = quality.run_checks({"m": df.limit(0)}, checks)
    assert {r.failures for r in empty.collect()} == {0}


def test_validation_and_profile_are_observed_by_the_write(spark, scratch, monkeypatch):
    """The text frame is scanned once: validation and the profile's summary ask for no aggregate of their own."""
    from farelake.operators import validate
    for module, name in ((validate, "value_problems"), (N, "summary")):
        monkeypatch.setattr(module, name, lambda *_: pytest.fail(f"{name} scans the rows again"))
    path = os.path.join(scratch, "t.csv")
    bad = list(ROW)
    bad[HEADER.index("Base Fare (BDT)")] = "-1"
    _write(path, [ROW, bad, ROW], HEADER)
    lake = Lake(spark, scratch + "/lake")
    assert P.ingest(spark, path, lake).rows_loaded == 3
    assert lake.read("profile_shape").first().total_rows == 3
    assert lake.read("profile_issues").first().negative_base_fares == 1


def test_target_is_reduced_before_any_shuffle(spark, scratch):
    from farelake.operators import changes
    spark.range(50_000).selectExpr("md5(cast(id as string)) as row_hash", "id").write.parquet(scratch + "/t")
    spark.range(49_990, 50_020).selectExpr("md5(cast(id as string)) as row_hash", "id").write.parquet(scratch + "/b")
    target, batch = spark.read.parquet(scratch + "/t"), spark.read.parquet(scratch + "/b")
    q = changes.new_rows(batch, target)
    assert sorted(r.id for r in q.collect()) == list(range(50_000, 50_020))
    lines = changes.known_keys(batch, target)._jdf.queryExecution().executedPlan().toString().splitlines()
    join = next(i for i, x in enumerate(lines) if "LeftSemi" in x)
    # between the target's scan and the join that reduces it stands no exchange
    scan = next(i for i, x in enumerate(lines) if "Scan parquet" in x and i > join)
    assert "BroadcastHashJoin" in lines[join] and not any("Exchange hashpartitioning" in x for x in lines[join:scan])


# ---------------------------------------------------------------- sketches, working tables
def test_sketches_of_loads_merge(spark):
    df = spark.range(60_000).selectExpr("id", "cast(id % 5000 as string) as v")
    metrics = {"id": F.col("id"), "v": F.col("v")}
    rows = [sketches.sketch_row(df.where(f"id % 3 = {k}"), metrics) for k in range(3)]
    merged = rows[0].unionByName(rows[1]).unionByName(rows[2])
    for r in sketches.estimates(merged, metrics).collect():
        exact = 60_000 if r.metric == "id" else 5000
        assert abs(r.distinct_estimate - exact) <= r.error <= 0.03 * exact
    dup = sketches.duplicate_hash_estimate(merged, "v").first()
    assert dup.total_rows == 60_000 and abs(dup.duplicate_estimate - 55_000) <= 150


def test_working_tables_go_with_their_scope(spark):
    outer = working(spark.range(3), "t")
    with working_tables(spark):
        inner = working(spark.range(4), "t")
        assert inner.count() == 4
        path = inner.inputFiles()[0].removeprefix("file://")
    assert outer.count() == 3 and not os.path.exists(path)
