"""What loads move and leave behind: rows found by place, generated code, shuffle files, source files."""

import os
import re
import time

import pytest
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions import keys as K
from farelake.operators import changes
from farelake.operators import load as L
from farelake.operators.ids import RANK
from farelake.plans import pipeline as P
from farelake.plans import runs
from farelake.sources import working as W
from farelake.sources.csv import read_text_csv
from farelake.sources.lake import Lake
from tests.conftest import SF_SMALL
from tests.test_ingest import HEADER, ROW, write_csv


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_rows_at_places_are_numbered_in_order(spark, scratch, monkeypatch, broadcast):
    monkeypatch.setattr(changes, "BROADCAST_BITMAPS", broadcast)
    at = [0, 1, 62, 63, 64, 65, 511, 512, 513, 2**21 - 1, 2**21, 2**21 + 63, 2**33, 2**33 + 700, 5 * 2**33 + 127]
    rows = sorted({*at, *range(60, 700, 3), *(a + 1 for a in at)})
    spark.createDataFrame([(p, f"r{p}") for p in rows], "place long, v string").write.parquet(scratch + "/b")
    spark.createDataFrame([(p,) for p in at], "place long").write.parquet(scratch + "/p")
    found, stay = changes.at_places(spark.read.parquet(scratch + "/b"), spark.read.parquet(scratch + "/p"), "place")
    assert stay == bool(broadcast)
    assert [(r.place, r.v, r[RANK]) for r in found.orderBy("place").collect()] == [(p, f"r{p}", i + 1) for i, p in enumerate(at)]
    nothing = spark.read.parquet(scratch + "/p").limit(0)
    assert changes.at_places(spark.read.parquet(scratch + "/b"), nothing, "place")[0].count() == 0


def test_new_rows_stay_where_they_are(spark, scratch):
    """Before, whole rows were shuffled by key where many were new and many known, and once more to number them."""
    spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("row_hash"), F.lit("x" * 50).alias("v"), "id").write.parquet(scratch + "/b")
    batch = spark.read.parquet(scratch + "/b")
    batch.where("id % 3 != 0").select("row_hash").write.parquet(scratch + "/t")
    places = W.working(changes.new_places(batch, spark.read.parquet(scratch + "/t"), "id"), "new-places")
    found, _ = changes.at_places(batch, places, "id")
    text = plan(found)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert sorted(r.id for r in found.collect()) == list(range(0, 1000, 3))


@pytest.mark.parametrize("reduces", [False, True])
def test_new_places_by_any_key(spark, scratch, monkeypatch, reduces):
    """Null keys are new, copies in the batch are all kept, and a key that is no hash is told from the bytes of one."""
    monkeypatch.setattr(changes, "_reduces", lambda *a: reduces)
    h = "00112233445566778899aabbccddeeff"
    keys = [None, None, h, h.upper(), h + "\n", "", "x", "x", "known", "known", " " * 15, "a" * 32]
    spark.createDataFrame(list(enumerate(keys)), "place long, row_hash string").write.parquet(scratch + "/b")
    spark.createDataFrame([("known",), ("known",), (None,), (h,), ("a" * 32,)], "row_hash string").write.parquet(scratch + "/t")
    found = changes.new_places(spark.read.parquet(scratch + "/b"), spark.read.parquet(scratch + "/t"), "place")
    assert sorted(r.place for r in found.collect()) == [0, 1, 3, 4, 5, 6, 7, 10]


def test_hashes_come_back_from_bytes(spark):
    h = "00112233445566778899aabbccddeeff"
    texts = [None, h, h.upper(), h + "\n", "", " ", " " * 15, " " * 16, "é" * 8, "z" * 32, h[:31], " " * 17 + h]
    df = spark.createDataFrame([(t,) for t in texts], "row_hash string").withColumn("bytes", K.hash_bytes("row_hash"))
    rows = df.withColumn("back", K.hash_text("bytes")).collect()
    assert [r.back for r in rows] == texts
    assert len({bytes(r.bytes) for r in rows[1:]}) == len(texts) - 1 and len(rows[1].bytes) == 16


@pytest.mark.parametrize("with_profile", [False, True])
def test_java_compiles_what_parses(spark, scratch, with_profile):
    """Java never compiles a method of over 8,000 bytes; before, the one that hashes rows had 8,407."""
    rows, _ = P.arriving(read_text_csv(spark, write_csv(scratch, HEADER, [ROW])), with_profile)
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(rows._jdf.queryExecution().executedPlan()))]
    assert len(sizes) == 2 and max(sizes) < 8000


def test_shuffle_files_go_with_their_query(spark, scratch):
    """Before, they stayed until the driver happened to collect its garbage."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", disk.getAllFiles().toString()))
    before, setting = files(), spark.conf.get(W.RELEASE, None)
    lake = Lake(spark, scratch + "/lake")
    path = write_csv(scratch, HEADER, [[f"Air {i}"] + ROW[1:] for i in range(50)])
    kept = []
    load = L.load

    def noted(*args, **kw):
        out = load(*args, **kw)
        kept.append(spark.conf.get(W.RELEASE))
        return out
    L.load = noted
    try:
        assert P.ingest(spark, path, lake).ok and P.ingest(spark, path, lake, S.INCREMENTAL).ok
    finally:
        L.load = load
    assert kept == ["true", "true"] and spark.conf.get(W.RELEASE, None) == setting
    ends = time.time() + 20
    while files() - before and time.time() < ends:
        time.sleep(0.2)
    assert not files() - before


def test_ids_follow_the_scan_after_known_rows(spark, scratch):
    """Many new and many known rows, over many splits: ids go on from the last one, in the file's order."""
    keys = {"spark.sql.files.maxPartitionBytes": "65536", "spark.sql.files.openCostInBytes": "1024"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        lake = Lake(spark, scratch + "/lake")
        rows = [[f"Air {i}"] + ROW[1:] for i in range(3000)]
        assert P.ingest(spark, write_csv(scratch, HEADER, rows[::3], "a.csv"), lake, with_profile=False).rows_loaded == 1000
        out = P.ingest(spark, write_csv(scratch, HEADER, rows, "b.csv"), lake, S.INCREMENTAL, with_profile=False)
        assert (out.rows_loaded, out.rows_skipped, out.rows_in_target) == (2000, 1000, 3000)
        new = [r.Airline for r in lake.read(P.STAGING).where("id > 1000").orderBy("id").collect()]
        assert new == [r[0] for i, r in enumerate(rows) if i % 3]
        ids = [r.id for r in lake.read(P.STAGING).select("id").orderBy("id").collect()]
        assert ids == list(range(1, 3001))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_promotion_of_repeated_ids(spark, scratch, monkeypatch):
    """Ids that repeat cannot tell rows apart, so the new rows are found by key."""
    lake = Lake(spark, scratch + "/lake")
    P.ingest(spark, write_csv(scratch, HEADER, [ROW], "a.csv"), lake)
    assert P.promote(spark, lake).rows_loaded == 1
    P.ingest(spark, write_csv(scratch, HEADER, [ROW] + [[f"Air {i}"] + ROW[1:] for i in range(3)], "b.csv"), lake, S.INCREMENTAL)
    staging = lake.read(P.STAGING)
    lake.write(staging.withColumn("id", F.lit(1).cast("long")), P.STAGING, partition_by=(S.LAYOUT_COLUMN,))
    assert P.promote(spark, lake, S.INCREMENTAL).rows_loaded == 3
    assert sorted(r.airline for r in lake.read(P.BRONZE).collect()) == ["Air 0", "Air 1", "Air 2", "Air One"]
    assert P.promote(spark, lake, S.INCREMENTAL).rows_loaded == 0


def test_a_file_is_gone_before_its_rows_are_loaded(spark, scratch, monkeypatch):
    """Before, the file stayed beside the batch, the shuffle and the new version of staging."""
    paths, seen = [], []
    csv, load = runs.Run.csv, L.load
    monkeypatch.setattr(runs.Run, "csv", lambda run, rows, name: paths.append(csv(run, rows, name)) or paths[-1])
    monkeypatch.setattr(L, "load", lambda *a, **kw: seen.append([os.path.exists(p) for p in paths]) or load(*a, **kw))
    assert runs.ingest_full(spark, SF_SMALL).count() > 0
    assert seen == [[False]]
    paths.clear(), seen.clear()
    assert runs.ingest_incremental(spark, SF_SMALL).count() == 4
    assert seen == [[False, True], [False, True], [False, True], [False, False]]


def test_the_reports_file_is_cut_where_its_rows_are(spark, monkeypatch):
    """The rows that the file keeps are picked by position; before, whole rows were shuffled to drop copies by id."""
    seen = []
    csv = runs.Run.csv
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monkeypatch.setattr(runs.Run, "csv", lambda run, rows, name: seen.append(plan(rows)) or csv(run, rows, name))
        assert runs.pipeline_report(spark, SF_SMALL).count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(seen) == 1 and "BroadcastHashJoin" in seen[0] and "SortMergeJoin" not in seen[0]
