"""CSV ingest, structural validation, load modes and logs."""

import os

from pyspark.sql import functions as F

from farelake import schema as S
from farelake.operators import validate
from farelake.plans import pipeline as P
from farelake.sources.lake import Lake

HEADER = list(S.SOURCE_COLUMNS)
ROW = ["Air One", "DAC", "Dhaka", "CXB", "Cox's Bazar", "2024-01-06 06:30:00",
       "2024-01-06 07:30:00", "1.0", "Direct", "ATR", "Economy", "Online Website",
       "100", "10", "110", "Regular", "10"]


def write_csv(dirpath, header, rows, name="bookings.csv"):
    path = os.path.join(dirpath, name)
    with open(path, "w") as f:
        for r in [header] + rows:
            f.write(",".join(f'"{x}"' if "," in x else x for x in r) + "\n")
    return path


def test_missing_column_fails_and_logs(spark, scratch):
    hdr = [h for h in HEADER if h != "Class"]
    row = [v for h, v in zip(HEADER, ROW) if h != "Class"]
    path = write_csv(scratch, hdr, [row])
    lake = Lake(spark, scratch + "/lake")
    res = P.ingest(spark, path, lake)
    assert not res.ok and res.error == "Missing columns: ['Class']"
    log = lake.read("ingestion_log").first()
    assert (log.status, log.rows_expected, log.rows_loaded) == ("FAILURE", 0, 0)


def test_extra_and_shuffled_columns(spark, scratch):
    hdr = list(reversed(HEADER)) + ["X"]
    row = list(reversed(ROW)) + ["junk"]
    res = validate.check_structure(spark, write_csv(scratch, hdr, [row]))
    assert res.ok
    assert res.df.columns == HEADER
    assert res.df.first()["Airline"] == "Air One"


def test_non_numeric_fare_and_float_days(spark, scratch):
    bad = list(ROW)
    bad[HEADER.index("Base Fare (BDT)")] = "abc"
    bad[HEADER.index("Days Before Departure")] = "5.0"
    res = validate.check_structure(spark, write_csv(scratch, HEADER, [ROW, bad]))
    assert res.errors == ["Column 'Base Fare (BDT)' expected double, got text"]


def test_preflight_errors(spark, scratch):
    empty = os.path.join(scratch, "empty.csv")
    open(empty, "w").close()
    header_only = write_csv(scratch, HEADER, [], "header.csv")
    assert validate.check_structure(spark, scratch + "/nope.csv").errors[0].startswith("File not found")
    assert validate.check_structure(spark, empty).errors == ["CSV file is empty (0 bytes)"]
    assert validate.check_structure(spark, header_only).errors == \
        ["CSV file contains only headers, no data rows"]


def test_na_tokens_become_null(spark, scratch):
    row = list(ROW)
    row[HEADER.index("Source Name")] = "NA"
    row[HEADER.index("Aircraft Type")] = "None"
    row[HEADER.index("Seasonality")] = ""
    res = validate.check_structure(spark, write_csv(scratch, HEADER, [row]))
    r = res.df.first()
    assert r["Source Name"] is None and r["Aircraft Type"] is None and r["Seasonality"] is None


def test_incremental_semantics(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    first = write_csv(scratch, HEADER, [ROW], "a.csv")
    other = list(ROW)
    other[0] = "Air Two"
    second = write_csv(scratch, HEADER, [ROW, other, other], "b.csv")
    assert P.ingest(spark, first, lake, S.INCREMENTAL).rows_loaded == 1
    res = P.ingest(spark, second, lake, S.INCREMENTAL)
    # in-batch copies are both kept; the known row is skipped
    assert (res.rows_loaded, res.rows_skipped, res.rows_in_target) == (2, 1, 3)
    again = P.ingest(spark, second, lake, S.INCREMENTAL)
    assert (again.ok, again.rows_loaded, again.rows_skipped) == (True, 0, 3)
    staging = lake.read(P.STAGING)
    ids = sorted(r.id for r in staging.collect())
    assert len(set(ids)) == 3 and ids[0] == 1
    from farelake.operators.bronze import duplicate_hash_metric
    assert duplicate_hash_metric(staging).first().duplicate_rows == 1
    # promote: full then incremental into the same bronze
    assert P.promote(spark, lake, S.FULL).rows_loaded == 3
    assert P.promote(spark, lake, S.INCREMENTAL).rows_loaded == 0
    bronze = lake.read(P.BRONZE)
    assert bronze.where(F.col("source_system") == S.SOURCE_SYSTEM).count() == 3
    assert "airline" in bronze.columns and "row_hash" in bronze.columns


def test_unknown_mode_is_full(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    path = write_csv(scratch, HEADER, [ROW, ROW])
    P.ingest(spark, path, lake, S.FULL)
    res = P.ingest(spark, path, lake, "delta")
    assert (res.rows_loaded, res.rows_in_target) == (2, 2)


def test_full_equals_incremental_into_empty(spark, scratch):
    path = write_csv(scratch, HEADER, [ROW, ROW[:1] + ["CGP"] + ROW[2:]])
    a, b = Lake(spark, scratch + "/a"), Lake(spark, scratch + "/b")
    P.ingest(spark, path, a, S.FULL)
    P.ingest(spark, path, b, S.INCREMENTAL)
    cols = ["id", "row_hash"]
    assert sorted(a.read(P.STAGING).select(cols).collect()) == sorted(b.read(P.STAGING).select(cols).collect())


def test_promote_without_staging_fails(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    res = P.promote(spark, lake)
    assert not res.ok and res.error == "No data in source table"
    assert lake.read("transfer_log").first().status == "FAILURE"


def test_ingest_with_profile(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    row2 = list(ROW)
    row2[HEADER.index("Seasonality")] = ""
    path = write_csv(scratch, HEADER, [ROW, row2])
    assert P.ingest(spark, path, lake, with_profile=True).ok
    nulls = {r.column_name: r.null_count for r in lake.read("profile_nulls").collect()}
    assert nulls["Seasonality"] == 1 and nulls["Airline"] == 0
    assert lake.read("profile_shape").first().total_rows == 2


def test_quoted_fields(spark, scratch):
    path = os.path.join(scratch, "quoted.csv")
    row = list(ROW)
    row[HEADER.index("Source Name")] = '"Dhaka, ""Shahjalal"" Intl"'
    with open(path, "w") as f:
        f.write(",".join(HEADER) + "\n")
        f.write(",".join(row) + "\n")
    res = validate.check_structure(spark, path)
    assert res.ok
    assert res.df.first()["Source Name"] == 'Dhaka, "Shahjalal" Intl'
    assert res.df.first()["Total Fare (BDT)"] == "110"


def test_every_row_is_kept_when_splits_differ_between_passes(spark, scratch, monkeypatch):
    n = 20000
    path = write_csv(scratch, HEADER, [[f"Air {i}"] + ROW[1:] for i in range(n)])
    keys = {"spark.sql.leafNodeDefaultParallelism": "4", "spark.sql.files.openCostInBytes": "1024",
            "spark.sql.files.maxPartitionBytes": "262144"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    check = validate.check_frame

    def check_then_change(df, **observed):
        out = check(df, **observed)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "32")
        return out
    monkeypatch.setattr(validate, "check_frame", check_then_change)
    try:
        lake = Lake(spark, scratch + "/lake")
        res = P.ingest(spark, path, lake, with_profile=False)
        assert (res.ok, res.rows_loaded) == (True, n)
        r = lake.read(P.STAGING).agg(F.min("id"), F.max("id"), F.count_distinct("id"), F.count("*")).first()
        assert tuple(r) == (1, n, n, n)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_short_full_load_is_not_committed(spark, scratch):
    import pytest
    from farelake.operators import load as L
    from farelake.sources.lake import RowCountError
    lake = Lake(spark, scratch + "/lake")
    lake.write(spark.range(3).withColumn("row_hash", F.lit("x")), "t")
    with pytest.raises(RowCountError):
        L.load(spark.range(5).withColumn("row_hash", F.lit("x")), lake, "t", S.FULL, batch_rows=6)
    assert Lake(spark, scratch + "/lake").read("t").count() == 3


def test_no_data_rows_keep_the_old_version(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    assert P.ingest(spark, write_csv(scratch, HEADER, [ROW], "a.csv"), lake).ok
    blank = os.path.join(scratch, "blank.csv")
    with open(blank, "w") as f:
        f.write(",".join(HEADER) + "\n\n\n")
    parts = os.path.join(scratch, "parts")
    os.makedirs(parts)
    for name in ("a.csv", "b.csv"):
        write_csv(parts, HEADER, [], name)
    for path in (blank, parts):
        res = P.ingest(spark, path, lake)
        assert not res.ok and "only headers" in res.error
        assert Lake(spark, scratch + "/lake").read(P.STAGING).count() == 1
    assert P.ingest(spark, write_csv(scratch, HEADER, [ROW], "a.csv"), lake, S.INCREMENTAL).rows_skipped == 1


def test_an_empty_table_is_readable(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    lake.write(spark.range(0).withColumn("m", F.lit("x")), "t", partition_by=("m",))
    again = Lake(spark, scratch + "/lake").read("t")
    assert again.count() == 0 and again.columns == ["id", "m"]


def test_white_space_around_a_date_is_the_same_row(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    padded = list(ROW)
    padded[HEADER.index("Departure Date & Time")] = "\t 2024-01-06 06:30:00"
    assert P.ingest(spark, write_csv(scratch, HEADER, [ROW], "a.csv"), lake).rows_loaded == 1
    res = P.ingest(spark, write_csv(scratch, HEADER, [padded], "b.csv"), lake, S.INCREMENTAL)
    assert (res.rows_loaded, res.rows_skipped) == (0, 1)


def test_incremental_ids_stay_dense(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    P.ingest(spark, write_csv(scratch, HEADER, [ROW], "a.csv"), lake)
    new = [[f"Air {i}"] + ROW[1:] for i in range(3)]
    P.ingest(spark, write_csv(scratch, HEADER, [ROW, new[0], ROW, new[1], new[2]], "b.csv"), lake, S.INCREMENTAL)
    assert sorted(r.id for r in lake.read(P.STAGING).collect()) == [1, 2, 3, 4]


def test_rows_with_too_many_fields_fail_with_the_line(spark, scratch):
    long = ROW + ["more", ""]
    trailing = ROW + [""]
    for extra in (long, trailing):
        res = validate.check_structure(spark, write_csv(scratch, HEADER, [ROW, extra, ROW[:10]]))
        assert len(res.errors) == 1 and "1 row(s) with more fields" in res.errors[0] and "Air One" in res.errors[0]
    short = validate.check_structure(spark, write_csv(scratch, HEADER, [ROW, ROW[:10]]))
    assert short.ok and short.rows == 2
    assert sorted(r["Class"] or "" for r in short.df.collect()) == ["", "Economy"]


def test_line_breaks_in_quotes(spark, scratch):
    row = list(ROW)
    row[HEADER.index("Source Name")] = '"Dhaka\nAirport"'
    path = os.path.join(scratch, "lines.csv")
    with open(path, "w") as f:
        f.write(",".join(HEADER) + "\n" + ",".join(row) + "\n" + ",".join(ROW) + "\n")
    res = validate.check_structure(spark, path, multiline=True)
    assert res.ok and res.rows == 2
    assert {r["Source Name"] for r in res.df.collect()} == {"Dhaka\nAirport", "Dhaka"}


def test_money_that_does_not_fit_is_reported(spark, scratch):
    row = list(ROW)
    row[HEADER.index("Total Fare (BDT)")] = "1000000000000.00"
    res = validate.check_structure(spark, write_csv(scratch, HEADER, [ROW, row]))
    assert res.errors == ["Column 'Total Fare (BDT)' holds 1 value(s) beyond decimal(18,6)"]


def test_hash_keeps_all_digits(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    rows = []
    for fare, hours in (("0.0000004", "1.0"), ("0.0000001", "1"), ("100", "1e13"), ("100.0", "10000000000000")):
        row = list(ROW)
        row[HEADER.index("Base Fare (BDT)")], row[HEADER.index("Duration (hrs)")] = fare, hours
        rows.append(row)
    assert P.ingest(spark, write_csv(scratch, HEADER, rows), lake).ok
    hashes = [r.row_hash for r in lake.read(P.STAGING).orderBy("id").collect()]
    assert len(set(hashes)) == 3 and hashes[2] == hashes[3]


def test_profile_families(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    bad = list(ROW)
    bad[HEADER.index("Base Fare (BDT)")] = "-1"
    bad[HEADER.index("Class")] = ""
    assert P.ingest(spark, write_csv(scratch, HEADER, [ROW, bad]), lake).ok
    assert lake.read("profile_null_columns").first().missing_value_columns == 1
    assert [(r.issue, r.rows) for r in lake.read("profile_issue_list").collect()] == [("negative_base_fares", 1)]


def test_runs_keep_no_source_files(spark, scratch, monkeypatch):
    """Source files are compressed and go after the last load of them; before, whole text files stayed beside the lake."""
    from farelake.plans import runs
    written = []
    csv = runs.Run.csv

    def noted(run, rows, name):
        path = csv(run, rows, name)
        written.append((run.root, sorted(f.rpartition(".")[2] for f in os.listdir(path) if f.startswith("part-"))))
        return path
    monkeypatch.setattr(runs.Run, "csv", noted)
    steps = runs.promote_incremental(spark, "/root/testdata/sf0.001").collect()
    assert [r.status for r in sorted(steps, key=lambda r: r.step)] == ["FAILURE", "SUCCESS", "SUCCESS", "SUCCESS"]
    assert len(written) == 2 and all(set(kinds) == {"gz"} for _, kinds in written)
    assert os.listdir(written[0][0]) == ["lake"]
