"""Print the physical plans of the pipeline's steps over materialized layers.

Usage: python tools/plans.py [sf_dir] > PLANS.md
Each plan is the final adaptive plan after execution, trimmed to operators.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from farelake.functions.dates import departure_month  # noqa: E402
from farelake.operators import bronze as B  # noqa: E402
from farelake.operators import changes, dims, kpi, silver  # noqa: E402
from farelake.operators.fact import fact_bookings  # noqa: E402
from farelake.session import local_session  # noqa: E402
from farelake.sources.fixture import fixture_bronze  # noqa: E402


def trimmed(df) -> str:
    df.collect()   # executes this DataFrame's own query, so its adaptive plan is final
    text = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in text.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        if "FileScan" in line:
            head = line[:line.index("FileScan") + len("FileScan parquet")]
            keep = [m.group(0) for m in re.finditer(
                r"(PartitionFilters|PushedFilters|ReadSchema): (\[[^\]]*\]|struct<[^>]*>)", line)]
            out.append(head + " " + ", ".join(keep))
        else:
            out.append(line[:160])
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    d = tempfile.mkdtemp(prefix="farelake-plans-")
    raw = B.with_row_hash(fixture_bronze(spark, sf)).withColumn(
        "departure_month", departure_month("departure_datetime"))
    raw.write.partitionBy("departure_month").parquet(f"{d}/bronze")
    bronze = spark.read.parquet(f"{d}/bronze")
    silver.stg_bookings(bronze).write.parquet(f"{d}/stg")
    stg = spark.read.parquet(f"{d}/stg")
    dims.dim_airline(stg).write.parquet(f"{d}/da")
    dims.dim_route(stg).write.parquet(f"{d}/dr")
    da, dr = spark.read.parquet(f"{d}/da"), spark.read.parquet(f"{d}/dr")
    fact_bookings(stg, dr).write.parquet(f"{d}/fact")
    fact = spark.read.parquet(f"{d}/fact")
    batch = bronze.where(F.col("departure_month") == "1995-03")
    steps = {
        "stg_bookings (dedupe: partial + final WindowGroupLimit, pushed filters)": silver.stg_bookings(bronze),
        "fct_flight_bookings (route dimension broadcast by file size; no shuffle of bookings)": fact_bookings(stg, dr),
        "kpi_avg_fare (the aggregate and the sketch's brackets are a written table; one scan selects the median)": kpi.kpi_avg_fare(fact, da),
        "kpi_popular_routes (over the written aggregate: ranks on 1 row/route, top-k)": kpi.kpi_popular_routes(fact, dr),
        "kpi_seasonal (windows instead of a cross join)": kpi.kpi_seasonal(fact),
        "incremental_new_rows (target pruned to the batch's months and reduced by its keys, key-only)":
            changes.new_rows(batch, bronze, prune_by="departure_month"),
    }
    print(f"# Physical plans ({os.path.basename(sf.rstrip('/'))}, local[8], final adaptive plans)\n")
    print("Generated by `python tools/plans.py`. Layers are read back from Parquet, as in the pipeline.\n")
    for title, df in steps.items():
        print(f"## {title}\n\n```\n{trimmed(df)}\n```\n")


if __name__ == "__main__":
    main()
