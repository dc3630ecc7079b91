"""Event-index numbering under skew: one person holds a third of 6M rows.

Compares the plain window with the heavy-group path; both print the same
checksum (sum and max of the row numbers). Run: python tools/skew_index.py
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from dxcohort import build_session  # noqa: E402
from dxcohort.operators import row_number_skew_safe  # noqa: E402


def main() -> None:
    spark = build_session(master="local[8]", shuffle_partitions=16)
    n = 6_000_000
    df = spark.range(n).select(
        F.lit("x").alias("outcome"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 200000 + 1).alias("bene_id"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") * 7919 % 6000).cast("int")).alias(
            "admission_date"
        ),
        F.col("id").alias("adm_id"),
    )
    path = os.path.join(tempfile.mkdtemp(prefix="dxskew-"), "data")
    df.write.mode("overwrite").parquet(path)
    data = spark.read.parquet(path)
    order = [F.col("admission_date").asc_nulls_last(), F.col("adm_id").asc()]

    def run(name, out):
        t = time.time()
        r = out.groupBy().agg(F.sum("rn").alias("s"), F.max("rn").alias("m")).collect()[0]
        print(name, round(time.time() - t, 2), r.s, r.m, flush=True)

    for _ in range(2):
        run("window", row_number_skew_safe(data, ["outcome", "bene_id"], order, "rn", heavy_rows=None))
        run("heavy ", row_number_skew_safe(data, ["outcome", "bene_id"], order, "rn", heavy_rows=500_000))
    spark.stop()


if __name__ == "__main__":
    main()
