"""Stratified counts over a realistic number of areas.

Each nation's area code is split 1000 ways by customer key, giving ~25k
areas; with 7 years and 210 strata the output has ~36.75M rows. Times the
job with a ``noop`` sink and prints the row count.
Run: python tools/strat_scale.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from dxcohort import build_session  # noqa: E402
from dxcohort.operators import strat_counts, tag_outcomes  # noqa: E402
from dxcohort.sources import codes_frame, read_table, write_by_year, write_parquet  # noqa: E402
from dxcohort.sources import fixtures as fx  # noqa: E402


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = build_session("dxcohort-strat-scale", master="local[8]", shuffle_partitions=16)
    work = tempfile.mkdtemp(prefix="dxstrat-")
    years = fx.order_years(spark, sf_dir)
    split = F.lpad((F.col("bene_id") % 1000).cast("string"), 3, "0")
    denom = fx.denom(spark, sf_dir, years).withColumn("zcta", F.concat(F.col("zcta"), split))
    spine = (
        fx.unique_zcta(spark, sf_dir, years)
        .select("zcta", "year", F.explode(F.sequence(F.lit(0), F.lit(999))).alias("_k"))
        .select(F.concat("zcta", F.lpad(F.col("_k").cast("string"), 3, "0")).alias("zcta"), "year")
    )
    write_by_year(denom, f"{work}/denom")
    write_parquet(spine, f"{work}/spine")
    codes = codes_frame(spark, fx.FIXTURE_CODE_LISTS)
    write_by_year(tag_outcomes(fx.admissions(spark, sf_dir), codes, "all"), f"{work}/out")
    den, sp, out = (read_table(spark, f"{work}/{k}") for k in ("denom", "spine", "out"))
    names = ["mixed", "single", "econ"]
    for run in ("cold", "warm"):
        t = time.time()
        strat_counts(out, den, sp, names, years).write.format("noop").mode("overwrite").save()
        print(run, round(time.time() - t, 2), flush=True)
    print("rows", strat_counts(out, den, sp, names, years).count(), "areas", sp.select("zcta").distinct().count())
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
