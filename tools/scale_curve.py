"""Wall time of the core jobs as the admissions grow.

The sf0.1 admissions are replicated k times with distinct admission ids (the
same persons, so each person's event history grows k-fold too), written as
year-partitioned Parquet, and the core jobs are timed on each size.
Run: python tools/scale_curve.py [sf_dir] [k ...]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from dxcohort import build_session  # noqa: E402
from dxcohort.operators import (  # noqa: E402
    area_counts,
    cohort_subset,
    index_outcomes,
    strat_counts,
    tag_outcomes,
)
from dxcohort.sources import codes_frame, read_table, write_by_year, write_parquet  # noqa: E402
from dxcohort.sources import fixtures as fx  # noqa: E402

NAMES = ["mixed", "single", "econ"]


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    ks = [int(k) for k in argv[1:]] or [1, 4, 16]
    spark = build_session("dxcohort-scale", master="local[8]", shuffle_partitions=16)
    work = tempfile.mkdtemp(prefix="dxscale-")
    years = fx.order_years(spark, sf_dir)
    base = fx.admissions(spark, sf_dir)
    write_by_year(fx.denom(spark, sf_dir, years), f"{work}/denom")
    write_parquet(fx.unique_zcta(spark, sf_dir, years), f"{work}/spine")
    den, spine = read_table(spark, f"{work}/denom"), read_table(spark, f"{work}/spine")
    codes = codes_frame(spark, fx.FIXTURE_CODE_LISTS)
    max_id = base.agg(F.max("adm_id")).collect()[0][0] + 1
    results = {}
    for k in ks:
        copies = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_copy")
        rep = base.select("*", copies).withColumn("adm_id", F.col("adm_id") + F.col("_copy") * F.lit(max_id))
        path = f"{work}/adm_{k}"
        write_by_year(rep.drop("_copy"), path)
        adm = read_table(spark, path)
        out_path = f"{work}/out_{k}"
        t = time.time()
        write_by_year(tag_outcomes(adm, codes, "all"), out_path)
        timings = {"tag_all_write": round(time.time() - t, 2)}
        outc = read_table(spark, out_path)
        jobs = {
            "outcome_index": lambda: index_outcomes(outc, adm),
            "area_counts": lambda: area_counts(outc, den, spine, NAMES, years),
            "strat_counts": lambda: strat_counts(outc, den, spine, NAMES, years),
            "cohort_subset": lambda: cohort_subset(adm, outc, "mixed"),
        }
        for name, build in jobs.items():
            t = time.time()
            build().write.format("noop").mode("overwrite").save()
            timings[name] = round(time.time() - t, 2)
        results[f"x{k} ({adm.count()} admissions)"] = timings
        print(json.dumps({f"x{k}": timings}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
