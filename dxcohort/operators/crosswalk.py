"""Roll area counts up to counties through population weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxcohort.schemas import need
from dxcohort.sources.readers import value_columns

AREA_KEYS = {"zcta", "year"}


def county_counts(
    area_counts: DataFrame, weights: DataFrame, value_cols: Sequence[str] | None = None, ordered: bool = True
) -> DataFrame:
    """``SUM(x * pop_pct / 100)`` per ``(year, county)`` for every count
    column, rounded to INT (halves to even) per county.

    The sum is exact (fixed-point, so it does not depend on the order of the
    rows). Every weight row is kept (a county without counts gets 0); areas
    with no county drop out. ``ordered`` sorts by year and county; a job that
    writes partitioned files leaves it out. Both inputs are bounded by geography, not by the
    number of admissions, so this join is small at any data size.
    """
    need(weights, ["year", "zcta", "county", "pop_pct"], "weights")
    need(area_counts, ["zcta", "year"], "area counts")
    cols = list(value_cols) if value_cols is not None else value_columns(area_counts, AREA_KEYS)
    w = weights.select("year", "zcta", "county", "pop_pct").where(F.col("county").isNotNull())
    joined = w.join(area_counts.select("zcta", "year", *[F.col(f"`{c}`") for c in cols]), ["zcta", "year"], "left")
    percent = F.col("pop_pct").cast("decimal(19,12)")
    summed = joined.groupBy("year", "county").agg(
        *[F.sum(F.col(f"`{c}`").cast("decimal(18,0)") * percent).alias(c) for c in cols]
    )
    hundredth = F.lit("0.01").cast("decimal(3,2)")
    out = summed.select(
        "year",
        "county",
        *[F.coalesce(F.bround(F.col(f"`{c}`") * hundredth, 0).cast("int"), F.lit(0)).alias(c) for c in cols],
    )
    return out.orderBy("year", "county") if ordered else out
