"""Data audits and profiles of the outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxcohort.functions.expressions import BROADCAST_BYTES, PAIR_KEY_BYTES
from dxcohort.session import materialize
from dxcohort.sources.readers import value_columns

# Up to this many repeated (year, hash) keys (64 MB as a hash relation) are
# broadcast so the second pass over the admissions is a row-local filter.
MAX_BROADCAST_HASHES = BROADCAST_BYTES // PAIR_KEY_BYTES

AUDIT_COLS = ["adm_id", "bene_id", "admission_date", "diagnoses", "discharge_date", "year", "adm_source"]


def duplicate_groups(
    admissions: DataFrame, cols: Sequence[str] = AUDIT_COLS, max_broadcast: int = MAX_BROADCAST_HASHES
) -> DataFrame:
    """Groups of identical rows (over ``cols``) that occur more than once.

    A 64-bit hash of the row is counted first: that shuffle moves a few
    bytes per row instead of the row, and a heavily repeated row collapses
    map-side. The repeated hashes (few in any usable table) are written to
    the checkpoint folder, counted, and broadcast, so the second pass over
    the admissions is a row-local filter; only the candidate rows are then
    grouped exactly, so hash collisions cannot create false duplicates. Years
    are compared null-safe: rows without a year can be duplicates too.
    """
    cols = list(cols)
    hashed = admissions.select(*cols, F.xxhash64(*cols).alias("_h"))
    repeated = materialize(
        hashed.groupBy("year", "_h").count().where(F.col("count") > 1).select(F.col("year").alias("_y"), F.col("_h").alias("_k")),
        "repeated_hashes",
    )
    side = F.broadcast(repeated) if repeated.count() <= max_broadcast else repeated
    candidates = hashed.join(side, F.col("year").eqNullSafe(F.col("_y")) & (F.col("_h") == F.col("_k")), "left_semi")
    return candidates.groupBy(*cols).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


def audit_duplicates(admissions: DataFrame, cols: Sequence[str] = AUDIT_COLS) -> DataFrame:
    """Duplicate *groups* per year; years without duplicates report 0."""
    per_year = duplicate_groups(admissions, cols).groupBy(F.col("year").alias("_y")).agg(
        F.count(F.lit(1)).alias("duplicate_count")
    )
    years = admissions.select("year").distinct()
    return years.join(per_year, F.col("year").eqNullSafe(F.col("_y")), "left").select(
        "year", F.coalesce("duplicate_count", F.lit(0)).cast("long").alias("duplicate_count")
    )


COUNT_KEYS = ("zcta", "county", "year", "age_grp", "sex", "race", "dual")


def counts_profile(counts: DataFrame, keys: Sequence[str] = COUNT_KEYS) -> DataFrame:
    """Rows, distinct areas (``n_zcta`` or, of a county table, ``n_county``) and
    the total of every count column of an area, county or stratified table."""
    cols = value_columns(counts, set(keys) | set(COUNT_KEYS))
    area = "zcta" if "zcta" in counts.columns else "county"
    return counts.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(area).alias(f"n_{area}"),
        *[F.sum(F.col(f"`{c}`")).alias(c) for c in cols],
    )


def totals_by_year(counts: DataFrame, keys: Sequence[str] = COUNT_KEYS) -> DataFrame:
    """Re-aggregate a count table to one row per year, ordered."""
    cols = value_columns(counts, set(keys) | set(COUNT_KEYS))
    return counts.groupBy("year").agg(*[F.sum(F.col(f"`{c}`")).alias(c) for c in cols]).orderBy("year")
