from __future__ import annotations

from conftest import adm_rows
from pyspark.sql import functions as F

from dxcohort.operators import (
    DATE_COLS,
    index_outcomes,
    index_profile,
    row_number_skew_safe,
    tag_outcomes,
)
from dxcohort.sources import codes_frame

CFG = {"x": {"icd10": ["X1"]}, "y": {"icd10": ["Y1"]}}


def _adm(spark):
    return adm_rows(
        spark,
        [
            (1, 13, "2000-05-01", 2000, ["X1"], "2001-01-02"),  # tie with 12 on date
            (1, 12, "2000-05-01", 2000, ["X1", "Y1"]),
            (1, 11, "2000-01-01", 2000, ["X1"]),
            (1, 14, None, 2001, ["X1"]),  # NULL date sorts last
            (1, 15, "1999-01-01", 1999, ["Y1"]),
            (2, 21, "2001-01-01", 2001, ["X1"]),
            (3, 31, "2001-01-01", 2001, ["Z9"]),
        ],
    )


def test_index_numbers_by_date_then_adm_id(spark):
    adm = _adm(spark)
    tagged = tag_outcomes(adm, codes_frame(spark, CFG), "all")
    idx = index_outcomes(tagged, adm)
    assert idx.columns == [
        "bene_id", "adm_id", "outcome", "outcome_criteria", "year",
        "discharge_year", "admission_date", "discharge_date", "outcome_index",
    ]
    got = sorted((r.outcome, r.bene_id, r.adm_id, r.outcome_index) for r in idx.collect())
    assert got == [
        ("x", 1, 11, 1), ("x", 1, 12, 2), ("x", 1, 13, 3), ("x", 1, 14, 4),
        ("x", 2, 21, 1),
        ("y", 1, 12, 2), ("y", 1, 15, 1),
    ]
    r13 = [r for r in idx.collect() if r.adm_id == 13][0]
    assert r13.discharge_year == 2001


def test_index_from_carried_dates_equals_join(spark):
    adm = _adm(spark)
    codes = codes_frame(spark, CFG)
    joined = index_outcomes(tag_outcomes(adm, codes, "all"), adm)
    carried = index_outcomes(tag_outcomes(adm, codes, "all", carry=DATE_COLS))
    assert sorted(joined.collect()) == sorted(carried.collect())


def test_heavy_path_equals_window(spark):
    # 3 persons, one of them heavy; forced through the range-numbering path.
    rows = [(1, 1000 + k, f"2000-{1 + k % 12:02d}-{1 + k % 28:02d}", 2000, ["X1"]) for k in range(400)]
    rows += [(2, 5000 + k, "2000-03-03", 2000, ["X1"]) for k in range(5)]
    rows += [(3, 6000, None, 2000, ["X1"])]
    adm = adm_rows(spark, rows)
    tagged = tag_outcomes(adm, codes_frame(spark, CFG), "all", carry=DATE_COLS)
    plain = index_outcomes(tagged, heavy_rows=None)
    heavy = index_outcomes(tagged, heavy_rows=50, sample_fraction=1.0)
    assert sorted(plain.collect()) == sorted(heavy.collect())
    # 1..k without gaps per person
    per = heavy.groupBy("bene_id").agg(
        F.min("outcome_index").alias("lo"), F.max("outcome_index").alias("hi"), F.count("*").alias("n")
    )
    assert all(r.lo == 1 and r.hi == r.n for r in per.collect())


def test_row_number_skew_safe_all_heavy(spark):
    df = spark.range(0, 3000).select(
        (F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 3000).alias("k")
    )
    order = [F.col("k").asc()]
    a = row_number_skew_safe(df, ["g"], order, "rn", heavy_rows=None)
    b = row_number_skew_safe(df, ["g"], order, "rn", heavy_rows=10, sample_fraction=1.0)
    assert sorted(a.collect()) == sorted(b.collect())


def test_index_profile(spark):
    adm = _adm(spark)
    idx = index_outcomes(tag_outcomes(adm, codes_frame(spark, CFG), "all"), adm)
    prof = {r.outcome: r for r in index_profile(idx).collect()}
    assert prof["x"].n_bene == 2 and prof["x"].n_rows == 5
    assert str(prof["y"].min_date) == "1999-01-01"


def test_checkpoint_dir_comes_from_session(spark):
    from dxcohort.session import ensure_checkpoint_dir, scratch_path

    d = ensure_checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir() == d
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        assert configured.rstrip("/").split("/")[-1] in d or d.startswith("file:" + configured.rstrip("/"))
    assert scratch_path(spark, "x").startswith(d)
