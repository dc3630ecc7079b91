from __future__ import annotations

import pytest
from conftest import denom_rows
from pyspark.sql import functions as F

from dxcohort.functions import age_band, int_round_half_even
from dxcohort.operators import (
    area_counts,
    counts_profile,
    county_counts,
    strat_counts,
    strat_observed,
    totals_by_year,
    year_counts_long,
    year_counts_wide,
)
from dxcohort.schemas import AREA_SPINE, AREA_WEIGHTS, OUTCOMES


@pytest.fixture()
def outcomes(spark):
    rows = [
        (1, 10, "x", "all", 2000),
        (1, 11, "x", "all", 2000),
        (1, 12, "y", "all", 2000),
        (2, 20, "x", "all", 2000),
        (3, 30, "x", "all", 2000),  # person-year missing from denom
        (4, 40, "x", "all", 2000),  # area NULL
        (5, 50, "x", "all", 2000),  # area off the spine
        (6, 60, "y", "all", 2001),
        (7, None, "y", "all", 2001),  # NULL admission id
    ]
    return spark.createDataFrame(rows, OUTCOMES)


@pytest.fixture()
def denom(spark):
    return denom_rows(
        spark,
        [
            (1, 2000, "A", 70, 0, 1, 0),
            (2, 2000, "A", 64, 1, 1, 0),  # too young for a band
            (4, 2000, None, 80, 0, 0, 0),
            (5, 2000, "Z", 80, 0, 0, 0),
            (6, 2001, "B", 115, 2, 6, 1),
            (7, 2001, "B", 116, 2, 7, 1),  # too old, race off domain
        ],
    )


@pytest.fixture()
def spine(spark):
    return spark.createDataFrame(
        [("A", 2000), ("B", 2000), ("A", 2001), ("B", 2001), ("C", 2001), ("C", 2001)], AREA_SPINE
    )


def test_age_bands(spark):
    df = spark.createDataFrame([(a,) for a in [64, 65, 75, 76, 100, 101, 115, 116, None]], "age int")
    got = [r[0] for r in df.select(age_band("age")).collect()]
    assert got == [None, "[65,75]", "[65,75]", "[76,85]", "[96,100]", "[101,115]", "[101,115]", None, None]


def test_year_counts(spark, outcomes):
    long = {(r.year, r.outcome): r.n for r in year_counts_long(outcomes).collect()}
    assert long[(2000, "x")] == 6 and long[(2001, "y")] == 1  # NULL id not counted
    wide = {r.year: r for r in year_counts_wide(outcomes, ["x", "y"]).collect()}
    assert wide[2001].x is None  # missing cell stays NULL
    assert wide[2000].y == 1


def test_area_counts(spark, outcomes, denom, spine):
    out = area_counts(outcomes, denom, spine, ["x", "y"])
    got = sorted(tuple(r) for r in out.collect())
    assert got == [
        ("A", 2000, 3, 1),
        ("A", 2001, 0, 0),
        ("B", 2000, 0, 0),
        ("B", 2001, 0, 2),
        ("C", 2001, 0, 0),  # listed twice on the spine: 2 x 0
    ]
    only2000 = area_counts(outcomes, denom, spine, ["x", "y"], years=[2000])
    assert only2000.count() == 2
    prof = counts_profile(out).collect()[0]
    assert prof.n_rows == 5 and prof.n_zcta == 3 and prof.x == 3 and prof.y == 3
    assert [tuple(r) for r in totals_by_year(out).collect()] == [(2000, 3, 1), (2001, 0, 2)]


def test_strat_counts(spark, outcomes, denom, spine):
    out = strat_counts(outcomes, denom, spine, ["x", "y"], years=[2000, 2001])
    assert out.count() == 3 * 2 * 210
    tot = out.agg(F.sum("x"), F.sum("y")).collect()[0]
    area = area_counts(outcomes, denom, spine, ["x", "y"]).agg(F.sum("x"), F.sum("y")).collect()[0]
    assert tot[0] <= area[0] and tot[1] <= area[1]
    cell = out.where(
        "zcta='A' and year=2000 and age_grp='[65,75]' and sex=0 and race=1 and dual=0"
    ).collect()[0]
    assert (cell.x, cell.y) == (2, 1)
    assert tot[0] == 2  # person 2 (age 64) and persons off the domain drop out
    b = out.where("zcta='B' and year=2001 and age_grp='[101,115]' and sex=2 and race=6 and dual=1")
    assert b.collect()[0].y == 1
    obs = strat_observed(outcomes, denom, ["x", "y"])
    assert obs.where(F.col("age_grp").isNull()).count() > 0


def test_county_counts_half_even_and_zero_fill(spark):
    areas = spark.createDataFrame(
        [("A", 2000, 5), ("B", 2000, 3), ("Q", 2000, 9)], "zcta string, year int, x long"
    )
    w = spark.createDataFrame(
        [
            (2000, "A", "K1", 50.0),  # 2.5 -> 2
            (2000, "A", "K2", 50.0),
            (2000, "B", "K2", 50.0),  # 2.5 + 1.5 = 4.0
            (2000, "E", "K3", 100.0),  # county without counts -> 0
            (2000, "B", None, 50.0),  # no county: dropped
        ],
        AREA_WEIGHTS,
    )
    got = [tuple(r) for r in county_counts(areas, w).collect()]
    assert got == [(2000, "K1", 2), (2000, "K2", 4), (2000, "K3", 0)]


def test_half_even_cast(spark):
    df = spark.createDataFrame([(v,) for v in [0.5, 1.5, 2.5, -2.5, 2.4999, 3.5]], "v double")
    assert [r[0] for r in df.select(int_round_half_even("v")).collect()] == [0, 2, 2, -2, 2, 4]
