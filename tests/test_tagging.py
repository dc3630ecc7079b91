from __future__ import annotations

import pytest
from conftest import adm_rows, collect_set

from dxcohort.operators import conditional_outcomes, has_code, tag_outcomes
from dxcohort.sources import code_rows, codes_frame, dirty_codes

CFG = {
    "a": {"long_name": "A", "icd9": ["111"], "icd10": ["A10", "A11"]},
    "b": {"icd10": ["B20"]},  # ICD-10 only: valid, no KeyError
    "empty": {"icd9": [], "icd10": []},
    "dirty": {"icd10": ['C563"', " A10"]},
    "c": {
        "primary_icd10": ["P1"],
        "secondary_icd9": ["S9"],
        "secondary_icd10": ["S1", "S2"],
    },
}


@pytest.fixture()
def adm(spark):
    dx26 = ["P1"] + [f"X{i}" for i in range(2, 26)] + ["S1"]  # S1 at position 26
    return adm_rows(
        spark,
        [
            (1, 10, "2000-01-01", 2000, ["Z1", "A10", "A11"]),  # two codes of a
            (1, 11, "2000-02-01", 2000, None),  # NULL array
            (1, 12, "2000-03-01", 2000, []),  # empty array
            (2, 20, "2001-01-01", 2001, ["B20"]),
            (2, 21, "2001-02-01", 2001, ["Z1", "Z2", "111"]),  # a at position 3
            (3, 30, "2001-03-01", 2001, ["P1", "S1"]),  # conditional hit
            (3, 31, "2001-04-01", 2001, ["S1", "P1"]),  # primary not first
            (3, 32, "2001-05-01", 2001, dx26),  # secondary only at 26
            (3, 33, "2001-06-01", 2001, ["P1", "Z", "S2", "S1"]),  # two secondaries
            (4, 40, "2001-07-01", 2001, ["A10"]),
            (4, 40, "2001-07-01", 2001, ["A10"]),  # repeated row
            (5, 50, "2001-07-01", 2001, ["C563", "A10 "]),  # near-dirty codes
        ],
    )


def test_code_rows_flatten_and_skip_missing():
    rows = code_rows(CFG)
    assert ("a", "any", "icd9", "111") in rows
    assert ("b", "any", "icd10", "B20") in rows
    assert not [r for r in rows if r[0] == "empty"]
    assert ("c", "secondary", "icd9", "S9") in rows
    assert {r[3] for r in dirty_codes(CFG)} == {'C563"', " A10"}


def test_all_positions(spark, adm):
    out = tag_outcomes(adm, codes_frame(spark, CFG), "all")
    assert out.columns == ["bene_id", "adm_id", "outcome", "outcome_criteria", "year"]
    got = collect_set(out, "adm_id", "outcome", "outcome_criteria", "year")
    assert got == [
        (10, "a", "all", 2000),
        (20, "b", "all", 2001),
        (21, "a", "all", 2001),
        (40, "a", "all", 2001),
    ]


def test_first_n(spark, adm):
    codes = codes_frame(spark, CFG)
    got = collect_set(tag_outcomes(adm, codes, "first_n", 2), "adm_id", "outcome", "outcome_criteria")
    assert got == [(10, "a", "first_2"), (20, "b", "first_2"), (40, "a", "first_2")]
    # n beyond every array length equals "all"
    big = collect_set(tag_outcomes(adm, codes, "first_n", 100), "adm_id", "outcome")
    assert big == collect_set(tag_outcomes(adm, codes, "all"), "adm_id", "outcome")
    one = collect_set(tag_outcomes(adm, codes, "first_n", 1), "adm_id")
    assert one == [(20,), (40,)]


def test_first_n_requires_n(spark, adm):
    with pytest.raises(ValueError):
        tag_outcomes(adm, codes_frame(spark, CFG), "first_n")
    with pytest.raises(ValueError):
        tag_outcomes(adm, codes_frame(spark, CFG), "nope")


def test_conditional(spark, adm):
    out = tag_outcomes(adm, codes_frame(spark, CFG), "conditional")
    rows = sorted(out.collect(), key=lambda r: r.adm_id)
    assert [r.adm_id for r in rows] == [30, 33]
    assert rows[0].primary_dx == "P1" and rows[0].secondary_dx == ["S1"]
    assert rows[1].secondary_dx == ["Z", "S2", "S1"]
    assert {r.outcome_criteria for r in rows} == {"conditional"}
    only = conditional_outcomes(adm, codes_frame(spark, CFG))
    assert only.columns == ["bene_id", "adm_id", "diagnoses", "primary_dx", "secondary_dx", "outcome"]
    assert only.count() == 2


def test_conditional_secondary_cap_is_parameter(spark, adm):
    out = tag_outcomes(adm, codes_frame(spark, CFG), "conditional", max_secondary_pos=26)
    assert collect_set(out, "adm_id") == [(30,), (32,), (33,)]
    r32 = [r for r in out.collect() if r.adm_id == 32][0]
    assert len(r32.secondary_dx) == 25


def test_exists_plan_equals_join_plan(spark, adm):
    codes = ["A10", "A11", "111"]
    flagged = adm.where(has_code("diagnoses", codes)).select("bene_id", "adm_id", "year").distinct()
    joined = tag_outcomes(adm, codes_frame(spark, {"a": CFG["a"]}), "all")
    assert collect_set(flagged, "adm_id") == collect_set(joined, "adm_id")
    flagged2 = adm.where(has_code("diagnoses", codes, 2)).select("adm_id").distinct()
    joined2 = tag_outcomes(adm, codes_frame(spark, {"a": CFG["a"]}), "first_n", 2)
    assert collect_set(flagged2, "adm_id") == collect_set(joined2, "adm_id")


def test_one_scan_and_broadcast_for_many_outcomes(spark, tmp_path):
    path = str(tmp_path / "adm")
    adm_rows(spark, [(1, 1, "2000-01-01", 2000, ["A10"])]).write.parquet(path)
    adm = spark.read.parquet(path)
    cfg = {f"o{i}": {"icd10": [f"A{i:02d}"]} for i in range(27)}
    out = tag_outcomes(adm, codes_frame(spark, cfg), "all")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    assert out.count() == 1


def test_missing_columns_fail_early(spark, adm):
    with pytest.raises(ValueError, match="admissions lacks"):
        tag_outcomes(adm.drop("diagnoses"), codes_frame(spark, CFG), "all")
    with pytest.raises(ValueError, match="codes lacks"):
        tag_outcomes(adm, codes_frame(spark, CFG).drop("role"), "all")


def test_declared_sizes():
    from dxcohort.sources import size_mismatches

    cfg = {
        "ok": {"icd9": ["1", "2"], "icd9_count": 2, "icd10": ["A"], "icd10_count": 1},
        "bad": {"icd10": ["A", "B", "B"], "icd10_count": 3},
        "none": {"icd10": ["A"]},
    }
    assert size_mismatches(cfg) == [("bad", "icd10", 3, 2)]


def test_united_outcomes_match_columns_by_name(spark):
    from dxcohort.operators import united_outcomes

    adm = adm_rows(spark, [(1, 1, "2000-01-01", 2000, ["A", "B"]), (2, 2, "2000-01-01", 2000, ["B"])])
    plain = tag_outcomes(adm, codes_frame(spark, {"x": {"icd10": ["B"]}}), "all")
    cond = tag_outcomes(adm, codes_frame(spark, {"c": {"primary_icd10": ["A"], "secondary_icd10": ["B"]}}), "conditional")
    got = united_outcomes(plain, cond, plain)
    assert set(got.columns) == set(cond.columns)
    assert sorted((r.outcome, r.adm_id, r.primary_dx) for r in got.where("outcome = 'c' OR adm_id = 1").collect()) == [("c", 1, "A"), ("x", 1, None), ("x", 1, None)]
    assert got.count() == 5 and united_outcomes(plain).columns == plain.columns
    with pytest.raises(ValueError):
        united_outcomes()
    with pytest.raises(ValueError, match="adm_id"):
        united_outcomes(plain, plain.withColumn("adm_id", plain.adm_id.cast("string")))
