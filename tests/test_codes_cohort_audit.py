from __future__ import annotations

from conftest import adm_rows, collect_set

from dxcohort.operators import (
    audit_duplicates,
    code_sizes,
    codes_in_ranges,
    cohort_subset,
    duplicate_groups,
    expand_patterns,
    expand_prefixes,
    family_prefixes,
    observed_codes,
    prefixes_frame,
    tag_outcomes,
)
from dxcohort.schemas import VALID_CODES
from dxcohort.sources import code_list_table, codes_frame

VALID = [
    ("E1", "icd10"), ("E10", "icd10"), ("E11", "icd10"), ("E111", "icd10"), ("E2", "icd10"),
    ("I10", "icd10"), ("I79", "icd10"), ("I80", "icd10"), ("Q200", "icd10"), ("Q281", "icd10"),
    ("4011", "icd9"), ("401", "icd9"), ("4281", "icd9"),
]


def _valid(spark):
    return spark.createDataFrame(VALID, VALID_CODES)


def test_prefix_expansion_is_distinct_with_overlaps(spark):
    pre = prefixes_frame(spark, {"d": {"icd10": ["E1", "E11"], "icd9": ["401"]}, "all": {"icd10": [""]}})
    out = expand_prefixes(_valid(spark), pre)
    got = [tuple(r) for r in out.collect()]
    d = [r for r in got if r[0] == "d"]
    assert d == [("d", "icd10", "E1"), ("d", "icd10", "E10"), ("d", "icd10", "E11"),
                 ("d", "icd10", "E111"), ("d", "icd9", "401"), ("d", "icd9", "4011")]
    assert len([r for r in got if r[0] == "all"]) == 10  # empty prefix: every ICD-10 code
    regex = expand_patterns(_valid(spark), pre.where("outcome = 'd'"))
    assert collect_set(regex, "outcome", "system", "code") == sorted(d)
    sizes = {(r.outcome, r.system): r.n_codes for r in code_sizes(out).collect()}
    assert sizes[("d", "icd10")] == 4 and sizes[("d", "icd9")] == 2
    table = {r.outcome: r for r in code_list_table(out).collect()}
    assert table["d"].icd9 == ["401", "4011"] and table["d"].icd10 == ["E1", "E10", "E11", "E111"]


def test_ranges(spark):
    out = codes_in_ranges(_valid(spark), [(3, "I00", "I79"), (4, "Q200", "Q280")])
    assert collect_set(out, "code") == [("I10",), ("I79",), ("Q200",)]


def test_families(spark):
    fam = family_prefixes(spark, [("cvd", "icd10", "I", 10, 80, 2), ("h", "icd9", "", 401, 403, 0)])
    pres = collect_set(fam, "prefix")
    assert ("I10",) in pres and ("I79",) in pres and ("I80",) not in pres and ("401",) in pres
    out = expand_patterns(_valid(spark), fam)
    assert collect_set(out, "outcome", "code") == [("cvd", "I10"), ("cvd", "I79"), ("h", "401"), ("h", "4011")]


def test_observed_codes(spark):
    adm = adm_rows(
        spark,
        [
            (1, 1, "2000-01-01", 2000, ["J1", "E1", "J1"]),
            (1, 2, "2001-01-01", 2001, ["J2", None]),
            (2, 3, "2001-01-01", 2001, None),
        ],
    )
    assert [r.code for r in observed_codes(adm, "J%").collect()] == ["J1", "J2"]


def test_cohort_subset_superset_of_tagged(spark):
    adm = adm_rows(
        spark,
        [
            (1, 1, "2000-01-01", 2000, ["X"]),
            (1, 2, "2001-01-01", 2001, ["Q"]),
            (2, 3, "2001-01-01", 2001, ["Q"]),
            (3, 4, "2001-01-01", 2001, ["X"]),
        ],
    )
    tagged = tag_outcomes(adm, codes_frame(spark, {"x": {"icd10": ["X"]}, "q": {"icd10": ["Q"]}}), "all")
    sub = cohort_subset(adm, tagged, "x")
    assert sub.columns == adm.columns
    assert collect_set(sub, "adm_id") == [(1,), (2,), (4,)]
    tagged_x = {r.adm_id for r in tagged.where("outcome='x'").collect()}
    assert tagged_x <= {r.adm_id for r in sub.collect()}
    assert cohort_subset(adm, tagged).count() == 4


def test_duplicate_audit_counts_groups(spark):
    base = [
        (1, 1, "2000-01-01", 2000, ["A", "B"]),
        (1, 1, "2000-01-01", 2000, ["A", "B"]),
        (1, 1, "2000-01-01", 2000, ["A", "B"]),  # one group of three
        (1, 1, "2000-01-01", 2000, ["B", "A"]),  # differs in order: not a duplicate
        (2, 2, "2001-01-01", 2001, None),
        (2, 2, "2001-01-01", 2001, None),  # NULLs group together
        (3, 3, "2002-01-01", 2002, ["C"]),
    ]
    adm = adm_rows(spark, base)
    got = {r.year: r.duplicate_count for r in audit_duplicates(adm).collect()}
    assert got == {2000: 1, 2001: 1, 2002: 0}
    groups = {r.adm_id: r.cnt for r in duplicate_groups(adm).collect()}
    assert groups == {1: 3, 2: 2}


def test_valid_codes_from_csv(spark, tmp_path):
    from dxcohort.sources import read_valid_codes

    icd9 = tmp_path / "icd9.csv"
    icd9.write_text("CODE,LONG DESCRIPTION\n4011,Benign hypertension\n401,Essential\n")
    icd10 = tmp_path / "icd10.csv"
    icd10.write_text("I10,Essential hypertension\nI110,Hypertensive heart disease\n")
    valid = read_valid_codes(spark, str(icd9), "icd9").unionByName(
        read_valid_codes(spark, str(icd10), "icd10", header=False)
    )
    assert collect_set(valid, "code", "system") == [("401", "icd9"), ("4011", "icd9"), ("I10", "icd10"), ("I110", "icd10")]
    pre = prefixes_frame(spark, {"htn": {"icd9": ["401"], "icd10": ["I1"]}})
    assert len(expand_prefixes(valid, pre).collect()) == 4
