"""The user-level jobs, end to end from files (sf0.001)."""

from __future__ import annotations

import pytest
import yaml
from conftest import SF_SMALL

from dxcohort.operators import (
    area_counts,
    cohort_subset,
    index_outcomes,
    observed_codes,
    strat_counts,
    tag_outcomes,
)
from dxcohort.plans import jobs
from dxcohort.sources import codes_frame, read_csv_strings, read_table, write_by_year, write_parquet
from dxcohort.sources import fixtures as fx

CFG = {k: v for k, v in fx.FIXTURE_CODE_LISTS.items()}
NAMES = ["mixed", "single", "econ"]


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    years = fx.order_years(spark, SF_SMALL)
    p = {k: str(root / k) for k in ["adm", "denom", "spine", "w"]}
    write_by_year(fx.admissions(spark, SF_SMALL), p["adm"])
    write_by_year(fx.denom(spark, SF_SMALL, years), p["denom"])
    write_parquet(fx.unique_zcta(spark, SF_SMALL, years), p["spine"])
    write_by_year(fx.zcta2county(spark, SF_SMALL, years), p["w"])
    yml = root / "codes.yml"
    yml.write_text(yaml.safe_dump(CFG, sort_keys=False))
    p["yml"] = str(yml)
    p["root"] = root
    p["years"] = years
    return p


def _rows(df, cols=None):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_jobs_match_operators(spark, files):
    root = files["root"]
    adm = read_table(spark, files["adm"])
    codes = codes_frame(spark, CFG)
    out = str(root / "outcomes")
    jobs.tag_job(spark, files["adm"], files["yml"], out, "first_n", 2)
    tagged = read_table(spark, out)
    cols = ["bene_id", "adm_id", "outcome", "outcome_criteria", "year"]
    assert _rows(tagged, cols) == _rows(tag_outcomes(adm, codes, "first_n", 2), cols)

    only_1995 = str(root / "outcomes_1995")
    jobs.tag_job(spark, files["adm"], CFG, only_1995, "all", years=[1995])
    assert {r.year for r in read_table(spark, only_1995).select("year").distinct().collect()} == {1995}

    cond = str(root / "cond")
    jobs.conditional_job(spark, files["adm"], CFG, cond)
    assert read_table(spark, cond).columns == [
        "bene_id", "adm_id", "diagnoses", "primary_dx", "secondary_dx", "year", "outcome"
    ]
    whole = _rows(read_table(spark, cond).select("adm_id", "year"))
    some = str(root / "cond_some")
    jobs.conditional_job(spark, files["adm"], CFG, some, years=[1995])
    jobs.conditional_job(spark, files["adm"], CFG, some, years=[1996])
    assert _rows(read_table(spark, some).select("adm_id", "year")) == [r for r in whole if r[1] in (1995, 1996)]

    idx = str(root / "idx")
    jobs.index_job(spark, out, files["adm"], idx, outcome="mixed")
    want = index_outcomes(tagged, adm, "mixed")
    assert _rows(read_table(spark, idx), want.columns) == _rows(want)

    yc = str(root / "year_counts")
    jobs.year_counts_job(spark, out, yc)
    assert read_csv_strings(spark, yc).count() == len(files["years"])

    den, spine = read_table(spark, files["denom"]), read_table(spark, files["spine"])
    ac = str(root / "area")
    jobs.area_counts_job(spark, out, files["denom"], files["spine"], ac, NAMES)
    want = area_counts(tagged, den, spine, NAMES)
    assert _rows(read_table(spark, ac), want.columns) == _rows(want)

    sc = str(root / "strat")
    jobs.strat_counts_job(spark, out, files["denom"], files["spine"], sc, NAMES, files["years"])
    assert read_table(spark, sc).count() == strat_counts(tagged, den, spine, NAMES, files["years"]).count()

    cc = str(root / "county")
    jobs.county_counts_job(spark, ac, files["w"], cc)
    county = read_table(spark, cc)
    assert set(NAMES) <= set(county.columns) and county.count() > 0

    co = str(root / "cohort")
    jobs.cohort_job(spark, files["adm"], out, co, "mixed")
    assert read_table(spark, co).count() == cohort_subset(adm, tagged, "mixed").count()

    ob = str(root / "observed")
    jobs.observed_codes_job(spark, files["adm"], "E%", ob)
    assert _rows(read_table(spark, ob)) == _rows(observed_codes(adm, "E%"))

    audit = jobs.audit_job(spark, files["adm"]).collect()
    assert all(r.duplicate_count == 0 for r in audit)
    assert jobs.outcome_list_of(files["yml"]) == list(CFG)


def test_reruns_leave_other_years_and_outcomes(spark, files):
    """CSV years written one by one, and outcomes indexed one by one, coexist."""
    csv = str(files["root"] / "csv_years")
    for year in (1995, 1996, 1995):
        jobs.tag_job(spark, files["adm"], CFG, csv, years=[year], fmt="csv")
    back = read_csv_strings(spark, csv)
    want = tag_outcomes(read_table(spark, files["adm"]).where("year in (1995, 1996)"), codes_frame(spark, CFG), "all")
    cols = ["bene_id", "adm_id", "outcome", "outcome_criteria", "year"]
    assert _rows(back, cols) == sorted(tuple(str(v) for v in r) for r in want.select(cols).collect())

    out, idx = str(files["root"] / "two_out"), str(files["root"] / "two_idx")
    jobs.tag_job(spark, files["adm"], CFG, out)
    for name in ("mixed", "econ"):
        jobs.index_job(spark, out, files["adm"], idx, outcome=name)
    tagged = read_table(spark, out)
    want = index_outcomes(tagged.where("outcome in ('mixed', 'econ')"), read_table(spark, files["adm"]))
    assert _rows(read_table(spark, idx), want.columns) == _rows(want)


def test_numeric_outcome_names_stay_text(spark, files):
    out = str(files["root"] / "numeric")
    jobs.tag_job(spark, files["adm"], {"007": {"icd10": ["S07"]}}, out)
    assert {r.outcome for r in read_table(spark, out).select("outcome").distinct().collect()} == {"007"}


def test_code_lists_end_to_end(spark, files):
    """Valid codes -> expanded list with long names -> tagging with that file."""
    root = files["root"]
    for system, codes in {"icd9": ["E110", "E12", "X1"], "icd10": ["L40", "L41", "M05"]}.items():
        spark.createDataFrame([(c,) for c in codes], "CODE string").write.option("header", "true").csv(str(root / system))
    cfg = {"p": {"long_name": "Some prefixes", "icd9": ["E1"], "icd10": ["L4"]}, "q": {"icd10": ["M05"]}}
    path = str(root / "derived")
    jobs.expand_codes_job(spark, {s: str(root / s) for s in ("icd9", "icd10")}, cfg, path)
    from dxcohort.sources import load_code_lists

    got = load_code_lists(path, spark)
    assert got["p"] == {"long_name": "Some prefixes", "icd9": ["E110", "E12"], "icd10": ["L40", "L41"]}
    assert got["q"]["icd10"] == ["M05"]
    out = str(root / "derived_out")
    jobs.tag_job(spark, files["adm"], path, out)
    want = tag_outcomes(read_table(spark, files["adm"]), codes_frame(spark, got), "all")
    assert read_table(spark, out).count() == want.count() > 0

    jobs.expand_codes_job(spark, {"icd10": str(root / "icd10")}, {"r": {"icd10": ["L4[01]", "M"]}}, str(root / "re"), patterns=True)
    assert load_code_lists(str(root / "re"), spark)["r"]["icd10"] == ["L40", "L41", "M05"]

    ob = str(root / "observed_1995")
    jobs.observed_codes_job(spark, files["adm"], "E%", ob, years=[1995])
    assert _rows(read_table(spark, ob)) == _rows(observed_codes(read_table(spark, files["adm"]).where("year = 1995"), "E%"))


def test_wrong_types_fail_early(spark, files):
    bad = str(files["root"] / "bad")
    adm = read_table(spark, files["adm"])
    adm.withColumn("bene_id", adm.bene_id.cast("string")).write.parquet(bad)
    with pytest.raises(ValueError, match="bene_id"):
        jobs.tag_job(spark, bad, CFG, str(files["root"] / "never"))
