"""Operators against plain-Python implementations of the reference SQL."""

from __future__ import annotations

from collections import Counter

from conftest import adm_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dxcohort.operators import area_counts, tag_outcomes
from dxcohort.schemas import AREA_SPINE, DENOM
from dxcohort.sources import codes_frame

ALPHABET = ["A1", "A2", "B1", "B2", "C1", "P1", "S1"]

dx = st.one_of(st.none(), st.lists(st.sampled_from(ALPHABET), min_size=0, max_size=6))
adm_row = st.tuples(st.integers(1, 4), st.integers(1, 12), st.sampled_from([2000, 2001]), dx)
code_list = st.lists(st.sampled_from(ALPHABET), min_size=0, max_size=3, unique=True)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _brute_tag(rows, cfg, criteria, n=None):
    out = set()
    for bene, adm, year, arr in rows:
        for outcome, spec in cfg.items():
            codes = set(spec.get("icd10", []))
            if criteria == "all":
                hit = any(c in codes for c in (arr or []))
            else:
                hit = any((arr or [])[k] in codes for k in range(min(n, len(arr or []))))
            if hit:
                out.add((bene, adm, outcome, year))
    return sorted(out)


def _brute_conditional(rows, prim, sec):
    out = set()
    for bene, adm, year, arr in rows:
        if arr and arr[0] in prim and any(c in sec for c in arr[1:25]):
            out.add((bene, adm, tuple(arr), year))
    return sorted(out)


def _adm(spark, rows):
    return adm_rows(spark, [(b, a, "2000-01-01", y, arr) for b, a, y, arr in rows])


@SETTINGS
@given(rows=st.lists(adm_row, max_size=25), a=code_list, b=code_list, n=st.integers(1, 4))
def test_tagging_matches_brute_force(spark, rows, a, b, n):
    cfg = {"a": {"icd10": a}, "b": {"icd10": b}}
    adm = _adm(spark, rows)
    codes = codes_frame(spark, cfg)
    got = sorted((r.bene_id, r.adm_id, r.outcome, r.year) for r in tag_outcomes(adm, codes, "all").collect())
    assert got == _brute_tag(rows, cfg, "all")
    got_n = sorted(
        (r.bene_id, r.adm_id, r.outcome, r.year) for r in tag_outcomes(adm, codes, "first_n", n).collect()
    )
    assert got_n == _brute_tag(rows, cfg, "first_n", n)


@SETTINGS
@given(rows=st.lists(adm_row, max_size=25), prim=code_list, sec=code_list)
def test_conditional_matches_brute_force(spark, rows, prim, sec):
    cfg = {"c": {"primary_icd10": prim, "secondary_icd10": sec}}
    out = tag_outcomes(_adm(spark, rows), codes_frame(spark, cfg), "conditional")
    got = sorted((r.bene_id, r.adm_id, tuple(r.diagnoses), r.year) for r in out.collect())
    assert got == _brute_conditional(rows, set(prim), set(sec))


person = st.tuples(st.integers(1, 6), st.sampled_from([2000, 2001]), st.sampled_from(["Z1", "Z2", "Z9", None]))


@SETTINGS
@given(
    tagged=st.lists(st.tuples(st.integers(1, 6), st.sampled_from([2000, 2001]), st.sampled_from(["a", "b"])), max_size=30),
    people=st.lists(person, max_size=12, unique_by=lambda p: (p[0], p[1])),
    spine=st.lists(st.tuples(st.sampled_from(["Z1", "Z2", "Z3"]), st.sampled_from([2000, 2001])), max_size=8),
)
def test_area_counts_match_brute_force(spark, tagged, people, spine):
    outcomes = spark.createDataFrame(
        [(b, k, o, "all", y) for k, (b, y, o) in enumerate(tagged)],
        "bene_id long, adm_id long, outcome string, outcome_criteria string, year int",
    )
    denom = spark.createDataFrame([(b, y, z, 70, 0, 0, 0) for b, y, z in people], DENOM)
    sp = spark.createDataFrame(spine, AREA_SPINE)
    got = sorted(tuple(r) for r in area_counts(outcomes, denom, sp, ["a", "b"]).collect())
    area_of = {(b, y): z for b, y, z in people}
    n = Counter()
    for b, y, o in tagged:
        z = area_of.get((b, y))
        if (b, y) in area_of and z is not None:
            n[(z, y, o)] += 1
    mult = Counter(spine)
    want = sorted((z, y, n[(z, y, "a")] * m, n[(z, y, "b")] * m) for (z, y), m in mult.items())
    assert got == want


day = st.one_of(st.none(), st.integers(1, 6))


@SETTINGS
@given(
    events=st.lists(st.tuples(st.integers(1, 3), st.sampled_from(["a", "b"]), day), min_size=1, max_size=30),
    heavy=st.booleans(),
)
def test_index_matches_brute_force(spark, events, heavy):
    import datetime as dt

    from dxcohort.operators import index_outcomes

    rows = [
        (b, k, o, "all", 2000, dt.date(2000, 1, d) if d else None, None) for k, (b, o, d) in enumerate(events)
    ]
    tagged = spark.createDataFrame(
        rows,
        "bene_id long, adm_id long, outcome string, outcome_criteria string, year int, "
        "admission_date date, discharge_date date",
    )
    out = index_outcomes(tagged, heavy_rows=2 if heavy else None, sample_fraction=1.0)
    got = {(r.adm_id): r.outcome_index for r in out.collect()}
    want = {}
    for (b, o) in {(b, o) for b, o, _ in events}:
        mine = [(d is None, d or 0, k) for k, (bb, oo, d) in enumerate(events) if (bb, oo) == (b, o)]
        for n, (_, _, k) in enumerate(sorted(mine), start=1):
            want[k] = n
    assert got == want


@SETTINGS
@given(
    counts=st.lists(st.integers(0, 9), min_size=3, max_size=3),
    shares=st.lists(st.sampled_from([12.5, 25.0, 37.5, 50.0, 62.5, 100.0]), min_size=3, max_size=3),
    target=st.lists(st.sampled_from(["K1", "K2", None]), min_size=3, max_size=3),
)
def test_county_matches_brute_force(spark, counts, shares, target):
    from dxcohort.operators import county_counts
    from dxcohort.schemas import AREA_WEIGHTS

    areas = spark.createDataFrame(
        [(f"Z{i}", 2000, c) for i, c in enumerate(counts)], "zcta string, year int, x long"
    )
    w = spark.createDataFrame(
        [(2000, f"Z{i}", t, p) for i, (t, p) in enumerate(zip(target, shares))] + [(2000, "Z9", "K3", 100.0)],
        AREA_WEIGHTS,
    )
    got = {r.county: r.x for r in county_counts(areas, w).collect()}
    sums = {"K3": 0.0}
    for i, (t, p) in enumerate(zip(target, shares)):
        if t is not None:
            sums[t] = sums.get(t, 0.0) + counts[i] * (p / 100)
    assert got == {k: round(v) for k, v in sums.items()}
