"""Results extended with new data equal full runs; ranges as data."""

from __future__ import annotations

import random

import pytest
from conftest import SF_SMALL, adm_rows
from pyspark.sql import functions as F

from dxcohort.operators import (
    DATE_COLS,
    area_counts,
    codes_in_range_table,
    distinct_persons,
    extend_index,
    index_outcomes,
    index_state,
    merge_bitmaps,
    next_state,
    person_bitmaps,
    renumbered,
    strat_counts,
    tag_outcomes,
    unseen,
    update_area_counts,
    update_strat_counts,
)
from dxcohort.plans import jobs
from dxcohort.session import materialize
from dxcohort.sources import codes_frame, read_table, write_by_year
from dxcohort.sources import fixtures as fx


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def _events(spark, n, seed, conditional=False):
    """Tagged events with null persons and dates, ties, and a person with many."""
    r = random.Random(seed)
    rows = []
    for k in range(n):
        person = r.choice([None, 1, 1, 1, r.randint(2, 30)])
        date = r.choice([None, f"20{r.randint(10, 13)}-0{r.randint(1, 3)}-0{r.randint(1, 9)}"])
        rows.append((person, k, date, int(date[:4]) if date else 2010, r.choice([["A"], ["B"], ["A", "B"]])))
    codes = {"a": {"icd10": ["A"]}, "b": {"icd10": ["B"]}}
    return tag_outcomes(adm_rows(spark, rows), codes_frame(spark, codes), "all", carry=DATE_COLS)


@pytest.mark.parametrize("heavy", [None, 20])
def test_three_runs_equal_one(spark, heavy):
    tagged = materialize(_events(spark, 300, 3), "tagged")
    first, *later = [tagged.where(F.col("adm_id") % 3 == k) for k in (1, 0, 2)]
    indexed = materialize(index_outcomes(first), "indexed")
    state = index_state(indexed)
    for new in later:
        added, changed = (materialize(df, "run") for df in extend_index(state, indexed, new, heavy_rows=heavy, max_broadcast=0 if heavy else 1000))
        state = materialize(next_state(state, added, changed), "state")
        indexed = materialize(renumbered(indexed, added, changed, max_broadcast=0 if heavy else 1000), "indexed")
        assert _rows(state) == _rows(index_state(indexed))
    assert indexed.columns == index_outcomes(tagged).columns
    assert _rows(indexed) == _rows(index_outcomes(tagged))


def test_only_persons_with_an_earlier_event_are_numbered_again(spark):
    old = [(1, 10, "2010-01-05", 2010, ["A"]), (1, 11, "2010-02-05", 2010, ["A"]), (2, 12, "2010-01-05", 2010, ["A"]), (3, 13, None, 2010, ["A"])]
    new = [(1, 20, "2010-01-20", 2010, ["A"]), (2, 21, "2011-01-05", 2011, ["A"]), (2, 22, "2011-01-01", 2011, ["A"]), (3, 23, None, 2011, ["A"]), (4, 24, "2011-01-01", 2011, ["A"])]
    codes = codes_frame(spark, {"a": {"icd10": ["A"]}})
    tag = lambda rows: tag_outcomes(adm_rows(spark, rows), codes, "all", carry=DATE_COLS)
    indexed = index_outcomes(tag(old))
    added, changed = extend_index(index_state(indexed), indexed, tag(new))
    assert {r.adm_id: r.outcome_index for r in added.collect()} == {20: 2, 21: 3, 22: 2, 23: 2, 24: 1}
    assert {r.adm_id: r.outcome_index for r in changed.collect()} == {11: 3}
    nothing = tag(new).where("false")
    added, changed = extend_index(index_state(indexed), indexed, nothing)
    assert added.collect() == [] and changed.collect() == []
    again = unseen(indexed, tag(old + new + new))
    assert sorted(r.adm_id for r in again.collect()) == [20, 21, 22, 23, 24]


def test_extend_index_job(spark, tmp_path):
    adm = fx.admissions(spark, SF_SMALL)
    codes = codes_frame(spark, {k: v for k, v in fx.FIXTURE_CODE_LISTS.items() if "cond" not in k})
    tagged = materialize(tag_outcomes(adm, codes, "first_n", 2), "tagged")
    p = {n: str(tmp_path / n) for n in ("adm", "one", "all", "index", "state")}
    write_by_year(adm, p["adm"])
    write_by_year(tagged.where("adm_id % 4 <> 0"), p["one"], keys=("year", "outcome"))
    write_by_year(tagged, p["all"], keys=("year", "outcome"))
    jobs.index_job(spark, p["one"], p["adm"], p["index"])
    for _ in range(2):  # the second run finds nothing new
        jobs.extend_index_job(spark, p["all"], p["adm"], p["index"], p["state"])
        got = read_table(spark, p["index"])
        assert _rows(got) == _rows(index_outcomes(tagged, adm).select(*got.columns))
    assert _rows(spark.read.parquet(p["state"] + "/run=2")) == _rows(index_state(got).select(*spark.read.parquet(p["state"] + "/run=2").columns))


def test_counts_take_deltas_back(spark):
    years = fx.order_years(spark, SF_SMALL)
    denom, spine = fx.denom(spark, SF_SMALL, years), fx.unique_zcta(spark, SF_SMALL, years)
    spine = spine.unionByName(spine.limit(3))  # listed twice
    tagged = materialize(fx.with_strangers(tag_outcomes(fx.admissions(spark, SF_SMALL), codes_frame(spark, fx.FIXTURE_CODE_LISTS), "all")), "tagged")
    names = ["mixed", "econ"]
    late = tagged.where("adm_id % 5 = 0")
    area = lambda t: area_counts(t, denom, spine, names, years)
    strat = lambda t: strat_counts(t, denom, spine, names, years)
    before = tagged.where("adm_id % 5 <> 0")
    assert _rows(update_area_counts(materialize(area(before), "s"), late, denom, spine, names)) == _rows(area(tagged))
    assert _rows(update_strat_counts(materialize(strat(before), "s"), late, denom, names)) == _rows(strat(tagged))
    gone = late.withColumn("change", F.lit(-1))
    assert _rows(update_area_counts(materialize(area(tagged), "s"), gone, denom, spine, names, "change")) == _rows(area(before))
    some = update_area_counts(area(before), late, denom, spine, ["mixed"])  # of one outcome only
    assert _rows(some.select("zcta", "year", "mixed")) == _rows(area(tagged).select("zcta", "year", "mixed"))
    assert _rows(some.select("zcta", "year", "econ")) == _rows(area(before).select("zcta", "year", "econ"))
    with pytest.raises(ValueError, match="single"):
        update_area_counts(area(before), late, denom, spine, ["single"])


def test_bitmaps_are_exact_and_mergeable(spark):
    r = random.Random(1)
    rows = [(r.choice([None, -5, 0, 32_768, 32_767, 2**40 + r.randint(0, 99), r.randint(-99, 99)]), 2000 + r.randint(0, 3), r.choice("xy")) for _ in range(500)]
    df = spark.createDataFrame(rows, "bene_id long, year int, outcome string")
    stored = merge_bitmaps(person_bitmaps(df.where("bene_id % 2 = 0")), person_bitmaps(df))
    for years in (None, [2001], [2000, 2003], [1990]):
        mine = [x for x in rows if x[0] is not None and (years is None or x[1] in years)]
        want = {o: len({b for b, _, p in mine if p == o}) for o in {p for _, _, p in mine}}
        assert {x.outcome: x.n_persons for x in distinct_persons(stored, years).collect()} == want
    (total,) = distinct_persons(stored, by=()).collect()
    assert total.n_persons == len({b for b, _, _ in rows if b is not None})


def test_ranges_as_data(spark):
    r = random.Random(8)
    code = lambda: "".join(r.choice("ABCab.1") for _ in range(r.randint(1, 4)))
    codes = [code() for _ in range(150)] + [""]
    ranges = [(r.choice("xyz"), r.randint(1, 4), *(sorted([code(), code()]) if r.random() < 0.9 else [code(), code()])) for _ in range(80)]
    ranges += [("nested", 4, "A" * k, "b" * k) for k in range(1, 5)] + [("null", 2, None, "Z"), ("point", 1, "A", "A")]
    valid = spark.createDataFrame([(c, "icd10") for c in codes] + [(None, "icd10")], "code string, system string")
    out = codes_in_range_table(valid, spark.createDataFrame(ranges, "outcome string, n int, lo string, hi string"))
    want = {(o, c) for o, n, lo, hi in ranges for c in codes if lo is not None and lo <= c[:n] <= hi}
    got = [(x.outcome, x.code) for x in out.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = spark.createDataFrame([], "outcome string, n int, lo string, hi string")
    assert codes_in_range_table(valid, none).collect() == []
