"""How often inputs are read, what is broadcast, and NULL and tie handling."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL, adm_rows, denom_rows
from pyspark.sql import functions as F

from dxcohort.operators import (
    DATE_COLS,
    area_counts,
    area_drop_report,
    audit_duplicates,
    cohort_subset,
    duplicate_groups,
    expand_patterns,
    index_outcomes,
    strat_counts,
    tag_outcomes,
)
from dxcohort.schemas import AREA_SPINE, OUTCOMES, VALID_CODES
from dxcohort.sources import codes_frame
from dxcohort.sources import fixtures as fx


@pytest.fixture()
def counted(spark):
    """Admissions, their number, and an accumulator of the rows read."""
    read = spark.sparkContext.accumulator(0)
    base = fx.admissions(spark, SF_SMALL).cache()

    def pass_on(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    yield base.mapInArrow(pass_on, base.schema), base.count(), read
    base.unpersist()


def test_composed_operators_read_the_admissions_once(spark, counted):
    adm, n, read = counted
    codes = codes_frame(spark, {k: v for k, v in fx.FIXTURE_CODE_LISTS.items() if "cond" not in k})
    years = fx.order_years(spark, SF_SMALL)
    denom, spine = fx.denom(spark, SF_SMALL, years), fx.unique_zcta(spark, SF_SMALL, years)

    def reads(make) -> float:
        before = read.value
        make().write.format("noop").mode("overwrite").save()
        return (read.value - before) / n

    tag = lambda **kw: tag_outcomes(adm, codes, "all", **kw)
    assert reads(tag) == 1
    assert reads(lambda: area_counts(tag(), denom, spine)) == 1
    assert reads(lambda: area_counts(tag(), denom, spine, ["mixed"], years[:2])) == 1
    assert reads(lambda: strat_counts(tag(), denom, spine, None, years)) == 1
    assert reads(lambda: area_drop_report(tag(), denom, spine)) == 1
    assert reads(lambda: index_outcomes(tag(carry=DATE_COLS))) == 1
    assert reads(lambda: index_outcomes(tag(), adm)) == 2  # tagged from it, dated from it
    assert reads(lambda: cohort_subset(adm, tag(), "mixed")) == 2
    assert reads(lambda: tag_outcomes(adm, codes_frame(spark, fx.FIXTURE_CODE_LISTS), "conditional")) == 1


def test_persons_behind_a_bloom_filter_are_tagged_once(spark, counted):
    adm, n, read = counted
    tagged = tag_outcomes(adm, codes_frame(spark, {"mixed": fx.FIXTURE_CODE_LISTS["mixed"]}), "all")
    before = read.value
    cohort_subset(adm, tagged, max_broadcast_persons=0).write.format("noop").mode("overwrite").save()
    assert (read.value - before) / n == 2  # tagged from it, chosen from it


def test_repeated_keys_are_not_broadcast(spark, monkeypatch):
    adm = adm_rows(spark, [(1, k, "2000-01-01", 2000, ["X"]) for k in range(200)])
    tagged = tag_outcomes(adm, codes_frame(spark, {"x": {"icd10": ["X"]}}), "all")
    sent = []
    real = F.broadcast
    monkeypatch.setattr(F, "broadcast", lambda df: (sent.append(df.count()), real(df))[1])
    assert cohort_subset(adm, tagged, "x").count() == 200 and sent == [1]
    sent.clear()
    denom = denom_rows(spark, [(1, 2000, "A", 70, 0, 1, 0)])
    spine = spark.createDataFrame([("A", 2000)], AREA_SPINE)
    assert [tuple(r) for r in area_counts(tagged, denom, spine, ["x"]).collect()] == [("A", 2000, 200)] and sent == [1]


def test_null_years_are_audited(spark):
    adm = adm_rows(spark, [(1, 1, "2000-01-01", None, ["A"])] * 2 + [(1, 1, "2000-01-01", 2000, ["A"])])
    assert [(r.year, r.cnt) for r in duplicate_groups(adm).collect()] == [(None, 2)]
    assert {r.year: r.duplicate_count for r in audit_duplicates(adm).collect()} == {None: 1, 2000: 0}


def test_heavy_null_person_is_numbered_exactly(spark):
    rows = [(None, k, f"2000-01-{1 + k % 28:02d}", 2000, ["X"]) for k in range(300)]
    rows += [(7, 1000 + k, "2000-02-01", 2000, ["X"]) for k in range(3)]
    tagged = tag_outcomes(adm_rows(spark, rows), codes_frame(spark, {"x": {"icd10": ["X"]}}), "all", carry=DATE_COLS)
    plain = index_outcomes(tagged, heavy_rows=None)
    heavy = index_outcomes(tagged, heavy_rows=50, sample_fraction=1.0)
    key = lambda df: sorted((str(r.bene_id), r.adm_id, r.outcome_index) for r in df.collect())
    assert key(heavy) == key(plain) and len(key(heavy)) == 303


def test_conditional_ties_are_broken_by_the_codes(spark):
    rows = [(1, 10, "2000-01-01", 2000, ["P1", "S1", x]) for x in ("C", "A", "B")]
    codes = codes_frame(spark, {"c": {"primary_icd10": ["P1"], "secondary_icd10": ["S1"]}})
    tagged = tag_outcomes(adm_rows(spark, rows), codes, "conditional", carry=DATE_COLS)
    for heavy in (None, 1):
        out = index_outcomes(tagged.repartition(5), heavy_rows=heavy, sample_fraction=1.0).collect()
        assert sorted((r.outcome_index, r.diagnoses[2]) for r in out) == [(1, "A"), (2, "B"), (3, "C")]


def test_drop_report_of_repeated_person_years(spark):
    outcomes = spark.createDataFrame([(b, k, "x", "all", 2000) for k, b in enumerate((1, 2, 3, 4, None))], OUTCOMES)
    denom = denom_rows(spark, [
        (1, 2000, "Z", 70, 0, 0, 0), (1, 2000, "A", 70, 0, 0, 0),  # one of its areas is on the spine
        (2, 2000, None, 70, 0, 0, 0), (2, 2000, "Z", 70, 0, 0, 0),  # off the spine
        (3, 2000, None, 70, 0, 0, 0), (3, 2000, None, 70, 0, 0, 0),
    ])
    spine = spark.createDataFrame([("A", 2000), ("A", 2001)], AREA_SPINE)
    got = [tuple(r) for r in area_drop_report(outcomes, denom, spine).collect()]
    assert got == [(2000, "x", 5, 2, 1, 1)]
    assert area_drop_report(outcomes, denom, spine, years=[1999]).collect() == []


def test_patterns_do_not_join_on_the_system_alone(spark):
    valid = spark.createDataFrame([("E10", "icd10"), ("E11", "icd10"), ("E110", "icd9"), ("F1", "icd10")], VALID_CODES)
    lists = spark.createDataFrame(
        [("a", "icd10", "E1"), ("a", "icd10", "F[0-9]$"), ("b", "icd9", "E.1"), ("b", "icd10", "")],
        "outcome string, system string, prefix string",
    )
    out = expand_patterns(valid, lists)
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("a", "icd10", "E10"), ("a", "icd10", "E11"), ("a", "icd10", "F1"), ("b", "icd10", "E10"),
                   ("b", "icd10", "E11"), ("b", "icd10", "F1"), ("b", "icd9", "E110")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "[system" in plan and "prefix" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
