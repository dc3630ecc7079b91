"""Tagging from the posting table, Bloom filters, and the check of admission ids."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL, adm_rows
from pyspark.sql import functions as F

from dxcohort.functions import bloom
from dxcohort.operators import (
    DATE_COLS,
    area_counts,
    attach_dates,
    cohort_subset,
    index_outcomes,
    posting_rows,
    read_postings,
    strat_counts,
    tag_outcomes,
    tag_postings,
    write_postings,
)
from dxcohort.operators import postings as postings_module
from dxcohort.sources import codes_frame
from dxcohort.sources import fixtures as fx


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def _scans(df) -> list[tuple[int, int]]:
    """Rows that each file scan of an executed frame has given."""
    df.collect()

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        found = [node.metrics().apply("numOutputRows").value()] if name.startswith("Scan parquet") else []
        for k in range(node.children().size()):
            found += walk(node.children().apply(k))
        return found

    return walk(df._jdf.queryExecution().executedPlan())


CODES = {"any": {"icd10": ["A", "B"], "icd9": ["C"]}, "again": {"icd10": ["B"]}, "none": {"icd10": []}, "p": {"primary_icd10": ["A"], "secondary_icd10": ["B"]}}


def test_equal_to_tagging_the_admissions(spark, tmp_path):
    rows = [
        (1, 1, "2000-01-01", 2000, ["A", "A", "B"]), (1, 2, "2000-01-02", 2000, [None, "B", "C"]), (2, 3, "2001-01-01", 2001, []),
        (2, 4, "2001-01-01", 2001, None), (None, 5, "2001-01-01", 2001, ["C"]), (3, None, None, 2001, ["X", "Y", "C", None]),
        (3, 6, "2001-01-01", None, ["A"]), (3, 6, "2001-01-01", None, ["B"]), (4, 7, "2002-01-01", 2002, ["Z"]),
    ]
    adm = adm_rows(spark, rows + [rows[0]])
    write_postings(adm, str(tmp_path / "p"), carry=DATE_COLS, files=3)
    table, codes = read_postings(spark, str(tmp_path / "p")), codes_frame(spark, CODES)
    for criteria, n in (("all", None), ("first_n", 1), ("first_n", 2), ("first_n", 3), ("first_n", 99)):
        want = tag_outcomes(adm, codes, criteria, n)
        got = tag_postings(table, codes, criteria, n)
        assert got.columns == want.columns and _rows(got) == _rows(want)
    years = tag_postings(table, codes, years=[2001], carry=DATE_COLS)
    assert _rows(years) == _rows(tag_outcomes(adm.where("year = 2001"), codes, carry=DATE_COLS))
    assert tag_postings(table, codes_frame(spark, {"none": {"icd10": []}})).collect() == []
    for wrong in ({"criteria": "conditional"}, {"criteria": "first_n"}):
        with pytest.raises(ValueError):
            tag_postings(table, codes, **wrong)


def test_a_year_is_added_without_the_others(spark, tmp_path):
    a = adm_rows(spark, [(1, 1, "2000-01-01", 2000, ["A"]), (1, 2, "2001-01-01", 2001, ["A"])])
    path = str(tmp_path / "p")
    write_postings(a, path)
    write_postings(adm_rows(spark, [(1, 3, "2001-01-05", 2001, ["B"]), (1, 4, "2002-01-05", 2002, ["B"])]), path)
    assert sorted((r.code, r.year, r.adm_id) for r in read_postings(spark, path).collect()) == [("A", 2000, 1), ("B", 2001, 3), ("B", 2002, 4)]


def test_records_read_follow_the_listed_codes(spark, tmp_path):
    """A hundred times the admissions of other codes: no more is read for a rare list."""
    path, small = str(tmp_path / "p"), str(tmp_path / "q")
    others = spark.range(300_000).select(
        F.col("id").alias("bene_id"), F.col("id").alias("adm_id"), F.lit(2000).alias("year"),
        F.array(F.concat(F.lit("K"), F.lpad((F.col("id") % 700).cast("string"), 3, "0")), F.lit("V99")).alias("diagnoses"),
    )
    rare = spark.range(60).select(
        (-F.col("id")).alias("bene_id"), (-F.col("id") - 1).alias("adm_id"), F.lit(2000).alias("year"), F.array(F.lit("L77")).alias("diagnoses")
    )
    write_postings(others.unionByName(rare), path, files=4, row_group_bytes=256 * 1024)
    write_postings(others.where("id % 100 = 0").unionByName(rare), small, files=4, row_group_bytes=256 * 1024)
    codes = codes_frame(spark, {"rare": {"icd10": ["L77", "K0005"]}})  # the second lies between others' codes
    tagged = tag_postings(read_postings(spark, path), codes)
    (read,) = _scans(tagged)
    assert tagged.count() == 60 and read <= 21_000  # a page holds 20,000 rows; the table 600,060
    (few,) = _scans(tag_postings(read_postings(spark, small), codes))
    assert read <= few + 20_000
    absent = codes_frame(spark, {"absent": {"icd10": ["K0001", "K0999", "M1"]}})
    assert _scans(tag_postings(read_postings(spark, path), absent)) == [0]


def test_long_lists_become_ranges(spark, tmp_path, monkeypatch):
    codes = [f"A{i:02d}{x}" for i in range(50) for x in "019"] + ["B", "Ba", "C9"]
    for most in (1, 2, 3, 60, 153):
        ranges = postings_module.code_ranges(codes, most)
        assert len(ranges) <= most and all(any(a <= c <= b for a, b in ranges) for c in codes)
    assert postings_module.code_ranges([], 5) == []
    adm = fx.admissions(spark, SF_SMALL)
    write_postings(adm, str(tmp_path / "p"))
    table, lists = read_postings(spark, str(tmp_path / "p")), codes_frame(spark, fx.FIXTURE_CODE_LISTS)
    want = _rows(tag_outcomes(adm, lists))
    monkeypatch.setattr(postings_module, "MAX_LOOKUPS", 3)
    monkeypatch.setattr(postings_module, "MAX_RANGES", 2)
    assert _rows(tag_postings(table, lists)) == want
    monkeypatch.setattr(postings_module, "MAX_COLLECT_CODES", 0)
    assert _rows(tag_postings(table, lists)) == want


def test_hot_code_is_spread_over_files(spark, tmp_path):
    adm = spark.range(40_000).select("id", F.col("id").alias("bene_id"), F.col("id").alias("adm_id"), F.lit(2000).alias("year"), F.array(F.lit("I10")).alias("diagnoses"))
    write_postings(adm, str(tmp_path / "p"), files=8)
    per_file = spark.read.parquet(str(tmp_path / "p")).groupBy(F.input_file_name()).count().collect()
    assert len(per_file) >= 6 and max(r["count"] for r in per_file) < 12_000
    assert posting_rows(adm).count() == 40_000


# --- Bloom filters ------------------------------------------------------------------


def test_filter_holds_all_keys_and_few_others(spark):
    keys = spark.range(5_000).select((F.col("id") * 7).cast("int").alias("k"), F.concat(F.lit("x"), "id").alias("s"))
    blocks = bloom.blocks_for(5_000)
    table = bloom.bloom_table(keys, ["k", "s"], blocks)
    assert table.count() <= blocks
    assert bloom.might_hold(keys.withColumn("k", F.col("k").cast("long")), ["k", "s"], table, blocks).count() == 5_000
    others = spark.range(100_000).select((F.col("id") * 7 + 1).alias("k"), F.concat(F.lit("x"), "id").alias("s"))
    assert bloom.might_hold(others, ["k", "s"], table, blocks).count() < 1_000
    halves = [bloom.bloom_table(keys.where(f"k % 2 = {i}"), ["k", "s"], blocks) for i in (0, 1)]
    assert _rows(bloom.merge_blooms(*halves)) == _rows(table)
    assert bloom.blocks_for(10**12) == 0 and bloom.blocks_for(0) == 1


def test_same_rows_without_broadcast_and_few_of_the_others_shuffled(spark, monkeypatch):
    adm = fx.admissions(spark, SF_SMALL)
    tagged = tag_outcomes(adm, codes_frame(spark, fx.FIXTURE_CODE_LISTS), "first_n", 1)
    rare = tagged.where("outcome = 'single'")
    years = fx.order_years(spark, SF_SMALL)
    denom, spine = fx.denom(spark, SF_SMALL, years), fx.unique_zcta(spark, SF_SMALL, years)
    want = [_rows(cohort_subset(adm, rare)), _rows(index_outcomes(rare, adm)), _rows(area_counts(rare, denom, spine)), _rows(strat_counts(rare, denom, spine))]
    passed, real = [], bloom.might_hold

    def counted(df, cols, table, blocks):
        out = real(df, cols, table, blocks)
        passed.append((df.count(), out.count()))
        return out

    monkeypatch.setattr(bloom, "might_hold", counted)
    from dxcohort.operators import counts, events

    monkeypatch.setattr(events._attach_dates, "__defaults__", (0, "raise"))
    monkeypatch.setattr(counts.people_of, "__defaults__", (0,))
    got = [
        _rows(cohort_subset(adm, rare, max_broadcast_persons=0)), _rows(index_outcomes(rare, adm)), _rows(area_counts(rare, denom, spine)),
        _rows(strat_counts(rare, denom, spine)),
    ]
    assert got == want and len(passed) == 4
    matching = [len(want[0]), rare.select("adm_id").distinct().count()] + [rare.select("bene_id", "year").distinct().count()] * 2
    for (before, after), n in zip(passed, matching, strict=True):
        assert after < before and after <= n + before * 0.02


# --- unique admission ids -----------------------------------------------------------------


def test_a_repeated_admission_id_ends_the_job_with_its_name(spark):
    adm = adm_rows(spark, [(1, 10, "2000-01-01", 2000, ["A"]), (2, 10, "2000-02-01", 2000, ["B"]), (3, 11, "2000-03-01", 2000, ["A"]), (4, 12, None, 2000, ["C"])])
    tagged = tag_outcomes(adm, codes_frame(spark, CODES), "first_n", 1).where("outcome = 'any'")
    for bound in (0, 100):
        with pytest.raises(Exception, match="admission id 10 occurs 2 times"):
            attach_dates(tagged, adm, bound).collect()
        told = attach_dates(tagged, adm, bound, on_repeat="report")
        assert sorted((r.bene_id, r.adm_id, str(r.admission_date), r.adm_rows) for r in told.collect()) == [
            (1, 10, "2000-01-01", 2), (2, 10, "2000-01-01", 2), (3, 11, "2000-03-01", 1), (4, 12, "None", 1)
        ]
    with pytest.raises(Exception, match="admission id 10 occurs 2 times"):
        index_outcomes(tagged, adm).collect()
    fine = tagged.where("adm_id <> 10")  # a repeat that no tagged row has does not matter
    assert index_outcomes(fine, adm).count() == 2
    with pytest.raises(ValueError):
        attach_dates(tagged, adm, on_repeat="maybe")


def test_the_check_needs_no_exchange_of_its_own(spark):
    adm = fx.admissions(spark, SF_SMALL)
    tagged = tag_outcomes(adm, codes_frame(spark, fx.FIXTURE_CODE_LISTS))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from dxcohort.session import materialize

        out = attach_dates(tagged, materialize(adm, "adm"), max_broadcast_ids=0)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(adm_id") == 2  # the tagged rows and the dates, once each
