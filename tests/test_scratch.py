"""Scratch tables end with the job, or with the lazily returned frame."""

from __future__ import annotations

import gc
import os

import pytest
from conftest import SF_SMALL, adm_rows
from pyspark.sql import functions as F

from dxcohort import session
from dxcohort.operators import index_outcomes, tag_outcomes
from dxcohort.operators.numbering import row_number_skew_safe, with_places
from dxcohort.plans import jobs
from dxcohort.plans.catalog import spark_query
from dxcohort.session import ensure_checkpoint_dir, is_written, materialize, scoped_frame, scratch_path, scratch_scope, sweep_scratch
from dxcohort.sources import codes_frame, read_table, write_by_year, write_parquet
from dxcohort.sources import fixtures as fx


@pytest.fixture()
def left(spark):
    """Names in the shared folder that were not there before the test."""
    gc.collect()
    sweep_scratch(spark)
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    return lambda: set(os.listdir(folder)) - before


def test_scope_removes_after_a_failure_and_nests(spark, left):
    with scratch_scope(spark):
        materialize(spark.range(5), "outer")
        with pytest.raises(RuntimeError), scratch_scope(spark):
            materialize(spark.range(5), "inner")
            assert len(left()) == 2
            raise RuntimeError
        assert len(left()) == 1
    assert left() == set()
    kept = scratch_path(spark, "kept")  # without an owner a path stays
    spark.range(1).write.parquet(kept)
    assert len(left()) == 1
    session.remove_path(spark, kept)


def test_lazy_frame_stays_readable_as_long_as_it_is_used(spark, left):
    df = scoped_frame(spark, lambda: materialize(spark.range(50), "lazy"))
    derived = df.where("id < 20").select((F.col("id") * 2).alias("x"))
    del df
    gc.collect()
    sweep_scratch(spark)
    assert derived.count() == 20 and len(left()) == 1
    assert derived.union(derived).distinct().count() == 20
    del derived
    gc.collect()
    sweep_scratch(spark)
    assert left() == set()

    def fails():
        materialize(spark.range(5), "lost")
        raise RuntimeError

    with pytest.raises(RuntimeError):
        scoped_frame(spark, fails)
    assert left() == set()
    plain = spark.range(3)
    assert scoped_frame(spark, lambda: plain) is plain


@pytest.mark.parametrize("name", ["outcome_index", "outcome_index_heavy", "strat_counts", "io_code_list_tag", "duplicate_audit_reload", "stream_tag_first_n"])
def test_queries_leave_nothing(spark, left, name):
    rows = spark_query(name)(spark, SF_SMALL).select("*").collect()  # the first frame is gone before the rows are read
    gc.collect()
    sweep_scratch(spark)
    assert rows and left() == set()


def test_jobs_leave_nothing_and_workflow_reports(spark, tmp_path, left):
    years = fx.order_years(spark, SF_SMALL)
    p = {n: str(tmp_path / n) for n in ("adm", "denom", "spine", "weights", "out", "post", "tag", "retag", "index", "cohort")}
    write_by_year(fx.admissions(spark, SF_SMALL), p["adm"])
    write_by_year(fx.denom(spark, SF_SMALL, years), p["denom"])
    write_parquet(fx.unique_zcta(spark, SF_SMALL, years), p["spine"])
    write_by_year(fx.zcta2county(spark, SF_SMALL, years), p["weights"])
    cfg = {k: v for k, v in fx.FIXTURE_CODE_LISTS.items() if not k.startswith("cond")}
    report = jobs.workflow_job(spark, p["adm"], cfg, p["denom"], p["spine"], p["weights"], p["out"], "first_n", 2)
    areas = read_table(spark, p["out"] + "/area_counts")
    for o in cfg:
        assert report["area_counts"][o]["total"] == areas.agg(F.sum(o)).first()[0]
    assert report["area_counts"][""] == {"n_rows": areas.count(), "n_zcta": areas.select("zcta").distinct().count()}
    jobs.postings_job(spark, p["adm"], p["post"])
    jobs.retag_job(spark, p["post"], cfg, p["retag"], "first_n", 2)
    jobs.tag_job(spark, p["adm"], cfg, p["tag"], "first_n", 2)
    jobs.index_job(spark, p["tag"], p["adm"], p["index"])
    jobs.cohort_job(spark, p["adm"], p["tag"], p["cohort"], "mixed")
    assert left() == set()
    rows = lambda d: sorted(map(tuple, read_table(spark, d).select("bene_id", "adm_id", "outcome", "year").collect()))
    assert rows(p["retag"]) == rows(p["tag"]) == rows(p["index"])
    missing = str(tmp_path / "nothing")
    with pytest.raises(Exception):
        jobs.index_job(spark, p["tag"], missing, p["index"])
    assert left() == set()


def test_workflow_writes_the_tagged_rows_once(spark, tmp_path, monkeypatch):
    """The event index reads the written outcomes; nothing copies them."""
    written, real = [], session.materialize
    monkeypatch.setattr(session, "materialize", lambda df, name: (written.append(name), real(df, name))[1])
    adm = fx.admissions(spark, SF_SMALL)
    tagged = tag_outcomes(adm, codes_frame(spark, fx.FIXTURE_CODE_LISTS), "all", carry=["admission_date", "discharge_date"])
    write_by_year(tagged, str(tmp_path / "t"), keys=("year", "outcome"))
    table = read_table(spark, str(tmp_path / "t"))
    assert is_written(table) and is_written(table.where("outcome = 'mixed'").select("bene_id")) and not is_written(table.distinct())
    want = sorted(map(str, index_outcomes(tagged.select(*table.columns)).collect()))
    assert "tagged" in written
    written.clear()
    assert sorted(map(str, index_outcomes(table).collect())) == want
    assert "tagged" not in written


def test_places_follow_the_order(spark):
    df = spark.range(1000, numPartitions=7).select((F.col("id") * 7919 % 1000).alias("x")).orderBy(F.desc("x"))
    assert sorted(map(tuple, with_places(df, "place").collect())) == [(x, 999 - x) for x in range(1000)]
    assert with_places(df.where("x < 0"), "place").collect() == []


def test_heavy_numbering_needs_no_checkpoint(spark):
    adm = adm_rows(spark, [(1, k, "2000-01-01", 2000, ["X"]) for k in range(200)])
    out = row_number_skew_safe(adm, ["bene_id"], [F.col("adm_id")], "n", heavy_rows=10, sample_fraction=1.0)
    assert [(r.adm_id, r.n) for r in out.orderBy("adm_id").collect()] == [(k, k + 1) for k in range(200)]


def test_sketch_finds_every_group_at_the_bound(spark):
    """Just at the bound, beside a thousand groups just below it; null groups too."""
    from dxcohort.operators import numbering as nb

    sizes = {None: 50, "a": 50, "b": 49, "c": 51, **{f"g{k}": 49 for k in range(300)}}
    rows = [(g, k) for g, n in sizes.items() for k in range(n)]
    df = spark.createDataFrame(rows, "g string, x int").repartition(5)
    sketch = nb.count_min(df, ["g"])
    merged = nb.count_min(df.where("x % 2 = 0"), ["g"]).unionByName(nb.count_min(df.where("x % 2 = 1"), ["g"])).groupBy("seed", "counter").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, sketch.collect()))
    light, hot, estimate = nb.split_heavy(df, sketch, ["g"], 50)
    heavy = {r.g for r in hot.select("g").distinct().collect()}
    assert {None, "a", "c"} <= heavy and len(heavy) < 6 and estimate >= 151
    assert light.count() + hot.count() == len(rows) and not heavy & {r.g for r in light.select("g").distinct().collect()}
    narrow = nb.split_heavy(df, nb.count_min(df, ["g"], 3), ["g"], 50, 3)  # a sketch that is far too small: all rows take the balanced path
    assert narrow[1].count() == len(rows)
    for bound in (1, 50, 52, 10_000):
        out = row_number_skew_safe(df, ["g"], [F.col("x")], "n", heavy_rows=bound)
        assert all(r.n == r.x + 1 for r in out.collect()) and out.count() == len(rows)
    assert nb.split_heavy(df, sketch, ["g"], 10_000)[1] is None
