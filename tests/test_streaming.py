from __future__ import annotations

from conftest import adm_rows

from dxcohort.operators import tag_outcomes
from dxcohort.sources import codes_frame
from dxcohort.streaming import admissions_stream, read_year_counts, start_tagging, start_year_counts, tag_stream

CFG = {"x": {"icd10": ["X1", "X2"]}, "y": {"icd9": ["Y1"]}}

ROWS1 = [
    (1, 10, "2000-01-01", 2000, ["X1", "X2"]),
    (1, 11, "2000-02-01", 2000, ["Q", "Y1"]),
    (2, 20, "2000-03-01", 2000, None),
]
ROWS2 = [
    (1, 10, "2000-01-01", 2000, ["X1", "X2"]),  # the same admission again
    (3, 30, "2001-01-01", 2001, ["X2", "Y1"]),
]


def test_stream_matches_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    adm_rows(spark, ROWS1).write.mode("append").parquet(src)
    adm_rows(spark, ROWS2).write.mode("append").parquet(src)
    codes = codes_frame(spark, CFG)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    q = start_tagging(spark, src, codes, out, ckpt, "all")
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(
        "bene_id", "adm_id", "outcome", "outcome_criteria", "year").collect())
    batch = adm_rows(spark, ROWS1 + ROWS2)
    want = sorted(tuple(r) for r in tag_outcomes(batch, codes, "all").collect())
    assert got == want

    # a restart with no new files adds nothing
    q2 = start_tagging(spark, src, codes, out, ckpt, "all")
    q2.awaitTermination(120)
    assert spark.read.parquet(out).count() == len(want)


def test_stream_counts(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "counts")
    adm_rows(spark, ROWS1 + ROWS2).write.parquet(src)
    codes = codes_frame(spark, CFG)
    run = lambda: start_year_counts(
        tag_stream(admissions_stream(spark, src), codes, "first_n", 1), out, str(tmp_path / "ck2")
    ).awaitTermination(120)
    counts = lambda: {(r.year, r.outcome): r.n for r in read_year_counts(spark, out).collect()}
    run()
    assert counts() == {(2000, "x"): 1, (2001, "x"): 1}
    adm_rows(spark, [(4, 40, "1999-01-01", 1999, ["X1"])]).write.mode("append").parquet(src)
    run()
    assert counts() == {(1999, "x"): 1, (2000, "x"): 1, (2001, "x"): 1}


def test_late_first_copies_stay_and_late_copies_go(spark, tmp_path):
    """A file of older admissions in a later run loses nothing, and a copy of
    a row written years before is not written again."""
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    codes = codes_frame(spark, CFG)
    adm_rows(spark, [(1, 10, "2005-06-01", 2005, ["X1"]), (9, 90, None, None, ["Y1"])]).write.parquet(src)
    start_tagging(spark, src, codes, out, ckpt).awaitTermination(120)
    later = [
        (2, 20, "2001-01-01", 2001, ["X2"]),  # older than anything seen: a first copy
        (1, 10, "2005-06-01", 2005, ["X1"]),  # a copy
        (9, 90, None, None, ["Y1"]),  # a copy without a year
        (9, 91, None, None, ["Y1"]),
    ]
    adm_rows(spark, later).write.mode("append").parquet(src)
    start_tagging(spark, src, codes, out, ckpt).awaitTermination(120)
    got = sorted((r.adm_id, r.outcome, r.year) for r in spark.read.parquet(out).collect())
    assert got == [(10, "x", 2005), (20, "x", 2001), (90, "y", None), (91, "y", None)]


def test_a_batch_run_again_adds_nothing(spark, tmp_path):
    from dxcohort.operators import tag_outcomes as tag
    from dxcohort.streaming.incremental import KEYS, _append_new

    out = str(tmp_path / "out")
    batch = tag(adm_rows(spark, ROWS1), codes_frame(spark, CFG), "all")
    _append_new(batch.limit(1), out, KEYS)  # a run that broke off
    _append_new(batch, out, KEYS)
    _append_new(batch, out, KEYS)
    assert spark.read.parquet(out).count() == batch.count()


def test_stream_conditional_matches_batch(spark, tmp_path):
    cfg = {"c": {"primary_icd10": ["P1"], "secondary_icd10": ["S1", "S2"]}}
    rows = [
        (1, 10, "2000-01-01", 2000, ["P1", "S1", "S2"]),
        (1, 10, "2000-01-01", 2000, ["P1", "S1", "S2"]),
        (2, 20, "2000-02-01", 2000, ["S1", "P1"]),
        (3, 30, "2001-01-01", 2001, ["P1", "Q", "S2"]),
    ]
    src = str(tmp_path / "src")
    adm_rows(spark, rows).write.parquet(src)
    codes = codes_frame(spark, cfg)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    q = start_tagging(spark, src, codes, out, ckpt, "conditional")
    q.awaitTermination(120)
    cols = ["bene_id", "adm_id", "primary_dx", "outcome", "outcome_criteria", "year"]
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(*cols).collect())
    want = sorted(tuple(r) for r in tag_outcomes(adm_rows(spark, rows), codes, "conditional").select(*cols).collect())
    assert got == want and len(got) == 2
