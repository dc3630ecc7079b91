"""Each size-checked broadcast has a shuffled fallback with equal results."""

from __future__ import annotations

from conftest import SF_SMALL

from dxcohort.operators import (
    attach_dates,
    cohort_subset,
    expand_prefixes,
    people_of,
    prefixes_frame,
    tag_outcomes,
)
from dxcohort.operators import tagging
from dxcohort.sources import codes_frame
from dxcohort.sources import fixtures as fx


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_fallbacks_equal_broadcast_paths(spark, monkeypatch):
    adm = fx.admissions(spark, SF_SMALL)
    codes = codes_frame(spark, fx.FIXTURE_CODE_LISTS)
    tagged = tag_outcomes(adm, codes, "first_n", 2)

    assert _rows(cohort_subset(adm, tagged, "mixed", max_broadcast_persons=0)) == _rows(
        cohort_subset(adm, tagged, "mixed")
    )
    assert _rows(attach_dates(tagged, adm, max_broadcast_ids=0)) == _rows(attach_dates(tagged, adm))
    people = fx.denom(spark, SF_SMALL).select("bene_id", "year", "zcta")
    joined = lambda p: tagged.join(p, ["bene_id", "year"])
    assert _rows(joined(people_of(tagged, people, max_keys=0))) == _rows(joined(people_of(tagged, people)))
    assert _rows(joined(people_of(tagged, people))) == _rows(joined(people))

    want_all = _rows(tag_outcomes(adm, codes, "all"))
    want_cond = _rows(tag_outcomes(adm, codes, "conditional"))
    monkeypatch.setattr(tagging, "MAX_BROADCAST_CODES", 0)
    monkeypatch.setattr(tagging, "MAX_PREFILTER_CODES", 0)
    monkeypatch.setattr(tagging, "MAX_COLLECT_CODES", 0)
    assert _rows(tag_outcomes(adm, codes, "all")) == want_all
    assert _rows(tag_outcomes(adm, codes, "conditional")) == want_cond

    valid = fx.valid_codes(spark, SF_SMALL)
    pre = prefixes_frame(spark, {"e": {"icd10": ["E1", "E"]}})
    from dxcohort.operators import codebook

    want = _rows(expand_prefixes(valid, pre))
    monkeypatch.setattr(codebook, "MAX_BROADCAST_PREFIXES", 0)
    assert _rows(expand_prefixes(valid, pre)) == want


def test_audit_fallback_equals_broadcast(spark):
    from dxcohort.operators import duplicate_groups

    adm = fx.admissions(spark, SF_SMALL)
    doubled = adm.unionByName(adm.where("adm_source = '1-URGENT'"))
    assert _rows(duplicate_groups(doubled, max_broadcast=0)) == _rows(duplicate_groups(doubled))
    assert len(_rows(duplicate_groups(doubled))) > 0
