from __future__ import annotations

import random

import pytest

from dxcohort.llm import licenses as l


def rows(seed, n):
    r = random.Random(seed)
    filler = "alpha beta gamma delta license the of under software notice provided following version".split()
    out = []
    for k in range(n):
        parts = [" ".join(r.choice(filler) for _ in range(r.randint(0, 60)))]
        for name in r.sample(sorted(l.TEMPLATES), r.randint(0, 2)):
            w = l.TEMPLATES[name].split()
            for _ in range(r.randint(0, max(1, len(w) // 12))):
                w[r.randrange(len(w))] = r.choice(filler)
            parts += [" ".join(w).upper() if r.random() < 0.3 else " ".join(w), " ".join(r.choice(filler) for _ in range(r.randint(0, 40)))]
        out.append((k, "\n".join(parts)))
    return out


def test_versions_are_told_apart(make_docs):
    texts = [l.TEMPLATES["gpl-3.0-line"], l.TEMPLATES["gpl-2.0-line"], "Intro text. " + l.TEMPLATES["cc-by-nc-4.0-line"]]
    got = {(r["doc_id"], r["license"]) for r in l.op5_license_scan(make_docs(enumerate(texts))).collect()}
    assert got == {(0, "gpl-3.0-line"), (1, "gpl-2.0-line"), (2, "cc-by-nc-4.0-line")}


def test_neighbours_do_not_compete(make_docs):
    """Only templates that share most of their shingles compete, for one stretch."""
    cut = lambda name: " ".join(w for i, w in enumerate(l.TEMPLATES[name].split()) if i != 12)
    texts = [
        "Available under CC BY-NC 4.0. All rights reserved.",
        cut("gpl-3.0") + "\n" + l.TEMPLATES["unlicense"],
        l.TEMPLATES["gpl-2.0-line"] + " " + l.TEMPLATES["gpl-3.0-line"],
        l.TEMPLATES["gpl-2.0-line"],
    ]
    got = {(r["doc_id"], r["license"]) for r in l.op5_license_scan(make_docs(enumerate(texts))).collect()}
    want = [{"cc-by-nc-4.0-line", "all-rights-reserved"}, {"gpl-3.0", "unlicense"}, {"gpl-2.0-line", "gpl-3.0-line"}, {"gpl-2.0-line"}]
    assert got == {(i, name) for i, names in enumerate(want) for name in names}


def test_against_brute_force_by_stretch(make_docs):
    """Every verified match but those whose stretch another template fits better."""
    data, want = rows(1, 250), {}
    for i, text in data:
        words, found = l.words_of(text), []
        for name, t in l.TEMPLATES.items():
            tw = l.words_of(t)
            shingles, size = l._shingles_of(tw), l.window_length(len(tw))
            for start in range(0, max(len(words) - l.K + 1, 0), size // 4):
                at = {k for k in range(start, min(start + size, len(words)) - l.K + 1) if tuple(words[k : k + l.K]) in shingles}
                c = len({tuple(words[k : k + l.K]) for k in at})
                if c >= l.needed(len(shingles)):
                    found.append((size, name, c / len(shingles), at))
        for size, name, c, at in found:
            if not any(z == size and d > c and len(at & o) >= l.SAME * max(len(at), len(o)) for z, _, d, o in found):
                want[i, name] = max(round(c, 6), want.get((i, name), 0))
    got = {(r["doc_id"], r["license"]): r["containment"] for r in l.op5_license_scan(make_docs(data)).collect()}
    assert got == want


def test_anchors_are_lossless():
    words = set(l.anchors(l.TEMPLATES))
    for text in l.TEMPLATES.values():
        shingles = l._shingles_of(l.words_of(text))
        bare = {s for s in shingles if not words & set(s)}
        assert len(bare) < l.needed(len(shingles))


def test_windows_hold_every_stretch():
    for n in range(3, 400):
        size = l.window_length(n)
        assert all(any(s <= at and at + n <= s + size for s in range(0, at + 1, size // 4)) for at in range(size))


def test_band_settings():
    for text in l.TEMPLATES.values():
        n = len(l.words_of(text))
        j = l.least_similarity(l.window_length(n), len(l._shingles_of(l.words_of(text))))
        assert (1 - j) ** l.bands(j) <= l.MISS


def test_odd_rows(make_docs, odd_rows):
    line = l.TEMPLATES["mit-line"]
    data = odd_rows + [(50, line), (50, line), (None, line)]
    got = sorted((str(r["doc_id"]), r["license"], r["first_word"]) for r in l.op5_license_scan(make_docs(data, extra=True)).collect())
    assert got == [("50", "mit-line", 0), ("None", "mit-line", 0)]
    assert l.op5_license_scan(make_docs([])).collect() == []


def test_other_templates(make_docs):
    got = l.license_matches(make_docs([(1, "this is our own notice of terms")]), {"own": "our own notice of terms"}).collect()
    assert [(r["license"], r["containment"]) for r in got] == [("own", 1.0)]
    with pytest.raises(ValueError):
        l.license_matches(make_docs([]), {"short": "two words"})


def test_plan_has_no_python(spark):
    df = l.op5_license_scan(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_lines_in_the_test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {(r["doc_id"], r["license"]) for r in l.op5_license_scan(docs).collect()}
    lines = ["mit-line", "apache-2.0-line", "gpl-3.0-line", "cc-by-nc-4.0-line", "all-rights-reserved"]
    flat = lambda t: f" {' '.join(l.words_of(t))} "  # noqa: E731  (lines with other characters between their words count)
    want = {(r["doc_id"], n) for r in docs.collect() for n in lines if flat(l.TEMPLATES[n]) in flat(r["text"])}
    assert want <= got and len(got) <= len(want) + 2
