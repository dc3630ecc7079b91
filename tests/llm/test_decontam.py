from __future__ import annotations

import random

import numpy as np
import pytest

from dxcohort.llm import decontam as d

WORDS = ["stone", "river", "canal", "light", "forge", "metal", "ocean", "paper", "grain", "cloud", "ember", "quartz", "violet", "harbor"]


def prose(r, n):
    return " ".join(r.choice(WORDS) + str(r.randint(0, 99)) for _ in range(n))


def infix_distance(w, text):
    """Least edits between ``w`` and any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(w, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (t != c), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(r, text, edits):
    for _ in range(edits):
        k, how = r.randrange(len(text)), r.random()
        text = text[:k] + ("" if how < 0.33 else r.choice("abcxyz09")) + text[k + (how < 0.66) :]
    return text


def squeezed(text):
    return "".join(map(chr, d.letters(text)))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(seed):
    """Every window within its edit budget is found, with its least edits, and no other."""
    r = random.Random(seed)
    items = [prose(r, n) for n in (5, 9, 22, 40)]
    block = d.Block(list(range(len(items))), items)
    for _ in range(12):
        item = r.choice(items)
        text = prose(r, r.randint(0, 8)) + edited(r, item, r.randint(0, 14)) + prose(r, r.randint(0, 8))
        got = d.window_edits(d.letters(text), block)
        want = {}
        for k, windows in enumerate(block.windows):
            for number, (start, w, e, _) in enumerate(windows):
                n = infix_distance(squeezed(items[k])[start : start + w], squeezed(text))
                if n <= e:
                    want[k, number] = n
        assert got == want


def test_lemma_bound():
    """No region within the budget shares fewer q-grams than the filter asks for."""
    r = random.Random(4)
    for _ in range(200):
        w = squeezed(prose(r, 30))[: r.choice([40, 60, 100, 120])]
        e = len(w) * d.EDIT_PERCENT // 100
        text = edited(r, w, e)
        shared = set(d.grams(d.letters(w)).tolist()) & set(d.grams(d.letters(text)).tolist())
        assert len(shared) >= len(w) + 1 - d.Q * (e + 1)


def test_decorations_case_and_spacing_do_not_hide():
    item = "Rere andthhaedble st oflyhable thhati bleti, erntsh in in. Than Hentat rend ndeshe."
    block = d.Block([7], [item])
    text = "intro " + " ".join(w.upper() + "%%%" for w in item.split()) + "\n| outro |"
    assert d.matches(d.letters(text), block) == {0: (len(block.windows[0]), 0)}
    assert d.matches(d.letters("rere st in in than " * 30), block) == {}


def test_passages_of_a_long_item_at_every_offset():
    """Verbatim passages of the least length and beyond, wherever they begin."""
    r = random.Random(9)
    item = squeezed(prose(r, 60))[:300]
    block = d.Block([1], [item])
    for size in (d.WINDOW, 75, 114, 166):
        for at in range(0, 300 - size + 1):
            got = d.matches(d.letters("zq " * 20 + item[at : at + size] + " qz" * 20), block)
            assert got[0][0] >= size - d.WINDOW + 1 and got[0][1] == 0


def test_an_item_without_a_tenth_at_one_end():
    r = random.Random(10)
    for size in (34, 45, 60, 100, 120):
        item = squeezed(prose(r, 30))[:size]
        block = d.Block([1], [item])
        for part in (item[size // 10 :], item[: size - size // 10]):
            assert 0 in d.matches(d.letters("zq " * 20 + part + " qz" * 20), block)


def test_slices_of_long_texts(monkeypatch):
    monkeypatch.setattr(d, "SLICE", 200)
    r = random.Random(5)
    item = prose(r, 18)
    block = d.Block([1], [item])
    for shift in range(0, 400, 37):
        text = "z" * shift + item + prose(r, 50)
        assert d.matches(d.letters(text), block)[0] == (len(block.windows[0]), 0)


def test_query_and_filter(spark, make_docs, odd_rows):
    r = random.Random(6)
    items = [(k, prose(r, 25)) for k in range(8)] + [(90, None), (None, prose(r, 20)), (91, ""), (92, "short one")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = odd_rows + [(100 + k, prose(r, 20) + " " + items[k][1] + " " + prose(r, 9)) for k in range(8)] + [(200, "short one")]
    rows += [(100, rows[len(odd_rows)][1])]  # a repeated row
    docs = make_docs(rows, extra=True)
    got = sorted((x["doc_id"], x["item_id"], x["edits"]) for x in d.op8_benchmark_decontamination(docs, benchmark).collect())
    assert got == sorted([(100 + k, k, 0) for k in range(8)] + [(100, 0, 0), (200, 92, 0)])
    kept = d.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 10
    empty = spark.createDataFrame([], "item_id long, text string")
    assert d.op8_benchmark_decontamination(docs, empty).collect() == [] and d.drop_contaminated(docs, empty).count() == docs.count()
    assert d.op8_benchmark_decontamination(make_docs([]), benchmark).collect() == []


def test_items_without_an_id(spark, make_docs):
    r = random.Random(11)
    item = prose(r, 20)
    benchmark = spark.createDataFrame([(None, item)], "item_id long, text string")
    docs = make_docs([(1, "intro " + item), (2, prose(r, 20))])
    assert [(x["doc_id"], x["item_id"]) for x in d.op8_benchmark_decontamination(docs, benchmark).collect()] == [(1, None)]
    assert [x["doc_id"] for x in d.drop_contaminated(docs, benchmark).collect()] == [2]


def test_blocks_cover_the_benchmark(spark, make_docs, monkeypatch):
    r = random.Random(7)
    items = [(k, prose(r, 20)) for k in range(12)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs([(k, text) for k, text in items])
    whole = sorted(d.contaminations(docs, benchmark).collect())
    blocks = d.blocks
    monkeypatch.setattr(d, "blocks", lambda b: blocks(b, 400))
    assert len(list(d.blocks(benchmark))) > 3
    assert sorted(d.contaminations(docs, benchmark).collect()) == whole and len(whole) == 12


def test_planted_items_are_found(spark):
    """Every whole item in the test documents, and nothing else."""
    base = "/root/testdata/sf0.001"
    docs, bench = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in d.contaminations(docs, bench).collect()}
    texts = {r["doc_id"]: squeezed(r["text"]) for r in docs.collect()}
    want = {(i, b["item_id"]) for b in bench.collect() for i, t in texts.items() if squeezed(b["text"]) in t}
    assert got == want


def test_banded_equals_full_alignment():
    r = np.random.default_rng(8)
    for _ in range(200):
        w, text = r.integers(0, 3, 20).astype(np.uint32), r.integers(0, 3, 60).astype(np.uint32)
        got = d.banded(w, text, -25, 65, 20)
        assert got == infix_distance(w.tolist(), text.tolist())


def test_short_items_match_whole_at_word_boundaries(spark, make_docs):
    benchmark = spark.createDataFrame([(1, "Two plus-two?"), (2, "ten letters"), (3, "?!"), (None, "x1")], "item_id long, text string")
    texts = ["what is TWO plus two today", "twotwo plus two", "two plus twofold", "two, PLUS  (two)", "atten letters", "Ten\nletters ten letters", "an x1", "x12 ?!", ""]
    docs = make_docs(enumerate(texts))
    got = sorted((r["doc_id"], r["item_id"], r["n_windows"], r["edits"]) for r in d.op8_benchmark_decontamination(docs, benchmark).fillna(-1).collect())
    assert got == [(0, 1, 1, 0), (3, 1, 1, 0), (5, 2, 1, 0), (6, -1, 1, 0)]
    assert sorted(r["doc_id"] for r in d.drop_contaminated(docs, benchmark).collect()) == [1, 2, 4, 7, 8]
