from __future__ import annotations

import re
from collections import Counter

from dxcohort.llm import quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for i, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if grams[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = len(lines) - len(set(lines))
    symbols, bangs, chars, n = len(re.findall(r"[#*$%&|<>]", text)), text.count("!"), sum(map(len, w)), len(w)
    base = n < 50 or 100 * len(covered) > 50 * n
    kept = not (base or 100 * symbols > 20 * n or 100 * bangs > 30 * n or 100 * dup > 40 * len(lines) or chars < 3 * n or chars > 12 * n)
    return n, chars, symbols, dup, len(covered), base, kept


def check(rows, df):
    want = Counter((i, *brute(t)) for i, t in rows)
    got = Counter(tuple(r) for r in q.op6_quality_rules(df).collect())
    assert got == want


def test_against_brute_force(spark, make_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check([(r["doc_id"], r["text"]) for r in docs.collect()], docs)


def test_odd_rows_and_extra_columns(make_docs, odd_rows):
    check(odd_rows, make_docs(odd_rows, extra=True))
    check([], make_docs([]))


def test_unicode_and_repeats(make_docs):
    rows = [(1, "a a a a"), (2, "a b c a b c"), (3, "x y z w é漢 !!"), (4, "l\nl\n \nl\r\nl"), (5, "# * $ % & | < > " * 20)]
    check(rows, make_docs(rows))


def test_any_order_gives_the_same_verdicts(make_docs, spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = lambda order: {r["doc_id"] for r in q.keep_good(docs, order).select("doc_id").collect()}
    assert kept(list(q.RULES)) == kept(list(q.RULES)[::-1]) == {r["doc_id"] for r in docs.collect() if brute(r["text"])[-1]}


def test_order_by_rejection_per_cost(make_docs, monkeypatch):
    docs = make_docs([(i, "short text") for i in range(30)])
    order = q.rule_order(docs)
    assert sorted(order) == sorted(q.RULES)
    assert order[0] == "too_short"  # it alone rejects, at the least cost


def test_short_circuit(monkeypatch):
    import numpy as np

    seen = []
    rules = {"first": lambda w: w.counts() < 3, "second": lambda w: (seen.append(len(w.counts())), w.counts() < 0)[1]}
    monkeypatch.setattr(q, "RULES", rules)
    data = np.frombuffer(b"one two three four" + b"one", np.uint8)
    assert q.cascade(data, np.array([0, 18, 21]), ["first", "second"]) == [None, "first"]
    assert seen == [1]


def test_quality_labels(spark):
    """Held against the labels: rejects nearly all bad and keeps nearly all good documents of some length."""
    d = "/root/testdata/sf0.01"
    got = q.op6_quality_rules(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    bad = [r["kept"] for r in got if r["quality"] == 0]
    good = [r["kept"] for r in got if r["quality"] == 1 and r["n_words"] >= 50]
    assert sum(bad) <= 0.05 * len(bad) and sum(good) >= 0.98 * len(good)
