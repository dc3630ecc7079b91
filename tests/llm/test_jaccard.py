from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from dxcohort.llm import jaccard as j

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k=3, percent=90):
    def shingles(t):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])

    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                up[root(a)] = root(b)
    low = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            low[root(x)] = min(i, low.get(root(x), i))
    return Counter((i, len(s), low.get(root(x)) if s else i) for x, ((i, _), s) in enumerate(zip(rows, sets)))


def copies(seed, n_base, n_copies, n_words, edits):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    passage = [r.choice(vocabulary) for _ in range(30)]
    rows = []
    for b in range(n_base):
        base = [r.choice(vocabulary) for _ in range(r.randint(n_words // 2, n_words))]
        for _ in range(n_copies):
            w = list(base)
            for _ in range(r.randint(0, edits)):
                w[r.randrange(len(w))] = r.choice(vocabulary).upper()
            if r.random() < 0.3:
                w += passage
            rows.append(" ".join(w))
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,n_base,n_copies,n_words,edits", [(1, 12, 12, 120, 5), (2, 2, 80, 200, 6), (3, 60, 3, 25, 1), (4, 40, 4, 14, 1)])
def test_against_brute_force(make_docs, seed, n_base, n_copies, n_words, edits):
    rows = copies(seed, n_base, n_copies, n_words, edits)
    assert Counter(tuple(r) for r in j.op3_ngram_jaccard_join(make_docs(rows)).collect()) == brute(rows)


@pytest.mark.parametrize("k,percent", [(5, 80), (1, 50), (4, 95)])
def test_other_settings(make_docs, k, percent):
    rows = copies(9, 8, 10, 90, 5)
    assert Counter(tuple(r) for r in j.jaccard_components(make_docs(rows), k, percent).collect()) == brute(rows, k, percent)


def test_odd_rows_and_extra_columns(make_docs, odd_rows):
    got = Counter(tuple(r) for r in j.op3_ngram_jaccard_join(make_docs(odd_rows, extra=True)).collect())
    assert got == brute(odd_rows)
    assert j.op3_ngram_jaccard_join(make_docs([])).collect() == []


def test_same_prefix_groups(make_docs, monkeypatch):
    """Members of one group that differ behind their prefix are told apart."""
    import numpy as np

    rows = copies(5, 3, 40, 150, 4)
    # One counter for all shingles: the order is by hash alone, so edits rarely touch the prefix.
    monkeypatch.setattr(j, "shingle_counts", lambda docs, k: np.zeros(j.SLOTS, np.uint32))
    assert Counter(tuple(r) for r in j.op3_ngram_jaccard_join(make_docs(rows)).collect()) == brute(rows)


def test_keep_one(make_docs, odd_rows):
    rows = copies(6, 6, 6, 100, 3) + [(1000, ""), (1001, None), (3, None)]
    kept = [r["doc_id"] for r in j.keep_one(make_docs(rows[:36] + rows[36:38])).collect()]
    parts = brute(rows[:36] + rows[36:38], j.STAGE_K, j.STAGE_PERCENT)
    assert sorted(kept) == sorted({c for _, _, c in parts})
    kept = j.keep_one(make_docs(odd_rows, extra=True)).collect()
    assert Counter(r["doc_id"] for r in kept)[7] == 1 and 8 not in [r["doc_id"] for r in kept]
    assert j.keep_one(make_docs([])).collect() == []


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 9), (9, 7), (20, 21)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["root"] for r in j.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 5: 5, 7: 5, 9: 5, 20: 20, 21: 20}


def test_oracle_on_small_tables(spark):
    import duckdb

    d = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{d}')")
    want = Counter(con.execute(j.ORACLE_SQL).fetchall())
    assert Counter(tuple(r) for r in j.op3_ngram_jaccard_join(spark.read.parquet(d)).collect()) == want


def test_keep_one_judges_rows_not_ids(make_docs):
    """Texts that nothing links all stay, whatever their ids."""
    text = lambda n: " ".join(f"w{n}x{i}" for i in range(30))
    near = text(1).replace("w1x29", "other")
    rows = [(None, text(1)), (None, text(2)), (7, text(3)), (7, text(4)), (5, near), (None, near), (5, text(3)), (9, text(5)), (9, text(5)), (None, text(6)), (None, text(6))]
    got = Counter((r["doc_id"], r["text"]) for r in j.keep_one(make_docs(rows, extra=True)).collect())
    assert got == Counter([(5, near), (None, text(2)), (5, text(3)), (7, text(4)), (9, text(5)), (None, text(6))])
    clash = make_docs(rows).selectExpr("*", "1 AS _doc_id", "2 AS _mark", "3 AS mark", "4 AS cid", "5 AS root")
    assert sorted(str(r["text"]) for r in j.keep_one(clash).collect()) == sorted(t for _, t in got)
