from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from dxcohort.llm import substrings as s

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def first_ids(rows, length):
    """The smallest doc_id in which each window starts."""
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - length + 1 if i is not None else 0):
            key = tuple(w[k : k + length])
            first[key] = min(i, first.get(key, i))
    return first


def brute(rows):
    first, out = first_ids(rows, 13), Counter()
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = set()
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def brute_longest(rows):
    best, length = [0] * len(rows), 13
    while True:
        first, found = first_ids(rows, length), False
        for n, (i, t) in enumerate(rows):
            w = WORD.findall(t or "")
            if i is not None and any(first[tuple(w[k : k + length])] < i for k in range(len(w) - length + 1)):
                best[n], found = length, True
        if not found:
            return Counter((i, b) for (i, _), b in zip(rows, best, strict=True))
        length *= 2


def corpus(n, seed, words=60):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "Wort", "x" * 300, "y" * 300]
    passages = [[r.choice(vocabulary) for _ in range(m)] for m in (6, 7, 12, 13, 14, 20, 25, 26, 27, 60, 120, 500)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(r.randint(0, 4)):
            p = r.choice(passages)
            a = r.randint(0, max(len(p) - 5, 0)) if r.random() < 0.3 else 0
            w += r.choice([p[a:], [r.choice(vocabulary) for _ in range(r.randint(0, 30))], p[a : a + 13]])
        rows.append((r.choice([i, i, i, i, r.randint(0, n), None]), r.choice([" ", "\n", " \t "]).join(w)))
    hot = " ".join(passages[8] + passages[4])
    return rows + [(1000 + i, hot + (f" end{i}" if i % 2 else "")) for i in range(n // 2)]


def got(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(make_docs, monkeypatch, seed):
    monkeypatch.setattr(s, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(s, "SLOT_BYTES", 4000)
    monkeypatch.setattr(s, "RANGE_BYTES", 9000)
    rows = corpus(160, seed, 60 if seed == 1 else 3)
    assert got(s.op11_substring_dedup(make_docs(rows, extra=True))) == brute(rows)


def test_odd_rows(make_docs, odd_rows):
    assert got(s.op11_substring_dedup(make_docs(odd_rows, extra=True))) == brute(odd_rows)
    assert s.op11_substring_dedup(make_docs([])).collect() == []
    assert got(s.op11_substring_dedup(make_docs([(1, None)]))) == brute([(1, None)])


def test_one_block_and_repeated_rows(make_docs):
    text = " ".join(f"a{i}" for i in range(40))
    rows = [(5, text)] * 30 + [(6, text + " b"), (4, "c " + text), (None, text)]
    assert got(s.op11_substring_dedup(make_docs(rows))) == brute(rows)


def test_kept_text(make_docs):
    rows = corpus(60, 3)
    for r in s.strip_repeats(make_docs(rows)).collect():
        assert hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"]
        assert len(WORD.findall(r["kept"])) == r["n_words"] - r["n_removed"]


def test_doubles_until_no_candidate_survives(make_docs):
    r = random.Random(7)
    long = [f"v{r.randrange(10_000)}" for _ in range(900)]
    rows = corpus(50, 4) + [(900, " ".join(long)), (901, "x " + " ".join(long[100:]) + " y"), (902, " ".join(long[300:420]))]
    assert got(s.longest_repeats(make_docs(rows))) == brute_longest(rows)


def test_texts_leave_their_block_once(make_docs):
    """Answers join the bucketed blocks: no exchange of texts in a round."""
    docs = make_docs(corpus(40, 5))
    blocks, n = s.blocks(docs)
    told = s._round(blocks, n, [])
    docs.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = s._with_answers(blocks, [told])._jdf.queryExecution().executedPlan().toString()
    finally:
        docs.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Join" in plan and all("data" not in line for line in plan.split("\n") if "Exchange" in line)
    assert "Bucketed: true" in plan


def test_long_crafted_words_are_told_apart():
    a, b = "a", "b"  # equal under polynomial hashes modulo a power of two
    for _ in range(11):
        a, b = a + b, b + a
    block = s.Block([1, 2], [len(a), len(b)], __import__("zstandard").ZstdCompressor().compress((a + b).encode()))
    assert len(np.unique(block.words)) == 2
