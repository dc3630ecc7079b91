from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from dxcohort.llm import audit as a
from dxcohort.llm.common import ship

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def failures(text, doc, smallest):
    w = WORD.findall(text)
    return "".join(
        c for c, f in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            bool(re.search(r"[#$%&*|]", text)), doc is not None and smallest.get(text, doc) < doc,
        ), strict=True) if f
    )


def brute(rows, labels):
    """Each order played through, row by row. Rows: (doc_id, text, lang)."""
    rows = [(i, t or "", p or "") for i, t, p in rows]
    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            smallest[t] = min(i, smallest.get(t, i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    cells = Counter((p, failures(t, i, smallest), i in good, i in toxic) for i, t, p in rows)
    out = {}
    for part in {p for _, _, p in rows}:
        mine = [(f, g, x, n) for (p, f, g, x), n in cells.items() if p == part]
        share = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [c for c in left if letter in c[0]]
                left = [c for c in left if letter not in c[0]]
                all_failing = sum(c[3] for c in mine if letter in c[0])
                removed = sum(c[3] for c in gone)
                share[letter] += removed
                out[part, order, step] = [
                    sum(c[3] for c in left), removed, all_failing - removed, sum(c[3] for c in mine if c[0] == letter),
                    sum(c[3] for c in gone if c[1]), sum(c[3] for c in gone if c[2]),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(share[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def check(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, p, "x", 0, "x", 7) for i, t, p in rows], "doc_id long, text string, lang string, part string, n long, key string, mask int")
    got = a.op13_filter_audit(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len({(r["part"], r["filter_order"], r["step"]) for r in got})
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in got} == brute(rows, labels)


@pytest.fixture(params=["plain", "small blocks"])
def sizes(request, monkeypatch):
    """Small blocks and ranges make many tries, heavy prefixes and hot texts."""
    if request.param == "small blocks":
        monkeypatch.setattr(a, "BLOCK_BYTES", 3000)
        monkeypatch.setattr(a, "RANGE_BYTES", 2000)


def test_against_brute_force(spark, sizes):
    ship(spark)
    r = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["Big", "LOUD", "a#b", "c|d", "é"]
    shared = "same beginning of a boilerplate header " * 5
    rows = []
    for i in range(600):
        kind = r.random()
        if kind < 0.33:  # a third of all rows: copies of one text
            text = "the hot text " * 40
        elif kind < 0.6:
            text = shared + " ".join(r.choices(words, k=r.randint(0, 140)))
        elif kind < 0.7 and rows:
            text = r.choice(rows)[1]
        else:
            text = " ".join(r.sample(words, r.randint(0, 200)))
        rows.append((r.choice([i, i, i, r.randint(0, 600)]), text, r.choice(["en", "de", None, ""])))
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in r.choices(range(600), k=500)]
    check(spark, rows, labels + [(None, 1, 1)])


def test_odd_rows(spark, odd_rows, sizes):
    rows = [(i, t, p) for i, t in odd_rows for p in ("en", None)] + [(11, "", "en"), (10, "", ""), (None, "", "en")]
    check(spark, rows, [(1, 1, 0), (1, 0, 1), (11, None, 1)])
    check(spark, rows, [])
    check(spark, [], [(1, 1, 1)])


def test_trie_holds_all_texts():
    r = random.Random(2)
    texts = [bytes(r.choices(b"ab\x00\xff", k=r.randint(0, 9))) for _ in range(3000)]
    trie, beaten = a.Trie(), []
    for i, t in enumerate(texts):
        beaten.append(trie.insert(t, (i * 7919) % 3000, 1, {"p": 1}))
    want = {}
    for i, t in enumerate(texts):
        want[t] = min((i * 7919) % 3000, want.get(t, 3000))
    assert [(t, h[0]) for t, h in trie.terminals()] == sorted(want.items())
    assert sum(b is not None for b in beaten) == len(texts) - len(want)


def test_long_text_is_one_node(spark):
    trie = a.Trie()
    long = b"x" * 5_000_000
    assert trie.insert(long, 2, 0, {"": 1}) is None and trie.insert(long + b"y", 3, 0, {"": 1}) is None
    assert trie.insert(long, 1, 0, {"": 1})[0] == 2
