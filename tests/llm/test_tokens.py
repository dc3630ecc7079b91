from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from dxcohort.llm import tokens as t
from dxcohort.session import scratch_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(t.tokenizer_path())


def test_encoding_equals_the_library(library):
    r = random.Random(1)
    parts = ["a", "the", " ", "  ", "   ", "\n", " \n", "\t ", "'s", "é", "漢", "12", "!?", " ", "  ", "<|endoftext|>", "'"]
    e = t.ByteBpe(t.tokenizer_path())
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(3000)] + ["x" * 5000, " " * 400]
    got = e.encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_full_table_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(t, "TABLE_ENTRIES", 10)
    e = t.ByteBpe(t.tokenizer_path())
    for k in range(30):
        texts = [f"word{k} and word{k - 1} again", "the same"]
        assert [np.frombuffer(x, np.uint32).tolist() for x in e.encode(texts)] == [library.encode(x).ids for x in texts]


def test_coding_round_trip():
    r = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 4, 5, 1000):
        v = (r.integers(0, 2**32, n, dtype=np.uint64) >> r.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
        control, data = t.pack(v)
        assert len(control) == -(-n // 4)
        assert (t.unpack(control, data, n) == v).all()
    edges = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], np.uint32)
    control, data = t.pack(edges)
    assert len(data) == 2 * (1 + 2 + 3 + 4) and (t.unpack(control, data, 8) == edges).all()


def expected(rows, library):
    """Rows by doc_id (null first); rows with equal ids in any order."""
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query(make_docs, library, monkeypatch):
    monkeypatch.setattr(t, "BLOCK_IDS", 50)
    monkeypatch.setattr(t, "PART_IDS", 300)
    r = random.Random(3)
    rows = [(i * 7 % 101, " ".join(r.choice(["alpha", "beta", "gamma\n", "δ"]) for _ in range(r.randint(0, 60)))) for i in range(101)]
    r.shuffle(rows)
    got = sorted(tuple(x) for x in t.op1_token_files(make_docs(rows, extra=True)).collect())
    assert got == expected(rows, library)


def test_odd_rows(make_docs, odd_rows, library):
    rows = [x for x in odd_rows if x != (None, "a null id with some words")]  # two null ids may come in any order
    got = sorted((tuple(x) for x in t.op1_token_files(make_docs(rows)).collect()), key=lambda x: x[1])
    assert got == expected(rows, library)
    assert t.op1_token_files(make_docs([])).collect() == []


def test_frequent_ids_are_short(spark, make_docs):
    docs = make_docs([(i, "the the the the cat") for i in range(50)])
    folder = scratch_path(spark, "test-op1")
    t.write_token_files(docs, folder)
    order = np.frombuffer(spark.read.parquet(f"{folder}/ranks").first()["ids"], np.uint32)
    block = spark.read.parquet(f"{folder}/blocks").first()
    assert len(block["data"]) == block["n_tokens"] == 300  # few ranks: one byte each
    assert len(order) == 4 and order[0] == 262  # " the"


def test_full_tables_keep_frequent_words(library, monkeypatch):
    monkeypatch.setattr(t, "TABLE_ENTRIES", 40)
    e = t.ByteBpe(t.tokenizer_path())
    r = random.Random(11)
    for k in range(60):
        texts = [" ".join(r.choice(["the", "cat", "x" * 60, f"word{r.randrange(10**6)}", "é\u00a0", "", "\u2003wide"]) for _ in range(r.randint(0, 40))) for _ in range(5)]
        if k == 30:
            monkeypatch.setattr(t, "TABLE_IDS", 200)
        got = [np.frombuffer(x, np.uint32).tolist() for x in e.encode(texts)]
        assert got == [library.encode(x, add_special_tokens=False).ids for x in texts]
        assert len(e.start) < 40 + 5 * 40 and set(e.known.values()) <= set(range(len(e.start)))
    assert "the" in e.known


def test_marks_and_line_ends_are_set_apart(library):
    """One known word for all its marks, before or after a line end."""
    e = t.ByteBpe(t.tokenizer_path())
    texts = ["one word, word. word! word? a\nword; word:\nword", "two word.\n\nword, \nword\n", "x word.. word.) \u00e9. 7. don't, it's.\n's a\n.b a.b\u2003\nword c\x1c\nd"]
    for text, ids in zip(texts, e.encode(texts), strict=True):
        assert np.frombuffer(ids, np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids
    e = t.ByteBpe(t.tokenizer_path())
    e.encode(texts[:1])
    assert sorted(e.known) == ["\nword", "a", "word"]


def test_lines_equal_the_library(library, monkeypatch):
    monkeypatch.setattr(t, "GROUP_WORDS", 3)
    r = random.Random(12)
    parts = ["a", "the", "Zq", " ", " ", "\n", "\n", ".", ",", "!", "'s", "\u00e9", "12", "\u2026", "\t", "\u00a0"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(3000)]
    e = t.ByteBpe(t.tokenizer_path())
    for k in range(0, len(texts), 50):
        for text, ids in zip(texts[k : k + 50], e.encode(texts[k : k + 50]), strict=True):
            assert np.frombuffer(ids, np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, text
