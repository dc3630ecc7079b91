from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from dxcohort.llm import pieces as p


@pytest.fixture(scope="module")
def encoder():
    return p.Encoder(p.Pieces(p.model_path()))


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=p.model_path())


def fuzz(seed, n):
    r = random.Random(seed)
    alphabet = ["a", "b", "the", "tion", " ", "  ", "\n", "\t", "é", "漢", "𝄞", "<0x0A>", "hello", "▁", "-12", ".", "zq"]
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(n)]


def test_equals_the_library(encoder, library):
    for text in fuzz(1, 1500):
        want = library.encode(text)
        assert np.frombuffer(encoder.encode(text), np.uint32).tolist() == want, text
        stream = p.SPACE + text.replace(" ", p.SPACE) if text else ""
        assert list(encoder.stream([stream])) == want
        assert list(encoder.stream(iter(stream))) == want  # symbol by symbol


def test_round_trip(encoder):
    for text in fuzz(2, 500):
        back = encoder.decode(np.frombuffer(encoder.encode(text), np.uint32))
        assert back == text.replace(p.SPACE, " ")


def test_long_stretches(encoder, library):
    for text in ("a" * 5000, "the" * 3000, " " * 3000, "xyz" * 500 + " " + "é" * 999, "no spaces at all".replace(" ", "") * 700):
        assert np.frombuffer(encoder.encode(text), np.uint32).tolist() == library.encode(text)


def test_window_stays_small(encoder, monkeypatch):
    """Ids are committed while the text streams in."""
    seen = []
    emit = encoder._emit
    monkeypatch.setattr(encoder, "_emit", lambda text, edge, end: (seen.append(len(text)), emit(text, edge, end))[1])
    list(encoder.stream(iter("▁the▁nation" * 3000)))
    assert max(seen) <= 6 * encoder.p.longest and len(seen) > 100


def test_full_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr(p, "TABLE_ENTRIES", 5)
    small = p.Encoder(p.Pieces(p.model_path()))
    for text in fuzz(3, 200):
        assert np.frombuffer(small.encode(text), np.uint32).tolist() == library.encode(text)


class Unigram:
    """A small unigram model, for the other kind of lattice."""

    bpe, prefix, crossing, bytes, unknown = False, "", True, {}, 0

    def __init__(self, scores):
        self.ids = {piece: i + 1 for i, piece in enumerate(scores)}
        self.score_of = dict(scores)
        self.ends = {piece[i:]: -1 for piece in self.ids for i in range(len(piece))} | self.ids
        self.codes = {piece: i.to_bytes(4, "little") for piece, i in self.ids.items()}
        self.longest = max(map(len, scores))
        self.least = min(scores.values()) - 10

    def spell(self, symbol):
        return [0]


def best_score(text, m):
    best = [0.0] + [None] * len(text)
    for n in range(1, len(text) + 1):
        options = [best[n - 1] + m.least] if text[n - 1] not in m.score_of else []
        options += [best[k] + m.score_of[text[k:n]] for k in range(n) if text[k:n] in m.score_of]
        best[n] = max(options)
    return best[-1]


def test_unigram_finds_the_best_path():
    r = random.Random(4)
    scores = {"a": -3.0, "b": -3.5, "ab": -4.0, "aba": -5.1, "bab": -5.2, "bb": -6.9, "aab": -7.0, "abab": -7.3}
    m = Unigram(scores)
    e = p.Encoder(m)
    names = {i: piece for piece, i in m.ids.items()}
    for _ in range(300):
        text = "".join(r.choice("aabbc") for _ in range(r.randint(1, 80)))
        ids = list(e.stream(iter(text)))
        total = sum(scores[names[i]] if i else m.least for i in ids)
        assert total == pytest.approx(best_score(text, m))
        assert "".join(names.get(i, "c") for i in ids) == text


def test_query(spark, make_docs, odd_rows, library):
    rows = odd_rows + [(20, "a ▁ b"), (21, "line\nline")]
    got = {}
    for r in p.op9_sentencepiece(make_docs(rows, extra=True)).collect():
        got.setdefault((r["doc_id"], r["n_ids"]), []).append(r)
    for i, text in rows:
        ids = library.encode(text or "")
        r = got[i, len(ids)].pop()
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert r["round_trip"] == (p.SPACE not in (text or "")) and r["n_decoded"] == len(text or "")
    assert p.op9_sentencepiece(make_docs([])).collect() == []


def test_documents_with_ids(spark, make_docs, library):
    docs = make_docs([(1, "some text"), (2, None)], extra=True)
    rows = {r["doc_id"]: r for r in p.encode_documents(docs).collect()}
    assert rows[1]["ids"] == library.encode("some text") and rows[2]["ids"] == [] and rows[1]["token"] == "x"
    assert "text" not in p.encode_documents(docs).columns


def test_a_symbol_alone_is_never_asked_for(library, monkeypatch):
    """It is what remains if no longer piece may follow; no pair is merged for it."""
    e = p.Encoder(p.Pieces(p.model_path()))
    asked, merged = [], e.p.merged
    monkeypatch.setattr(e, "_may_follow", lambda *a: (asked.append(a[-1]), merged(a[-2] + a[-1]) == [a[-2], a[-1]])[1])
    for text in [*fuzz(7, 300), "qzxv jkwq vbnq"]:
        assert np.frombuffer(e.encode(text), np.uint32).tolist() == library.encode(text)
    assert asked and min(map(len, asked)) > 1


def test_words_move_over_from_the_older_table(library):
    e = p.Encoder(p.Pieces(p.model_path()), 3)
    for texts in (["the old words", "x" * 60 + " the"], ["new words here"], ["old new the " + "x" * 60], ["the", "", None]):
        assert [np.frombuffer(x, np.uint32).tolist() for x in e.encode_many(texts)] == [library.encode(x or "") for x in texts]
    assert all(len(x) <= p.KEEP_CHARS for x in [*e.known, *e.older])
