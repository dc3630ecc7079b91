from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from dxcohort.llm import repair as r

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")
FORM = re.compile(r"(s?(ua)+)?")


def damage(rows):
    """(conv_id, turn, role, text) to the rows left of each conversation, in order."""
    left = {c: [] for c, *_ in rows}
    for c, t, role, text in rows:
        act = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if act == 1:
            text = ""
        elif act == 2:
            text = re.sub("[.!?]", "", text)
        elif act == 4:
            role = "user"
        left[c] += [(t, role, text)] * {0: 0, 3: 2}.get(act, 1)
    return {c: sorted(x, key=lambda y: (y[0] is not None, y[0] or 0, y[1].encode(), y[2].encode())) for c, x in left.items()}


def brute(rows):
    """Facts and the cheapest edits, by plain strings from row to row."""
    seen, kinds, blank, duplicate, truncated = set(), [], 0, 0, 0
    for _, role, text in rows:
        solid = WORD.findall(text)
        again = (role, text) in seen
        seen.add((role, text))
        cut = bool(solid) and solid[-1] not in ".!?"
        blank, duplicate, truncated = blank + (not solid), duplicate + (bool(solid) and again), truncated + (cut and not again)
        kinds.append((not solid or again, cut, role[:1] or " "))
    initials = [k[2] for k in kinds]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0

    def follow(role, c):  # role initials so far end in "", s, u or a
        return c if (c == "s" and role == "") or (c == "u" and role in ("", "s", "a")) or (c == "a" and role == "u") else None

    def inserts(best):
        for _ in range(2):
            for role, (cost, audit) in list(best.items()):
                for c in "ua":
                    if follow(role, c):
                        best[c] = min(best.get(c, (1e9, "")), (cost + 3, audit + "I"))
        return best

    best = {"": (0, "")}
    for must, cut, initial in kinds:
        after = {}
        for role, (cost, audit) in inserts(best).items():
            options = [(role, 4, "D")]
            if not must:
                options += [(initial, 3 * cut, "K")] if initial in "sua" and follow(role, initial) else []
                options += [(c, 3 + 3 * cut, "R") for c in "ua" if follow(role, c)]
            for state, more, letter in options:
                after[state] = min(after.get(state, (1e9, "")), (cost + more, audit + letter))
        best = after
    cost, audit = min(v for k, v in inserts(best).items() if k in ("", "a"))
    return gaps, blank, duplicate, truncated, illegal, cost, audit, render(rows, audit)


def render(rows, audit):
    rows, out, initials = iter(rows), [], ""
    for e in audit:
        _, role, text = (None, None, "") if e == "I" else next(rows)
        if e == "D":
            continue
        if e != "K":
            role = "assistant" if initials.endswith("u") else "user"
        initials += role[:1]
        out.append(f"{role}:{text}")
    assert FORM.fullmatch(initials)
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


def check(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.selectExpr("*", "'x' AS copies", "'x' AS seat", "'x' AS audit", "1 AS _c", "2 AS segment", "3 AS cost")
    got = r.op12_conversation_repair(df).collect()
    assert len(got) == len({x["conv_id"] for x in got})
    assert {x["conv_id"]: tuple(x)[1:] for x in got} == {c: brute(x) for c, x in damage(rows).items()}


def talk(n, seed, most=9):
    rnd = random.Random(seed)
    texts = ["Yes.", "No", "  \n", "", "What?\n", "long text " * 30 + "!", None, "Ja…"]
    rows = []
    for c in range(n):
        for t in range(rnd.randint(1, most)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "ua"])
            rows.append((rnd.choice([c, c, c, None]), rnd.choice([t, t, t, t + 3, None]), role, rnd.choice(texts)))
    rnd.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    check(spark, talk(400, 1), extra=True)


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(x) for x in df.select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)


def test_long_conversations_in_segments(spark, monkeypatch):
    monkeypatch.setattr(r, "LONG_ROWS", 20)
    monkeypatch.setattr(r, "SEGMENT_ROWS", 7)
    rows = talk(30, 2, 5) + [(c, t, random.Random(t).choice(["user", "assistant", "system"]), f"t{t % 400}{'.' if t % 3 else ''}") for c in (1000, None) for t in range(900)]
    rows += [(1001, 5, "user", "same.")] * 60 + [(1002, None, None, None)] * 40
    check(spark, rows)


def test_blocks_and_hot_sequences(spark, monkeypatch):
    monkeypatch.setattr(r, "BLOCK_ROWS", 5)
    rows = talk(60, 3)
    check(spark, rows + [(c, t, ["user", "assistant"][t % 2], "hello.") for c in range(5000, 5300) for t in range(2)])


def test_empty_and_all_dropped(spark):
    check(spark, [])
    gone = [c for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    check(spark, [(c, 0, "user", "x.") for c in gone])
    (row,) = r.op12_conversation_repair(spark.createDataFrame([(gone[0], 0, "user", "x.")], SCHEMA)).collect()
    assert tuple(row)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("length", [1, 2, 3])
def test_all_edits_of_short_sequences(length):
    """Every string of edits of every short sequence of symbols."""
    roles = {0: "u"} | {1 + 2 * i + c: "suat"[i] for i in range(4) for c in (0, 1)}
    seqs = list(itertools.product(range(r.SYMBOLS), repeat=length))
    best = r.cheapest([bytes(s) for s in seqs])
    rnd = random.Random(length)
    for s in seqs if length < 3 else rnd.sample(seqs, 60):
        found = []
        for ops in itertools.product("KRD", repeat=length):
            for gaps in itertools.product(range(3), repeat=length + 1):
                audit = "".join("I" * g + e for g, e in zip(gaps, (*ops, ""), strict=True))
                initials, cost, ok, k = "", 0, True, iter(s)
                for e in audit:
                    x = None if e == "I" else next(k)
                    cost += {"K": 0, "R": 3, "D": 4, "I": 3}[e]
                    if e in "KR":
                        ok = ok and x != 0
                        cost += 3 * ((x - 1) % 2)
                    if e == "K":
                        initials += roles[x]
                    elif e != "D":
                        initials += "a" if initials.endswith("u") else "u"
                if ok and FORM.fullmatch(initials):
                    found.append((cost, audit))
        assert best[bytes(s)] == min(found)


def test_ropes_and_grammar():
    rnd = random.Random(4)
    texts = ["".join(rnd.choices("DIKR", k=rnd.randint(0, 400))) for _ in range(30)]
    ropes = [sum((r.Rope(t[i : i + 7]) for i in range(0, len(t), 7)), r.Rope("")) for t in texts]
    for (a, x), (b, y) in itertools.product(zip(texts, ropes, strict=True), repeat=2):
        assert str(x) == a and x.before(y) == (a < b)
    shared = ropes[0] + ropes[1]
    assert not shared.before(ropes[0] + ropes[1]) and (shared + r.Rope("D")).before(shared + r.Rope("K"))
    seqs = [bytes(rnd.choices(range(9), k=rnd.randint(0, 30))) for _ in range(200)] + [bytes(100), bytes([3, 5] * 50)]
    rules, lines = r.re_pair(seqs)

    def expand(x):
        return [x] if x < r.SYMBOLS else expand(rules[x - r.SYMBOLS][0]) + expand(rules[x - r.SYMBOLS][1])

    assert [bytes(y for x in line.tolist() for y in expand(x)) for line in lines] == seqs
    assert rules and sum(map(len, lines)) < sum(map(len, seqs))
