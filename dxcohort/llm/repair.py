"""Conversation structure repair: the cheapest edits to (system)? (user assistant)+.

Each row of a conversation is one of nine symbols: rows that must go, or the
initial of the role (s, u, a, other) with or without a truncated text. An
automaton of four states reads the repaired roles, so a symbol is a 4 x 4
min-plus matrix of (cost, edits), inserts before the row included; equal costs
go to the ASCII-least edits. Two audits of equal cost are never one the beginning
of the other, so the least one is found by composing matrices.

Re-Pair turns the different symbol sequences of a block of conversations into a
grammar; each rule's matrix is the product of its two sides', made once, bottom
up, and shared by all conversations of the block. Edits are ropes: a rule's
points into those of its sides.

On Spark: one exchange by conversation, then blocks of whole conversations in
streams of Arrow batches. Conversations of more than ``LONG_ROWS`` rows or
``LONG_BYTES`` are cut into segments of numbered rows: each segment's matrix is
made in its own task, a stream over the matrices settles the edits, and a stream
over the rows makes the hash (a SHA-256 has to see its text in order).

Defined results: null roles and texts are one space, a null conv_id is a
conversation of its own, null turns come first and take no part in gaps. Rows of
one turn are ordered by role and text. An empty role counts as one space among
initials. Repeated rows are rows. Very long texts cost memory for one row. Extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxcohort.llm.common import ship, staged
from dxcohort.operators.numbering import row_number_skew_safe

# Costs of the edits, and the surcharge of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
_LEGAL = ("su", "ua", "au")
_WHITE = " \t\n\x0b\x0c\r"

#: A block of conversations that share a grammar.
BLOCK_ROWS, BLOCK_BYTES = 20_000, 16 << 20
#: Longer conversations are cut into segments.
LONG_ROWS, LONG_BYTES, SEGMENT_ROWS = 20_000, 32 << 20, 5_000
#: Rules of one grammar; sequences may stay longer than one symbol.
MAX_RULES = 400
#: Ropes up to this length are plain strings.
LEAF = 64

# --- ropes ------------------------------------------------------------------------

_PRIME, _BASE = (1 << 61) - 1, 911382323


class Rope:
    """A string as a tree of shared parts, with its length and a hash."""

    __slots__ = ("code", "left", "n", "right", "text")

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if text is not None:
            self.n, code = len(text), 0
            for c in text:
                code = (code * _BASE + ord(c)) % _PRIME
            self.code = code
        else:
            self.n = left.n + right.n
            self.code = (left.code * pow(_BASE, right.n, _PRIME) + right.code) % _PRIME

    def leaves(self) -> Iterator[str]:
        rest = [self]
        while rest:
            r = rest.pop()
            if r.text is None:
                rest += (r.right, r.left)
            else:
                yield r.text

    def __str__(self) -> str:
        return "".join(self.leaves())

    def __add__(self, other: Rope) -> Rope:
        if not self.n or not other.n:
            return self if self.n else other
        if self.n + other.n <= LEAF:
            return Rope(str(self) + str(other))
        return Rope(None, self, other)

    def before(self, other: Rope) -> bool:
        """Whether this string is the ASCII-lesser one; equal parts are skipped by their hash."""
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x is y or (x.n == y.n and x.code == y.code):
                continue
            if x.text is not None and y.text is not None:
                k = min(x.n, y.n)
                if x.text[:k] != y.text[:k]:
                    return x.text < y.text
                if x.n > k:
                    a.append(Rope(x.text[k:]))
                elif y.n > k:
                    b.append(Rope(y.text[k:]))
            elif y.text is not None or (x.text is None and x.n >= y.n):
                a += (x.right, x.left)
                b.append(y)
            else:
                b += (y.right, y.left)
                a.append(x)
        return bool(b) and not a


# --- automaton and matrices ---------------------------------------------------------

START, SYSTEM, USER, ASSISTANT = range(4)
_BY_USER = {START: USER, SYSTEM: USER, ASSISTANT: USER}
_BY_ASSISTANT = {USER: ASSISTANT}
_KEEP = {"s": {START: SYSTEM}, "u": _BY_USER, "a": _BY_ASSISTANT, "": {}}
_INITIALS = ("s", "u", "a", "")
GONE = 0  # the symbol of rows that must go; others are 1 + 2 * initial + truncated
SYMBOLS = 9

Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def symbol(initial: str, truncated: bool) -> int:
    return 1 + 2 * (_INITIALS.index(initial) if initial in _INITIALS else 3) + truncated


def _less(a: Entry, b: Entry) -> Entry:
    """The cheaper entry; of equally cheap ones the ASCII-least."""
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if a[1].before(b[1]) else b


def _inserted(state: int) -> list[tuple[int, int, str]]:
    """States reached by inserts alone, their cost and edits."""
    reached = [(state, 0, "")]
    if state in _BY_USER:
        reached.append((USER, INSERT, "I"))
        if state != ASSISTANT:
            reached.append((ASSISTANT, 2 * INSERT, "II"))
    else:
        reached.append((ASSISTANT, INSERT, "I"))
    return reached


def symbol_matrix(s: int) -> Matrix:
    m: Matrix = [[None] * 4 for _ in range(4)]
    for p in range(4):
        for r, cost, edits in _inserted(p):
            steps = [(r, DELETE, "D")]
            if s != GONE:
                initial, extra = _INITIALS[(s - 1) // 2], TRUNCATED * ((s - 1) % 2)
                if r in _KEEP[initial]:
                    steps.append((_KEEP[initial][r], extra, "K"))
                steps += [(by[r], REROLE + extra, "R") for by in (_BY_USER, _BY_ASSISTANT) if r in by]
            for q, c, letter in steps:
                m[p][q] = _less(m[p][q], (cost + c, Rope(edits + letter)))
    return m


_SYMBOL_MATRICES = [symbol_matrix(s) for s in range(SYMBOLS)]
_UNIT: Matrix = [[(0, Rope("")) if p == q else None for q in range(4)] for p in range(4)]


def _row(v: list[Entry], m: Matrix) -> list[Entry]:
    out: list[Entry] = [None] * 4
    for r in range(4):
        if v[r] is not None:
            for q in range(4):
                if m[r][q] is not None:
                    cost = v[r][0] + m[r][q][0]
                    if out[q] is None or cost <= out[q][0]:
                        out[q] = _less(out[q], (cost, v[r][1] + m[r][q][1]))
    return out


def product(x: Matrix, y: Matrix) -> Matrix:
    return [_row(v, y) for v in x]


def settled(v: list[Entry]) -> tuple[int, Rope]:
    """The cheapest accepted end, inserts after the last row included."""
    ends = [v[START], v[ASSISTANT]]
    for state, n in ((SYSTEM, 2), (USER, 1)):
        if v[state] is not None:
            ends.append((v[state][0] + n * INSERT, v[state][1] + Rope("I" * n)))
    best = None
    for e in ends:
        best = _less(best, e)
    return best


# --- grammar --------------------------------------------------------------------------

def re_pair(sequences: list[bytes]) -> tuple[list[tuple[int, int]], list[np.ndarray]]:
    """Rules (rule k is symbol SYMBOLS + k, its sides come before it) and the
    sequences in symbols and rules. The most frequent pair (ties: the smallest)
    becomes a rule until no pair occurs twice or there are ``MAX_RULES``."""
    lengths = [len(s) for s in sequences]
    line = np.full(sum(lengths) + len(lengths), -1, np.int64)
    at = 0
    for s in sequences:
        line[at : at + len(s)] = np.frombuffer(s, np.uint8)
        at += len(s) + 1
    rules: list[tuple[int, int]] = []
    while len(rules) < MAX_RULES:
        known = SYMBOLS + len(rules)
        here = np.flatnonzero((line[:-1] >= 0) & (line[1:] >= 0))
        if not len(here):
            break
        counts = np.bincount(line[here] * known + line[here + 1])
        best = int(counts.argmax())
        if counts[best] < 2:
            break
        left, right = divmod(best, known)
        found = here[(line[here] == left) & (line[here + 1] == right)]
        if left == right:  # of a run of equal symbols every other pair
            first = np.r_[True, np.diff(found) > 1]
            found = found[(found - np.maximum.accumulate(np.where(first, found, 0))) % 2 == 0]
        line[found] = known
        keep = np.ones(len(line), bool)
        keep[found + 1] = False
        line = line[keep]
        rules.append((left, right))
    ends = np.flatnonzero(line < 0)
    return rules, [line[a:b] for a, b in zip(np.r_[0, ends[:-1] + 1], ends, strict=True)]


def matrices(rules: list[tuple[int, int]]) -> list[Matrix]:
    out = list(_SYMBOL_MATRICES)
    for left, right in rules:
        out.append(product(out[left], out[right]))
    return out


def cheapest(sequences: list[bytes]) -> dict[bytes, tuple[int, str]]:
    """Cost and edits of each sequence of symbols."""
    different = sorted(set(sequences))
    rules, lines = re_pair(different)
    known = matrices(rules)
    out = {}
    for s, line in zip(different, lines, strict=True):
        v = _UNIT[START]
        for x in line.tolist():
            v = _row(v, known[x])
        cost, edits = settled(v)
        out[s] = cost, str(edits)
    return out


def segment_matrix(codes: bytes) -> Matrix:
    rules, (line,) = re_pair([codes])
    known = matrices(rules)
    m = _UNIT
    for x in line.tolist():
        m = product(m, known[x])
    return m


# --- rows -------------------------------------------------------------------------------

class Facts(NamedTuple):
    """What is told of consecutive rows before any repair."""

    codes: bytes = b""
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str = ""
    last: str = ""
    low: int | None = None
    high: int | None = None
    turns: int = 0

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def facts(rows: list[tuple], again: list[bool]) -> Facts:
    """``rows`` (turn, role, text) in order; ``again`` tells which were seen earlier."""
    codes, blank, duplicate, truncated, illegal = bytearray(), 0, 0, 0, 0
    turns: set[int] = set()
    last = first = ""
    for (turn, role, text), seen in zip(rows, again, strict=True):
        initial = role[:1] or " "
        if last and last + initial not in _LEGAL:
            illegal += 1
        first, last = first or initial, initial
        if turn is not None:
            turns.add(turn)
        end = text.rstrip(_WHITE)[-1:]
        cut = end not in (".", "!", "?")
        if not end:
            blank += 1
        elif seen:
            duplicate += 1
        elif cut:
            truncated += 1
        codes.append(GONE if seen or not end else symbol(initial, cut))
    return Facts(bytes(codes), blank, duplicate, truncated, illegal, first, last, min(turns, default=None), max(turns, default=None), len(turns))


def joined(a: Facts, b: Facts) -> Facts:
    """Facts of two stretches that follow each other, without their codes."""
    if not a.first:
        return b._replace(codes=b"")
    if not b.first:
        return a._replace(codes=b"")
    low = b.low if a.low is None else a.low
    high = a.high if b.high is None else b.high
    return Facts(
        b"", a.blank + b.blank, a.duplicate + b.duplicate, a.truncated + b.truncated,
        a.illegal + b.illegal + (a.last + b.first not in _LEGAL), a.first, b.last, low, high,
        a.turns + b.turns - (a.high is not None and a.high == b.low),
    )


class Repaired:
    """The hash of a repaired conversation, row by row."""

    def __init__(self) -> None:
        self.sha, self.state, self.empty = hashlib.sha256(), START, True

    def _put(self, role: str, text: str, state: int) -> None:
        self.sha.update((("" if self.empty else "\n") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.empty, self.state = False, state

    def _next(self) -> tuple[str, int]:
        return ("assistant", ASSISTANT) if self.state == USER else ("user", USER)

    def apply(self, edits: str, rows: Iterator[tuple]) -> None:
        for e in edits:
            if e == "I":
                role, state = self._next()
                self._put(role, "", state)
                continue
            _, role, text = next(rows)
            if e == "K":
                self._put(role, text, _KEEP[role[:1]][self.state])
            elif e == "R":
                role, state = self._next()
                self._put(role, text, state)


SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
_TYPES = [pa.int64()] * 7 + [pa.string()] * 2


def _table(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after damage: conv_id, turn, role, text and ``copies`` (0 of a
    dropped row, which stays as a sign of its conversation)."""
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    action = F.crc32(name.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(action == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), F.lit(" "))).alias("role"),
        F.when(action.isin(0, 1), "").when(action == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(action == 0, 0).when(action == 3, 2).otherwise(1).alias("copies"),
    )


def _whole(rows: DataFrame) -> DataFrame:
    """Repair of conversations that fit a block: one exchange, then a stream."""

    def block(held: list[tuple[int | None, list[tuple]]]) -> pa.RecordBatch:
        told = []
        for _, lines in held:
            seen: set[tuple] = set()
            again = []
            for _, role, text in lines:
                again.append((role, text) in seen)
                seen.add((role, text))
            told.append(facts(lines, again))
        best = cheapest([f.codes for f in told])
        out = []
        for (conv, lines), f in zip(held, told, strict=True):
            cost, edits = best[f.codes]
            made = Repaired()
            made.apply(edits, iter(lines))
            out.append((conv, f.gaps(), f.blank, f.duplicate, f.truncated, f.illegal, cost, edits, made.sha.hexdigest()))
        return _table(out, _NAMES, _TYPES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, list[tuple]]] = []
        n = size = 0
        for batch in batches:
            for conv, turn, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not held or held[-1][0] != conv:
                    if n >= BLOCK_ROWS or size >= BLOCK_BYTES:
                        yield block(held)
                        held, n, size = [], 0, 0
                    held.append((conv, []))
                held[-1][1].extend([(turn, role, text)] * copies)
                n, size = n + 1, size + len(text)
        if held:
            yield block(held)

    order = (F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"))
    return rows.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "copies").mapInArrow(run, SCHEMA)


# --- long conversations ----------------------------------------------------------------------

_SEGMENT = (
    "conv_id long, segment long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
    "low long, high long, turns long, matrix array<struct<p:int,q:int,cost:long,edits:string>>"
)


def _segments(numbered: DataFrame) -> DataFrame:
    """Facts and matrix of each segment, each in its own place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, lines, again = None, [], []

        def out() -> pa.RecordBatch:
            f = facts(lines, again)
            m = [
                {"p": p, "q": q, "cost": e[0], "edits": str(e[1])}
                for p, row in enumerate(segment_matrix(f.codes)) for q, e in enumerate(row) if e is not None
            ]
            row = dict(zip(("conv_id", "segment"), key, strict=True)) | f._asdict() | {"matrix": m}
            del row["codes"]
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in batches:
            for conv, segment, turn, role, text, seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if lines and (conv, segment) != key:
                    yield out()
                    lines, again = [], []
                key = conv, segment
                lines.append((turn, role, text))
                again.append(seen)
        if lines:
            yield out()

    i, s = pa.int64(), pa.string()
    cell = pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", i), ("edits", s)])
    arrow = pa.schema([
        ("conv_id", i), ("segment", i), ("blank", i), ("duplicate", i), ("truncated", i), ("illegal", i), ("first", s), ("last", s),
        ("low", i), ("high", i), ("turns", i), ("matrix", pa.list_(cell)),
    ])
    rows = numbered.repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "seat")
    return rows.select("conv_id", "segment", "turn", "role", "text", "again").mapInArrow(run, _SEGMENT)


def _settle(segments: DataFrame) -> DataFrame:
    """Facts, cost and edits of each long conversation: a stream over its segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, told, v = None, Facts(), _UNIT[START]

        def out() -> pa.RecordBatch:
            cost, edits = settled(v)
            return _table([(key, told.gaps(), told.blank, told.duplicate, told.truncated, told.illegal, cost, str(edits))], _NAMES[:-1], _TYPES[:-1])

        begun = False
        for batch in batches:
            for r in batch.to_pylist():
                if begun and r["conv_id"] != key:
                    yield out()
                    told, v = Facts(), _UNIT[START]
                key, begun = r["conv_id"], True
                m: Matrix = [[None] * 4 for _ in range(4)]
                for e in r["matrix"]:
                    m[e["p"]][e["q"]] = e["cost"], Rope(e["edits"])
                told = joined(told, Facts(b"", *(r[k] for k in Facts._fields[1:])))
                v = _row(v, m)
        if begun:
            yield out()

    return segments.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(run, SCHEMA.rsplit(", ", 1)[0])


def _hashes(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """conv_id and hash: the rows of a conversation stream by in order, behind its edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        coming = lines()
        conv, _, _, _, plan = next(coming, (None,) * 5)
        while plan is not None:
            following: list = [None, None]

            def mine() -> Iterator[tuple]:
                for other, turn, role, text, then in coming:
                    if then is not None:
                        following[:] = other, then
                        return
                    yield turn, role, text

            made, left = Repaired(), mine()
            made.apply(plan, left)
            for _ in left:
                raise ValueError("more rows than edits")
            yield _table([(conv, made.sha.hexdigest())], ["conv_id", "repaired_sha256"], [pa.int64(), pa.string()])
            conv, plan = following

    ahead = edits.select("conv_id", F.lit(0).cast("long").alias("seat"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), "audit")
    both = rows.select("conv_id", "seat", "turn", "role", "text", F.lit(None).cast("string").alias("audit")).unionByName(ahead)
    stream = both.repartition("conv_id").sortWithinPartitions("conv_id", "seat").select("conv_id", "turn", "role", "text", "audit")
    return stream.mapInArrow(run, "conv_id long, repaired_sha256 string")


def _long(rows: DataFrame) -> DataFrame:
    """Repair of long conversations; a conversation's rows are spread over tasks
    for all work but the hash."""
    lines = rows.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc(), F.col("copy").asc()]
    numbered = staged(row_number_skew_safe(lines.drop("copies"), ["conv_id"], order, "seat", heavy_rows=4 * LONG_ROWS).drop("copy"), "op12-seats")
    same = ["conv_id", "role", F.sha2("text", 256).alias("_t")]
    firsts = numbered.groupBy(*same).agg(F.min("seat").alias("_seat")).select(F.col("conv_id").alias("_conv"), "_seat")
    told = numbered.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("seat") == F.col("_seat")), "left")
    cut = told.select("conv_id", "seat", "turn", "role", "text", F.col("_seat").isNull().alias("again"), F.floor((F.col("seat") - 1) / SEGMENT_ROWS).alias("segment"))
    edits = staged(_settle(_segments(cut)), "op12-edits")
    made = _hashes(numbered, edits).withColumnRenamed("conv_id", "_conv")
    return edits.join(made, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(*_NAMES)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Facts, cost, edits and hash of each conversation of ``damaged`` rows (or
    others with these columns)."""
    spark = rows.sparkSession
    ship(spark)
    sizes = rows.groupBy("conv_id").agg(F.sum("copies").alias("_n"), F.sum(F.when(F.col("copies") > 0, F.octet_length("text"))).alias("_b"))
    # At most the input's rows / LONG_ROWS + bytes / LONG_BYTES conversations.
    long = staged(sizes.where((F.col("_n") > LONG_ROWS) | (F.col("_b") > LONG_BYTES)).select(F.col("conv_id").alias("_c")), "op12-long")
    if long.isEmpty():
        return _whole(rows)
    same = F.col("conv_id").eqNullSafe(F.col("_c"))
    side = F.broadcast(long)
    return _whole(rows.join(side, same, "left_anti")).unionByName(_long(rows.join(side, same, "left_semi")))


def op12_conversation_repair(conversations: DataFrame) -> DataFrame:
    return repair_conversations(damaged(conversations))


def _then(x: str, cost: int, letter: str) -> str:
    """SQL: a cost of six digits and its edits, one edit further."""
    return f"(lpad(CAST(CAST(substr({x}, 1, 6) AS INTEGER) + {cost} AS VARCHAR), 6, '0') || substr({x}, 7) || '{letter}')"


def _oracle_sql() -> str:
    more = f"CASE WHEN cut THEN {TRUNCATED} ELSE 0 END"

    def step(x: str, keep: str) -> str:
        return (
            f"CASE WHEN NOT gone THEN lpad(CAST(CAST(substr({x}, 1, 6) AS INTEGER) + {more} + CASE WHEN {keep} THEN 0 ELSE {REROLE} END AS VARCHAR), 6, '0') "
            f"|| substr({x}, 7) || CASE WHEN {keep} THEN 'K' ELSE 'R' END END"
        )

    user, assistant = "ini = 'u'", "ini = 'a'"
    two = lambda x: _then(_then(x, INSERT, "I"), INSERT, "I")
    return rf"""WITH RECURSIVE crc AS (SELECT list(c ORDER BY n) AS t FROM (
  SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM (SELECT unnest(range(256)) AS n))),
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
acts AS (SELECT g.*, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda x: CAST(ord(x) AS BIGINT))),
  lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1]))) % 20 AS act FROM given g, crc),
hurt AS (SELECT conv_id, turn, CASE WHEN act = 4 THEN 'user' ELSE role END AS role,
  CASE act WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE act WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM acts WHERE act <> 0),
seats AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM hurt),
marks AS (SELECT *, CASE WHEN role = '' THEN ' ' ELSE substr(role, 1, 1) END AS ini,
  NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
  NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut FROM seats),
lines AS (SELECT *, blank OR again AS gone, lag(ini) OVER (PARTITION BY conv_id ORDER BY pos) || ini AS pair FROM marks),
counts AS (SELECT conv_id, max(pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again AND NOT blank) AS duplicate,
  count(*) FILTER (WHERE cut AND NOT gone) AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM lines GROUP BY conv_id),
best AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, '000000' AS s0, CAST(NULL AS VARCHAR) AS ss, CAST(NULL AS VARCHAR) AS su, CAST(NULL AS VARCHAR) AS sa FROM counts
  UNION ALL
  SELECT conv_id, pos, {_then('s0', DELETE, 'D')},
    least({_then('ss', DELETE, 'D')}, CASE WHEN ini = 's' AND NOT gone THEN lpad(CAST(CAST(substr(s0, 1, 6) AS INTEGER) + {more} AS VARCHAR), 6, '0') || substr(s0, 7) || 'K' END),
    least({_then('su', DELETE, 'D')}, {step('s0', user)}, {step('ss', user)}, {step('sa', user)}),
    least({_then('sa', DELETE, 'D')}, {step('su', assistant)})
  FROM (SELECT b.conv_id, l.pos, l.ini, l.gone, l.cut, s0, ss,
      least(su, {_then('s0', INSERT, 'I')}, {_then('ss', INSERT, 'I')}, {_then('sa', INSERT, 'I')}) AS su,
      least(sa, {_then('su', INSERT, 'I')}, {two('s0')}, {two('ss')}) AS sa
    FROM best b JOIN lines l ON l.conv_id IS NOT DISTINCT FROM b.conv_id AND l.pos = b.pos + 1)),
done AS (SELECT c.*, least(s0, sa, {_then('su', INSERT, 'I')}, {two('ss')}) AS b
  FROM counts c JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id AND best.pos = c.n),
edits AS (SELECT conv_id, substr(b, 7) AS audit, unnest(range(1, length(b) - 5)) AS i FROM done),
steps AS (SELECT conv_id, i, substr(audit, i, 1) AS e, i - length(regexp_replace(substr(audit, 1, i), '[^I]', '', 'g')) AS pos,
  i - length(regexp_replace(substr(audit, 1, i), '[^D]', '', 'g')) AS o FROM edits),
kept AS (SELECT s.conv_id, s.i, s.e, s.o, l.role, l.ini, CASE WHEN s.e = 'I' THEN '' ELSE l.text END AS text,
  max(CASE WHEN s.o = 1 AND s.e = 'K' AND l.ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv_id) AS head
  FROM steps s LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM s.conv_id AND l.pos = s.pos WHERE s.e <> 'D'),
made AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (o - head) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i) AS t
  FROM kept GROUP BY conv_id)
SELECT g.conv_id, coalesce(d.gaps, 0) AS gaps, coalesce(d.blank, 0) AS blank, coalesce(d.duplicate, 0) AS duplicate, coalesce(d.truncated, 0) AS truncated,
  coalesce(d.illegal, 0) AS illegal, CAST(coalesce(CAST(substr(d.b, 1, 6) AS INTEGER), 0) AS BIGINT) AS cost, coalesce(substr(d.b, 7), '') AS audit,
  sha256(coalesce(m.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN made m ON m.conv_id IS NOT DISTINCT FROM g.conv_id"""


#: CRC-32 by its table, and the edits by a recursion over rows that carries the best of each state.
ORACLE_SQL = _oracle_sql()
