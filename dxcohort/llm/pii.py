"""Personal data: candidate spans judged by gradient-boosted trees.

Base spans (e-mail, IPv4, card, phone) follow fixed patterns and always stay.
High-recall generators propose more, overlapping spans: spelled-out e-mail
addresses, phone numbers without a plus, cards with other separators, IPv4
addresses that run into a port or mask. Boosted trees score format and context
features of each candidate; one calibrated threshold for each kind selects the
spans that are added, with the names in ``ADDED``.

Training: ``SAMPLE_DOCS`` documents (lowest id hashes) lend contexts; into each
a task writes labelled values made from the document's own hash, half of them
personal data in varied formats, half look-alikes (dates, versions, amounts,
part numbers, prose). A third is held out: a logistic curve fitted on it turns
scores into probabilities, and each kind's threshold is the lowest one that
keeps ``PRECISION`` there; a kind that cannot is never added.

Offsets are code points, ends exclusive. A null or empty text has no spans. Repeated
rows are judged one by one; extra columns are carried along by ``redact``; an
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxcohort.llm.common import arrow_text, ship, worker_tables

KINDS = ("email", "ip", "card", "phone")
ADDED = ("x_email", "x_ip", "x_card", "x_phone")
#: Documents that lend contexts to the training sample.
SAMPLE_DOCS = 300
TREES, DEPTH, RATE, CUTS = 40, 3, 0.2, 16
PRECISION = 0.98

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A digit run that fails from its first digit fails from every later one too.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Like a search for the whole pattern, but from each @ outwards, so that a
    long run of letters is read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() and 16 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


# --- generators: more than is wanted -------------------------------------------

_GENERATORS = {
    "x_email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\s?(?:\(at\)|\[at\]|\{at\}|\sat\s|@)\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\(dot\)|\[dot\]|\{dot\}|\sdot\s|\.)\s?[A-Za-z0-9-]{1,63}){1,4}", re.I),
    "x_ip": re.compile(r"(?<![0-9.])[0-9]{1,5}(?:\.[0-9]{1,5}){3,5}(?:[:/][0-9]{1,5})?(?![0-9.])"),
    "x_card": re.compile(r"(?<![0-9])[0-9]{1,19}(?:[\x20./_-]{1,2}[0-9]{2,7}){1,6}(?![0-9])"),
    "x_phone": re.compile(r"(?<![0-9])\(?[0-9]{2,4}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,4}\)?){1,4}(?![0-9])"),
}


#: What every span of the x_email generator holds: an at, spelled out in some form or not, and a part of the name after it.
_AT = re.compile(r"(?:\(at\)|\[at\]|\{at\}|\sat\s|@)\s?[A-Za-z0-9-]", re.I)


def candidates(text: str) -> list[Span]:
    out: list[Span] = []
    for kind, pattern in _GENERATORS.items():
        if kind == "x_email" and not _AT.search(text):
            continue
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    return out


_CUES = {
    "x_email": re.compile(r"mail|write|contact|reach|@", re.I),
    "x_ip": re.compile(r"\bip\b|addr|host|server|from|login", re.I),
    "x_card": re.compile(r"card|visa|pay|credit|account", re.I),
    "x_phone": re.compile(r"phone|tel|call|fax|mobile|dial", re.I),
}


def features(text: str, span: Span) -> list[float]:
    """Format of the span and its context; no pattern's verdict among them."""
    kind, a, b = span
    s = text[a:b]
    digits = _NOT_DIGIT.sub("", s)
    groups = [len(g) for g in re.findall(r"[0-9]+", s)]
    before, after = text[max(0, a - 24) : a], text[b : b + 24]
    parts = s.split(":")[0].split("/")[0].split(".")
    return [
        float(ADDED.index(kind)), float(len(s)), float(len(digits)), len(digits) / max(1, len(s)),
        float(len(groups)), float(max(groups, default=0)), float(min(groups, default=0)), float(groups[-1] if groups else 0),
        float(luhn(digits)) if digits else 0.0,
        float(len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) <= 255 for p in parts)),
        float(s.count("-")), float(s.count(" ")), float(s.count(".")), float(s.count("/")), float(s.count("(")),
        float(bool(re.search(r"at[)\]}]|\sat\s", s, re.I))), float(bool(re.search(r"dot[)\]}]|\sdot\s", s, re.I))), float("@" in s),
        float(bool(re.search(r"[.\s)\]}](?:com|org|net|edu|io|de|fr|es)$", s, re.I))),
        float(bool(_CUES[kind].search(before))), float(before[-1:].isalnum()), float(after[:1].isalnum()),
        float(before[-1:] in "$€£#" and before != ""), float(after[:1] == "%"),
        float(int(digits[:4]) in range(1900, 2100)) if len(digits) >= 4 else 0.0,
        float(sum(c.isdigit() for c in before + after)),
    ]


# --- boosted trees ----------------------------------------------------------------

class Boosted:
    """Trees of ``DEPTH`` levels on binned features, fitted to logistic loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, CUTS + 1)[1:-1])) for c in x.T]
        bins = self._bins(x)
        self.base = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
        self.trees: list[tuple[list[tuple[int, int]], np.ndarray]] = []
        f = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-f))
            g, h = y - p, p * (1 - p) + 1e-6
            node, splits = np.zeros(len(y), np.int64), []
            for level in range(DEPTH):  # one split for each level: all leaves ask the same question
                best = (-1.0, 0, 0)
                for j, cuts in enumerate(self.cuts):
                    for c in range(len(cuts)):
                        key = node * 2 + (bins[:, j] > c)
                        gs = np.bincount(key, g, 2 ** (level + 1))
                        hs = np.bincount(key, h, 2 ** (level + 1))
                        gain = float((gs**2 / (hs + 1.0)).sum())
                        if gain > best[0] + 1e-9:
                            best = (gain, j, c)
                splits.append(best[1:])
                node = node * 2 + (bins[:, best[1]] > best[2])
            leaf = RATE * np.bincount(node, g, 2**DEPTH) / (np.bincount(node, h, 2**DEPTH) + 1.0)
            self.trees.append((splits, leaf))
            f += leaf[node]

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, "left") for c, v in zip(self.cuts, x.T, strict=True)], axis=1) if len(x) else np.zeros((0, len(self.cuts)), np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        bins, f = self._bins(x), np.full(len(x), self.base)
        for splits, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for j, c in splits:
                node = node * 2 + (bins[:, j] > c)
            f += leaf[node]
        return f


class Stretches:
    """Disjoint stretches of a text, in order: whether another one touches none
    of them is one binary search, however many there are."""

    def __init__(self, spans: Iterable[tuple[int, int]] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(b, self.ends[-1])
            else:
                self.starts.append(a)
                self.ends.append(b)

    def free(self, a: int, b: int) -> bool:
        k = bisect_right(self.ends, a)  # the first stretch that ends beyond a
        return k == len(self.starts) or b <= self.starts[k]

    def add(self, a: int, b: int) -> None:
        """A stretch that is free."""
        k = bisect_right(self.starts, a)
        self.starts.insert(k, a)
        self.ends.insert(k, b)


class Model:
    """Trees, the logistic curve over their scores, and a threshold for each kind."""

    def __init__(self, x: np.ndarray, y: np.ndarray, held: np.ndarray):
        self.trees = Boosted(x[~held], y[~held])
        s, t = self.trees.score(x[held]), y[held]
        a, b = 1.0, 0.0
        for _ in range(25):  # Newton steps on the held-out rows
            p = 1 / (1 + np.exp(-(a * s + b)))
            w = p * (1 - p) + 1e-6
            grad = np.array([((t - p) * s).sum() - 1e-2 * (a - 1), (t - p).sum()])
            hess = np.array([[(w * s * s).sum() + 1e-2, (w * s).sum()], [(w * s).sum(), w.sum() + 1e-6]])
            step = np.linalg.solve(hess, grad)
            a, b = a + float(step[0]), b + float(step[1])
        self.curve = (a, b)
        p, kind = self.probability(x[held]), x[held][:, 0]
        self.least = {}
        for k, name in enumerate(ADDED):
            mine = kind == k
            order = np.argsort(-p[mine], kind="stable")
            right, q = np.cumsum(t[mine][order]), p[mine][order]
            good = np.flatnonzero(right >= PRECISION * np.arange(1, len(q) + 1))
            self.least[name] = max(float(q[good[-1]]), 0.5) if len(good) and right[good[-1]] >= 5 else 2.0

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.curve[0] * self.trees.score(x) + self.curve[1])))

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Candidates over their threshold that overlap no base span; of
        overlapping ones the likeliest, then the longest, then the first."""
        found = candidates(text)
        taken = Stretches((a, b) for _, a, b in base)
        found = [c for c in found if taken.free(c[1], c[2])] if base else found
        if not found:
            return []
        p = self.probability(np.array([features(text, c) for c in found]))
        ranked = sorted((-q, c[1] - c[2], c) for q, c in zip(p, found, strict=True) if q >= self.least[c[0]])
        out, accepted = [], Stretches()
        for _, _, c in ranked:
            if accepted.free(c[1], c[2]):
                accepted.add(c[1], c[2])
                out.append(c)
        return out


# --- training sample ---------------------------------------------------------------

def _number(r: random.Random, n: int) -> str:
    return "".join(r.choice("0123456789") for _ in range(n))


def _labelled(r: random.Random, words: list[str]) -> tuple[str, str, int]:
    """(kind, value, label): personal data in some format, or a look-alike."""
    word = lambda: re.sub(r"[^A-Za-z]", "", r.choice(words)).lower() or "name"
    kind, label = r.choice(ADDED), r.randint(0, 1)
    if kind == "x_email":
        at, dot = r.choice([("(at)", "(dot)"), ("[at]", "[dot]"), (" at ", " dot "), (" (at) ", " (dot) "), (" [at] ", ".")])
        if label:
            return kind, f"{word()}{r.choice(['.', '', '_'])}{_number(r, 2)}{at}{word()}{dot}{r.choice(['com', 'org', 'net'])}", 1
        return kind, r.choice([f"{word()} at {word()} dot {word()}", f"{word()} at {word()}.{word()}", f"{word()} at {word()} dot {word()} {word()}"]), 0
    if kind == "x_ip":
        if label:
            return kind, ".".join(str(r.randint(1, 255)) for _ in range(4)) + r.choice([":" + _number(r, 4), "/24", "/16"]), 1
        return kind, r.choice([f"{r.randint(1, 9)}.{r.randint(0, 20)}.{r.randint(0, 20)}.{_number(r, 4)}", f"{r.randint(256, 999)}.{_number(r, 3)}.{_number(r, 3)}.{_number(r, 3)}", f"{r.randint(1, 9)}.{r.randint(0, 9)}.{r.randint(0, 9)}.{r.randint(0, 9)}.{r.randint(0, 9)}"]), 0
    if kind == "x_card":
        d = "4" + _number(r, 14)
        d += next(c for c in "0123456789" if luhn(d + c))
        if not label:
            d = d[:-1] + r.choice([c for c in "0123456789" if c != d[-1]])
        sep = r.choice([".", "/", "  ", "_"])
        return kind, r.choice([sep.join(d[i : i + 4] for i in range(0, 16, 4))] if label else [sep.join(d[i : i + 4] for i in range(0, 16, 4)), f"{_number(r, 3)}-{_number(r, 5)}-{_number(r, 4)}-{_number(r, 2)}", f"{_number(r, 7)}_{_number(r, 5)}"]), label
    if label:
        return kind, r.choice([f"({_number(r, 3)}) 555-{_number(r, 4)}", f"{_number(r, 3)}-555-{_number(r, 4)}", f"{_number(r, 3)}.555.{_number(r, 4)}", f"0{_number(r, 2)} {_number(r, 3)} {_number(r, 4)}"]), 1
    return kind, r.choice([f"{r.randint(1900, 2099)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}", f"{r.randint(1, 28):02}/{r.randint(1, 12):02}/{r.randint(1900, 2099)}", f"{_number(r, 2)} {_number(r, 2)}", f"{r.randint(1900, 2099)}-{r.randint(1900, 2099)}", f"{_number(r, 3)} {_number(r, 3)}", f"{_number(r, 2)}.{_number(r, 2)}"]), 0


_LEADS = {"x_email": ["mail", "contact", "write to"], "x_ip": ["host", "server", "from"], "x_card": ["card", "pay by"], "x_phone": ["call", "phone", "tel"]}


def training_rows(text: str, per_document: int = 12) -> Iterator[tuple[list[float], int, bool]]:
    """Features, label and held-out mark of values written into ``text``."""
    words = text.split()[:400]
    if not words:
        return
    r = random.Random(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest())
    held = r.random() < 1 / 3
    for _ in range(per_document):
        kind, value, label = _labelled(r, words)
        i = r.randrange(len(words))
        lead = r.choice(_LEADS[kind]) if r.random() < (0.5 if label else 0.2) else ""
        left, right = " ".join([*words[max(0, i - 6) : i], *([lead] if lead else [])]), " ".join(words[i : i + 6])
        context = f"{left} {value}{r.choice([' ', '. ', ', '])}{right}"
        at = len(left) + 1
        for c in candidates(context):
            if c[0] == kind and c[1] < at + len(value) and at < c[2]:
                exact = (c[1], c[2]) == (at, at + len(value))
                yield features(context, c), int(label and exact), held


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """The model of this corpus; None without any words to learn from."""
    ship(docs.sparkSession)
    ids = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id")).limit(sample_docs)
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id", "left_semi").select("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [m for t in batch.column(0).to_pylist() if t for m in training_rows(t)]
            yield pa.RecordBatch.from_pydict({
                "x": pa.array([m[0] for m in made], pa.list_(pa.float64())),
                "y": pa.array([m[1] for m in made], pa.int32()),
                "held": pa.array([m[2] for m in made], pa.bool_()),
            })

    # Sorted, so the trees do not depend on the order in which tasks end.
    got = sorted((tuple(r["x"]), r["y"], r["held"]) for r in sample.mapInArrow(rows, "x array<double>, y int, held boolean").limit(sample_docs * 40).collect())
    x, y, held = np.array([g[0] for g in got]), np.array([g[1] for g in got], float), np.array([g[2] for g in got], bool)
    if not len(got) or held.all() or not held.any() or len(set(y[~held])) < 2:
        return None
    return Model(x, y, held)


# --- operator -----------------------------------------------------------------------

_MAYBE = np.zeros(256, bool)
_MAYBE[list(b"0123456789@")] = True


def find(text: str | None, model: Model | None) -> tuple[list[Span], list[Span]]:
    """Base and added spans of one text, by kind as listed, then start."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, sorted(model.added(text, base), key=lambda s: (ADDED.index(s[0]), s[1])) if model else []


def _worth(batch_column) -> np.ndarray:
    """Which rows hold a digit or @; besides those, only rows with a spelled-out
    at can have a span."""
    data, off = arrow_text(batch_column)
    marks = np.concatenate([[0], np.cumsum(_MAYBE[data])])
    return np.diff(marks[off]) > 0


def _texts(column) -> Iterator[tuple[int, str]]:
    """Rows that can have a span; only these are decoded."""
    # Any white space or bracket around it passes; this finds more than the generator takes.
    spelled = pc.fill_null(pc.match_substring_regex(column, "[^a-z0-9]at[^a-z0-9]", ignore_case=True), False).to_numpy(zero_copy_only=False)
    for d in np.flatnonzero(_worth(column) | spelled):
        text = column[int(d)].as_py()
        if text:
            yield int(d), text


def spans(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, base and added spans (arrays of kind, start, end) of every row."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model or train(docs))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables("pii")
        for batch in batches:
            base: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            more: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for d, text in _texts(batch.column(1)):
                for out, found in zip((base, more), find(text, sent.value), strict=True):
                    out[d] = [{"kind": k, "start": a, "end": b} for k, a, b in found]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "base": pa.array(base, kind), "added": pa.array(more, kind)})

    field = "array<struct<kind: string, start: int, end: int>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, f"doc_id long, base {field}, added {field}")


def op7_pii(docs: DataFrame) -> DataFrame:
    """Contract columns of the query, from ``spans``."""
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return spans(docs).select(
        "doc_id", *[count(k) for k in KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"),
    )


def redacted(text: str, found: list[Span]) -> str:
    """``text`` with every span, or run of overlapping spans, replaced by the
    kind of its first one in brackets."""
    out, done = [], 0
    for k, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{k.removeprefix('x_').upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with personal data replaced in text, and n_chars (if there)
    counted anew; all rows and columns stay."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model or train(docs))
    schema = docs.schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables("pii")
        for batch in batches:
            k = batch.schema.get_field_index("text")
            texts = {}
            for d, text in _texts(batch.column(k)):
                base, more = find(text, sent.value)
                if base or more:
                    texts[d] = redacted(text, base + more)
            if not texts:
                yield batch
                continue
            new = batch.set_column(k, batch.schema.field(k), pa.array([texts.get(d, t) for d, t in enumerate(batch.column(k).to_pylist())], batch.schema.field(k).type))
            n = new.schema.get_field_index("n_chars")
            if n >= 0:
                sizes = [len(texts[d]) if d in texts else v for d, v in enumerate(new.column(n).to_pylist())]
                new = new.set_column(n, new.schema.field(n), pa.array(sizes, new.schema.field(n).type))
            yield new

    return docs.mapInArrow(scan, schema)
