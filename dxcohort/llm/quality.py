"""Quality rules as a short-circuit cascade.

Each rule reads one or two counts of a document. Before the run, one task
measures every rule's cost and rejections on a bounded sample
(``SAMPLE_ROWS`` documents); rules then run in the order of rejections per
second, and a rule only sees the documents that all earlier ones accepted.
The order changes the work, never the verdict: a document is kept if every
rule accepts it.

Words are ``[^\\x20\\x09-\\x0D]+``. A null or empty text has no words and is
rejected (fewer than ``MIN_WORDS``). Extra columns are ignored by the counts
and carried along by ``keep_good``; repeated rows are judged one by one; an
empty table gives an empty table.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxcohort.llm.common import Words, arrow_text, runs, ship, shingle_rows, worker_tables

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 20
MAX_DUP_LINE_PERCENT = 40
MAX_SHOUT_PERCENT = 30
MIN_MEAN_WORD, MAX_MEAN_WORD = 3, 12
#: Documents on which costs and rejections are measured.
SAMPLE_ROWS = 400

_SYMBOL = np.zeros(256, np.int8)
_SYMBOL[list(b"#*$%&|<>")] = 1
_BANG = np.zeros(256, np.int8)
_BANG[ord("!")] = 1


# --- counts: each takes the words of a run of documents -----------------------

def word_chars(w: Words) -> np.ndarray:
    return w.per_document(w.solid & ((w.data & 0xC0) != 0x80))


def n_symbols(w: Words) -> np.ndarray:
    return w.per_document(_SYMBOL[w.data])


def n_bangs(w: Words) -> np.ndarray:
    return w.per_document(_BANG[w.data])


def line_counts(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them equal to an earlier line."""
    total, dup = np.zeros(len(w.off) - 1, np.int64), np.zeros(len(w.off) - 1, np.int64)
    for d, (a, b) in enumerate(zip(w.off[:-1], w.off[1:], strict=True)):
        lines = [x for x in w.data[a:b].tobytes().split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
        total[d], dup[d] = len(lines), len(lines) - len(set(lines))
    return total, dup


def n_repeat_words(w: Words) -> np.ndarray:
    """Words inside 3-word windows that occur twice or more in the document."""
    out = np.zeros(len(w.off) - 1, np.int64)
    for d, (s, n) in enumerate(zip(shingle_rows(w, lower=False), w.counts(), strict=True)):
        if n < 4:
            continue
        order = np.argsort(s, kind="stable")
        same = s[order][1:] == s[order][:-1]
        if same.any():
            twice = np.zeros(len(s), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            covered = np.zeros(n, bool)
            for i in range(3):
                covered[i : i + len(s)] |= twice
            out[d] = covered.sum()
    return out


# --- rules: True where a document is rejected ---------------------------------

def _too_short(w: Words) -> np.ndarray:
    return w.counts() < MIN_WORDS


def _repeats(w: Words) -> np.ndarray:
    return 100 * n_repeat_words(w) > MAX_REPEAT_PERCENT * w.counts()


def _symbols(w: Words) -> np.ndarray:
    return 100 * n_symbols(w) > MAX_SYMBOL_PERCENT * w.counts()


def _shouting(w: Words) -> np.ndarray:
    return 100 * n_bangs(w) > MAX_SHOUT_PERCENT * w.counts()


def _same_lines(w: Words) -> np.ndarray:
    total, dup = line_counts(w)
    return 100 * dup > MAX_DUP_LINE_PERCENT * total


def _word_length(w: Words) -> np.ndarray:
    chars, n = word_chars(w), w.counts()
    return (chars < MIN_MEAN_WORD * n) | (chars > MAX_MEAN_WORD * n)


RULES: dict[str, Callable[[Words], np.ndarray]] = {
    "too_short": _too_short,
    "repeats": _repeats,
    "symbols": _symbols,
    "shouting": _shouting,
    "same_lines": _same_lines,
    "word_length": _word_length,
}


# --- cascade ------------------------------------------------------------------

def subset(data: np.ndarray, off: np.ndarray, rows: np.ndarray) -> Words:
    """The words of some of the documents."""
    sizes = off[rows + 1] - off[rows]
    new = np.concatenate([[0], np.cumsum(sizes)])
    parts = [data[off[r] : off[r + 1]] for r in rows]
    return Words(np.concatenate(parts) if parts else data[:0], new)


def cascade(data: np.ndarray, off: np.ndarray, order: list[str]) -> list[str | None]:
    """The first rule, in ``order``, that rejects each document; None if kept."""
    failed: list[str | None] = [None] * (len(off) - 1)
    alive, w = np.arange(len(off) - 1), Words(data, off)
    for name in order:
        if not len(alive):
            break
        bad = RULES[name](w)
        for d in alive[bad]:
            failed[d] = name
        if bad.any():
            alive = alive[~bad]
            w = subset(data, off, alive)
    return failed


def rule_order(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rules by rejections per second on the ``sample_rows`` documents whose
    ids hash lowest. The sample is measured in one task; only one row for
    each rule reaches the driver."""
    ship(docs.sparkSession)
    ids = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id")).limit(sample_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi").select("text").repartition(1)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, hits = dict.fromkeys(RULES, 0.0), dict.fromkeys(RULES, 0)
        for batch in batches:
            data, off = arrow_text(batch.column(0))
            for a, b in runs(off):
                w = Words(data[off[a] : off[b]], off[a : b + 1] - off[a])
                for name, rule in RULES.items():
                    began = time.perf_counter()
                    hits[name] += int(rule(w).sum())
                    cost[name] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict(
            {"rule": list(RULES), "cost": [cost[r] for r in RULES], "hits": [hits[r] for r in RULES]}
        )

    rows = {r["rule"]: r for r in sample.mapInArrow(measure, "rule string, cost double, hits long").collect()}
    seat = {name: i for i, name in enumerate(RULES)}
    score = lambda r: (rows[r]["hits"] + 0.5) / (rows[r]["cost"] + 1e-6) if r in rows else 0.0
    return sorted(RULES, key=lambda r: (-score(r), seat[r]))


def verdicts(docs: DataFrame, order: list[str] | None = None, counts: bool = True) -> DataFrame:
    """One row for each document: doc_id, failed_rule (null if kept) and, with
    ``counts``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    ship(docs.sparkSession)
    order = order or rule_order(docs)
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"] if counts else []

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables("quality")
        for batch in batches:
            data, off = arrow_text(batch.column("text"))
            for a, b in runs(off):
                part, at = data[off[a] : off[b]], off[a : b + 1] - off[a]
                out = {"doc_id": batch.column("doc_id").slice(a, b - a)}
                if counts:
                    w = Words(part, at)
                    for name, v in zip(fields, (w.counts(), word_chars(w), n_symbols(w), line_counts(w)[1], n_repeat_words(w)), strict=True):
                        out[name] = pa.array(v, pa.int64())
                out["failed_rule"] = pa.array(cascade(part, at, order), pa.string())
                yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, " + "".join(f"{f} long, " for f in fields) + "failed_rule string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(judge, schema)


def keep_good(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The documents that every rule accepts, all columns unchanged. Rows are
    judged in place, so repeated ids and extra columns need no join."""
    ship(docs.sparkSession)
    order = order or rule_order(docs)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables("quality")
        for batch in batches:
            data, off = arrow_text(batch.column(batch.schema.get_field_index("text")))
            good = np.zeros(batch.num_rows, bool)
            for a, b in runs(off):
                failed = cascade(data[off[a] : off[b]], off[a : b + 1] - off[a], order)
                good[a:b] = [f is None for f in failed]
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)


def op6_quality_rules(docs: DataFrame) -> DataFrame:
    """Contract columns of the query, from ``verdicts``."""
    v = verdicts(docs)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return v.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), F.col("failed_rule").isNull().alias("kept"),
    )


ORACLE_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT k, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws,
         [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS ls
  FROM d
), tri AS (
  SELECT k, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS t
  FROM (SELECT k, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), rep AS (
  SELECT k, count(DISTINCT i + j) AS n
  FROM (SELECT k, i, count(*) OVER (PARTITION BY k, t) AS c FROM tri), range(3) AS r(j)
  WHERE c > 1 GROUP BY k
), c AS (
  SELECT w.k, doc_id, len(ws) AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(text, '[^!]', '', 'g')) AS n_bangs,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words
  FROM w LEFT JOIN rep USING (k)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words
            OR 100 * n_symbols > {MAX_SYMBOL_PERCENT} * n_words
            OR 100 * n_bangs > {MAX_SHOUT_PERCENT} * n_words
            OR 100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines
            OR word_chars < {MIN_MEAN_WORD} * n_words OR word_chars > {MAX_MEAN_WORD} * n_words) AS kept
FROM c
"""
