"""Secret scans with character Markov models, in DataFrame functions only.

Base spans follow fixed patterns (assigned values, access keys, long hex runs)
and always stay. Besides them, every run of at least ``LEAST_CHARS`` characters of
``ALPHABET`` is a candidate: two first-order Markov models over its characters,
one of random strings and one of ordinary identifiers, give it a log-likelihood
ratio, and candidates of ``LEAST_RATIO`` or more that overlap no base span
become spans of the kind ``markov``.

The models are trained from labelled samples of at most ``SAMPLE_TOKENS``
tokens for each label, taken from the ``SAMPLE_DOCS`` documents whose ids
hash lowest: labelled random are the values of base spans and digests of the
ids in several encodings; labelled ordinary are words outside base spans and
identifiers composed of neighbouring words. Only bigram counts (a number for each
pair of characters and label) reach the driver.

Offsets are code points, ends exclusive. A null or empty text has no spans. Repeated
rows are judged one by one; extra columns are ignored; an empty table gives an
empty table (and models that only know the uniform prior).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # runs of 20 characters or more, from AKIA on
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
LEAST_VALUE = 6

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LEAST_CHARS = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_CHARS
#: Log-likelihood ratio (nats) from which a candidate is a secret.
LEAST_RATIO = 10.0
SAMPLE_DOCS = 300
SAMPLE_TOKENS = 20_000
#: Pseudo-counts of each row of the models, spread evenly over the alphabet.
PRIOR_RANDOM, PRIOR_ORDINARY = 60.0, 6.0


# --- spans of a pattern ---------------------------------------------------------------

def _spans(text: Column, pattern: str, rank: int, value_group: int | None = None, least_value: int = 0) -> Column:
    """array<struct<start, kind, end>> of the leftmost non-overlapping matches
    of ``pattern``. The gaps (split) and the matches of the same scan give
    the places; texts without a match cost one scan."""
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if value_group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    sizes = F.zip_with(F.transform(gaps, lambda g: F.length(g)), whole, lambda g, m: F.struct(g.alias("gap"), F.coalesce(F.length(m), F.lit(0)).alias("match")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        low = acc["at"] + s["gap"]
        span = F.struct(low.alias("start"), F.lit(rank).alias("kind"), (low + s["match"]).alias("end"))
        return F.struct((low + s["match"]).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    found = F.slice(F.aggregate(sizes, start, step)["out"], 1, F.size(whole))
    if least_value:
        pairs = F.filter(F.zip_with(found, value, lambda s, v: F.struct(s.alias("s"), v.alias("v"))), lambda p: F.length(p["v"]) >= least_value)
        found = F.transform(pairs, lambda p: p["s"])
    return F.when(F.rlike(text, F.lit(pattern)), found).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def with_base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and base: spans of the three fixed kinds."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.withColumn("base", F.concat(_spans(F.col("text"), ASSIGN, 0, 1, LEAST_VALUE), _spans(F.col("text"), ACCESS, 1), _spans(F.col("text"), HEX, 2)))


# --- models -------------------------------------------------------------------------------

def labelled_samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_tokens: int = SAMPLE_TOKENS) -> DataFrame:
    """token, label (1 random, 0 ordinary)."""
    ids = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id")).limit(sample_docs)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    values = rows.select(F.explode(F.concat(
        F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)), F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)), F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
    )).alias("token")).where(F.length("token") >= LEAST_CHARS)
    digest = lambda salt: F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    base64 = lambda salt: F.regexp_replace(F.base64(F.unhex(digest(salt))), "[\r\n]", "")
    made = rows.select("doc_id").distinct().select(F.explode(F.array(
        *[base64(s) for s in "abcdef"], *[F.regexp_replace(base64(s), "[+/=]", "") for s in "ghijkl"],
        *[F.upper(F.regexp_replace(base64(s), "[+/=]", "")) for s in "mn"], *[F.substring(digest(s), 1, 40) for s in "op"],
    )).alias("token"))
    cleared = F.regexp_replace(F.regexp_replace(text, ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    split = F.filter(F.split(cleared, "[^A-Za-z0-9_-]+"), lambda w: F.length(w) >= 2)
    # A column of its own: inside a lambda it would be made anew for each word.
    split_rows = rows.select(split.alias("words")).where(F.size("words") > 1)
    joint = lambda i: F.element_at(F.array(F.lit("_"), F.lit("-"), F.lit("")), (i % 3 + 1).cast("int"))
    second = lambda i: F.when(i % 3 == 2, F.initcap(F.get("words", i + 1))).otherwise(F.lower(F.get("words", i + 1)))
    pairs = F.transform(F.sequence(F.lit(0), F.size("words") - 2), lambda i: F.concat(F.lower(F.get("words", i)), joint(i), second(i)))
    ordinary = split_rows.select(F.explode(F.concat("words", pairs)).alias("token"))
    first = lambda df: df.orderBy(F.xxhash64("token"), "token").limit(sample_tokens)
    return first(values.union(made)).withColumn("label", F.lit(1)).union(first(ordinary).withColumn("label", F.lit(0)))


def _places(token: Column) -> Column:
    """The alphabet places of a token's characters, others left out."""
    chars = F.filter(F.split(token, ""), lambda c: (c != "") & (F.instr(F.lit(ALPHABET), c) > 0))
    return F.transform(chars, lambda c: F.instr(F.lit(ALPHABET), c) - 1)


def train(samples: DataFrame) -> list[float]:
    """log P(next | character, random) - log P(next | character, ordinary) of
    every pair of characters, in alphabet order."""
    n = len(ALPHABET)
    at = samples.select("label", _places(F.col("token")).alias("p")).where(F.size("p") > 1)
    pairs = at.select("label", F.explode(F.transform(F.sequence(F.lit(0), F.size("p") - 2), lambda i: F.get("p", i) * n + F.get("p", i + 1))).alias("pair"))
    counts = {(r["label"], r["pair"]): r["n"] for r in pairs.groupBy("label", "pair").agg(F.count("*").alias("n")).collect()}

    def log_rows(label: int, prior: float) -> list[float]:
        out = []
        for a in range(n):
            row = [counts.get((label, a * n + b), 0) + prior / n for b in range(n)]
            out += [math.log(v / sum(row)) for v in row]
        return out

    return [r - o for r, o in zip(log_rows(1, PRIOR_RANDOM), log_rows(0, PRIOR_ORDINARY), strict=True)]


def log_ratio(token: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of ``token`` (of alphabet characters) by ``model``;
    the table is one folded literal."""
    table = F.split(F.lit(",".join(f"{v:.6f}" for v in model)), ",").cast("array<double>")
    places = _places(token)
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    total = F.aggregate(places, start, lambda acc, p: F.struct(p.alias("last"), (acc["sum"] + F.when(acc["last"] < 0, F.lit(0.0)).otherwise(F.get(table, acc["last"] * len(ALPHABET) + p))).alias("sum")))
    return total["sum"]


# --- operator ----------------------------------------------------------------------------

def with_spans(docs: DataFrame, model: list[float] | None = None) -> DataFrame:
    """doc_id, base and spans (base and markov), each an array of structs start,
    kind (place in ``KINDS``) and end, by start, then kind."""
    model = model or train(labelled_samples(docs))
    rows = with_base_spans(docs)
    found = _spans(F.col("text"), CANDIDATE, 3)
    free = F.filter(found, lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    kept = F.filter(free, lambda s: log_ratio(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]), model) >= LEAST_RATIO)
    return rows.select("doc_id", F.array_sort("base").alias("base"), F.array_sort(F.concat("base", kept)).alias("spans"))


def op4_secret_scan(docs: DataFrame) -> DataFrame:
    """Contract columns of the query, from ``with_spans``."""
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return with_spans(docs).select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
