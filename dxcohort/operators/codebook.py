"""Build code lists: from prefixes, anchored patterns, lexical ranges,
numeric families, or the codes observed in the admissions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dxcohort.functions.arrays import code_prefixes
from dxcohort.functions.expressions import bounded_broadcast, zero_pad
from dxcohort.sources.codelists import CODE_KEYS

MAX_BROADCAST_PREFIXES = 500_000
MAX_PATTERNS = 10_000


def prefixes_frame(spark: SparkSession, config: Mapping) -> DataFrame:
    """``(outcome, system, prefix)`` from the ``icd9``/``icd10`` lists of a
    config, read as prefixes rather than exact codes."""
    rows = []
    for outcome, spec in config.items():
        if not isinstance(spec, Mapping):
            continue
        for key, (role, system) in CODE_KEYS.items():
            if role != "any":
                continue
            for p in spec.get(key) or []:
                rows.append((str(outcome), system, str(p)))
    return spark.createDataFrame(sorted(set(rows)), "outcome string, system string, prefix string")


def _by_prefix(valid: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Each valid code is expanded into its own prefixes, so the match is an
    equi-join on ``(system, prefix)``, not a nested loop over codes x prefixes."""
    v = valid.select("code", "system", F.explode(code_prefixes("code")).alias("prefix"))
    p = bounded_broadcast(prefixes.select("outcome", "system", "prefix"), MAX_BROADCAST_PREFIXES)
    return v.join(p, ["system", "prefix"]).select("outcome", "system", "code")


def expand_prefixes(valid: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Every valid code of the same system that starts with a prefix
    (``code LIKE 'p%'``), distinct, ordered by outcome, system, code."""
    return _by_prefix(valid, prefixes).distinct().orderBy("outcome", "system", "code")


def expand_patterns(valid: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Valid codes matching the anchored alternation ``^(?:p1|p2|...)`` of
    each outcome and system; unique codes.

    Plain prefixes (letters and digits) take the equi-join of
    ``expand_prefixes``. Real patterns, if any, are read from the (config-sized,
    at most ``MAX_PATTERNS``) list and tested row-locally, each outcome's
    alternation a literal that is compiled once.
    """
    plain = F.col("prefix").rlike("^[A-Za-z0-9]*$")
    found = _by_prefix(valid, prefixes.where(plain))
    rest = prefixes.where(~plain).select("outcome", "system", "prefix").distinct().limit(MAX_PATTERNS + 1).collect()
    if len(rest) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns")
    if rest:
        lists: dict[tuple[str, str], list[str]] = {}
        for r in sorted(rest):
            lists.setdefault((r["outcome"], r["system"]), []).append(r["prefix"])
        hits = [
            F.when((F.col("system") == system) & F.col("code").rlike("^(?:" + "|".join(patterns) + ")"), F.lit(outcome))
            for (outcome, system), patterns in lists.items()
        ]
        outcome = F.explode(F.array_compact(F.array(*hits))).alias("outcome")
        found = found.unionByName(valid.select(outcome, "system", "code"))
    return found.distinct()


def codes_in_ranges(valid: DataFrame, ranges: Sequence[tuple[int, str, str]]) -> DataFrame:
    """Codes whose first ``n`` characters lie in ``[lo, hi]`` (lexically)
    for any ``(n, lo, hi)`` of ``ranges``."""
    cond = None
    for n, lo, hi in ranges:
        c = F.substring("code", 1, n).between(lo, hi)
        cond = c if cond is None else (cond | c)
    return valid.where(cond)


def observed_codes(admissions: DataFrame, pattern: str, years: Sequence[int] | None = None) -> DataFrame:
    """Distinct diagnosis codes ``LIKE pattern`` over all (or the given)
    years, sorted.

    The array is filtered before it is exploded, so only matching codes are
    generated; the distinct step aggregates map-side first.
    """
    if years is not None:
        admissions = admissions.where(F.col("year").isin(list(years)))
    matching = F.filter("diagnoses", lambda d: d.like(pattern))
    return (
        admissions.select(F.explode(matching).alias("code"))
        .distinct()
        .orderBy("code")
    )


def family_prefixes(
    spark: SparkSession,
    families: Sequence[tuple[str, str, str, int, int, int]],
) -> DataFrame:
    """Code families from numeric ranges: ``(outcome, system, letter,
    start, stop, width)`` gives ``letter + zero_pad(i, width)`` for
    ``start <= i < stop`` (width 0: no padding)."""
    parts = []
    for outcome, system, letter, start, stop, width in families:
        num = F.col("id").cast("string") if width <= 0 else zero_pad(F.col("id"), width)
        parts.append(
            spark.range(start, stop, numPartitions=1).select(
                F.lit(outcome).alias("outcome"),
                F.lit(system).alias("system"),
                F.concat(F.lit(letter), num).alias("prefix"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def code_sizes(codes: DataFrame) -> DataFrame:
    """Number of distinct codes per outcome and coding system."""
    return codes.groupBy("outcome", "system").agg(F.count_distinct("code").alias("n_codes"))
