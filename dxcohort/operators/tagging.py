"""Tag admissions whose diagnosis codes match code lists.

Plan for every criterion: one scan of the admissions, an ``explode`` of the
(possibly sliced) diagnosis array, a broadcast hash join with the flat
``codes`` relation that yields the outcome name, and a de-duplication that
shuffles only the *matching* keys. All outcomes of a code list are tagged in
the same pass, so the scanned bytes do not grow with the number of outcomes.
The de-duplication is a hash aggregate with a map-side partial step, so a
key repeated many times collapses before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dxcohort.functions.arrays import dx_at, dx_slice
from dxcohort.functions.expressions import bounded_broadcast
from dxcohort.schemas import need

# A code list is a config file: tens of thousands of codes at most. Above
# this bound the codes side is joined with a shuffle instead.
MAX_BROADCAST_CODES = 2_000_000

# Up to this many (code, outcome) rows, the codes side is proven small by a
# bounded collect of the config-sized table.
MAX_COLLECT_CODES = 50_000
# Up to this many distinct codes, admissions are first filtered row-locally
# (``exists(diagnoses, d -> d IN codes)``, a hash set built once per task),
# so admissions that match nothing are never exploded. Longer lists skip it:
# planning a filter with thousands of literals costs more than it saves.
MAX_PREFILTER_CODES = 1_000

# Fixed value: the last diagnosis position read for secondary codes.
MAX_SECONDARY_POS = 25

KEYS = ["bene_id", "adm_id"]


def _codes(codes: DataFrame, role: str, alias: str) -> tuple[DataFrame, list[str] | None]:
    """The ``(code, outcome)`` rows of ``role`` as a join side, plus the
    distinct codes when they are few enough for a row-local prefilter.

    One bounded collect (at most ``MAX_COLLECT_CODES + 1`` config rows)
    proves a small side; otherwise a count decides between broadcast and a
    shuffled join.
    """
    sel = codes.where(F.col("role") == role).select(F.col("code").alias(alias), "outcome")
    rows = sel.limit(MAX_COLLECT_CODES + 1).collect()
    if len(rows) > MAX_COLLECT_CODES:
        return bounded_broadcast(sel, MAX_BROADCAST_CODES), None
    listed = sorted({r[alias] for r in rows})
    return F.broadcast(sel), (listed if len(listed) <= MAX_PREFILTER_CODES else None)


def criteria_label(criteria: str, first_n: int | None) -> str:
    if criteria == "first_n":
        return f"first_{first_n}"
    return criteria


def tag_any(
    admissions: DataFrame,
    codes: DataFrame,
    first_n: int | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Admissions with a listed code at any position (or in the first n).

    A short code list first filters the admissions row-locally, so only
    admissions with a match are exploded and joined. Returns ``bene_id, adm_id, outcome, year`` (+ ``carry`` columns, which
    must be functionally dependent on the admission, e.g. its dates).
    """
    arr = F.col("diagnoses") if first_n is None else dx_slice("diagnoses", 1, first_n)
    side, listed = _codes(codes, "any", "_code")
    if listed is not None:
        admissions = admissions.where(F.exists(arr, lambda d: d.isin(listed)))
    exploded = admissions.select(*KEYS, "year", *carry, F.explode(arr).alias("_code"))
    matched = exploded.join(side, "_code")
    return matched.select(*KEYS, "outcome", "year", *carry).dropDuplicates(
        ["year", *KEYS, "outcome"]
    )


def conditional_matches(first: DataFrame, codes: DataFrame, max_secondary_pos: int) -> DataFrame:
    """Rows of ``first`` (with ``diagnoses`` and ``_p``, its first code) that
    meet an outcome's primary and secondary lists. Both sides are bounded by
    the lists and broadcast when a count proves them small."""
    primary = codes.where(F.col("role") == "primary").select(F.col("code").alias("_p"), "outcome").distinct()
    secondary = codes.where(F.col("role") == "secondary").groupBy("outcome").agg(F.collect_set("code").alias("_secondary"))
    met = first.join(bounded_broadcast(primary, MAX_BROADCAST_CODES, probe=codes), "_p").join(
        bounded_broadcast(secondary, MAX_BROADCAST_CODES, probe=codes), "outcome"
    )
    return met.where(F.arrays_overlap(dx_slice("diagnoses", 2, max_secondary_pos), F.col("_secondary")))


def tag_conditional(
    admissions: DataFrame,
    codes: DataFrame,
    max_secondary_pos: int = MAX_SECONDARY_POS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Position 1 in the primary list AND any of positions 2..max in the
    secondary list of the same outcome.

    Both tests are row-local: a broadcast join on ``diagnoses[1]`` gives the
    outcome, another one its secondary codes as an array, and positions
    2..max must overlap that array. No array is exploded. Rows are distinct on
    ``(bene_id, adm_id, diagnoses)`` per outcome and year.
    """
    first = admissions.select(*KEYS, "year", "diagnoses", *carry, dx_at("diagnoses", 1).alias("_p"))
    both = conditional_matches(first, codes, max_secondary_pos)
    distinct = both.select(*KEYS, "year", "diagnoses", "outcome", *carry).dropDuplicates(
        ["year", *KEYS, "diagnoses", "outcome"]
    )
    return distinct.select(
        *KEYS,
        "diagnoses",
        dx_at("diagnoses", 1).alias("primary_dx"),
        dx_slice("diagnoses", 2, max_secondary_pos).alias("secondary_dx"),
        "outcome",
        "year",
        *carry,
    )


def tag_outcomes(
    admissions: DataFrame,
    codes: DataFrame,
    criteria: str = "all",
    first_n: int | None = None,
    max_secondary_pos: int = MAX_SECONDARY_POS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Tag every outcome of ``codes`` in one pass over ``admissions``.

    ``criteria``: ``all`` (any position), ``first_n`` (positions 1..n) or
    ``conditional`` (primary + secondary). Output:
    ``bene_id, adm_id, outcome, outcome_criteria, year``; conditional also
    returns ``diagnoses, primary_dx, secondary_dx``. ``year`` is the
    admissions' own year column, so many years run in one job.
    """
    need(admissions, ["bene_id", "adm_id", "year", "diagnoses", *carry], "admissions")
    need(codes, ["outcome", "role", "code"], "codes")
    if criteria == "all":
        tagged = tag_any(admissions, codes, None, carry)
    elif criteria == "first_n":
        if first_n is None or int(first_n) < 1:
            raise ValueError("criteria 'first_n' needs first_n >= 1")
        tagged = tag_any(admissions, codes, int(first_n), carry)
    elif criteria == "conditional":
        tagged = tag_conditional(admissions, codes, max_secondary_pos, carry)
    else:
        raise ValueError(f"unknown criteria {criteria!r}: use all, first_n or conditional")
    label = F.lit(criteria_label(criteria, first_n)).alias("outcome_criteria")
    extra = ["diagnoses", "primary_dx", "secondary_dx"] if criteria == "conditional" else []
    return tagged.select(*KEYS, *extra, "outcome", label, "year", *carry)


def conditional_outcomes(
    admissions: DataFrame, codes: DataFrame, max_secondary_pos: int = MAX_SECONDARY_POS, with_year: bool = False
) -> DataFrame:
    """Stand-alone conditional tagging: ``bene_id, adm_id, diagnoses,
    primary_dx, secondary_dx, outcome`` (no criteria label) and, with
    ``with_year``, the year each row belongs to."""
    year = ["year"] if with_year else []
    return tag_conditional(admissions, codes, max_secondary_pos).select(
        *KEYS, "diagnoses", "primary_dx", "secondary_dx", "outcome", *year
    )


def united_outcomes(*tables: DataFrame) -> DataFrame:
    """Outcome tables that were made one by one (other criteria, other files) as
    one: rows are kept as they are, columns are matched by name, and a column
    that a table lacks is NULL for its rows. A column must have one type."""
    if not tables:
        raise ValueError("no outcome table")
    types: dict[str, str] = {}
    for t in tables:
        need(t, ["bene_id", "adm_id", "outcome", "year"], "outcomes")
        for f in t.schema.fields:
            if types.setdefault(f.name, f.dataType.simpleString()) != f.dataType.simpleString():
                raise ValueError(f"column {f.name} is {types[f.name]} in one table and {f.dataType.simpleString()} in another")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def has_code(arr: str | Column, codes: Sequence[str], first_n: int | None = None) -> Column:
    """Row-local test for one short list: any (of the first n) codes listed.

    Equivalent to the join plan for a single outcome; handy as a filter.
    """
    a = F.col(arr) if isinstance(arr, str) else arr
    if first_n is not None:
        a = F.slice(a, 1, first_n)
    return F.coalesce(F.exists(a, lambda d: d.isin(list(codes))), F.lit(False))
