"""A posting table: for each diagnosis code the admissions that carry it.

Code lists are revised often, admissions are not. Tagging with a new list from the
admissions scans all of them; a posting table, written once, is ordered by code, so
tagging reads the listed codes' rows only. One row is (code, position, year,
bene_id, adm_id) for each different code of an admission, with its first position;
columns that depend on the admission (its dates) can be carried along.

Layout: a folder for each year (new years are added without touching others), rows
range-partitioned and sorted by (code, bene_id, adm_id), so a code that a third of
all admissions carry is spread over many files, and a rare one lies in one row
group. Parquet's statistics and pages cut the scan to ranges of codes, Bloom
filters on ``code`` skip row groups that lie around a listed code without having it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dxcohort.functions.expressions import bounded_broadcast
from dxcohort.operators.tagging import KEYS, MAX_BROADCAST_CODES, MAX_COLLECT_CODES, criteria_label
from dxcohort.schemas import need
from dxcohort.sources.readers import read_table

#: Up to this many listed codes are looked up one by one (and by Bloom filter);
#: more are gathered into as many ranges of neighbours.
MAX_LOOKUPS = 1_000
MAX_RANGES = 200
#: Distinct codes a Bloom filter is sized for.
EXPECTED_CODES = 100_000
ROW_GROUP_BYTES = 32 * 1024 * 1024


def posting_rows(admissions: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``code, position, year, bene_id, adm_id`` (+ ``carry``), row-locally: one
    row for each different code of an admission, at its first position. Null
    codes, and admissions without codes, have none."""
    need(admissions, ["bene_id", "adm_id", "year", "diagnoses", *carry], "admissions")
    first = F.transform(
        F.array_distinct(F.array_compact("diagnoses")),
        lambda c: F.struct(c.alias("code"), F.array_position("diagnoses", c).cast("int").alias("position")),
    )
    return admissions.select(F.explode(first).alias("_p"), "year", *KEYS, *carry).select("_p.code", "_p.position", "year", *KEYS, *carry)


def write_postings(
    admissions: DataFrame,
    path: str,
    carry: Sequence[str] = (),
    files: int | None = None,
    row_group_bytes: int = ROW_GROUP_BYTES,
    expected_codes: int = EXPECTED_CODES,
) -> None:
    """Write (or, for the years at hand, replace) the posting table of ``admissions``."""
    rows = posting_rows(admissions, carry)
    order = ["year", "code", *KEYS]
    n = files or int(admissions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        rows.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.bloom.filter.enabled#code", "true")
        .option("parquet.bloom.filter.expected.ndv#code", expected_codes)
        .partitionBy("year")
        .parquet(path)
    )


def _any(conditions: list[Column]) -> Column:
    """A balanced OR (a chain of hundreds would overflow the planner's stack)."""
    while len(conditions) > 1:
        pairs = [reduce(lambda a, b: a | b, conditions[i : i + 2]) for i in range(0, len(conditions), 2)]
        conditions = pairs
    return conditions[0]


def code_ranges(codes: Sequence[str], most: int = MAX_RANGES) -> list[tuple[str, str]]:
    """At most ``most`` ranges that cover ``codes``: neighbours that share the
    longest beginnings are gathered first."""
    codes = sorted(set(codes))
    for length in range(max(map(len, codes), default=0), -1, -1):
        groups: dict[str, tuple[str, str]] = {}
        for c in codes:
            low, _ = groups.get(c[:length], (c, c))
            groups[c[:length]] = low, c
        if len(groups) <= most or length == 0:
            return sorted(groups.values())
    return []


def listed_filter(codes: Sequence[str], max_lookups: int = MAX_LOOKUPS, max_ranges: int = MAX_RANGES) -> Column:
    """What the Parquet reader can use to skip: the codes, or ranges around them."""
    codes = sorted(set(codes))
    if not codes:
        return F.lit(False)
    if len(codes) <= max_lookups:
        return F.col("code").isin(codes)
    return _any([F.col("code").between(low, high) for low, high in code_ranges(codes, max_ranges)])


def tag_postings(
    table: DataFrame,
    codes: DataFrame,
    criteria: str = "all",
    first_n: int | None = None,
    years: Sequence[int] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """What ``tag_outcomes`` gives for the posting table's admissions (criteria
    ``all`` or ``first_n``), from the listed codes' rows alone.

    Up to 50,000 code rows are collected (a config) and pushed into the scan; a
    longer relation is joined without that. A code of several outcomes gives a
    row for each; an admission with several listed codes gives one.
    """
    need(table, ["code", "position", "year", *KEYS, *carry], "postings")
    need(codes, ["outcome", "role", "code"], "codes")
    if criteria not in ("all", "first_n"):
        raise ValueError(f"postings answer the criteria all and first_n, not {criteria!r}")
    if criteria == "first_n" and (first_n is None or int(first_n) < 1):
        raise ValueError("criteria 'first_n' needs first_n >= 1")
    if years is not None:
        table = table.where(F.col("year").isin(list(years)))
    if criteria == "first_n":
        table = table.where(F.col("position") <= int(first_n))
    listed = codes.where((F.col("role") == "any") & F.col("code").isNotNull()).select("code", "outcome")
    rows = listed.limit(MAX_COLLECT_CODES + 1).collect()
    if len(rows) <= MAX_COLLECT_CODES:
        table, side = table.where(listed_filter([r["code"] for r in rows])), F.broadcast(listed)
    else:
        side = bounded_broadcast(listed, MAX_BROADCAST_CODES)
    label = F.lit(criteria_label(criteria, first_n)).alias("outcome_criteria")
    matched = table.join(side, "code").select(*KEYS, "outcome", label, "year", *carry)
    return matched.dropDuplicates(["year", *KEYS, "outcome"])


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path)
