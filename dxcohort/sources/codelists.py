"""Code-list configuration -> one flat ``codes`` relation.

A code-list file maps an outcome name to its lists::

    asthma:
      long_name: "Asthma, any severity"
      icd9: ['49390', '49392']
      icd10: ['J4520', 'J4540']

Conditional outcomes use ``primary_icd9/10`` and ``secondary_icd9/10``.
All lists of all outcomes become rows ``(outcome, role, system, code)``, so a
single join tags every outcome in one pass over the admissions. Keys that
carry no codes (``long_name``, ``outcome_criteria``, ``ref_period``,
exclusion lists, ...) stay in the loaded config and have no effect.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dxcohort.schemas import CODES

# Config keys holding codes -> (role, coding system).
CODE_KEYS = {
    "icd9": ("any", "icd9"),
    "icd10": ("any", "icd10"),
    "primary_icd9": ("primary", "icd9"),
    "primary_icd10": ("primary", "icd10"),
    "secondary_icd9": ("secondary", "icd9"),
    "secondary_icd10": ("secondary", "icd10"),
}

_CLEAN = re.compile(r"^[A-Za-z0-9]+$")


def load_code_lists(path: str, spark: SparkSession | None = None) -> dict:
    """Read a code-list file (YAML, or JSON when PyYAML is absent), or the
    folder that ``write_code_list`` made (JSON lines).

    With ``spark`` the path may be any that Spark reads (HDFS, object store);
    the file is config-sized and read whole. Without, it is a local file.
    """
    if spark is None:
        with open(path, encoding="utf-8") as fh:
            return parse_code_lists(fh.read())
    out: dict = {}
    for row in spark.read.text(path, wholetext=True).collect():
        out.update(parse_code_lists(row["value"]))
    return out


def parse_code_lists(text: str) -> dict:
    """The config in a text: YAML or JSON by outcome name, or JSON lines with
    an ``outcome`` each."""
    lines = [line for line in text.splitlines() if line.strip()]
    if lines and all(line.lstrip().startswith("{") for line in lines):
        rows = [json.loads(line) for line in lines]
        if all("outcome" in r for r in rows):
            return {r.pop("outcome"): r for r in rows}
    try:
        import yaml  # optional dependency
    except ImportError:  # pragma: no cover - depends on the image
        return json.loads(text)
    return yaml.safe_load(text) or {}


def code_rows(config: Mapping) -> list[tuple[str, str, str, str]]:
    """Flatten a config into distinct ``(outcome, role, system, code)`` rows.

    A missing or empty list simply contributes no codes (an ICD-10-only
    list is valid). Codes are kept verbatim: matching is exact, so a dirty
    code such as ``C563"`` stays in the table and never matches.
    """
    rows: list[tuple[str, str, str, str]] = []
    seen = set()
    for outcome, spec in config.items():
        if not isinstance(spec, Mapping):
            continue
        for key, (role, system) in CODE_KEYS.items():
            for code in spec.get(key) or []:
                row = (str(outcome), role, system, str(code))
                if row not in seen:
                    seen.add(row)
                    rows.append(row)
    return rows


def codes_frame(spark: SparkSession, config: Mapping) -> DataFrame:
    """The ``codes`` relation of a config; small, built on the driver."""
    return spark.createDataFrame(code_rows(config), CODES)


def dirty_codes(config: Mapping) -> list[tuple[str, str, str, str]]:
    """Codes with characters other than letters and digits (never match)."""
    return [r for r in code_rows(config) if not _CLEAN.match(r[3])]


def size_mismatches(config: Mapping) -> list[tuple[str, str, int, int]]:
    """Lists whose declared size (``icd9_count`` / ``icd10_count``) differs
    from the number of distinct codes listed: ``(outcome, key, declared,
    listed)``."""
    out = []
    for outcome, spec in config.items():
        if not isinstance(spec, Mapping):
            continue
        for key in ("icd9", "icd10"):
            declared = spec.get(f"{key}_count")
            if declared is None:
                continue
            listed = len(set(spec.get(key) or []))
            if int(declared) != listed:
                out.append((str(outcome), key, int(declared), listed))
    return out


def outcome_names(config: Mapping) -> list[str]:
    """Outcomes in file order: they name the pivoted count columns."""
    return [str(k) for k, v in config.items() if isinstance(v, Mapping)]


def code_list_table(codes: DataFrame, long_names: Mapping[str, str] | None = None) -> DataFrame:
    """Derived code list as one row per outcome: ``outcome, icd9[], icd10[]``
    and, with ``long_names`` (outcome -> name), ``long_name``.

    A code list is bounded by the coding vocabulary, so collecting one
    outcome's codes into an array is bounded too.
    """
    table = codes.groupBy("outcome").agg(
        F.sort_array(F.collect_set(F.when(F.col("system") == "icd9", F.col("code")))).alias("icd9"),
        F.sort_array(F.collect_set(F.when(F.col("system") == "icd10", F.col("code")))).alias("icd10"),
    )
    if long_names is None:
        return table
    names = codes.sparkSession.createDataFrame(sorted(long_names.items()) or [("", "")], "outcome string, long_name string")
    return table.join(F.broadcast(names), "outcome", "left").select("outcome", "long_name", "icd9", "icd10")


def long_names(config: Mapping) -> dict[str, str]:
    """Outcome -> long name, of the outcomes that have one."""
    return {str(k): str(v["long_name"]) for k, v in config.items() if isinstance(v, Mapping) and v.get("long_name")}
