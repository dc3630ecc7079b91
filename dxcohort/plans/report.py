"""What the workflow writes, told by the tasks that write it.

Each output's row counts, totals and dates are *observed* while it is written
(``write_by_year(metrics=...)``): no further job reads it again. The figures are
those of the profile operators (``index_profile``, ``counts_profile``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Report = dict[str, dict[str, dict[str, object]]]


def _of(outcome: str) -> Column:
    return F.col("outcome") == F.lit(outcome)


def outcome_metrics(names: Sequence[str]) -> list[Column]:
    """Tagged rows of each outcome, and all."""
    return [F.count(F.lit(1)).alias("n_rows"), *[F.count_if(_of(o)).alias(f"n_{k}") for k, o in enumerate(names)]]


def index_metrics(names: Sequence[str]) -> list[Column]:
    """Persons, dates and rows of each outcome. A person's first event has the
    number 1, so persons are counted without a distinct step."""
    out = [F.count(F.lit(1)).alias("n_rows")]
    for k, o in enumerate(names):
        mine = F.when(_of(o), F.col("admission_date"))
        out += [
            F.count_if(_of(o) & (F.col("outcome_index") == 1) & F.col("bene_id").isNotNull()).alias(f"bene_{k}"),
            F.min(mine).alias(f"min_{k}"), F.max(mine).alias(f"max_{k}"), F.count_if(_of(o)).alias(f"n_{k}"),
        ]
    return out


def count_metrics(names: Sequence[str], area: str) -> list[Column]:
    """Rows, areas and the total of each outcome. Areas are few (geography), so
    their set is small in each task."""
    totals = [F.coalesce(F.sum(F.col(f"`{o}`")), F.lit(0)).alias(f"n_{k}") for k, o in enumerate(names)]
    return [F.count(F.lit(1)).alias("n_rows"), F.size(F.collect_set(area)).alias("n_areas"), *totals]


def outcome_report(seen: Mapping, names: Sequence[str]) -> dict[str, dict[str, object]]:
    return {"": {"n_rows": seen["n_rows"]}, **{o: {"n_rows": seen[f"n_{k}"]} for k, o in enumerate(names)}}


def index_report(seen: Mapping, names: Sequence[str]) -> dict[str, dict[str, object]]:
    """Outcomes without rows are left out, as in a profile."""
    found = {
        o: {"n_bene": seen[f"bene_{k}"], "min_date": seen[f"min_{k}"], "max_date": seen[f"max_{k}"], "n_rows": seen[f"n_{k}"]}
        for k, o in enumerate(names) if seen[f"n_{k}"]
    }
    return {"": {"n_rows": seen["n_rows"]}, **found}


def count_report(seen: Mapping, names: Sequence[str], area: str) -> dict[str, dict[str, object]]:
    totals = {o: {"total": seen[f"n_{k}"]} for k, o in enumerate(names)}
    return {"": {"n_rows": seen["n_rows"], f"n_{area}": seen["n_areas"]}, **totals}


def dropped_report(tagged: Mapping, areas: Mapping, names: Sequence[str]) -> dict[str, dict[str, object]]:
    """Tagged rows that no area count holds (where spine rows and person-years are
    unique; ``area_drop_report`` tells the reasons, in a job of its own)."""
    return {o: {"dropped": tagged[f"n_{k}"] - areas[f"n_{k}"]} for k, o in enumerate(names)}
