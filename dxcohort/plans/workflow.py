"""Compositions of the operators into the workflow's jobs.

``cohort_workflow`` is the whole workflow in one lineage: tag -> event
index -> area counts -> county counts (+ stratified and year counts). The
admissions are scanned once: the admission dates ride along with the tagged
rows, so the event index needs no second scan or join of the admissions.
Each output is planned on first access only, so asking for the county
counts runs no job for the event index.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame

from dxcohort.operators.counts import area_counts, area_drop_report, collapsed, strat_counts, year_counts_wide
from dxcohort.operators.crosswalk import county_counts
from dxcohort.operators.events import DATE_COLS, index_outcomes
from dxcohort.operators.tagging import MAX_SECONDARY_POS, tag_outcomes
from dxcohort.session import materialize, remove_path


class CohortResults:
    """Lazily planned outputs of one workflow run."""

    def __init__(self, tagged, denom, spine, weights, outcome_list, years, heavy_rows, owned=None):
        self.tagged = tagged
        self._owned = owned
        self._denom, self._spine, self._weights = denom, spine, weights
        self._names, self._years, self._heavy = list(outcome_list), years, heavy_rows

    def release(self) -> None:
        """Delete the written tagged rows (when this object wrote them); call
        it when all outputs have been written."""
        for path in self._owned or []:
            remove_path(self.tagged.sparkSession, path)
        self._owned = None

    @cached_property
    def outcomes(self) -> DataFrame:
        return self.tagged.drop(*DATE_COLS)

    @cached_property
    def indexed(self) -> DataFrame:
        return index_outcomes(self.tagged, None, heavy_rows=self._heavy)

    @cached_property
    def year_counts(self) -> DataFrame:
        return year_counts_wide(self.outcomes, self._names)

    @cached_property
    def person_years(self) -> DataFrame:
        """Tagged rows of each person-year and outcome: written once for all counts."""
        return collapsed(self.outcomes)

    @cached_property
    def area_counts(self) -> DataFrame:
        return area_counts(self.outcomes, self._denom, self._spine, self._names, self._years, self.person_years)

    @cached_property
    def strat_counts(self) -> DataFrame:
        return strat_counts(self.outcomes, self._denom, self._spine, self._names, self._years, self.person_years)

    @cached_property
    def dropped(self) -> DataFrame:
        return area_drop_report(self.outcomes, self._denom, self._spine, self._years, self.person_years)

    @cached_property
    def county_counts(self) -> DataFrame:
        return county_counts(self.area_counts, self._weights, self._names)


def cohort_workflow(
    admissions: DataFrame,
    codes: DataFrame,
    denom: DataFrame,
    spine: DataFrame,
    weights: DataFrame,
    outcome_list: Sequence[str],
    criteria: str = "all",
    first_n: int | None = None,
    years: Sequence[int] | None = None,
    heavy_rows: int | None = 5_000_000,
    tagged: DataFrame | None = None,
    max_secondary_pos: int = MAX_SECONDARY_POS,
) -> CohortResults:
    """All outputs of the workflow as lazy DataFrames.

    ``tagged`` may be a written tagging output (with the date columns) to
    cut lineage between the tagging and the downstream jobs. Otherwise the
    tagged rows are written here, to the shared folder, so every output and
    every size check shares one pass over the admissions and a lost executor
    does not repeat it.
    """
    owned = None
    if tagged is None:
        tagged = materialize(
            tag_outcomes(admissions, codes, criteria, first_n, max_secondary_pos, carry=DATE_COLS), "workflow_tagged"
        )
        owned = sorted({f.rsplit("/", 1)[0] for f in tagged.inputFiles()})
    return CohortResults(tagged, denom, spine, weights, outcome_list, years, heavy_rows, owned)
