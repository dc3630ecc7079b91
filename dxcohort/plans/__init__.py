"""Jobs and query plans composed from the operators."""

from dxcohort.plans.workflow import CohortResults, cohort_workflow

__all__ = ["CohortResults", "cohort_workflow"]
