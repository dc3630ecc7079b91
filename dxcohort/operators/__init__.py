"""Operators of the cohort workflow, each a DataFrame -> DataFrame function."""

from dxcohort.operators.audit import (
    audit_duplicates,
    counts_profile,
    duplicate_groups,
    totals_by_year,
)
from dxcohort.operators.codebook import (
    code_sizes,
    codes_in_ranges,
    expand_patterns,
    expand_prefixes,
    family_prefixes,
    observed_codes,
    prefixes_frame,
)
from dxcohort.operators.cohort import cohort_subset
from dxcohort.operators.counts import (
    area_counts,
    area_drop_report,
    people_of,
    strat_counts,
    strat_observed,
    strat_spine,
    stratify,
    year_counts_long,
    year_counts_wide,
)
from dxcohort.operators.crosswalk import county_counts
from dxcohort.operators.events import DATE_COLS, attach_dates, index_outcomes, index_profile
from dxcohort.operators.incremental import (
    distinct_persons,
    extend_index,
    index_state,
    merge_bitmaps,
    next_state,
    person_bitmaps,
    renumbered,
    unseen,
    update_area_counts,
    update_strat_counts,
)
from dxcohort.operators.numbering import heavy_groups, row_number_skew_safe
from dxcohort.operators.postings import posting_rows, read_postings, tag_postings, write_postings
from dxcohort.operators.ranges import codes_in_range_table
from dxcohort.operators.tagging import (
    conditional_outcomes,
    has_code,
    tag_any,
    tag_conditional,
    tag_outcomes,
    united_outcomes,
)

__all__ = [
    "DATE_COLS",
    "area_counts",
    "area_drop_report",
    "attach_dates",
    "audit_duplicates",
    "code_sizes",
    "codes_in_range_table",
    "codes_in_ranges",
    "cohort_subset",
    "conditional_outcomes",
    "counts_profile",
    "county_counts",
    "distinct_persons",
    "duplicate_groups",
    "expand_patterns",
    "expand_prefixes",
    "extend_index",
    "family_prefixes",
    "has_code",
    "heavy_groups",
    "index_outcomes",
    "index_profile",
    "index_state",
    "merge_bitmaps",
    "next_state",
    "observed_codes",
    "people_of",
    "person_bitmaps",
    "posting_rows",
    "prefixes_frame",
    "read_postings",
    "renumbered",
    "row_number_skew_safe",
    "strat_counts",
    "strat_observed",
    "strat_spine",
    "stratify",
    "tag_any",
    "tag_conditional",
    "tag_outcomes",
    "tag_postings",
    "totals_by_year",
    "united_outcomes",
    "unseen",
    "update_area_counts",
    "update_strat_counts",
    "write_postings",
    "year_counts_long",
    "year_counts_wide",
]
