"""Sources and sinks: yearly Parquet, CSV code tables, code-list configs."""

from dxcohort.sources.codelists import (
    code_list_table,
    code_rows,
    codes_frame,
    dirty_codes,
    load_code_lists,
    long_names,
    outcome_names,
    parse_code_lists,
    size_mismatches,
)
from dxcohort.sources.readers import (
    bounded_values,
    outcomes_present,
    read_csv_strings,
    read_glob,
    read_table,
    read_valid_codes,
    read_year,
    value_columns,
    years_present,
)
from dxcohort.sources.sinks import (
    flatten_for_csv,
    write_bucketed,
    write_by_year,
    write_code_list,
    write_csv,
    write_parquet,
)

__all__ = [
    "bounded_values",
    "code_list_table",
    "code_rows",
    "codes_frame",
    "dirty_codes",
    "flatten_for_csv",
    "load_code_lists",
    "long_names",
    "outcome_names",
    "outcomes_present",
    "parse_code_lists",
    "read_csv_strings",
    "read_glob",
    "read_table",
    "read_valid_codes",
    "read_year",
    "size_mismatches",
    "value_columns",
    "write_bucketed",
    "write_by_year",
    "write_code_list",
    "write_csv",
    "write_parquet",
    "years_present",
]
