"""End-to-end batch jobs: read datasets, run an operator, write the result.

Each job covers all years in one Spark job (the year is a partition column)
and writes with dynamic partition overwrite, so re-running some years only
replaces those years. Tagged and indexed rows are partitioned by year and
outcome, so outcomes written one by one share a dataset. Paths, code lists
included, may be local, HDFS or object-store URIs. Jobs that pivot outcomes
without a given list fail beyond 10,000 outcomes (1,000 years). A job's scratch
tables are removed when it ends, after a failure as well.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dxcohort.operators import (
    DATE_COLS,
    area_counts,
    attach_dates,
    audit_duplicates,
    cohort_subset,
    conditional_outcomes,
    county_counts,
    expand_patterns,
    expand_prefixes,
    extend_index,
    index_outcomes,
    index_state,
    next_state,
    observed_codes,
    prefixes_frame,
    renumbered,
    strat_counts,
    tag_outcomes,
    unseen,
    year_counts_wide,
)
from dxcohort.operators.tagging import MAX_SECONDARY_POS
from dxcohort.operators.postings import read_postings, tag_postings, write_postings
from dxcohort.plans.report import (
    Report,
    count_metrics,
    count_report,
    dropped_report,
    index_metrics,
    index_report,
    outcome_metrics,
    outcome_report,
)
from dxcohort.plans.workflow import cohort_workflow
from dxcohort.schemas import ADMISSIONS, AREA_SPINE, AREA_WEIGHTS, DENOM, OUTCOMES, VALID_CODES, require_columns
from dxcohort.session import materialize, scoped_frame, scratch_scope
from dxcohort.sources import (
    code_list_table,
    codes_frame,
    load_code_lists,
    long_names,
    outcome_names,
    read_table,
    read_valid_codes,
    write_by_year,
    write_code_list,
    write_csv,
    write_parquet,
)


BY_OUTCOME = ("year", "outcome")


def _scoped(job: Callable) -> Callable:
    """What a job writes to the scratch folder is removed when it ends."""

    @wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        with scratch_scope(spark):
            return job(spark, *args, **kwargs)

    return run


def _config(config: Mapping | str, spark: SparkSession | None = None) -> Mapping:
    return load_code_lists(config, spark) if isinstance(config, str) else config


def _write(df: DataFrame, path: str, fmt: str, keys: tuple[str, ...] | None) -> None:
    if keys:
        write_by_year(df, path, fmt, keys=keys)
    elif fmt == "csv":
        write_csv(df, path)
    else:
        write_parquet(df, path)


def _admissions(spark: SparkSession, path: str, years: Sequence[int] | None) -> DataFrame:
    adm = read_table(spark, path)
    require_columns(adm, ADMISSIONS, "admissions")
    return adm if years is None else adm.where(F.col("year").isin(list(years)))


def _outcomes(spark: SparkSession, path: str) -> DataFrame:
    df = read_table(spark, path)
    require_columns(df, OUTCOMES, "outcomes", ["bene_id", "adm_id", "outcome", "year"])
    return df


def _denom(spark: SparkSession, path: str, cols: list[str]) -> DataFrame:
    df = read_table(spark, path)
    require_columns(df, DENOM, "person-years", cols)
    return df


def _spine(spark: SparkSession, path: str) -> DataFrame:
    df = read_table(spark, path)
    require_columns(df, AREA_SPINE, "area spine")
    return df


def _weights(spark: SparkSession, path: str) -> DataFrame:
    df = read_table(spark, path)
    require_columns(df, AREA_WEIGHTS, "area weights")
    return df


@_scoped
def tag_job(
    spark: SparkSession,
    admissions_path: str,
    code_lists: Mapping | str,
    out_path: str,
    criteria: str = "all",
    first_n: int | None = None,
    years: Sequence[int] | None = None,
    fmt: str = "parquet",
    max_secondary_pos: int = MAX_SECONDARY_POS,
) -> None:
    """Tag all outcomes of a code-list file over the chosen (or all) years."""
    adm = _admissions(spark, admissions_path, years)
    tagged = tag_outcomes(adm, codes_frame(spark, _config(code_lists, spark)), criteria, first_n, max_secondary_pos)
    _write(tagged, out_path, fmt, BY_OUTCOME)


@_scoped
def conditional_job(
    spark: SparkSession,
    admissions_path: str,
    code_lists: Mapping | str,
    out_path: str,
    fmt: str = "parquet",
    years: Sequence[int] | None = None,
    max_secondary_pos: int = MAX_SECONDARY_POS,
) -> None:
    """Stand-alone conditional tagging of the chosen (or all) years."""
    adm = _admissions(spark, admissions_path, years)
    tagged = conditional_outcomes(adm, codes_frame(spark, _config(code_lists, spark)), max_secondary_pos, with_year=True)
    _write(tagged, out_path, fmt, BY_OUTCOME)


@_scoped
def index_job(
    spark: SparkSession,
    outcomes_path: str,
    admissions_path: str,
    out_path: str,
    outcome: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Event index of one outcome (or all), written per year and outcome."""
    indexed = index_outcomes(_outcomes(spark, outcomes_path), read_table(spark, admissions_path), outcome)
    _write(indexed, out_path, fmt, BY_OUTCOME)


@_scoped
def year_counts_job(spark: SparkSession, outcomes_path: str, out_path: str, fmt: str = "csv") -> None:
    _write(year_counts_wide(_outcomes(spark, outcomes_path)), out_path, fmt, None)


@_scoped
def area_counts_job(
    spark: SparkSession,
    outcomes_path: str,
    denom_path: str,
    spine_path: str,
    out_path: str,
    outcome_list: Sequence[str] | None = None,
    years: Sequence[int] | None = None,
) -> None:
    denom = _denom(spark, denom_path, ["bene_id", "year", "zcta"])
    counts = area_counts(_outcomes(spark, outcomes_path), denom, _spine(spark, spine_path), outcome_list, years)
    write_by_year(counts, out_path)


@_scoped
def strat_counts_job(
    spark: SparkSession,
    outcomes_path: str,
    denom_path: str,
    spine_path: str,
    out_path: str,
    outcome_list: Sequence[str] | None = None,
    years: Sequence[int] | None = None,
) -> None:
    denom = _denom(spark, denom_path, DENOM.fieldNames())
    counts = strat_counts(_outcomes(spark, outcomes_path), denom, _spine(spark, spine_path), outcome_list, years)
    write_by_year(counts, out_path)


@_scoped
def county_counts_job(spark: SparkSession, area_counts_path: str, weights_path: str, out_path: str) -> None:
    counts = county_counts(read_table(spark, area_counts_path), _weights(spark, weights_path), ordered=False)
    write_by_year(counts, out_path, sort_within=["county"])


@_scoped
def cohort_job(
    spark: SparkSession, admissions_path: str, outcomes_path: str, out_path: str, outcome: str | None = None
) -> None:
    write_parquet(cohort_subset(read_table(spark, admissions_path), read_table(spark, outcomes_path), outcome), out_path)


@_scoped
def observed_codes_job(
    spark: SparkSession, admissions_path: str, pattern: str, out_path: str, years: Sequence[int] | None = None
) -> None:
    """Codes of the chosen (or all) years' admissions that match a pattern."""
    write_parquet(observed_codes(read_table(spark, admissions_path), pattern, years), out_path)


@_scoped
def expand_codes_job(
    spark: SparkSession,
    valid_paths: Mapping[str, str],
    code_lists: Mapping | str,
    out_path: str,
    patterns: bool = False,
    header: bool = True,
    column: str | None = None,
) -> None:
    """Expand a config whose lists are prefixes (``patterns``: anchored
    patterns) over CSV tables of valid codes, ``valid_paths`` by coding
    system, and write a code list that ``tag_job`` reads."""
    cfg = _config(code_lists, spark)
    valid = None
    for system, path in valid_paths.items():
        part = read_valid_codes(spark, path, system, header, column)
        valid = part if valid is None else valid.unionByName(part)
    if valid is None:
        raise ValueError("no table of valid codes")
    require_columns(valid, VALID_CODES, "valid codes")
    expand = expand_patterns if patterns else expand_prefixes
    write_code_list(code_list_table(expand(valid, prefixes_frame(spark, cfg)), long_names(cfg)), out_path)


def audit_job(spark: SparkSession, admissions_path: str) -> DataFrame:
    return scoped_frame(spark, lambda: audit_duplicates(read_table(spark, admissions_path)))


def outcome_list_of(code_lists: Mapping | str, spark: SparkSession | None = None) -> list[str]:
    return outcome_names(_config(code_lists, spark))


@_scoped
def workflow_job(
    spark: SparkSession,
    admissions_path: str,
    code_lists: Mapping | str,
    denom_path: str,
    spine_path: str,
    weights_path: str,
    out_root: str,
    criteria: str = "all",
    first_n: int | None = None,
    years: Sequence[int] | None = None,
    max_secondary_pos: int = MAX_SECONDARY_POS,
) -> Report:
    """The whole workflow with one scan of the admissions, and a report of it.

    The tagged rows are written once, as ``outcomes`` with their admission dates,
    per year and outcome; every downstream output reads that table, so lineage is
    cut there and a lost executor never re-runs the tagging. Person-years are
    collapsed once for all counts. The report ({table: {outcome or "": {figure:
    value}}}) is observed by the tasks that write, without a further job.
    """
    cfg = _config(code_lists, spark)
    names = outcome_names(cfg)
    adm = _admissions(spark, admissions_path, years)
    weights = _weights(spark, weights_path)
    root = out_root.rstrip("/")
    codes = codes_frame(spark, cfg)
    tagged = tag_outcomes(adm, codes, criteria, first_n, max_secondary_pos, carry=DATE_COLS)
    seen = {"outcomes": write_by_year(tagged, f"{root}/outcomes", keys=BY_OUTCOME, metrics=outcome_metrics(names))}
    res = cohort_workflow(
        adm,
        codes,
        _denom(spark, denom_path, DENOM.fieldNames()),
        _spine(spark, spine_path),
        weights,
        names,
        criteria,
        first_n,
        years,
        tagged=_of_run(read_table(spark, f"{root}/outcomes"), names, years),
    )
    seen["indexed"] = write_by_year(res.indexed, f"{root}/indexed", keys=BY_OUTCOME, metrics=index_metrics(names))
    area_path = f"{root}/area_counts"
    seen["area_counts"] = write_by_year(res.area_counts, area_path, metrics=count_metrics(names, "zcta"))
    seen["strat_counts"] = write_by_year(res.strat_counts, f"{root}/strat_counts", metrics=count_metrics(names, "zcta"))
    areas = read_table(spark, area_path)
    county = county_counts(areas if years is None else areas.where(F.col("year").isin(list(years))), weights, names, ordered=False)
    seen["county_counts"] = write_by_year(county, f"{root}/county_counts", sort_within=["county"], metrics=count_metrics(names, "county"))
    write_csv(res.year_counts, f"{root}/year_counts")
    got = {table: o.get for table, o in seen.items()}
    return {
        "outcomes": outcome_report(got["outcomes"], names),
        "indexed": index_report(got["indexed"], names),
        "area_counts": count_report(got["area_counts"], names, "zcta"),
        "strat_counts": count_report(got["strat_counts"], names, "zcta"),
        "county_counts": count_report(got["county_counts"], names, "county"),
        "dropped": dropped_report(got["outcomes"], got["area_counts"], names),
    }


def _of_run(outcomes: DataFrame, names: Sequence[str], years: Sequence[int] | None) -> DataFrame:
    """This run's rows of a dataset that may hold other outcomes and years."""
    mine = outcomes.where(F.col("outcome").isin(list(names)))
    return mine if years is None else mine.where(F.col("year").isin(list(years)))


@_scoped
def postings_job(
    spark: SparkSession, admissions_path: str, out_path: str, years: Sequence[int] | None = None, files: int | None = None
) -> None:
    """Write the posting table of the chosen (or all) years, with the dates."""
    write_postings(_admissions(spark, admissions_path, years), out_path, carry=DATE_COLS, files=files)


@_scoped
def retag_job(
    spark: SparkSession,
    postings_path: str,
    code_lists: Mapping | str,
    out_path: str,
    criteria: str = "all",
    first_n: int | None = None,
    years: Sequence[int] | None = None,
    fmt: str = "parquet",
) -> None:
    """Tag with a new code-list file from the posting table, without the admissions."""
    codes = codes_frame(spark, _config(code_lists, spark))
    _write(tag_postings(read_postings(spark, postings_path), codes, criteria, first_n, years), out_path, fmt, BY_OUTCOME)


@_scoped
def extend_index_job(
    spark: SparkSession, outcomes_path: str, admissions_path: str, indexed_path: str, state_path: str, fmt: str = "parquet"
) -> None:
    """Number the tagged rows of ``outcomes_path`` that are not in the index yet.

    Reads the person state (``state_path``; made from the index the first time),
    the index of persons with a late event, and of the years and outcomes that
    change; writes those years and outcomes again, and the next state beside the
    old one (``state_path`` holds one folder for each run, the last one counts).
    """
    if fmt != "parquet":
        raise ValueError("the index is extended in Parquet")
    indexed = read_table(spark, indexed_path)
    runs = _state_runs(spark, state_path)
    state = spark.read.parquet(f"{state_path.rstrip('/')}/run={runs[-1]}") if runs else materialize(index_state(indexed), "state")
    fresh = unseen(indexed, _outcomes(spark, outcomes_path).drop(*DATE_COLS))
    new = materialize(attach_dates(fresh, read_table(spark, admissions_path)), "new")
    added, changed = (materialize(df, "numbers") for df in extend_index(state, indexed, new))
    # (year, outcome) folders with a new number: calendar years times listed outcomes.
    folders = materialize(added.unionByName(changed).select("year", "outcome").distinct(), "folders")
    affected = indexed.join(F.broadcast(folders), ["year", "outcome"], "left_semi")
    whole = materialize(renumbered(affected, added, changed), "index")  # not read from where it is written to
    write_by_year(whole, indexed_path, keys=BY_OUTCOME)
    following = next_state(state, added, changed)
    following.write.parquet(f"{state_path.rstrip('/')}/run={(runs[-1] if runs else 0) + 1}")


def _state_runs(spark: SparkSession, path: str) -> list[int]:
    """Runs whose state was written to its end, in order (a name for each run)."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath() for s in fs.listStatus(folder)]
    done = [p.getName() for p in names if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(n.removeprefix("run=")) for n in done if n.startswith("run="))
