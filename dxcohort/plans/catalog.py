"""Registered queries over the driver's tables (their SQL oracles are in
``plans/oracle.py``).

Every query derives the workflow's inputs from the given tables (see
``sources/fixtures.py``) and runs one operator over all of them. Outputs are
presented for comparison: dates become ISO strings and arrays become
comma-joined strings, in both engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dxcohort.functions.arrays import dx_at, dx_slice
from dxcohort.operators import (
    DATE_COLS,
    area_counts,
    area_drop_report,
    attach_dates,
    audit_duplicates,
    code_sizes,
    codes_in_range_table,
    codes_in_ranges,
    cohort_subset,
    conditional_outcomes,
    counts_profile,
    county_counts,
    distinct_persons,
    expand_patterns,
    expand_prefixes,
    extend_index,
    family_prefixes,
    index_outcomes,
    index_profile,
    index_state,
    merge_bitmaps,
    observed_codes,
    people_of,
    person_bitmaps,
    prefixes_frame,
    read_postings,
    renumbered,
    strat_counts,
    strat_spine,
    stratify,
    tag_outcomes,
    tag_postings,
    totals_by_year,
    united_outcomes,
    unseen,
    update_area_counts,
    update_strat_counts,
    write_postings,
    year_counts_long,
    year_counts_wide,
)
from dxcohort.operators.numbering import with_places
from dxcohort.plans.jobs import workflow_job
from dxcohort.plans.workflow import cohort_workflow
from dxcohort.session import materialize, scoped_frame, scratch_path
from dxcohort.sources import (
    code_list_table,
    codes_frame,
    load_code_lists,
    outcomes_present,
    read_csv_strings,
    read_glob,
    read_table,
    read_year,
    write_by_year,
    write_code_list,
    write_csv,
    write_parquet,
    years_present,
)
from dxcohort.sources import fixtures as fx

# ---------------------------------------------------------------------------
# Fixed values of the registered queries.
ANY_OUTCOMES = ["mixed", "single", "econ"]  # outcomes with any-position lists
FIRST_N = 2
PREFIX_LISTS = {
    "endo": {"icd10": ["E1", "E11", "E2"]},
    "large": {"icd10": ["L0"]},
    "split": {"icd9": ["E1"], "icd10": ["M4", "S"]},
}
CODE_RANGES = [(3, "E05", "E15"), (2, "P2", "P3")]
RANGE_TABLE = [
    ("endo", 3, "E05", "E15"), ("endo", 3, "E10", "E30"), ("endo", 2, "E2", "E2"), ("wide", 1, "E", "M"), ("wide", 3, "L10", "P20"),
    ("point", 3, "M05", "M05"), ("none", 3, "Z1", "A1"), ("between", 3, "E055", "E1"),
]
FAMILIES = [("fam", "icd10", "E", 1, 12, 2), ("fam", "icd10", "P", 45, 51, 2)]
OBSERVED_PATTERN = "E%"
RELOADED_SOURCE = "1-URGENT"
PROFILE_YEAR = 1998
HEAVY_ROWS = 100
# ---------------------------------------------------------------------------


def present(df: DataFrame) -> DataFrame:
    """Dates -> ISO strings, arrays -> comma-joined strings."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)


class Inputs:
    """Lazily derived inputs of one ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._years = None

    @property
    def years(self) -> list[int]:
        if self._years is None:
            self._years = fx.order_years(self.spark, self.sf_dir)
        return self._years

    def admissions(self) -> DataFrame:
        return fx.admissions(self.spark, self.sf_dir)

    def denom(self) -> DataFrame:
        return fx.denom(self.spark, self.sf_dir, self.years)

    def spine(self) -> DataFrame:
        return fx.unique_zcta(self.spark, self.sf_dir, self.years)

    def weights(self) -> DataFrame:
        return fx.zcta2county(self.spark, self.sf_dir, self.years)

    def valid(self) -> DataFrame:
        return fx.valid_codes(self.spark, self.sf_dir)

    def codes(self, *outcomes: str) -> DataFrame:
        cfg = fx.FIXTURE_CODE_LISTS
        if outcomes:
            cfg = {k: v for k, v in cfg.items() if k in outcomes}
        return codes_frame(self.spark, cfg)

    def tagged(self, criteria: str = "all", first_n: int | None = None, *outcomes: str) -> DataFrame:
        return tag_outcomes(self.admissions(), self.codes(*outcomes), criteria, first_n)

    def prefixes(self) -> DataFrame:
        return prefixes_frame(self.spark, PREFIX_LISTS)


# ---------------------------------------------------------------------------
# Spark side


def q_tag_all(i: Inputs) -> DataFrame:
    return i.tagged("all", None, "mixed")


def q_tag_first_n(i: Inputs) -> DataFrame:
    return i.tagged("first_n", FIRST_N, "mixed")


def q_tag_conditional(i: Inputs) -> DataFrame:
    return i.tagged("conditional", None, "cond")


def q_tag_conditional_only(i: Inputs) -> DataFrame:
    return conditional_outcomes(i.admissions(), i.codes("cond"))


def q_tag_conditional_years(i: Inputs) -> DataFrame:
    return conditional_outcomes(i.admissions(), i.codes("cond", "cond2"), with_year=True)


def q_tag_multi_outcome(i: Inputs) -> DataFrame:
    return i.tagged("all", None)


def _united(i: Inputs) -> DataFrame:
    """Outcomes tagged one by one, with the criteria of each."""
    one = i.tagged("all", None, "mixed")
    return united_outcomes(one, i.tagged("first_n", FIRST_N, "econ"), i.tagged("conditional", None, "cond"))


def q_outcomes_united(i: Inputs) -> DataFrame:
    return _united(i)


def q_year_counts_united(i: Inputs) -> DataFrame:
    return year_counts_long(_united(i))


def _postings(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "postings")
    write_postings(i.admissions(), path)
    return read_postings(i.spark, path)


def q_tag_by_postings(i: Inputs) -> DataFrame:
    return tag_postings(_postings(i), i.codes())


def q_tag_by_postings_first_n(i: Inputs) -> DataFrame:
    return tag_postings(_postings(i), i.codes("mixed"), "first_n", FIRST_N)


def q_codes_prefix_expand(i: Inputs) -> DataFrame:
    return expand_prefixes(i.valid(), i.prefixes())


def q_codes_prefix_ordered(i: Inputs) -> DataFrame:
    """With each row's place, so that the order is compared as well."""
    return with_places(expand_prefixes(i.valid(), i.prefixes()), "place")


def q_codes_regex_expand(i: Inputs) -> DataFrame:
    return expand_patterns(i.valid(), i.prefixes())


def q_codes_range(i: Inputs) -> DataFrame:
    return codes_in_ranges(i.valid(), CODE_RANGES)


def q_codes_range_table(i: Inputs) -> DataFrame:
    return codes_in_range_table(i.valid(), i.spark.createDataFrame(RANGE_TABLE, "outcome string, n int, lo string, hi string"))


def q_codes_observed(i: Inputs) -> DataFrame:
    return observed_codes(i.admissions(), OBSERVED_PATTERN)


def q_codes_generate(i: Inputs) -> DataFrame:
    return expand_patterns(i.valid(), family_prefixes(i.spark, FAMILIES))


def q_codes_sizes(i: Inputs) -> DataFrame:
    return code_sizes(expand_prefixes(i.valid(), i.prefixes()))


def q_outcome_index(i: Inputs) -> DataFrame:
    return index_outcomes(i.tagged("first_n", FIRST_N, "mixed"), i.admissions())


def q_outcome_index_profile(i: Inputs) -> DataFrame:
    return index_profile(index_outcomes(i.tagged("first_n", FIRST_N, "mixed"), i.admissions()))


def q_outcome_index_heavy(i: Inputs) -> DataFrame:
    """The range path of the numbering, with a heavy NULL person."""
    adm = i.admissions()
    tagged = tag_outcomes(adm, i.codes("mixed"), "all", carry=["admission_date", "discharge_date"])
    lost = tagged.withColumn("bene_id", F.when(F.col("bene_id") % 4 != 0, F.col("bene_id")))
    # text: a nullable integer converts to different pandas dtypes per engine
    return index_outcomes(lost, heavy_rows=HEAVY_ROWS).withColumn("bene_id", F.col("bene_id").cast("string"))


def q_outcome_index_bloom(i: Inputs) -> DataFrame:
    """Dates looked up behind a Bloom filter of the tagged ids, none broadcast."""
    dated = attach_dates(i.tagged("first_n", FIRST_N, "mixed"), i.admissions(), max_broadcast_ids=0)
    return index_outcomes(dated)


def _first_run(column: str = "adm_id"):
    """Two thirds of the admissions, dealt by number: the rest come late, and lie
    before and between them."""
    return F.col(column) % 3 != 0


def q_outcome_index_extended(i: Inputs) -> DataFrame:
    """Indexed in two runs: the second is numbered on from the first one's state,
    and offers some of the first one's rows again."""
    dated = i.admissions()
    tagged = tag_outcomes(dated, i.codes("mixed"), "first_n", FIRST_N, carry=DATE_COLS)
    tagged = materialize(tagged, "tagged")
    indexed = materialize(index_outcomes(tagged.where(_first_run())), "indexed")
    new = unseen(indexed, tagged.where(~_first_run() | (F.col("adm_id") % 2 == 0)))
    added, changed = extend_index(index_state(indexed), indexed, new)
    return renumbered(indexed, added, changed)


def _two_runs(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """Rows of a first count, some of them twice by mistake, and the delta that
    adds the late ones and takes the mistakes back."""
    rows = materialize(_counted(i), "counted")
    wrong = rows.where(F.abs("adm_id") % 7 == 0)
    first = rows.where(_first_run()).unionByName(wrong)
    late = rows.where(~_first_run()).withColumn("sign", F.lit(1)).unionByName(wrong.withColumn("sign", F.lit(-1)))
    return first, late


def q_area_counts_updated(i: Inputs) -> DataFrame:
    first, late = _two_runs(i)
    stored = materialize(area_counts(first, i.denom(), i.spine(), ANY_OUTCOMES, i.years), "stored")
    return update_area_counts(stored, late, i.denom(), i.spine(), ANY_OUTCOMES, "sign")


def q_strat_counts_updated(i: Inputs) -> DataFrame:
    first, late = _two_runs(i)
    stored = materialize(strat_counts(first, i.denom(), i.spine(), ANY_OUTCOMES, i.years), "stored")
    return update_strat_counts(stored, late, i.denom(), ANY_OUTCOMES, "sign")


def q_distinct_persons(i: Inputs) -> DataFrame:
    """Different persons by outcome over unions of years, from bitmaps that two
    runs have stored."""
    rows = materialize(_counted(i), "counted")
    stored = materialize(merge_bitmaps(*[person_bitmaps(rows.where(c)) for c in (_first_run(), ~_first_run())]), "bitmaps")
    half = i.years[: len(i.years) // 2]
    parts = [
        distinct_persons(stored).select(F.lit("all").alias("period"), "outcome", "n_persons"),
        distinct_persons(stored, half).select(F.lit("first half").alias("period"), "outcome", "n_persons"),
        distinct_persons(stored, by=("year", "outcome")).select(F.col("year").cast("string").alias("period"), "outcome", "n_persons"),
        distinct_persons(stored, by=()).select(F.lit("all").alias("period"), F.lit("any").alias("outcome"), "n_persons"),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def q_outcomes_present(i: Inputs) -> DataFrame:
    return outcomes_present(i.tagged("all", None), PROFILE_YEAR)


def q_years_present(i: Inputs) -> DataFrame:
    return years_present(i.tagged("all", None))


def q_year_counts_long(i: Inputs) -> DataFrame:
    return year_counts_long(i.tagged("all", None))


def q_year_counts_wide(i: Inputs) -> DataFrame:
    return year_counts_wide(i.tagged("all", None), ANY_OUTCOMES)


def _counted(i: Inputs) -> DataFrame:
    """Tagged rows of customers and strangers, for the counts."""
    return fx.with_strangers(i.tagged("all", None))


def _area(i: Inputs) -> DataFrame:
    return area_counts(_counted(i), i.denom(), i.spine(), ANY_OUTCOMES, i.years)


def q_area_counts(i: Inputs) -> DataFrame:
    return _area(i)


def q_area_counts_profile(i: Inputs) -> DataFrame:
    return counts_profile(_area(i))


def q_area_counts_by_year(i: Inputs) -> DataFrame:
    return totals_by_year(_area(i))


def q_area_counts_dropped(i: Inputs) -> DataFrame:
    return area_drop_report(_counted(i), i.denom(), i.spine())


def _strat(i: Inputs) -> DataFrame:
    return strat_counts(_counted(i), i.denom(), i.spine(), ANY_OUTCOMES, i.years)


def q_strat_counts(i: Inputs) -> DataFrame:
    return _strat(i)


def q_strat_domain_spine(i: Inputs) -> DataFrame:
    return strat_spine(i.spine(), i.years)


def q_age_bands(i: Inputs) -> DataFrame:
    return stratify(i.denom())


def q_county_counts(i: Inputs) -> DataFrame:
    return county_counts(_area(i), i.weights(), ANY_OUTCOMES)


def q_county_counts_profile(i: Inputs) -> DataFrame:
    return counts_profile(county_counts(_area(i), i.weights(), ANY_OUTCOMES))


def q_strat_counts_profile(i: Inputs) -> DataFrame:
    return counts_profile(_strat(i))


def q_cohort_subset(i: Inputs) -> DataFrame:
    return cohort_subset(i.admissions(), i.tagged("first_n", FIRST_N, "mixed"))


def q_cohort_subset_bloom(i: Inputs) -> DataFrame:
    """Persons behind a Bloom filter, none broadcast; admissions are derived once."""
    adm = materialize(i.admissions(), "admissions")
    return cohort_subset(adm, tag_outcomes(adm, i.codes("mixed"), "first_n", FIRST_N), max_broadcast_persons=0)


def q_outcome_denominator_bloom(i: Inputs) -> DataFrame:
    """Person-years behind a Bloom filter of the tagged ones, none broadcast."""
    t = materialize(i.tagged("first_n", FIRST_N, "mixed"), "tagged")
    people = people_of(t, i.denom().select("bene_id", "year", "zcta"), max_keys=0)
    return t.join(people, ["bene_id", "year"]).select("bene_id", "adm_id", "year", "zcta", "outcome")


def q_duplicate_audit(i: Inputs) -> DataFrame:
    return audit_duplicates(i.admissions())


def q_duplicate_audit_reload(i: Inputs) -> DataFrame:
    adm = i.admissions()
    reloaded = adm.where(F.col("adm_source") == RELOADED_SOURCE)
    return audit_duplicates(adm.unionByName(reloaded))


def q_duplicate_audit_null_years(i: Inputs) -> DataFrame:
    adm = i.admissions()
    both = adm.unionByName(adm.where(F.col("adm_source") == RELOADED_SOURCE))
    return audit_duplicates(both.withColumn("year", F.when(F.col("adm_id") % 3 != 0, F.col("year")))).select(
        F.coalesce(F.col("year").cast("string"), F.lit("none")).alias("year"), "duplicate_count"
    )


def q_outcome_denominator_join(i: Inputs) -> DataFrame:
    t = i.tagged("first_n", FIRST_N, "mixed")
    return t.join(i.denom().select("bene_id", "year", "zcta"), ["bene_id", "year"]).select(
        "bene_id", "adm_id", "year", "zcta", "outcome"
    )


def q_secondary_slice(i: Inputs) -> DataFrame:
    return i.admissions().select(
        "adm_id",
        dx_at("diagnoses", 1).alias("primary_dx"),
        dx_at("diagnoses", 2).alias("second_dx"),
        dx_at("diagnoses", 26).alias("dx26"),
        dx_slice("diagnoses", 2, 25).alias("secondary_dx"),
        # text: a nullable integer converts to different pandas dtypes per engine
        F.array_size("diagnoses").cast("string").alias("n_dx"),
    )


def q_workflow_tag_to_county(i: Inputs) -> DataFrame:
    res = cohort_workflow(
        i.admissions(), i.codes(), i.denom(), i.spine(), i.weights(), ANY_OUTCOMES, "first_n", FIRST_N, i.years
    )
    return res.county_counts


def q_workflow_index(i: Inputs) -> DataFrame:
    res = cohort_workflow(
        i.admissions(), i.codes(), i.denom(), i.spine(), i.weights(), ANY_OUTCOMES, "first_n", FIRST_N, i.years
    )
    return res.indexed


def q_workflow_conditional_counts(i: Inputs) -> DataFrame:
    res = cohort_workflow(
        i.admissions(), i.codes("cond"), i.denom(), i.spine(), i.weights(), ["cond"], "conditional", None, i.years
    )
    return res.area_counts


def q_workflow_report(i: Inputs) -> DataFrame:
    """The figures that the workflow's writing tasks observe, as rows of text."""
    inputs = {name: scratch_path(i.spark, f"in_{name}") for name in ("adm", "denom", "spine", "weights")}
    write_by_year(i.admissions(), inputs["adm"])
    write_by_year(i.denom(), inputs["denom"])
    write_parquet(i.spine(), inputs["spine"])
    write_by_year(i.weights(), inputs["weights"])
    lists = {o: fx.FIXTURE_CODE_LISTS[o] for o in ANY_OUTCOMES}
    report = workflow_job(
        i.spark, inputs["adm"], lists, inputs["denom"], inputs["spine"], inputs["weights"], scratch_path(i.spark, "out"), "first_n", FIRST_N
    )
    rows = [
        (table, outcome, figure, str(value))
        for table, outcomes in report.items() for outcome, figures in outcomes.items() for figure, value in figures.items()
    ]
    return i.spark.createDataFrame(rows, "part string, outcome string, figure string, value string")


def q_stream_tag_first_n(i: Inputs) -> DataFrame:
    from dxcohort.streaming import start_tagging

    src = scratch_path(i.spark, "stream_src")
    write_by_year(i.admissions(), src)
    out, ckpt = scratch_path(i.spark, "stream_out"), scratch_path(i.spark, "stream_ckpt")
    query = start_tagging(i.spark, src, i.codes("mixed"), out, ckpt, "first_n", FIRST_N)
    query.awaitTermination()
    return read_table(i.spark, out).select("bene_id", "adm_id", "outcome", "outcome_criteria", "year")


def q_io_parquet_by_year(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "outcomes")
    write_by_year(i.tagged("all", None, "mixed"), path)
    return read_year(i.spark, path, PROFILE_YEAR).select(
        "bene_id", "adm_id", "outcome", "outcome_criteria", "year"
    )


def q_io_csv_strings(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "valid_csv")
    i.valid().write.mode("overwrite").option("header", "false").csv(path)
    return read_csv_strings(i.spark, path, header=False)


def q_io_code_list(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "code_list")
    write_code_list(code_list_table(expand_prefixes(i.valid(), i.prefixes())), path)
    return i.spark.read.schema("outcome string, icd9 array<string>, icd10 array<string>").json(path)


def q_io_cohort_export(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "cohort")
    write_parquet(cohort_subset(i.admissions(), i.tagged("first_n", FIRST_N, "mixed")), path)
    return read_table(i.spark, path)


def q_io_multi_year_glob(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "outcomes_all")
    write_by_year(i.tagged("all", None), path)
    return year_counts_long(read_glob(i.spark, f"{path}/year=*", base_path=path))


def q_io_csv_two_runs(i: Inputs) -> DataFrame:
    """CSV years written in two runs into one dataset."""
    path = scratch_path(i.spark, "csv_years")
    tagged = i.tagged("all", None)
    half = len(i.years) // 2
    for years in (i.years[:half], i.years[half:]):
        write_by_year(tagged.where(F.col("year").isin(years)), path, "csv")
    return read_csv_strings(i.spark, path)


def q_io_index_two_runs(i: Inputs) -> DataFrame:
    """Two outcomes indexed one by one into one dataset, per year and outcome."""
    out, path = scratch_path(i.spark, "outcomes"), scratch_path(i.spark, "indexed")
    write_by_year(i.tagged("all", None), out, keys=("year", "outcome"))
    adm = i.admissions()
    for name in ("mixed", "econ"):
        write_by_year(index_outcomes(read_table(i.spark, out), adm, name), path, keys=("year", "outcome"))
    return read_table(i.spark, path)


def q_io_spine_file(i: Inputs) -> DataFrame:
    """Area counts over a spine that is read from a file."""
    path = scratch_path(i.spark, "spine")
    write_parquet(i.spine(), path)
    return area_counts(_counted(i), i.denom(), read_table(i.spark, path), ANY_OUTCOMES)


def q_io_code_list_tag(i: Inputs) -> DataFrame:
    """Expand prefixes, write the list, load it, tag with it."""
    path = scratch_path(i.spark, "derived_list")
    expanded = expand_prefixes(i.valid(), i.prefixes())
    write_code_list(code_list_table(expanded, {k: f"Expanded {k}" for k in PREFIX_LISTS}), path)
    return tag_outcomes(i.admissions(), codes_frame(i.spark, load_code_lists(path, i.spark)), "all")


def q_io_csv_outcomes(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "cond_csv")
    write_csv(i.tagged("conditional", None, "cond"), path)
    return read_csv_strings(i.spark, path, header=True)


SPARK_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "tag_all": q_tag_all,
    "tag_first_n": q_tag_first_n,
    "tag_conditional": q_tag_conditional,
    "tag_conditional_only": q_tag_conditional_only,
    "tag_conditional_years": q_tag_conditional_years,
    "tag_multi_outcome": q_tag_multi_outcome,
    "outcomes_united": q_outcomes_united,
    "year_counts_united": q_year_counts_united,
    "tag_by_postings": q_tag_by_postings,
    "tag_by_postings_first_n": q_tag_by_postings_first_n,
    "codes_prefix_expand": q_codes_prefix_expand,
    "codes_prefix_ordered": q_codes_prefix_ordered,
    "codes_regex_expand": q_codes_regex_expand,
    "codes_range": q_codes_range,
    "codes_range_table": q_codes_range_table,
    "codes_observed": q_codes_observed,
    "codes_generate": q_codes_generate,
    "codes_sizes": q_codes_sizes,
    "outcome_index": q_outcome_index,
    "outcome_index_profile": q_outcome_index_profile,
    "outcome_index_heavy": q_outcome_index_heavy,
    "outcome_index_bloom": q_outcome_index_bloom,
    "outcome_index_extended": q_outcome_index_extended,
    "distinct_persons": q_distinct_persons,
    "outcomes_present": q_outcomes_present,
    "years_present": q_years_present,
    "year_counts_long": q_year_counts_long,
    "year_counts_wide": q_year_counts_wide,
    "area_counts": q_area_counts,
    "area_counts_profile": q_area_counts_profile,
    "area_counts_by_year": q_area_counts_by_year,
    "area_counts_dropped": q_area_counts_dropped,
    "area_counts_updated": q_area_counts_updated,
    "strat_counts": q_strat_counts,
    "strat_counts_updated": q_strat_counts_updated,
    "strat_domain_spine": q_strat_domain_spine,
    "age_bands": q_age_bands,
    "county_counts": q_county_counts,
    "county_counts_profile": q_county_counts_profile,
    "strat_counts_profile": q_strat_counts_profile,
    "cohort_subset": q_cohort_subset,
    "cohort_subset_bloom": q_cohort_subset_bloom,
    "outcome_denominator_bloom": q_outcome_denominator_bloom,
    "duplicate_audit": q_duplicate_audit,
    "duplicate_audit_reload": q_duplicate_audit_reload,
    "duplicate_audit_null_years": q_duplicate_audit_null_years,
    "outcome_denominator_join": q_outcome_denominator_join,
    "secondary_slice": q_secondary_slice,
    "workflow_tag_to_county": q_workflow_tag_to_county,
    "workflow_index": q_workflow_index,
    "workflow_report": q_workflow_report,
    "workflow_conditional_counts": q_workflow_conditional_counts,
    "stream_tag_first_n": q_stream_tag_first_n,
    "io_parquet_by_year": q_io_parquet_by_year,
    "io_csv_strings": q_io_csv_strings,
    "io_code_list": q_io_code_list,
    "io_cohort_export": q_io_cohort_export,
    "io_multi_year_glob": q_io_multi_year_glob,
    "io_csv_outcomes": q_io_csv_outcomes,
    "io_csv_two_runs": q_io_csv_two_runs,
    "io_index_two_runs": q_io_index_two_runs,
    "io_spine_file": q_io_spine_file,
    "io_code_list_tag": q_io_code_list_tag,
}


def spark_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = SPARK_QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return scoped_frame(spark, lambda: present(fn(Inputs(spark, sf_dir))))

    run.__name__ = f"query_{name}"
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: spark_query(name) for name in SPARK_QUERIES}
