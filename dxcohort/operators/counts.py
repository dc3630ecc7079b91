"""Outcome counts by year, by area, and by area x demographic stratum.

Counts are per tagged row (admission), not per person. Area and stratified
counts first collapse the tagged rows to one row per person-year and outcome
and write that (small) table: the aggregate has a map-side partial step, so a
person with very many tagged rows never becomes a hot join key, and outcome
names, broadcast keys and the join all read the written table, so the tagged
rows' own lineage runs once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dxcohort.functions.bloom import towards_keys
from dxcohort.functions.expressions import (
    AGE_BANDS,
    BROADCAST_BYTES,
    DUAL_DOMAIN,
    PAIR_KEY_BYTES,
    RACE_DOMAIN,
    SEX_DOMAIN,
    age_band,
    with_strata,
)
from dxcohort.schemas import need
from dxcohort.session import materialize
from dxcohort.sources.readers import bounded_values

STRATA = ["age_grp", "sex", "race", "dual"]

# Up to this many distinct tagged person-years (64 MB as a hash relation) are
# broadcast to filter the person-year table row-locally before the join.
MAX_BROADCAST_PERSON_YEARS = BROADCAST_BYTES // PAIR_KEY_BYTES


def _c(name: str) -> Column:
    """Column by exact name (outcome names may contain dots or blanks)."""
    return F.col(f"`{name}`")


def _outcome_list(outcomes: DataFrame, outcome_list: Sequence[str] | None) -> list[str]:
    if outcome_list is not None:
        return list(outcome_list)
    return bounded_values(outcomes, "outcome")


def year_counts_long(outcomes: DataFrame) -> DataFrame:
    """``COUNT(adm_id)`` by year and outcome (NULL ids are not counted)."""
    return outcomes.groupBy("year", "outcome").agg(F.count("adm_id").alias("n"))


def year_counts_wide(outcomes: DataFrame, outcome_list: Sequence[str] | None = None) -> DataFrame:
    """Years x outcomes; a year without an outcome's rows is NULL, not 0."""
    names = _outcome_list(outcomes, outcome_list)
    return year_counts_long(outcomes).groupBy("year").pivot("outcome", names).agg(F.first("n"))


def collapsed(outcomes: DataFrame, sign: str | None = None) -> DataFrame:
    """Tagged rows ``n`` of each (person, year, outcome), written once. ``sign``
    names a column of 1, or -1 for a row that is taken back."""
    n = F.count(F.lit(1)) if sign is None else F.sum(F.col(sign).cast("long"))
    return materialize(outcomes.groupBy("bene_id", "year", "outcome").agg(n.alias("n")), "person_year_outcomes")


def _wide(sums: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Sums ``n`` of each cell and outcome as one row for each cell. Rows stay
    narrow until here, where cells are few, however many outcomes there are."""
    return sums.groupBy(*keys).agg(*[F.coalesce(F.sum(F.when(F.col("outcome") == F.lit(o), F.col("n"))), F.lit(0)).alias(o) for o in names])


def _joined_sums(rows: DataFrame, people: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``collapsed`` rows joined to their person-years, and summed by ``keys``."""
    listed = rows.where(F.col("outcome").isin(list(names)))
    joined = listed.join(people, ["bene_id", "year"])
    return _wide(joined.groupBy(*keys, "outcome").agg(F.sum("n").alias("n")), keys, names)


def people_of(outcomes: DataFrame, people: DataFrame, max_keys: int = MAX_BROADCAST_PERSON_YEARS) -> DataFrame:
    """The person-year rows of tagged persons only.

    Up to ``max_keys`` distinct person-years are broadcast and semi-join
    ``people`` row-locally, so a rare outcome never shuffles the whole
    person-year table; more of them become a Bloom filter of fixed size, which
    lets a few other rows pass. Exact: the join that follows drops those.
    ``outcomes`` is read twice: pass a written table (see ``collapsed``).
    """
    keys = outcomes.select("bene_id", "year").distinct()
    return towards_keys(people, keys, ["bene_id", "year"], max_keys)[0]


def _of_years(df: DataFrame, years: Sequence[int] | None) -> DataFrame:
    """Rows of ``years``: prunes year partitions before anything else reads them."""
    return df if years is None else df.where(F.col("year").isin(list(years)))


def area_counts(
    outcomes: DataFrame,
    denom: DataFrame,
    spine: DataFrame,
    outcome_list: Sequence[str] | None = None,
    years: Sequence[int] | None = None,
    person_years: DataFrame | None = None,
) -> DataFrame:
    """Counts per ``(zcta, year)`` for every area-year of the spine.

    Tagged rows whose person-year is missing, or whose area is NULL or off
    the spine, drop out; spine areas without rows get 0. A spine row listed
    twice counts twice, as a join with the spine would. ``person_years`` may be
    the ``collapsed`` outcomes, if they are there already.
    """
    need(outcomes, ["bene_id", "year", "outcome"], "outcomes")
    need(denom, ["bene_id", "year", "zcta"], "denom")
    need(spine, ["zcta", "year"], "spine")
    rows = collapsed(_of_years(outcomes, years)) if person_years is None else _of_years(person_years, years)
    names = _outcome_list(rows, outcome_list)
    by_area = _by_area(rows, _of_years(denom, years), names)
    sp = _of_years(spine, years).groupBy("zcta", "year").agg(F.count(F.lit(1)).alias("_m"))
    joined = sp.join(by_area, ["zcta", "year"], "left")
    return joined.select(
        "zcta",
        "year",
        *[(F.coalesce(_c(o), F.lit(0)) * F.col("_m")).cast("long").alias(o) for o in names],
    )


def _by_area(rows: DataFrame, denom: DataFrame, names: Sequence[str]) -> DataFrame:
    """Sums of ``collapsed`` rows for the areas and years that have any."""
    people = people_of(rows, denom.select("bene_id", "year", "zcta"))
    return _joined_sums(rows, people, ["zcta", "year"], names)


def area_sums(
    outcomes: DataFrame, denom: DataFrame, spine: DataFrame, outcome_list: Sequence[str], sign: str | None = None
) -> DataFrame:
    """What ``outcomes`` alone add to the area counts: only areas of the spine
    that have any of them."""
    by_area = _by_area(collapsed(outcomes, sign), denom, outcome_list)
    sp = spine.groupBy("zcta", "year").agg(F.count(F.lit(1)).alias("_m"))
    both = by_area.join(sp, ["zcta", "year"])
    return both.select("zcta", "year", *[(_c(o) * F.col("_m")).cast("long").alias(o) for o in outcome_list])


def strat_sums(outcomes: DataFrame, denom: DataFrame, outcome_list: Sequence[str], sign: str | None = None) -> DataFrame:
    """What ``outcomes`` alone add to the stratified counts, by cell."""
    return _observed(collapsed(outcomes, sign), denom, outcome_list).where(_in_domain())


def area_drop_report(
    outcomes: DataFrame,
    denom: DataFrame,
    spine: DataFrame,
    years: Sequence[int] | None = None,
    person_years: DataFrame | None = None,
) -> DataFrame:
    """Tagged rows that area counts cannot place, per year and outcome: no
    person-year, no area in any of the person-year's rows, or no area of
    them on the spine. (A person-year listed with two areas is placed if one
    of them is on the spine.)

    Tagged rows are collapsed to person-years first, and rows without an
    area never enter a join, so neither a person nor the NULL area is hot.
    """
    rows = collapsed(_of_years(outcomes, years)) if person_years is None else _of_years(person_years, years)
    people = people_of(rows, _of_years(denom, years).select("bene_id", "year", "zcta"))
    keys = _of_years(spine, years).select("zcta", "year").distinct()
    on_spine = (
        people.where(F.col("zcta").isNotNull())
        .join(keys, ["zcta", "year"], "left_semi")
        .select("bene_id", "year", F.lit(True).alias("_on_spine"))
        .distinct()
    )
    known = people.groupBy("bene_id", "year").agg(F.max(F.col("zcta").isNotNull()).alias("_has_area"))
    placed = rows.join(known, ["bene_id", "year"], "left").join(on_spine, ["bene_id", "year"], "left")

    def total(cond: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).alias(name)

    return placed.groupBy("year", "outcome").agg(
        F.sum("n").alias("n_tagged"),
        total(F.col("_has_area").isNull(), "n_no_person"),
        total(~F.col("_has_area"), "n_null_area"),
        total(F.col("_has_area") & F.col("_on_spine").isNull(), "n_off_spine"),
    )


def stratify(denom: DataFrame) -> DataFrame:
    """Person-years with their stratum; age outside the bands gives NULL."""
    return denom.select("bene_id", "year", "zcta", age_band("age_dob").alias("age_grp"), "sex", "race", "dual")


def _in_domain() -> Column:
    return (
        F.col("zcta").isNotNull()
        & F.col("age_grp").isin([b[0] for b in AGE_BANDS])
        & F.col("sex").isin(SEX_DOMAIN)
        & F.col("race").isin(RACE_DOMAIN)
        & F.col("dual").isin(DUAL_DOMAIN)
    )


# Every sex / race / dual value is a single digit, so a stratum packs into
# one int: age-band position, then sex, race and dual as decimal digits.
assert max(SEX_DOMAIN + RACE_DOMAIN + DUAL_DOMAIN) < 10 and min(SEX_DOMAIN + RACE_DOMAIN + DUAL_DOMAIN) >= 0


def _stratum_key(age_grp: Column, sex: Column, race: Column, dual: Column) -> Column:
    """Integer key of a stratum: cheap to compute for each of the 210 spine
    rows and cheap to compare in the per-area map lookup."""
    age_pos = F.array_position(F.array(*[F.lit(b[0]) for b in AGE_BANDS]), age_grp)
    return (age_pos * 1000 + sex * 100 + race * 10 + dual).cast("int")


def strat_observed(outcomes: DataFrame, denom: DataFrame, outcome_list: Sequence[str]) -> DataFrame:
    """Counts of the strata that occur: ``zcta, year, age_grp, sex, race,
    dual`` + one column per outcome (before the spine is applied)."""
    return _observed(collapsed(outcomes), denom, outcome_list)


def _observed(rows: DataFrame, denom: DataFrame, names: Sequence[str]) -> DataFrame:
    return _joined_sums(rows, people_of(rows, stratify(denom)), ["year", "zcta", *STRATA], names)


def strat_counts(
    outcomes: DataFrame,
    denom: DataFrame,
    spine: DataFrame,
    outcome_list: Sequence[str] | None = None,
    years: Sequence[int] | None = None,
    person_years: DataFrame | None = None,
) -> DataFrame:
    """Counts for every (area, year, age group, sex, race, dual) cell.

    The spine is every distinct area of ``spine`` (any year) x ``years``
    (default: the person-year table's years) x 210 strata. Persons outside
    the domain (no area, age outside 65-115, race 7, ...) drop out.

    Plan: observed cells (few) are aggregated and then packed per area-year
    into a map of at most 210 entries; the spine is joined at area-year
    grain and expanded by ``explode`` *after* the join, so the full
    210-fold spine is generated row-locally and never shuffled.
    """
    need(outcomes, ["bene_id", "year", "outcome"], "outcomes")
    need(denom, ["bene_id", "year", "zcta", "age_dob", "sex", "race", "dual"], "denom")
    need(spine, ["zcta"], "spine")
    denom = _of_years(denom, years)
    rows = collapsed(_of_years(outcomes, years)) if person_years is None else _of_years(person_years, years)
    names = _outcome_list(rows, outcome_list)
    yrs = list(years) if years is not None else bounded_values(denom, "year", 1000)
    observed = _observed(rows, denom, names).where(_in_domain())
    key = _stratum_key(F.col("age_grp"), F.col("sex"), F.col("race"), F.col("dual"))
    cells = observed.groupBy("zcta", "year").agg(
        F.map_from_entries(
            F.collect_list(F.struct(key.alias("k"), F.struct(*[_c(o) for o in names]).alias("v")))
        ).alias("_cells")
    )
    areas = spine.select("zcta").distinct()
    area_years = areas.select("zcta", F.explode(F.array(*[F.lit(y).cast("int") for y in yrs])).alias("year"))
    with_cells = area_years.join(cells, ["zcta", "year"], "left")
    expanded = with_strata(with_cells)
    cell = F.col("_cells")[_stratum_key(F.col("age_grp"), F.col("sex"), F.col("race"), F.col("dual"))]
    return expanded.select(
        "zcta",
        "year",
        *STRATA,
        *[F.coalesce(cell.getField(o), F.lit(0)).cast("long").alias(o) for o in names],
    )


def strat_spine(spine: DataFrame, years: Sequence[int]) -> DataFrame:
    """The stratum spine alone: distinct areas x years x 210 strata."""
    areas = spine.select("zcta").distinct()
    return with_strata(
        areas.select("zcta", F.explode(F.array(*[F.lit(y).cast("int") for y in years])).alias("year"))
    )
