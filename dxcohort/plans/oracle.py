"""SQL oracles (DuckDB) for the registered queries.

Each oracle computes the same result as its Spark query from the same
derived inputs, but through a different formulation: list predicates
instead of explode + join, ``FILTER`` aggregates instead of per-person
pre-aggregation, a correlated count instead of a window for the event index,
a band table instead of CASE chains. Agreement between the two is the
correctness gate.
"""

from __future__ import annotations

from dxcohort.plans.catalog import (
    ANY_OUTCOMES,
    CODE_RANGES,
    FAMILIES,
    FIRST_N,
    OBSERVED_PATTERN,
    PREFIX_LISTS,
    PROFILE_YEAR,
    RANGE_TABLE,
    RELOADED_SOURCE,
)
from dxcohort.sources import fixtures as fx
from dxcohort.sources.fixtures import oracle_with

# Fixed values of the studied workflow, stated here once more: the SQL must not
# follow a wrong value in the code that it checks.
AGE_BANDS = [("[65,75]", 65, 75), ("[76,85]", 76, 85), ("[86,95]", 86, 95), ("[96,100]", 96, 100), ("[101,115]", 101, 115)]
SEX_DOMAIN = [0, 1, 2]
RACE_DOMAIN = [0, 1, 2, 3, 4, 5, 6]
DUAL_DOMAIN = [0, 1]
MAX_SECONDARY_POS = 25


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _any_codes(outcome: str) -> list[str]:
    spec = fx.FIXTURE_CODE_LISTS[outcome]
    return list(spec.get("icd9", [])) + list(spec.get("icd10", []))


def tagged_cte(first_n: int | None = None, outcomes: list[str] | None = None) -> str:
    """Tagged rows of the any-position lists (``first_n``: positions 1..n)."""
    label = "all" if first_n is None else f"first_{first_n}"
    arr = "diagnoses" if first_n is None else f"list_slice(diagnoses, 1, {first_n})"
    parts = [
        f"SELECT DISTINCT bene_id, adm_id, '{o}' AS outcome, '{label}' AS outcome_criteria, year\n"
        f"  FROM admissions WHERE list_has_any({arr}, {_sql_list(_any_codes(o))})"
        for o in (outcomes or ANY_OUTCOMES)
    ]
    return "tagged AS (\n  " + "\n  UNION ALL\n  ".join(parts) + ")"


def counted_cte() -> str:
    """``tagged``: the rows of customers and, negated, of their strangers."""
    own = tagged_cte().replace("tagged AS (", "own AS (", 1)
    return own + """,
tagged AS (
  SELECT * FROM own
  UNION ALL SELECT -bene_id, -adm_id, outcome, outcome_criteria, year FROM own)"""


def _conditional_rows(name: str = "cond") -> str:
    spec = fx.FIXTURE_CODE_LISTS[name]
    return f"""SELECT DISTINCT bene_id, adm_id, diagnoses, diagnoses[1] AS primary_dx,
         list_slice(diagnoses, 2, {MAX_SECONDARY_POS}) AS secondary_dx,
         '{name}' AS outcome, 'conditional' AS outcome_criteria, year
  FROM admissions
  WHERE list_contains({_sql_list(spec['primary_icd10'])}, diagnoses[1])
    AND list_has_any(list_slice(diagnoses, 2, {MAX_SECONDARY_POS}), {_sql_list(spec['secondary_icd10'])})"""


def _conditional_sql(with_label: bool) -> str:
    label = ", outcome_criteria, year" if with_label else ""
    return oracle_with(f"cond_rows AS (\n  {_conditional_rows()})") + (
        "SELECT bene_id, adm_id, array_to_string(diagnoses, ',') AS diagnoses, primary_dx,\n"
        f"       array_to_string(secondary_dx, ',') AS secondary_dx, outcome{label}\n"
        "FROM cond_rows"
    )


def _conditional_years() -> str:
    rows = "\n  UNION ALL ".join(_conditional_rows(name) for name in ("cond", "cond2"))
    return oracle_with(f"cond_rows AS (\n  {rows})") + (
        "SELECT bene_id, adm_id, array_to_string(diagnoses, ',') AS diagnoses, primary_dx,\n"
        "       array_to_string(secondary_dx, ',') AS secondary_dx, outcome, year FROM cond_rows"
    )


def _prefix_table() -> str:
    rows = [
        f"('{outcome}', '{system}', '{p}')"
        for outcome, spec in PREFIX_LISTS.items()
        for system in ("icd9", "icd10")
        for p in spec.get(system, [])
    ]
    return f"pre AS (SELECT * FROM (VALUES {', '.join(rows)}) t(outcome, system, prefix))"


_PREFIX_MATCH = """SELECT DISTINCT p.outcome, v.system, v.code
FROM valid_codes v JOIN pre p ON v.system = p.system AND starts_with(v.code, p.prefix)"""


def _regex_sql() -> str:
    pats = (
        "pats AS (SELECT outcome, system, '^(?:' || string_agg(prefix, '|') || ')' AS pattern "
        "FROM pre GROUP BY outcome, system)"
    )
    return oracle_with(_prefix_table(), pats) + """SELECT DISTINCT p.outcome, v.system, v.code
FROM valid_codes v JOIN pats p ON v.system = p.system AND regexp_matches(v.code, p.pattern)"""


def _families_sql() -> str:
    parts = []
    for outcome, system, letter, start, stop, width in FAMILIES:
        num = f"lpad(CAST(i AS VARCHAR), {width}, '0')" if width > 0 else "CAST(i AS VARCHAR)"
        parts.append(
            f"SELECT '{outcome}' AS outcome, '{system}' AS system, '{letter}' || {num} AS prefix "
            f"FROM range({start}, {stop}) t(i)"
        )
    return oracle_with("pre AS (" + " UNION ALL ".join(parts) + ")") + _PREFIX_MATCH


def _filter_counts(alias: str = "t", names: list[str] | None = None) -> str:
    return ", ".join(
        f"COUNT(*) FILTER (WHERE {alias}.outcome = '{o}') AS {o}" for o in (names or ANY_OUTCOMES)
    )


def area_ctes(tag: str, names: list[str] | None = None) -> list[str]:
    """``area``: spine area-years x outcome counts (spine multiplicity kept)."""
    names = names or ANY_OUTCOMES
    zero = ", ".join(f"SUM(COALESCE(p.{o}, 0))::BIGINT AS {o}" for o in names)
    return [
        tag,
        f"""per_area AS (
  SELECT d.zcta, t.year, {_filter_counts("t", names)}
  FROM tagged t JOIN denom d ON d.bene_id = t.bene_id AND d.year = t.year
  GROUP BY d.zcta, t.year)""",
        f"""area AS (
  SELECT s.zcta, s.year, {zero}
  FROM unique_zcta s LEFT JOIN per_area p ON p.zcta = s.zcta AND p.year = s.year
  WHERE s.year IN (SELECT year FROM yrs)
  GROUP BY s.zcta, s.year)""",
    ]


def _bands_cte() -> str:
    rows = ", ".join(f"('{g}', {lo}, {hi})" for g, lo, hi in AGE_BANDS)
    return f"bands AS (SELECT * FROM (VALUES {rows}) b(age_grp, lo, hi))"


def _banded_cte() -> str:
    return """banded AS (
  SELECT d.bene_id, d.year, d.zcta, b.age_grp, d.sex, d.race, d.dual
  FROM denom d LEFT JOIN bands b ON d.age_dob BETWEEN b.lo AND b.hi)"""


def _grid_cte() -> str:
    def dom(name: str, values) -> str:
        return f"(SELECT CAST(unnest({list(values)}) AS INTEGER) AS {name})"

    return f"""grid AS (
  SELECT a.zcta, y.year, b.age_grp, s.sex, r.race, u.dual
  FROM (SELECT DISTINCT zcta FROM unique_zcta) a,
       (SELECT DISTINCT year FROM denom) y,
       (SELECT age_grp FROM bands) b,
       {dom('sex', SEX_DOMAIN)} s, {dom('race', RACE_DOMAIN)} r, {dom('dual', DUAL_DOMAIN)} u)"""


def _strat_sql() -> str:
    cells = f"""cells AS (
  SELECT b.zcta, b.year, b.age_grp, b.sex, b.race, b.dual, {_filter_counts()}
  FROM tagged t JOIN banded b ON b.bene_id = t.bene_id AND b.year = t.year
  GROUP BY ALL)"""
    vals = ", ".join(f"COALESCE(c.{o}, 0)::BIGINT AS {o}" for o in ANY_OUTCOMES)
    return oracle_with(counted_cte(), _bands_cte(), _banded_cte(), _grid_cte(), cells) + f"""SELECT g.*, {vals}
FROM grid g LEFT JOIN cells c
  ON c.zcta = g.zcta AND c.year = g.year AND c.age_grp = g.age_grp
 AND c.sex = g.sex AND c.race = g.race AND c.dual = g.dual"""


def _county_sql(tag: str) -> str:
    vals = ", ".join(
        f"CAST(COALESCE(SUM(a.{o} * (w.pop_pct / 100)), 0) AS INTEGER) AS {o}" for o in ANY_OUTCOMES
    )
    return oracle_with(*area_ctes(tag)) + f"""SELECT w.year, w.county, {vals}
FROM zcta2county w LEFT JOIN area a ON a.zcta = w.zcta AND a.year = w.year
WHERE w.county IS NOT NULL
GROUP BY w.year, w.county"""


def index_ctes(tag: str) -> list[str]:
    """``idx``: each tagged row numbered by counting the person's earlier
    events of the same outcome (date, then admission id)."""
    return [
        tag,
        """dated AS (
  SELECT t.bene_id, t.adm_id, t.outcome, t.outcome_criteria, t.year, a.admission_date, a.discharge_date
  FROM tagged t JOIN admissions a ON a.adm_id = t.adm_id)""",
        """idx AS (
  SELECT e.*, CAST(year(e.discharge_date) AS INTEGER) AS discharge_year,
         CAST(1 + (SELECT COUNT(*) FROM dated p
                   WHERE p.outcome = e.outcome AND p.bene_id = e.bene_id
                     AND (p.admission_date < e.admission_date
                          OR (p.admission_date = e.admission_date AND p.adm_id < e.adm_id))) AS INTEGER)
           AS outcome_index
  FROM dated e)""",
    ]


_INDEX_SELECT = """SELECT bene_id, adm_id, outcome, outcome_criteria, year, discharge_year,
       CAST(admission_date AS VARCHAR) AS admission_date,
       CAST(discharge_date AS VARCHAR) AS discharge_date, outcome_index
FROM idx"""

_ADMISSION_COLS = """a.bene_id, a.adm_id, CAST(a.admission_date AS VARCHAR) AS admission_date,
       CAST(a.discharge_date AS VARCHAR) AS discharge_date, a.year, a.adm_source,
       array_to_string(a.diagnoses, ',') AS diagnoses"""

_COHORT = f"""SELECT {_ADMISSION_COLS}
FROM admissions a WHERE a.bene_id IN (SELECT bene_id FROM tagged)"""


def _audit_sql(source: str) -> str:
    groups = """dup_groups AS (
  SELECT year FROM adm_data
  GROUP BY adm_id, bene_id, admission_date, diagnoses, discharge_date, year, adm_source
  HAVING COUNT(*) > 1)"""
    return oracle_with(f"adm_data AS ({source})", groups) + """SELECT y.year, COUNT(g.year)::BIGINT AS duplicate_count
FROM (SELECT DISTINCT year FROM adm_data) y LEFT JOIN dup_groups g ON g.year = y.year
GROUP BY y.year"""


def _audit_null_years() -> str:
    source = (
        "SELECT * REPLACE (CASE WHEN adm_id % 3 <> 0 THEN year END AS year) FROM (SELECT * FROM admissions UNION ALL "
        f"SELECT * FROM admissions WHERE adm_source = '{RELOADED_SOURCE}')"
    )
    groups = """dup_groups AS (
  SELECT year, 1 AS one FROM adm_data
  GROUP BY adm_id, bene_id, admission_date, diagnoses, discharge_date, year, adm_source
  HAVING COUNT(*) > 1)"""
    return oracle_with(f"adm_data AS ({source})", groups) + """SELECT COALESCE(CAST(y.year AS VARCHAR), 'none') AS year, COUNT(g.one)::BIGINT AS duplicate_count
FROM (SELECT DISTINCT year FROM adm_data) y LEFT JOIN dup_groups g ON g.year IS NOT DISTINCT FROM y.year
GROUP BY y.year"""


def _index_heavy() -> str:
    lost = tagged_cte(None, ["mixed"]).replace("tagged AS (", "own AS (", 1) + """,
dated AS (
  SELECT CASE WHEN t.bene_id % 4 <> 0 THEN t.bene_id END AS bene_id, t.adm_id, t.outcome, t.outcome_criteria,
         t.year, a.admission_date, a.discharge_date
  FROM own t JOIN admissions a ON a.adm_id = t.adm_id)"""
    return oracle_with(lost) + """SELECT CAST(bene_id AS VARCHAR) AS bene_id, adm_id, outcome, outcome_criteria, year,
       CAST(year(discharge_date) AS INTEGER) AS discharge_year, CAST(admission_date AS VARCHAR) AS admission_date,
       CAST(discharge_date AS VARCHAR) AS discharge_date,
       CAST(row_number() OVER (PARTITION BY outcome, bene_id ORDER BY admission_date, adm_id) AS INTEGER) AS outcome_index
FROM dated"""


def _year_counts_wide() -> str:
    cols = ", ".join(
        f"CASE WHEN COUNT(*) FILTER (WHERE outcome = '{o}') > 0 "
        f"THEN COUNT(adm_id) FILTER (WHERE outcome = '{o}') END AS {o}"
        for o in ANY_OUTCOMES
    )
    return oracle_with(tagged_cte()) + f"SELECT year, {cols} FROM tagged GROUP BY year"


def _csv_outcomes() -> str:
    return oracle_with(f"cond_rows AS (\n  {_conditional_rows()})") + """SELECT CAST(bene_id AS VARCHAR) AS bene_id, CAST(adm_id AS VARCHAR) AS adm_id,
       CAST(to_json(diagnoses) AS VARCHAR) AS diagnoses, primary_dx,
       CAST(to_json(secondary_dx) AS VARCHAR) AS secondary_dx,
       outcome, outcome_criteria, CAST(year AS VARCHAR) AS year
FROM cond_rows"""


def _united(select: str) -> str:
    parts = {"one": tagged_cte(None, ["mixed"]), "two": tagged_cte(FIRST_N, ["econ"])}
    ctes = [sql.replace("tagged AS (", f"{name} AS (", 1) for name, sql in parts.items()] + [f"cond_rows AS (\n  {_conditional_rows()})"]
    none = "CAST(NULL AS VARCHAR)"
    plain = " UNION ALL ".join(
        f"SELECT bene_id, adm_id, outcome, outcome_criteria, year, {none} AS diagnoses, {none} AS primary_dx, {none} AS secondary_dx FROM {t}" for t in parts
    )
    united = f"""united AS ({plain} UNION ALL
  SELECT bene_id, adm_id, outcome, outcome_criteria, year, array_to_string(diagnoses, ','), primary_dx, array_to_string(secondary_dx, ',')
  FROM cond_rows)"""
    return oracle_with(*ctes, united) + select


def _report_sql() -> str:
    """The profiles of the workflow's outputs, computed from the outputs' SQL."""
    tag = tagged_cte(FIRST_N)
    idx = oracle_with(*index_ctes(tag)) + "SELECT * FROM idx"
    area = oracle_with(*area_ctes(tag)) + "SELECT * FROM area"
    strat = _strat_sql().replace(counted_cte(), tag)
    tables = f"t AS ({oracle_with(tag)}SELECT * FROM tagged), i AS ({idx}), a AS ({area}), s AS ({strat}), c AS ({_county_sql(tag)})"

    def row(part: str, outcome: str, figure: str, value: str, source: str) -> str:
        return f"SELECT '{part}' AS part, '{outcome}' AS outcome, '{figure}' AS figure, CAST({value} AS VARCHAR) AS value FROM {source}"

    parts = [row("outcomes", "", "n_rows", "COUNT(*)", "t"), row("indexed", "", "n_rows", "COUNT(*)", "i")]
    counted = {"area_counts": ("a", "zcta"), "strat_counts": ("s", "zcta"), "county_counts": ("c", "county")}
    for part, (source, area_col) in counted.items():
        parts += [row(part, "", "n_rows", "COUNT(*)", source), row(part, "", f"n_{area_col}", f"COUNT(DISTINCT {area_col})", source)]
        parts += [row(part, o, "total", f"CAST(SUM({o}) AS BIGINT)", source) for o in ANY_OUTCOMES]
    for o in ANY_OUTCOMES:
        mine = f"(SELECT * FROM i WHERE outcome = '{o}') HAVING COUNT(*) > 0"
        parts += [
            row("outcomes", o, "n_rows", "COUNT(*)", f"t WHERE outcome = '{o}'"),
            row("indexed", o, "n_bene", "COUNT(DISTINCT bene_id)", mine),
            row("indexed", o, "min_date", "MIN(admission_date)", mine),
            row("indexed", o, "max_date", "MAX(admission_date)", mine),
            row("indexed", o, "n_rows", "COUNT(*)", mine),
            row("dropped", o, "dropped", f"(SELECT COUNT(*) FROM t WHERE outcome = '{o}') - CAST(SUM({o}) AS BIGINT)", "a"),
        ]
    return f"WITH {tables}\n" + "\nUNION ALL ".join(parts)


def oracle_queries() -> dict[str, str]:
    mixed_all = tagged_cte(None, ["mixed"])
    mixed_f2 = tagged_cte(FIRST_N, ["mixed"])
    multi_all = tagged_cte()
    multi_f2 = tagged_cte(FIRST_N)
    counted = counted_cte()
    totals = ", ".join(f"SUM({o})::BIGINT AS {o}" for o in ANY_OUTCOMES)
    ranges = " OR ".join(f"substr(code, 1, {n}) BETWEEN '{lo}' AND '{hi}'" for n, lo, hi in CODE_RANGES)
    long_counts = "SELECT year, outcome, COUNT(adm_id) AS n FROM tagged GROUP BY year, outcome"
    return {
        "tag_all": oracle_with(mixed_all) + "SELECT * FROM tagged",
        "tag_first_n": oracle_with(mixed_f2) + "SELECT * FROM tagged",
        "tag_conditional": _conditional_sql(True),
        "tag_conditional_only": _conditional_sql(False),
        "tag_conditional_years": _conditional_years(),
        "tag_multi_outcome": oracle_with(multi_all) + "SELECT * FROM tagged",
        "outcomes_united": _united("SELECT * FROM united"),
        "year_counts_united": _united("SELECT year, outcome, COUNT(adm_id) AS n FROM united GROUP BY year, outcome"),
        "tag_by_postings": oracle_with(multi_all) + "SELECT * FROM tagged",
        "tag_by_postings_first_n": oracle_with(mixed_f2) + "SELECT * FROM tagged",
        "codes_prefix_expand": oracle_with(_prefix_table()) + _PREFIX_MATCH,
        "codes_prefix_ordered": oracle_with(_prefix_table(), f"ex AS ({_PREFIX_MATCH})")
        + "SELECT *, row_number() OVER (ORDER BY outcome, system, code) - 1 AS place FROM ex",
        "codes_regex_expand": _regex_sql(),
        "codes_range": oracle_with() + f"SELECT code, system FROM valid_codes WHERE {ranges}",
        "codes_range_table": oracle_with(
            "r AS (SELECT * FROM (VALUES " + ", ".join(f"('{o}', {n}, '{lo}', '{hi}')" for o, n, lo, hi in RANGE_TABLE) + ") t(outcome, n, lo, hi))"
        )
        + "SELECT DISTINCT r.outcome, v.code, v.system FROM valid_codes v JOIN r ON substr(v.code, 1, r.n) BETWEEN r.lo AND r.hi",
        "codes_observed": oracle_with()
        + "SELECT DISTINCT c AS code FROM (SELECT unnest(diagnoses) AS c FROM admissions) "
        + f"WHERE c LIKE '{OBSERVED_PATTERN}'",
        "codes_generate": _families_sql(),
        "codes_sizes": oracle_with(_prefix_table(), f"ex AS ({_PREFIX_MATCH})")
        + "SELECT outcome, system, COUNT(DISTINCT code) AS n_codes FROM ex GROUP BY outcome, system",
        "outcome_index": oracle_with(*index_ctes(mixed_f2)) + _INDEX_SELECT,
        "outcome_index_bloom": oracle_with(*index_ctes(mixed_f2)) + _INDEX_SELECT,
        "outcome_index_profile": oracle_with(*index_ctes(mixed_f2))
        + """SELECT outcome, COUNT(DISTINCT bene_id) AS n_bene,
       CAST(MIN(admission_date) AS VARCHAR) AS min_date,
       CAST(MAX(admission_date) AS VARCHAR) AS max_date, COUNT(*) AS n_rows
FROM idx GROUP BY outcome""",
        "outcome_index_heavy": _index_heavy(),
        "outcome_index_extended": oracle_with(*index_ctes(mixed_f2)) + _INDEX_SELECT,
        "distinct_persons": oracle_with(counted)
        + """SELECT 'all' AS period, outcome, COUNT(DISTINCT bene_id) AS n_persons FROM tagged GROUP BY outcome
UNION ALL SELECT 'first half', outcome, COUNT(DISTINCT bene_id) FROM tagged
WHERE year IN (SELECT year FROM yrs ORDER BY year LIMIT (SELECT COUNT(*) // 2 FROM yrs)) GROUP BY outcome
UNION ALL SELECT CAST(year AS VARCHAR), outcome, COUNT(DISTINCT bene_id) FROM tagged GROUP BY year, outcome
UNION ALL SELECT 'all', 'any', COUNT(DISTINCT bene_id) FROM tagged""",
        "outcomes_present": oracle_with(multi_all)
        + f"SELECT DISTINCT outcome FROM tagged WHERE year = {PROFILE_YEAR}",
        "years_present": oracle_with(multi_all) + "SELECT DISTINCT year FROM tagged",
        "year_counts_long": oracle_with(multi_all) + long_counts,
        "year_counts_wide": _year_counts_wide(),
        "area_counts": oracle_with(*area_ctes(counted)) + "SELECT * FROM area",
        "io_spine_file": oracle_with(*area_ctes(counted)) + "SELECT * FROM area",
        "area_counts_profile": oracle_with(*area_ctes(counted))
        + f"SELECT COUNT(*) AS n_rows, COUNT(DISTINCT zcta) AS n_zcta, {totals} FROM area",
        "area_counts_by_year": oracle_with(*area_ctes(counted))
        + f"SELECT year, {totals} FROM area GROUP BY year",
        "area_counts_dropped": oracle_with(counted)
        + """SELECT t.year, t.outcome, COUNT(*) AS n_tagged,
       COUNT(*) FILTER (WHERE d.bene_id IS NULL) AS n_no_person,
       COUNT(*) FILTER (WHERE d.bene_id IS NOT NULL AND d.zcta IS NULL) AS n_null_area,
       COUNT(*) FILTER (WHERE d.zcta IS NOT NULL AND s.zcta IS NULL) AS n_off_spine
FROM tagged t
LEFT JOIN denom d ON t.bene_id = d.bene_id AND t.year = d.year
LEFT JOIN (SELECT DISTINCT zcta, year FROM unique_zcta) s ON d.zcta = s.zcta AND t.year = s.year
GROUP BY t.year, t.outcome""",
        "area_counts_updated": oracle_with(*area_ctes(counted)) + "SELECT * FROM area",
        "strat_counts_updated": _strat_sql(),
        "strat_counts": _strat_sql(),
        "strat_domain_spine": oracle_with(_bands_cte(), _grid_cte()) + "SELECT * FROM grid",
        "age_bands": oracle_with(_bands_cte(), _banded_cte()) + "SELECT * FROM banded",
        "county_counts": _county_sql(counted),
        "county_counts_profile": f"SELECT COUNT(*) AS n_rows, COUNT(DISTINCT county) AS n_county, {totals} FROM ({_county_sql(counted)})",
        "strat_counts_profile": f"SELECT COUNT(*) AS n_rows, COUNT(DISTINCT zcta) AS n_zcta, {totals} FROM ({_strat_sql()})",
        "cohort_subset": oracle_with(mixed_f2) + _COHORT,
        "cohort_subset_bloom": oracle_with(mixed_f2) + _COHORT,
        "outcome_denominator_bloom": oracle_with(mixed_f2)
        + """SELECT t.bene_id, t.adm_id, t.year, d.zcta, t.outcome
FROM tagged t JOIN denom d ON d.bene_id = t.bene_id AND d.year = t.year""",
        "duplicate_audit": _audit_sql("SELECT * FROM admissions"),
        "duplicate_audit_reload": _audit_sql(
            "SELECT * FROM admissions UNION ALL "
            f"SELECT * FROM admissions WHERE adm_source = '{RELOADED_SOURCE}'"
        ),
        "duplicate_audit_null_years": _audit_null_years(),
        "outcome_denominator_join": oracle_with(mixed_f2)
        + """SELECT t.bene_id, t.adm_id, t.year, d.zcta, t.outcome
FROM tagged t JOIN denom d ON d.bene_id = t.bene_id AND d.year = t.year""",
        "secondary_slice": oracle_with()
        + """SELECT adm_id, diagnoses[1] AS primary_dx, diagnoses[2] AS second_dx, diagnoses[26] AS dx26,
       array_to_string(list_slice(diagnoses, 2, 25), ',') AS secondary_dx,
       CAST(len(diagnoses) AS VARCHAR) AS n_dx
FROM admissions""",
        "workflow_tag_to_county": _county_sql(multi_f2),
        "workflow_report": _report_sql(),
        "workflow_index": oracle_with(*index_ctes(multi_f2)) + _INDEX_SELECT,
        "workflow_conditional_counts": oracle_with(
            *area_ctes(f"tagged AS (\n  {_conditional_rows()})", ["cond"])
        )
        + "SELECT * FROM area",
        "stream_tag_first_n": oracle_with(mixed_f2) + "SELECT * FROM tagged",
        "io_parquet_by_year": oracle_with(mixed_all) + f"SELECT * FROM tagged WHERE year = {PROFILE_YEAR}",
        "io_csv_strings": oracle_with() + "SELECT code AS column0, system AS column1 FROM valid_codes",
        "io_code_list": oracle_with(_prefix_table(), f"ex AS ({_PREFIX_MATCH})")
        + """SELECT outcome,
       COALESCE(array_to_string(list(code ORDER BY code) FILTER (WHERE system = 'icd9'), ','), '') AS icd9,
       COALESCE(array_to_string(list(code ORDER BY code) FILTER (WHERE system = 'icd10'), ','), '') AS icd10
FROM ex GROUP BY outcome""",
        "io_cohort_export": oracle_with(mixed_f2) + _COHORT,
        "io_multi_year_glob": oracle_with(multi_all) + long_counts,
        "io_csv_outcomes": _csv_outcomes(),
        "io_csv_two_runs": oracle_with(multi_all)
        + "SELECT CAST(bene_id AS VARCHAR) AS bene_id, CAST(adm_id AS VARCHAR) AS adm_id, outcome, "
        + "outcome_criteria, CAST(year AS VARCHAR) AS year FROM tagged",
        "io_index_two_runs": oracle_with(*index_ctes(tagged_cte(None, ["mixed", "econ"]))) + _INDEX_SELECT,
        "io_code_list_tag": oracle_with(_prefix_table(), f"ex AS ({_PREFIX_MATCH})")
        + """SELECT DISTINCT x.bene_id, x.adm_id, ex.outcome, 'all' AS outcome_criteria, x.year
FROM (SELECT bene_id, adm_id, year, unnest(diagnoses) AS code FROM admissions) x JOIN ex ON ex.code = x.code""",
    }
