"""Test inputs in the workflow's schemas, derived by Spark from the driver's
TPC-H-like tables (see FIXTURES.md), plus the same derivations as DuckDB CTE
text for the SQL oracle.

These are adapters for testing and benchmarking only: in production the
admissions, person-year, area spine and crosswalk tables are inputs.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dxcohort.functions.expressions import zero_pad
from dxcohort.sources.readers import bounded_values

# Code lists used by the tests and registered queries.
FIXTURE_CODE_LISTS = {
    "mixed": {
        "long_name": "Mixed-system list",
        "icd9": ["E11", "E12"],
        "icd10": ["L40", "M05"],
    },
    "cond": {
        "long_name": "Conditional list",
        "primary_icd10": [f"E{i:02d}" for i in range(1, 11)],
        "secondary_icd10": [f"P{i:02d}" for i in range(1, 21)],
    },
    "cond2": {
        "long_name": "Second conditional list",
        "primary_icd10": [f"M{i:02d}" for i in range(1, 16)],
        "secondary_icd10": [f"E{i:02d}" for i in range(1, 16)],
    },
    "single": {"long_name": "One code", "icd10": ["S07"]},
    "econ": {"long_name": "Economy family", "icd10": [f"E{i:02d}" for i in range(20, 31)]},
}

# Edge cases are added rows; no row of the given tables is left out. The
# spine has two more areas (no county; one without persons), and every
# customer has a stranger: a person of the negated id, who lives off the
# spine, in the first extra area, or in no person-year at all.
EXTRA_AREAS = ["99901", "99902"]
OFF_SPINE_AREA = "77701"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: ordered diagnosis codes from its line items."""
    part = _t(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.substring("p_type", 1, 1), zero_pad("p_size", 2)).alias("code"),
    )
    li = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    # Bounded by the line items of one order (up to 13 in the test data).
    dx = (
        li.join(part, li.l_partkey == part.p_partkey)
        .groupBy("l_orderkey")
        .agg(
            F.transform(
                F.array_sort(
                    F.collect_list(
                        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "code")
                    )
                ),
                lambda x: x["code"],
            ).alias("diagnoses")
        )
    )
    orders = _t(spark, sf_dir, "orders")
    adm_date = F.to_date("o_orderdate")
    return orders.join(dx, orders.o_orderkey == dx.l_orderkey, "left").select(
        F.col("o_custkey").alias("bene_id"),
        F.col("o_orderkey").alias("adm_id"),
        adm_date.alias("admission_date"),
        F.date_add(adm_date, (F.col("o_orderkey") % 40).cast("int")).alias("discharge_date"),
        F.year("o_orderdate").cast("int").alias("year"),
        F.col("o_orderpriority").alias("adm_source"),
        F.col("diagnoses"),
    )


def order_years(spark: SparkSession, sf_dir: str) -> list[int]:
    """Calendar years of the orders (a handful of values)."""
    years = _t(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("int").alias("year"))
    return bounded_values(years, "year", max_values=1000)


def _years_col(years: list[int]):
    return F.explode(F.array(*[F.lit(y).cast("int") for y in years])).alias("year")


def denom(spark: SparkSession, sf_dir: str, years: list[int] | None = None) -> DataFrame:
    """Person-years of all customers (some without area, ages 58-117) and of
    two in three strangers."""
    years = years if years is not None else order_years(spark, sf_dir)
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", _years_col(years))
    k = F.col("c_custkey")
    person = [
        (F.lit(58) + (k * 7 + F.col("year")) % 60).cast("int").alias("age_dob"),
        (k % 3).cast("int").alias("sex"),
        (k % 8).cast("int").alias("race"),
        ((k % 6) / 3 >= 1).cast("int").alias("dual"),
    ]
    strangers = c.where(k % 3 != 0).select(
        (-k).alias("bene_id"),
        F.col("year"),
        F.when(k % 3 == 1, F.lit(OFF_SPINE_AREA)).otherwise(F.lit(EXTRA_AREAS[0])).alias("zcta"),
        *person,
    )
    own = c.select(
        k.alias("bene_id"),
        F.col("year"),
        F.when(k % 50 != 0, zero_pad("c_nationkey", 5)).alias("zcta"),
        *person,
    )
    return own.unionByName(strangers)


def with_strangers(tagged: DataFrame) -> DataFrame:
    """Tagged rows and a copy of each for the person's stranger."""
    copies = tagged.withColumn("bene_id", -F.col("bene_id")).withColumn("adm_id", -F.col("adm_id"))
    return tagged.unionByName(copies)


def unique_zcta(spark: SparkSession, sf_dir: str, years: list[int] | None = None) -> DataFrame:
    """Area spine (zcta, year): all nations plus two areas."""
    years = years if years is not None else order_years(spark, sf_dir)
    nations = _t(spark, sf_dir, "nation").select(zero_pad("n_nationkey", 5).alias("zcta"))
    extra = spark.createDataFrame([(a,) for a in EXTRA_AREAS], "zcta string")
    return nations.unionByName(extra).select("zcta", _years_col(years))


def zcta2county(spark: SparkSession, sf_dir: str, years: list[int] | None = None) -> DataFrame:
    """Area -> county weights in percent; odd nations split 62.5 / 37.5. One
    county has no counted area, one area a NULL county."""
    years = years if years is not None else order_years(spark, sf_dir)
    n = _t(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    main = n.select(
        zero_pad(key, 5).alias("zcta"),
        F.concat(F.lit("C"), F.col("n_regionkey").cast("string")).alias("county"),
        F.when(key % 2 == 1, F.lit(62.5)).otherwise(F.lit(100.0)).cast("double").alias("pop_pct"),
    )
    split = n.where(key % 2 == 1).select(
        zero_pad(key, 5).alias("zcta"),
        F.concat(F.lit("C"), ((F.col("n_regionkey") + 1) % 5).cast("string")).alias("county"),
        F.lit(37.5).cast("double").alias("pop_pct"),
    )
    orphan = spark.createDataFrame([("88888", "C9", 100.0), (EXTRA_AREAS[1], None, 100.0)], "zcta string, county string, pop_pct double")
    x = main.unionByName(split).unionByName(orphan)
    return x.select(_years_col(years), "zcta", "county", "pop_pct")


def valid_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A valid-code table: type letter + zero-padded size; codes of two of
    the letters are valid in the older system as well."""
    codes = (
        _t(spark, sf_dir, "part")
        .select(F.concat(F.substring("p_type", 1, 1), zero_pad("p_size", 2)).alias("code"))
        .distinct()
    )
    older = codes.where(F.substring("code", 1, 1).isin("E", "M")).select("code", F.lit("icd9").alias("system"))
    return codes.select("code", F.lit("icd10").alias("system")).unionByName(older)


# ---------------------------------------------------------------------------
# The same fixtures as DuckDB CTEs (the oracle side of the correctness gate).

ORACLE_FIXTURES = """
li AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice,
         concat(substr(p.p_type, 1, 1), lpad(CAST(p.p_size AS VARCHAR), 2, '0')) AS code
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
dx AS (
  SELECT l_orderkey,
         list(code ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, code) AS diagnoses
  FROM li GROUP BY l_orderkey),
admissions AS (
  SELECT o.o_custkey AS bene_id, o.o_orderkey AS adm_id,
         CAST(o.o_orderdate AS DATE) AS admission_date,
         CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 40 AS INTEGER) AS discharge_date,
         CAST(year(o.o_orderdate) AS INTEGER) AS year,
         o.o_orderpriority AS adm_source, dx.diagnoses
  FROM orders o LEFT JOIN dx ON o.o_orderkey = dx.l_orderkey),
yrs AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
denom AS (
  SELECT c.c_custkey AS bene_id, y.year,
         CASE WHEN c.c_custkey % 50 <> 0 THEN lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') END AS zcta,
         CAST(58 + (c.c_custkey * 7 + y.year) % 60 AS INTEGER) AS age_dob,
         CAST(c.c_custkey % 3 AS INTEGER) AS sex,
         CAST(c.c_custkey % 8 AS INTEGER) AS race,
         CAST((c.c_custkey % 6) / 3 >= 1 AS INTEGER) AS dual
  FROM customer c CROSS JOIN yrs y
  UNION ALL
  SELECT -c.c_custkey, y.year, CASE WHEN c.c_custkey % 3 = 1 THEN '77701' ELSE '99901' END,
         CAST(58 + (c.c_custkey * 7 + y.year) % 60 AS INTEGER),
         CAST(c.c_custkey % 3 AS INTEGER), CAST(c.c_custkey % 8 AS INTEGER),
         CAST((c.c_custkey % 6) / 3 >= 1 AS INTEGER)
  FROM customer c CROSS JOIN yrs y WHERE c.c_custkey % 3 <> 0),
unique_zcta AS (
  SELECT z.zcta, y.year
  FROM (SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS zcta FROM nation
        UNION ALL SELECT '99901' UNION ALL SELECT '99902') z
  CROSS JOIN yrs y),
zcta2county AS (
  SELECT y.year, x.zcta, x.county, x.pop_pct FROM (
    SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS zcta,
           concat('C', CAST(n_regionkey AS VARCHAR)) AS county,
           CAST(CASE WHEN n_nationkey % 2 = 1 THEN 62.5 ELSE 100 END AS DOUBLE) AS pop_pct
    FROM nation
    UNION ALL
    SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0'),
           concat('C', CAST((n_regionkey + 1) % 5 AS VARCHAR)), CAST(37.5 AS DOUBLE)
    FROM nation WHERE n_nationkey % 2 = 1
    UNION ALL SELECT '88888', 'C9', CAST(100 AS DOUBLE)
    UNION ALL SELECT '99902', NULL, CAST(100 AS DOUBLE)) x
  CROSS JOIN yrs y),
part_codes AS (
  SELECT DISTINCT concat(substr(p_type, 1, 1), lpad(CAST(p_size AS VARCHAR), 2, '0')) AS code FROM part),
valid_codes AS (
  SELECT code, 'icd10' AS system FROM part_codes
  UNION ALL SELECT code, 'icd9' FROM part_codes WHERE substr(code, 1, 1) IN ('E', 'M'))
"""


def oracle_with(*ctes: str) -> str:
    """``WITH <fixtures>, <extra ctes>`` prefix for an oracle query."""
    extra = "".join(f",\n{c}" for c in ctes)
    return "WITH " + ORACLE_FIXTURES.strip() + extra + "\n"
