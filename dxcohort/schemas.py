"""Declared schemas of the inputs and outputs, and a light validator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

ADMISSIONS = T.StructType(
    [
        T.StructField("bene_id", T.LongType()),
        T.StructField("adm_id", T.LongType()),
        T.StructField("admission_date", T.DateType()),
        T.StructField("discharge_date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("adm_source", T.StringType()),
        T.StructField("diagnoses", T.ArrayType(T.StringType())),
    ]
)

DENOM = T.StructType(
    [
        T.StructField("bene_id", T.LongType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("zcta", T.StringType()),
        T.StructField("age_dob", T.IntegerType()),
        T.StructField("sex", T.IntegerType()),
        T.StructField("race", T.IntegerType()),
        T.StructField("dual", T.IntegerType()),
    ]
)

AREA_SPINE = T.StructType(
    [T.StructField("zcta", T.StringType()), T.StructField("year", T.IntegerType())]
)

AREA_WEIGHTS = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("zcta", T.StringType()),
        T.StructField("county", T.StringType()),
        T.StructField("pop_pct", T.DoubleType()),
    ]
)

CODES = T.StructType(
    [
        T.StructField("outcome", T.StringType(), False),
        T.StructField("role", T.StringType(), False),
        T.StructField("system", T.StringType(), False),
        T.StructField("code", T.StringType(), False),
    ]
)

VALID_CODES = T.StructType(
    [T.StructField("code", T.StringType()), T.StructField("system", T.StringType())]
)

OUTCOMES = T.StructType(
    [
        T.StructField("bene_id", T.LongType()),
        T.StructField("adm_id", T.LongType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("outcome_criteria", T.StringType()),
        T.StructField("year", T.IntegerType()),
    ]
)


def _family(t: T.DataType) -> str:
    """Types that stand in for each other: any integer, any real number."""
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "number"
    if isinstance(t, T.ArrayType):
        return f"array of {_family(t.elementType)}"
    return t.simpleString()


def require_columns(df: DataFrame, schema: T.StructType, what: str, only: list[str] | None = None) -> None:
    """Fail early, on the driver and without a job, if columns (all of
    ``schema`` or ``only`` some) are missing or of another type."""
    wanted = [f for f in schema.fields if only is None or f.name in only]
    missing = [f.name for f in wanted if f.name not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; has {df.columns}")
    for f in wanted:
        have, want = _family(df.schema[f.name].dataType), _family(f.dataType)
        if have != want and not (want == "number" and have == "integer"):
            raise ValueError(f"{what}: column {f.name} is {have}, not {want}")


def need(df: DataFrame, cols: list[str] | tuple[str, ...], what: str) -> None:
    """Fail on the driver, without a job, if ``df`` lacks any of ``cols``."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; has {df.columns}")
