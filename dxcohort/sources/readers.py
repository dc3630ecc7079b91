"""Sources: yearly Parquet datasets, CSV code tables, discovery helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """A Parquet dataset: a single file, a glob (``prefix_*.parquet``), or a
    ``year=``-partitioned root. With ``schema`` the footer inference is
    skipped and the declared types are enforced. An ``outcome=`` folder is
    read as text, also where all names look like numbers."""
    paths = path if isinstance(path, list) else [path]
    if schema is not None:
        return spark.read.schema(schema).parquet(*paths)
    df = spark.read.parquet(*paths)
    if "outcome" in df.columns and not isinstance(df.schema["outcome"].dataType, T.StringType):
        fields = [T.StructField(f.name, T.StringType()) if f.name == "outcome" else f for f in df.schema.fields]
        df = spark.read.schema(T.StructType(fields)).parquet(*paths)
    return df


def read_glob(spark: SparkSession, pattern: str, base_path: str | None = None) -> DataFrame:
    """Files matching a glob (``prefix_*.parquet``, ``root/year=20*``). With
    ``base_path`` the ``key=value`` folders under it stay columns."""
    reader = spark.read if base_path is None else spark.read.option("basePath", base_path)
    return reader.parquet(pattern)


def read_year(spark: SparkSession, path: str, year: int, schema: T.StructType | None = None) -> DataFrame:
    """One year of a dataset. On a ``year=``-partitioned root the filter
    prunes partitions; on flat files it is pushed to the Parquet reader."""
    return read_table(spark, path, schema).where(F.col("year") == F.lit(year))


def read_csv_strings(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """CSV with every column as string (no inference pass over the data),
    those of ``key=value`` folders included. Without a header, columns are named ``column0, column1, ...``."""
    df = spark.read.option("header", str(header).lower()).option("inferSchema", "false").csv(path)
    if not header:
        df = df.toDF(*[f"column{i}" for i in range(len(df.columns))])
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def value_columns(df: DataFrame, keys: list[str] | set[str]) -> list[str]:
    """All columns except ``keys`` (schema only, no job)."""
    keys = set(keys)
    return [c for c in df.columns if c not in keys]


def outcomes_present(outcomes: DataFrame, year: int | None = None) -> DataFrame:
    """Distinct outcome names (of one year, if given)."""
    if year is not None:
        outcomes = outcomes.where(F.col("year") == F.lit(year))
    return outcomes.select("outcome").distinct()


def years_present(df: DataFrame) -> DataFrame:
    """Distinct years, ordered."""
    return df.select("year").distinct().orderBy("year")


def bounded_values(df: DataFrame, column: str, max_values: int = 10_000) -> list:
    """Collect the sorted distinct values of a low-cardinality column (years,
    outcome names) to fix pivot columns. More than ``max_values`` of them fail
    the job that needs them (name the outcomes or years then) instead of pulling a
    set without a bound to the driver."""
    rows = df.select(column).distinct().where(F.col(column).isNotNull()).limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise ValueError(f"{column} has more than {max_values} distinct values")
    return sorted(r[0] for r in rows)


def read_valid_codes(
    spark: SparkSession, path: str, system: str, header: bool = True, column: str | None = None
) -> DataFrame:
    """A valid-code CSV as ``(code, system)``, all strings.

    With a header the code column defaults to ``CODE``; without one it is
    the first column (``column0``).
    """
    df = read_csv_strings(spark, path, header)
    col = column or ("CODE" if header else "column0")
    return df.select(F.col(col).alias("code"), F.lit(system).alias("system")).where(F.col("code").isNotNull())
