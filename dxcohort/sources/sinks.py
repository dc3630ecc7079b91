"""Sinks: yearly partitioned Parquet, CSV, code lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_by_year(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    rebalance: bool = True,
    sort_within: list[str] | None = None,
    keys: tuple[str, ...] = ("year",),
    metrics: Sequence[Column] = (),
) -> Observation | None:
    """Write one partition per year (or per ``keys``) in one job.

    With ``partitionOverwriteMode=dynamic`` (set here for the write) a re-run
    of some years replaces only those years' partitions; with ``keys`` of
    (year, outcome), one outcome written alone leaves the others. The
    ``rebalance`` hint lets adaptive execution group each partition's rows
    into few, evenly sized tasks (splitting a large one) so the output is a
    few files per partition rather than one small file per task.
    ``sort_within`` orders the rows inside each written file (no global
    sort). CSV files get a header, and arrays as JSON text.

    ``metrics``, named aggregates over the written rows, are taken by the tasks
    that write (not before the shuffle, where a repeated stage would count
    twice) and returned as an ``Observation`` that is filled already.
    """
    if fmt == "csv":
        df = flatten_for_csv(df)
    if rebalance:
        df = df.hint("rebalance", *keys)
    if sort_within:
        df = df.sortWithinPartitions(*keys, *sort_within)
    seen = Observation() if metrics else None
    if seen is not None:
        df = df.observe(seen, *metrics)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(path)
    return seen


def flatten_for_csv(df: DataFrame) -> DataFrame:
    """CSV holds no arrays: encode array columns as JSON text."""
    cols = [
        F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def write_csv(df: DataFrame, path: str) -> None:
    flatten_for_csv(df).write.mode("overwrite").option("header", "true").csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_code_list(code_list: DataFrame, path: str) -> None:
    """Save a derived code list (``outcome, icd9[], icd10[]`` and, if there,
    ``long_name``) as JSON lines, which ``load_code_lists`` reads."""
    code_list.coalesce(1).write.mode("overwrite").json(path)


def write_bucketed(
    df: DataFrame,
    table: str,
    key: str = "bene_id",
    buckets: int = 4096,
    path: str | None = None,
    by_year: bool = True,
) -> None:
    """Save ``df`` as a catalog table bucketed (and sorted) by ``key``.

    Stored this way, admissions need no shuffle for any per-person step:
    the tagging de-duplication, the per-person counts, the event-index
    window and the cohort semi-join all group or join on ``bene_id`` and
    reuse the bucket partitioning. ``path`` makes it an external table.
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if by_year:
        writer = writer.partitionBy("year")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
