"""Incremental tagging of newly arriving admission files.

The batch tagging plan is stateless per admission row except for the
de-duplication on ``(year, bene_id, adm_id, outcome)``. Here each micro-batch
is tagged and de-duplicated by itself, compared with what the output already
holds for the batch's years, and appended. Nothing is dropped for being late:
a first copy of an old admission is written whenever its file arrives, and a
copy of a written one never is, however long after. No state grows with the
data; the comparison reads the keys of the affected years only.

A batch that is run again after a failure finds the rows it wrote before in the
output and adds the missing ones, so restarts and lost executors leave no
duplicates and no gaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dxcohort.functions.arrays import dx_at, dx_slice
from dxcohort.functions.expressions import bounded_broadcast
from dxcohort.operators.tagging import MAX_BROADCAST_CODES, MAX_SECONDARY_POS, conditional_matches
from dxcohort.schemas import ADMISSIONS

KEYS = ["year", "bene_id", "adm_id", "outcome"]


def admissions_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(ADMISSIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def _role(codes: DataFrame, role: str, alias: str) -> DataFrame:
    """Static codes side of the stream-static join, broadcast when a count
    proves it small (the codes table is config-sized)."""
    sel = codes.where(F.col("role") == role).select(F.col("code").alias(alias), "outcome")
    return bounded_broadcast(sel, MAX_BROADCAST_CODES)


def _check(criteria: str, first_n: int | None) -> None:
    if criteria not in ("all", "first_n", "conditional"):
        raise ValueError(f"unknown criteria {criteria!r}: use all, first_n or conditional")
    if criteria == "first_n" and (first_n is None or first_n < 1):
        raise ValueError("criteria 'first_n' needs first_n >= 1")


def _matched(
    stream: DataFrame, codes: DataFrame, criteria: str, first_n: int | None, max_secondary_pos: int
) -> tuple[DataFrame, list[str]]:
    """Matching rows (copies included) in the output's columns, and their key."""
    _check(criteria, first_n)
    label = F.lit({"all": "all", "first_n": f"first_{first_n}", "conditional": "conditional"}[criteria])
    if criteria == "conditional":
        first = stream.select("bene_id", "adm_id", "year", "diagnoses", dx_at("diagnoses", 1).alias("_p"))
        rows = conditional_matches(first, codes, max_secondary_pos).select(
            "bene_id",
            "adm_id",
            "diagnoses",
            dx_at("diagnoses", 1).alias("primary_dx"),
            dx_slice("diagnoses", 2, max_secondary_pos).alias("secondary_dx"),
            "outcome",
            label.alias("outcome_criteria"),
            "year",
        )
        return rows, [*KEYS, "diagnoses"]
    arr = F.col("diagnoses") if criteria == "all" else dx_slice("diagnoses", 1, first_n)
    rows = (
        stream.select("bene_id", "adm_id", "year", F.explode(arr).alias("_code"))
        .join(_role(codes, "any", "_code"), "_code")
        .select("bene_id", "adm_id", "outcome", label.alias("outcome_criteria"), "year")
    )
    return rows, list(KEYS)


def tag_stream(
    stream: DataFrame,
    codes: DataFrame,
    criteria: str = "all",
    first_n: int | None = None,
    max_secondary_pos: int = MAX_SECONDARY_POS,
) -> DataFrame:
    """Streaming version of ``tag_outcomes`` (same output columns), for queries
    that go on from the tagged stream. Its de-duplication keeps every matched
    key as state, because dropping old keys would drop late first copies or
    repeat old ones; ``start_tagging`` compares with its output instead and
    keeps none."""
    rows, keys = _matched(stream, codes, criteria, first_n, max_secondary_pos)
    return rows.dropDuplicates(keys)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(target)) if fs.exists(target) else False


def _append_new(batch: DataFrame, out_path: str, keys: list[str]) -> None:
    """Append the rows of ``batch`` that ``out_path`` does not hold yet."""
    spark = batch.sparkSession
    rows = batch.dropDuplicates(keys)
    if _exists(spark, out_path):
        years = [r["year"] for r in batch.select("year").distinct().collect()]  # calendar years: a few
        held = spark.read.schema(batch.schema).parquet(out_path)
        known = [y for y in years if y is not None]
        scope = F.col("year").isin(known) if known else F.lit(False)
        if None in years:
            scope = scope | F.col("year").isNull()
        held = held.where(scope).select(*[F.col(k).alias(f"_{k}") for k in keys])
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        rows = rows.join(held, same, "left_anti")
    rows.write.mode("append").partitionBy("year").parquet(out_path)


def start_tagging(
    spark: SparkSession,
    admissions_path: str,
    codes: DataFrame,
    out_path: str,
    checkpoint_path: str,
    criteria: str = "all",
    first_n: int | None = None,
    available_now: bool = True,
    max_secondary_pos: int = MAX_SECONDARY_POS,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the tagging stream into a year-partitioned Parquet dataset.

    ``available_now=True`` processes every file present and stops (a
    scheduled incremental batch); otherwise it runs continuously. One query
    writes to ``out_path`` at a time.
    """
    rows, keys = _matched(
        admissions_stream(spark, admissions_path, max_files_per_trigger), codes, criteria, first_n, max_secondary_pos
    )

    def append(batch: DataFrame, _: int) -> None:
        # The batch is read twice (its years, its rows); a lost block is made again from its files.
        batch = batch.persist()
        try:
            _append_new(batch, out_path, keys)
        finally:
            batch.unpersist()

    writer = rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def start_year_counts(
    tagged_stream: DataFrame, out_path: str, checkpoint_path: str, available_now: bool = True
) -> StreamingQuery:
    """Running ``COUNT(adm_id)`` per (year, outcome), written to ``out_path`` (one
    Parquet folder for each micro-batch, ``batch=<n>``; the highest holds the
    counts of all data so far, and a batch that is run again replaces its own).

    State and output are one row per year and outcome, whatever the data volume.
    """
    counts = tagged_stream.groupBy("year", "outcome").agg(F.count("adm_id").alias("n"))

    def write(batch: DataFrame, number: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch={number}")

    writer = counts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path).outputMode("complete")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_year_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """The counts of the last micro-batch of ``start_year_counts``."""
    df = spark.read.parquet(out_path)
    last = df.agg(F.max("batch").alias("last"))
    return df.join(F.broadcast(last), F.col("batch") == F.col("last")).select("year", "outcome", "n")
