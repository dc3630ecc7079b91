"""Number each person's tagged events over time (all years, all outcomes)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxcohort.functions.bloom import towards_keys
from dxcohort.functions.expressions import BROADCAST_BYTES, LONG_KEY_BYTES
from dxcohort.operators.numbering import row_number_skew_safe
from dxcohort.schemas import need
from dxcohort.session import written

DATE_COLS = ["admission_date", "discharge_date"]

# Up to this many distinct tagged ids (64 MB as a hash relation) are broadcast
# to filter the admissions row-locally before the date lookup.
MAX_BROADCAST_IDS = BROADCAST_BYTES // LONG_KEY_BYTES


#: What a repeated admission id does: end the job with a message, or be counted in a column.
ON_REPEAT = ("raise", "report")


def attach_dates(
    outcomes: DataFrame,
    admissions: DataFrame,
    max_broadcast_ids: int = MAX_BROADCAST_IDS,
    on_repeat: str = "raise",
) -> DataFrame:
    """Admission and discharge dates of each tagged row, in one join on ``adm_id``.

    The tagged rows are written once, so their lineage runs once. Only three
    narrow columns of the admissions are read. Up to ``max_broadcast_ids``
    distinct tagged ids are broadcast (a broadcast keeps repeated keys, hence
    the distinct) and semi-join the admissions row-locally, so only the
    matching admissions reach the join; more ids become a Bloom filter first.

    Admission ids must be unique, and a join would fan out silently where one is
    not. The join's own shuffle tells: the admissions that reach it are grouped
    by id first, which needs the same partitioning, so no second scan or exchange
    is made. A repeated id of a tagged row ends the job with its name, or with
    ``on_repeat="report"`` its rows get the earliest dates and the column
    ``adm_rows`` says how many admissions share it.
    """
    return _attach_dates(written(outcomes, "tagged"), admissions, max_broadcast_ids, on_repeat)


def unique_dates(admissions: DataFrame, on_repeat: str = "raise") -> DataFrame:
    """One row for each admission id: its dates, and ``adm_rows`` if reported.
    Rows without an id are left out; they never join."""
    if on_repeat not in ON_REPEAT:
        raise ValueError(f"on_repeat is one of {', '.join(ON_REPEAT)}")
    grouped = (
        admissions.where(F.col("adm_id").isNotNull())
        .groupBy("adm_id")
        .agg(F.count(F.lit(1)).alias("adm_rows"), *[F.min(c).alias(c) for c in DATE_COLS])
    )
    if on_repeat == "report":
        return grouped
    told = F.concat(F.lit("admission id "), F.col("adm_id").cast("string"), F.lit(" occurs "), F.col("adm_rows").cast("string"), F.lit(" times"))
    types = {c: admissions.schema[c].dataType for c in DATE_COLS}
    return grouped.select("adm_id", *[F.when(F.col("adm_rows") > 1, F.raise_error(told).cast(types[c])).otherwise(F.col(c)).alias(c) for c in DATE_COLS])


def _attach_dates(
    outcomes: DataFrame, admissions: DataFrame, max_broadcast_ids: int = MAX_BROADCAST_IDS, on_repeat: str = "raise"
) -> DataFrame:
    """``attach_dates`` of a written table."""
    ids = outcomes.select("adm_id").where(F.col("adm_id").isNotNull()).distinct()
    dates, _ = towards_keys(admissions.select("adm_id", *DATE_COLS), ids, ["adm_id"], max_broadcast_ids)
    counted = ["adm_rows"] if on_repeat == "report" else []
    return outcomes.join(unique_dates(dates, on_repeat), "adm_id").select(*outcomes.columns, *DATE_COLS, *counted)


def index_outcomes(
    outcomes: DataFrame,
    admissions: DataFrame | None = None,
    outcome: str | None = None,
    heavy_rows: int | None = 5_000_000,
    sample_fraction: float | None = None,
) -> DataFrame:
    """Event index: ``row_number()`` per (outcome, person) by admission date.

    ``outcomes`` are tagged rows of any years. Without ``admissions`` they
    must already carry ``admission_date`` and ``discharge_date`` (e.g. tagged
    with ``carry=DATE_COLS``), which saves the second scan of the admissions.
    Ties on the date are broken by ``adm_id``, ``year`` and ``diagnoses`` (which
    conditional rows may differ in alone); NULL dates sort last. The rows are
    written once (unless they are a written table already), so finding heavy groups and numbering share one run of
    their lineage.

    Returns the tagged columns followed by ``discharge_year,
    admission_date, discharge_date, outcome_index``.
    """
    need(outcomes, ["bene_id", "adm_id", "outcome"], "outcomes")
    if admissions is None:
        need(outcomes, DATE_COLS, "outcomes without admissions")
    else:
        need(admissions, ["adm_id", *DATE_COLS], "admissions")
    if outcome is not None:
        outcomes = outcomes.where(F.col("outcome") == F.lit(outcome))
    base_cols = [c for c in outcomes.columns if c not in DATE_COLS]
    if admissions is not None:
        outcomes = written(outcomes.select(*base_cols), "tagged")
        dated = _attach_dates(outcomes, admissions)
    else:
        if heavy_rows is not None:
            outcomes = written(outcomes, "tagged")
        dated = outcomes
    order = [F.col("admission_date").asc_nulls_last(), F.col("adm_id").asc()]
    if "year" in dated.columns:
        order.append(F.col("year").asc())
    if "diagnoses" in dated.columns:
        order.append(F.col("diagnoses").asc())
    numbered = row_number_skew_safe(
        dated,
        ["outcome", "bene_id"],
        order,
        "outcome_index",
        heavy_rows=heavy_rows,
        sample_fraction=sample_fraction,
        # group sizes are those of the tagged rows: look at them, not at the join
        detect_on=outcomes.select("outcome", "bene_id"),
    )
    return numbered.select(
        *base_cols,
        F.year("discharge_date").cast("int").alias("discharge_year"),
        *DATE_COLS,
        "outcome_index",
    )


def index_profile(indexed: DataFrame) -> DataFrame:
    """Per outcome: persons, first and last admission date, rows."""
    return indexed.groupBy("outcome").agg(
        F.count_distinct("bene_id").alias("n_bene"),
        F.min("admission_date").alias("min_date"),
        F.max("admission_date").alias("max_date"),
        F.count(F.lit(1)).alias("n_rows"),
    )
