"""Results that grow with new data instead of being made anew.

* **Event index.** The state of a person and outcome is the last number and the
  last event. New events that come after it are numbered on from there; only
  persons with an event that lies earlier are numbered again, all of them exactly.
* **Area and stratified counts** are sums over tagged rows, so late rows are a
  delta: only their person-years are joined, and the delta is added to (or, with
  negative rows, taken from) the stored counts.
* **Distinct persons** are kept as exact bitmaps by year and outcome; a union of
  years is a bit-wise OR of stored rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dxcohort.functions.bloom import towards_keys
from dxcohort.functions.expressions import BROADCAST_BYTES, PAIR_KEY_BYTES
from dxcohort.operators.counts import STRATA, area_sums, strat_sums
from dxcohort.operators.events import DATE_COLS, index_outcomes
from dxcohort.operators.numbering import row_number_skew_safe
from dxcohort.schemas import need
from dxcohort.session import materialize, written
from dxcohort.sources.readers import value_columns

PERSON = ["outcome", "bene_id"]
EVENT = [*PERSON, "year", "adm_id"]
#: Up to this many persons' keys are broadcast to find their rows.
MAX_BROADCAST_PERSONS = BROADCAST_BYTES // PAIR_KEY_BYTES


def _same(names: Sequence[str], prefix: str) -> Column:
    """Null-safe equality with the columns of that prefix."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in names])


def _side(df: DataFrame, names: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c if c in names else c) for c in df.columns])


def index_state(indexed: DataFrame) -> DataFrame:
    """One row for each outcome and person: ``last_index`` and the event that has
    it (``last_date``, ``last_adm``). Two states of different persons can be
    united; it follows from the index and can be made anew at any time."""
    last = F.max_by(F.struct("admission_date", "adm_id"), "outcome_index")
    return (
        indexed.groupBy(*PERSON)
        .agg(F.max("outcome_index").alias("last_index"), last.alias("_last"))
        .select(*PERSON, "last_index", F.col("_last.admission_date").alias("last_date"), F.col("_last.adm_id").alias("last_adm"))
    )


def _after_last() -> Column:
    """Whether an event comes after the person's last one: by date (none at the
    end), then by id. Anything else, equal events too, has to be numbered again."""
    date, last = F.col("admission_date"), F.col("last_date")
    later = (date > last) | (date.isNull() & last.isNotNull())
    return F.col("last_index").isNull() | F.coalesce(later, F.lit(False)) | (date.eqNullSafe(last) & F.coalesce(F.col("adm_id") > F.col("last_adm"), F.lit(False)))


def extend_index(
    state: DataFrame, indexed: DataFrame, new: DataFrame, heavy_rows: int | None = 5_000_000, max_broadcast: int = MAX_BROADCAST_PERSONS
) -> tuple[DataFrame, DataFrame]:
    """Number ``new`` tagged rows (with their dates) on from ``state``.

    Returns the numbered new rows, and the rows of ``indexed`` whose number is
    another one now; both have the columns of ``indexed``, which is read only for
    persons with an event before their last one. ``new`` must not repeat events
    that are numbered already (see ``unseen``). The new rows are written once.
    """
    need(new, [*EVENT, *DATE_COLS], "new outcomes")
    need(indexed, [*EVENT, *DATE_COLS, "outcome_index"], "indexed outcomes")
    base = [c for c in new.columns if c not in DATE_COLS]
    new = written(new, "new_events")
    known = _side(state, PERSON, "_s_")
    # The state of the new rows' persons only: one row each, so nothing fans out.
    persons = new.select(*PERSON).distinct()
    mine = persons.join(known, _same(PERSON, "_s_"), "left").select(*PERSON, "last_index", "last_date", "last_adm")
    mine = _side(materialize(mine, "new_persons"), PERSON, "_p_")
    placed = materialize(
        new.join(mine, _same(PERSON, "_p_")).select(*new.columns, "last_index", _after_last().alias("_after")), "placed_events"
    )
    late = materialize(placed.where("not _after").select(*PERSON).distinct(), "late_persons")
    few = late.count() <= max_broadcast
    side = _side(late, PERSON, "_l_")
    side = F.broadcast(side) if few else side
    # Persons whose new events all follow: numbers go on.
    order = [F.col("admission_date").asc_nulls_last(), F.col("adm_id").asc(), F.col("year").asc()]
    order += [F.col("diagnoses").asc()] if "diagnoses" in new.columns else []
    on = placed.join(side, _same(PERSON, "_l_"), "left_anti")
    on = row_number_skew_safe(on, PERSON, order, "_n", heavy_rows=heavy_rows)
    numbered = on.withColumn("outcome_index", (F.col("_n") + F.coalesce("last_index", F.lit(0))).cast("int"))
    numbered = numbered.withColumn("discharge_year", F.year("discharge_date").cast("int")).select(*indexed.columns)
    # The others: their old and new events are numbered together.
    old = indexed.join(side, _same(PERSON, "_l_"), "left_semi")
    both = (
        old.select(*base, *DATE_COLS, F.col("outcome_index").alias("_old"))
        .unionByName(placed.join(side, _same(PERSON, "_l_"), "left_semi").select(*base, *DATE_COLS, F.lit(None).cast("int").alias("_old")))
    )
    again = index_outcomes(materialize(both, "late_events"), heavy_rows=heavy_rows)
    added = numbered.unionByName(again.where(F.col("_old").isNull()).select(*indexed.columns))
    changed = again.where(F.col("_old").isNotNull() & (F.col("_old") != F.col("outcome_index"))).select(*indexed.columns)
    return added, changed


def next_state(state: DataFrame, added: DataFrame, changed: DataFrame) -> DataFrame:
    """The state after ``extend_index``. A person's last event is a new one, or its
    number has grown, so the rows of the run tell it without the index."""
    fresh = materialize(index_state(added.unionByName(changed)), "fresh_state")
    side = _side(fresh.select(*PERSON), PERSON, "_f_")
    return state.join(side, _same(PERSON, "_f_"), "left_anti").unionByName(fresh)


def renumbered(indexed: DataFrame, added: DataFrame, changed: DataFrame, max_broadcast: int = MAX_BROADCAST_PERSONS) -> DataFrame:
    """The whole index: ``changed`` takes the place of its rows, ``added`` joins them."""
    keys = [c for c in (*EVENT, "diagnoses") if c in indexed.columns]
    changed = materialize(changed, "changed")
    side = _side(changed.select(*keys), keys, "_c_")
    if changed.count() <= max_broadcast:
        side = F.broadcast(side)
    return indexed.join(side, _same(keys, "_c_"), "left_anti").unionByName(changed).unionByName(added)


def unseen(outcomes: DataFrame, new: DataFrame, max_broadcast: int = MAX_BROADCAST_PERSONS) -> DataFrame:
    """Rows of ``new`` whose (outcome, person, year, admission) is not in
    ``outcomes`` yet, each once: a late file may repeat what is there."""
    new = written(new.dropDuplicates(EVENT), "new_rows")
    ids = materialize(new.select("adm_id").where(F.col("adm_id").isNotNull()).distinct(), "new_ids")
    near, _ = towards_keys(outcomes.select(*EVENT).where(F.col("adm_id").isNotNull()), ids, ["adm_id"], max_broadcast)
    lost = outcomes.select(*EVENT).where(F.col("adm_id").isNull())
    return new.join(_side(near.unionByName(lost), EVENT, "_o_"), _same(EVENT, "_o_"), "left_anti")


# --- counts -----------------------------------------------------------------------------


def _added(stored: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored counts with the delta of the same cell added; cells stay as they are."""
    values = value_columns(stored, set(keys))
    lost = [c for c in value_columns(delta, set(keys)) if c not in values]
    if lost:
        raise ValueError(f"outcomes that the stored counts do not have: {', '.join(lost)}")
    there = value_columns(delta, set(keys))
    side = delta.select(*[F.col(c).alias(f"_d_{c}") for c in keys], *[F.col(f"`{c}`").alias(f"_d_{c}") for c in there])
    both = stored.join(side, [F.col(c) == F.col(f"_d_{c}") for c in keys], "left")
    return both.select(
        *keys, *[(F.col(f"`{c}`") + (F.coalesce(F.col(f"`_d_{c}`"), F.lit(0)) if c in there else F.lit(0))).cast("long").alias(c) for c in values]
    )


def update_area_counts(
    stored: DataFrame, new: DataFrame, denom: DataFrame, spine: DataFrame, outcome_list: Sequence[str], sign: str | None = None
) -> DataFrame:
    """Stored area counts after ``new`` tagged rows (``sign``: a column of 1 and -1
    for rows that come and go). Only the new rows' person-years are joined. Spine
    areas that the stored counts lack stay out: they need a full run."""
    delta = area_sums(new, denom, spine, outcome_list, sign)
    return _added(stored, delta, ["zcta", "year"])


def update_strat_counts(
    stored: DataFrame, new: DataFrame, denom: DataFrame, outcome_list: Sequence[str], sign: str | None = None
) -> DataFrame:
    """Stored stratified counts after ``new`` tagged rows; see ``update_area_counts``."""
    return _added(stored, strat_sums(new, denom, outcome_list, sign), ["zcta", "year", *STRATA])


# --- distinct persons -----------------------------------------------------------------------


def person_bitmaps(outcomes: DataFrame) -> DataFrame:
    """``year, outcome, bucket, persons``: bit sets of 32,768 person numbers each.
    Exact, and mergeable over years, files and runs (``merge_bitmaps``). Persons
    without a number are left out, as a distinct count does."""
    need(outcomes, ["year", "outcome", "bene_id"], "outcomes")
    person = F.col("bene_id").cast("long")
    return (
        outcomes.where(person.isNotNull())
        .select("year", "outcome", F.bitmap_bucket_number(person).alias("bucket"), F.bitmap_bit_position(person).alias("_bit"))
        .groupBy("year", "outcome", "bucket")
        .agg(F.bitmap_construct_agg("_bit").alias("persons"))
    )


def merge_bitmaps(*tables: DataFrame) -> DataFrame:
    """Bitmaps of several runs or files as one table."""
    rows = reduce(lambda a, b: a.unionByName(b), tables)
    return rows.groupBy("year", "outcome", "bucket").agg(F.bitmap_or_agg("persons").alias("persons"))


def distinct_persons(bitmaps: DataFrame, years: Sequence[int] | None = None, by: Sequence[str] = ("outcome",)) -> DataFrame:
    """Exact numbers of different persons for each ``by`` over a union of years,
    from the stored rows. ``by`` may hold outcome and year, or nothing."""
    if years is not None:
        bitmaps = bitmaps.where(F.col("year").isin(list(years)))
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("persons").alias("persons"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("persons")).cast("long").alias("n_persons"))
