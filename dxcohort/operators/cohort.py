"""All admissions of the persons who have a tagged outcome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxcohort.functions.bloom import towards_keys
from dxcohort.functions.expressions import BROADCAST_BYTES, LONG_KEY_BYTES
from dxcohort.session import materialize, shuffles

# Up to this many distinct persons (64 MB as a hash relation) are broadcast.
MAX_BROADCAST_PERSONS = BROADCAST_BYTES // LONG_KEY_BYTES


def cohort_subset(
    admissions: DataFrame,
    outcomes: DataFrame,
    outcome: str | None = None,
    max_broadcast_persons: int = MAX_BROADCAST_PERSONS,
) -> DataFrame:
    """Every admission (all columns, any year) of persons with the outcome.

    A left semi join against the distinct persons: no fan-out. They are
    written once; if they are at most ``max_broadcast_persons`` they are
    broadcast, so the (wide, huge) admissions are never shuffled. Beyond that a
    Bloom filter of fixed size drops most other persons' admissions row-locally
    and only the rest is shuffled, with skewed partitions split by AQE. A bound
    of 0 asks for that; persons that are found without a shuffle are not written
    then (a bucketed layout is kept).
    """
    persons = outcomes if outcome is None else outcomes.where(F.col("outcome") == F.lit(outcome))
    people = persons.select("bene_id").where(F.col("bene_id").isNotNull()).distinct()
    if max_broadcast_persons > 0 or shuffles(people):
        people = materialize(people, "persons")
    near, exact = towards_keys(admissions, people, ["bene_id"], max_broadcast_persons)
    return (near if exact else near.join(people, "bene_id", "left_semi")).select(*admissions.columns)
