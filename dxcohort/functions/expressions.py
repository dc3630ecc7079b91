"""Scalar expressions and the stratum domain of the stratified counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# They must equal the studied workflow's for equal results.
# Age bands (label, lowest age, highest age), both ends inclusive:
AGE_BANDS = [
    ("[65,75]", 65, 75),
    ("[76,85]", 76, 85),
    ("[86,95]", 86, 95),
    ("[96,100]", 96, 100),
    ("[101,115]", 101, 115),
]
SEX_DOMAIN = [0, 1, 2]
RACE_DOMAIN = [0, 1, 2, 3, 4, 5, 6]
DUAL_DOMAIN = [0, 1]
# ---------------------------------------------------------------------------


def age_band(age: str | Column) -> Column:
    """Age group label; NULL below 65, above 115 and between bands."""
    a = F.col(age) if isinstance(age, str) else age
    expr = None
    for label, lo, hi in AGE_BANDS:
        cond = a.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def with_strata(df: DataFrame) -> DataFrame:
    """Each row repeated once per stratum (age_grp, sex, race, dual):
    5 x 3 x 7 x 2 = 210 rows, emitted row-locally by one ``explode`` per
    domain. This replaces a cross join with the constant domains."""
    domains = [
        ("age_grp", [F.lit(b[0]) for b in AGE_BANDS]),
        ("sex", [F.lit(v).cast("int") for v in SEX_DOMAIN]),
        ("race", [F.lit(v).cast("int") for v in RACE_DOMAIN]),
        ("dual", [F.lit(v).cast("int") for v in DUAL_DOMAIN]),
    ]
    for name, values in domains:
        df = df.select("*", F.explode(F.array(*values)).alias(name))
    return df


def int_round_half_even(x: str | Column) -> Column:
    """Double to INT rounding halves to even (2.5 -> 2, 3.5 -> 4).

    This is how the SQL engine of the studied workflow casts a DOUBLE to
    INT; a bare Spark cast would truncate instead.
    """
    c = F.col(x) if isinstance(x, str) else x
    return F.rint(c).cast("int")


def zero_pad(x: str | Column, width: int) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    return F.lpad(c.cast("string"), width, "0")


# A broadcast relation of more than this is not worth holding on the driver
# and on every executor. Measured sizes of a hash relation per distinct key:
BROADCAST_BYTES = 64 * 1024 * 1024
LONG_KEY_BYTES = 112
PAIR_KEY_BYTES = 160


def bounded_broadcast(df: DataFrame, max_rows: int, probe: DataFrame | None = None) -> DataFrame:
    """Broadcast ``df`` only if it provably holds at most ``max_rows`` rows.

    The proof is a row count of ``probe`` (default ``df``), which must have
    at least as many rows as ``df`` (e.g. the input of a distinct step). A
    count is a distributed partial count; on Parquet with no columns needed
    it reads only file footers. Beyond the bound the frame is returned as is
    and the join is planned as a shuffled join.
    """
    n = (probe if probe is not None else df).count()
    return F.broadcast(df) if n <= max_rows else df
