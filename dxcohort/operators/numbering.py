"""Row numbering within groups that stays exact and balanced under skew.

A plain ``row_number()`` window sends each group to one task. If one group
holds a large share of all rows that task gets it all. Here heavy groups, found
by a count-min sketch of all rows (or by a sample), are numbered separately: their rows are range-partitioned
on ``(group, order)`` so a heavy group spans many tasks, each task numbers its
sorted slice locally, and a small table of per-(group, task) offsets turns
local numbers into global ones. Both paths are exact for any group; the
sketch only decides which path a group takes. It never counts a group too low,
so a group that reaches the bound always takes the balanced one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dxcohort.functions.expressions import BROADCAST_BYTES, PAIR_KEY_BYTES
from dxcohort.session import materialize

# Target rows per task when numbering heavy groups (narrow rows: ~0.5 GB).
ROWS_PER_TASK = 5_000_000


# Group keys (with their estimate) up to this many are broadcast; more shuffle.
MAX_BROADCAST_GROUPS = BROADCAST_BYTES // PAIR_KEY_BYTES


def heavy_groups(
    df: DataFrame,
    group_cols: Sequence[str],
    heavy_rows: int,
    sample_fraction: float = 0.01,
    seed: int = 17,
) -> DataFrame:
    """Groups estimated (from a sample) to hold at least ``heavy_rows`` rows,
    and ``est``, their estimated row counts; written once.

    All of them: their number is bounded by the rows over ``heavy_rows``.
    """
    sampled = df.select(*group_cols)
    if sample_fraction < 1.0:
        sampled = sampled.sample(fraction=sample_fraction, seed=seed)
    min_hits = max(1, int(heavy_rows * sample_fraction))
    scale = 1.0 / sample_fraction if sample_fraction < 1.0 else 1.0
    counts = sampled.groupBy(*group_cols).count().where(F.col("count") >= min_hits)
    return materialize(counts.select(*group_cols, (F.col("count") * scale).cast("long").alias("est")), "heavy_groups")


#: Counters of the sketch for each of its two hashes; a task's partial table of them
#: stays below 50 MB. A counter is heavy by chance only with far more rows than
#: ``SKETCH_WIDTH`` times the bound.
SKETCH_WIDTH = 1 << 18
_SEEDS = (0, 1)


def _counters(group_cols: Sequence[str], width: int) -> list[Column]:
    """A row's counter for each hash (NULL keys hash too)."""
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000null")) for c in group_cols]
    return [F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(width)).cast("int") for seed in _SEEDS]


def count_min(df: DataFrame, group_cols: Sequence[str], width: int = SKETCH_WIDTH) -> DataFrame:
    """``seed, counter, n``: rows of each counter, at most two times ``width``
    rows. Sketches of several files or days are merged by adding ``n``."""
    both = F.array(*[F.struct(F.lit(s).alias("seed"), c.alias("counter")) for s, c in zip(_SEEDS, _counters(group_cols, width), strict=True)])
    return df.select(F.explode(both).alias("_c")).groupBy("_c.seed", "_c.counter").agg(F.count(F.lit(1)).alias("n"))


def split_heavy(
    df: DataFrame, sketch: DataFrame, group_cols: Sequence[str], heavy_rows: int, width: int = SKETCH_WIDTH
) -> tuple[DataFrame | None, DataFrame | None, int]:
    """The rows of groups whose estimate (the smaller of its counters) is below
    ``heavy_rows``, the others, and an estimate of the others' number; None for a
    side without rows to look for. Heavy counters are at most 2 * rows / bound."""
    heavy = materialize(sketch.where(F.col("n") >= heavy_rows), "heavy_counters")
    found = heavy.groupBy("seed").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("rows")).collect()
    if len(found) < len(_SEEDS):
        return df, None, 0
    marked = df
    for seed, counter in zip(_SEEDS, _counters(group_cols, width), strict=True):
        side = heavy.where(F.col("seed") == seed).select(F.col("counter").alias(f"_heavy{seed}"))
        if max(r["k"] for r in found) <= MAX_BROADCAST_GROUPS:
            side = F.broadcast(side)
        marked = marked.join(side, counter == F.col(f"_heavy{seed}"), "left")
    both = F.col("_heavy0").isNotNull() & F.col("_heavy1").isNotNull()
    return marked.where(~both).select(*df.columns), marked.where(both).select(*df.columns), min(r["rows"] for r in found)


def _renamed(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with other names for ``cols``, to join on them null-safe."""
    names = [f"_key{i}" for i in range(len(cols))]
    for c, n in zip(cols, names):
        df = df.withColumnRenamed(c, n)
    return df, names


def _same(cols: Sequence[str], names: Sequence[str]) -> Column:
    """Equality that holds for NULLs: a NULL group can be heavy too."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(cols, names)])


def _number_heavy(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[Column],
    out_col: str,
    est_rows: int,
) -> DataFrame:
    spark = df.sparkSession
    # enough range slices that each task numbers about ROWS_PER_TASK rows
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(est_rows / ROWS_PER_TASK))
    sort_cols = [F.col(c).asc() for c in group_cols] + list(order_cols)
    ranged = (
        df.repartitionByRange(n_parts, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mono", F.monotonically_increasing_id())
    )
    # Written to the shared folder: both consumers below must see the same
    # partition ids, and recovery must not renumber.
    ranged = materialize(ranged, "ranged")
    # Contiguous ranges: (group, task) pairs <= groups + tasks.
    slices = ranged.groupBy(*group_cols, "_pid").agg(
        F.min("_mono").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1
    )
    slices = slices.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    slices = materialize(slices.select(*group_cols, F.col("_pid").alias("_slice"), "_first", "_offset"), "slices")
    side, names = _renamed(slices, group_cols)
    if slices.count() <= MAX_BROADCAST_GROUPS:
        side = F.broadcast(side)
    numbered = ranged.join(side, _same(group_cols, names) & (F.col("_pid") == F.col("_slice")))
    return numbered.withColumn(
        out_col, (F.col("_offset") + F.col("_mono") - F.col("_first") + 1).cast("int")
    ).drop("_pid", "_mono", "_first", "_offset", "_slice", *names)


def row_number_skew_safe(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[Column],
    out_col: str,
    heavy_rows: int | None = 5_000_000,
    sample_fraction: float | None = None,
    detect_on: DataFrame | None = None,
) -> DataFrame:
    """``row_number() over (partition by group order by order_cols)``.

    ``order_cols`` should end with a unique tie-break so numbers are
    deterministic. ``heavy_rows=None`` disables the heavy-group path.
    ``detect_on`` is a cheaper frame with the same group sizes to look at
    (e.g. the input of a 1:1 join rather than its output). Groups of at least
    ``heavy_rows`` rows are found by a count-min sketch of fixed size, none is
    missed; with ``sample_fraction`` a sample finds them instead.
    """
    window = Window.partitionBy(*group_cols).orderBy(*order_cols)
    if heavy_rows is None:
        return df.withColumn(out_col, F.row_number().over(window))
    seen = detect_on if detect_on is not None else df
    if sample_fraction is None:
        light, hot, rows = split_heavy(df, count_min(seen, group_cols), group_cols, heavy_rows)
        light = light.withColumn(out_col, F.row_number().over(window))
        if hot is None:
            return light
        return light.unionByName(_number_heavy(hot, group_cols, order_cols, out_col, rows).select(*light.columns))
    heavy = heavy_groups(seen, group_cols, heavy_rows, sample_fraction)
    found = heavy.agg(F.count(F.lit(1)).alias("n"), F.sum("est").alias("rows")).first()
    if not found["n"]:
        return df.withColumn(out_col, F.row_number().over(window))
    side, names = _renamed(heavy.select(*group_cols), group_cols)
    if found["n"] <= MAX_BROADCAST_GROUPS:
        side = F.broadcast(side)
    same = _same(group_cols, names)
    light = df.join(side, same, "left_anti").withColumn(out_col, F.row_number().over(window))
    hot = _number_heavy(df.join(side, same, "left_semi"), group_cols, order_cols, out_col, found["rows"])
    return light.unionByName(hot.select(*light.columns))


def with_places(ordered: DataFrame, out_col: str) -> DataFrame:
    """``ordered`` (a sorted frame) with each row's place, from 0: tasks number
    their own rows, and a small table of one row per task gives each its first
    place. Written once, so that the order is taken as it came out."""
    local = ordered.withColumn("_pid", F.spark_partition_id()).withColumn("_mono", F.monotonically_increasing_id())
    local = materialize(local, "places")
    # One row for each task of the sort: their running sum fits one task.
    tasks = local.groupBy("_pid").agg(F.min("_mono").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select(F.col("_pid").alias("_task"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = local.join(F.broadcast(tasks), F.col("_pid") == F.col("_task"))
    return placed.select(*ordered.columns, (F.col("_before") + F.col("_mono") - F.col("_first")).alias(out_col))
