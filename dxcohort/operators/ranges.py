"""Code ranges as data: an interval join without a nested loop.

``codes_in_ranges`` compiles a short list of ranges into one filter. Here ranges
are rows (outcome, n, lo, hi): thousands of them, overlapping ones included. The
bounds of each prefix length are sorted into an array; a code finds its place
among them by binary search, row-locally, and a range is the stretch of places
between its bounds. Stretches are cut into nodes of a binary tree over the places
(at most two on each level), and a code asks for the nodes above its place, so the
join is on equal (n, level, node): log-many rows for a code or a range, however
much ranges overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dxcohort.functions.expressions import bounded_broadcast
from dxcohort.schemas import need
from dxcohort.sources.readers import bounded_values

#: Ranges beyond this number (a list, not data) are joined with a shuffle.
MAX_BROADCAST_RANGES = 100_000
#: Halvings of a binary search, and levels of the tree: up to a million bounds.
STEPS = 20


def _below(points: Column, x: Column) -> Column:
    """Number of sorted ``points`` below ``x``, by binary search."""
    start = F.struct(F.lit(0).alias("low"), F.array_size(points).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        open_ = s["low"] < s["high"]
        right = open_ & (F.get(points, middle) < x)
        low = F.when(right, middle + 1).otherwise(s["low"])
        high = F.when(open_ & ~right, middle).otherwise(s["high"])
        return F.struct(low.alias("low"), high.alias("high"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS + 1)), start, halve)["low"]


def _place(points: Column, x: Column) -> Column:
    """Odd places are the points themselves, even ones lie between them."""
    n = _below(points, x)
    return 2 * n + F.when(F.get(points, n) == x, 1).otherwise(0)


def _nodes_of_stretch(low: Column, high: Column) -> Column:
    """(level, node) pairs that make up the places from ``low`` to ``high``."""
    none = F.array().cast("array<struct<level:int,node:int>>")
    start = F.struct(low.cast("int").alias("a"), high.cast("int").alias("b"), none.alias("nodes"))

    def node(level: Column, at: Column) -> Column:
        return F.array(F.struct(level.cast("int").alias("level"), at.cast("int").alias("node")))

    def climb(s: Column, level: Column) -> Column:
        a, b = s["a"], s["b"]
        left = (a <= b) & (a % 2 == 1)
        a_next = F.when(left, a + 1).otherwise(a)
        right = (a_next <= b) & (b % 2 == 0)
        b_next = F.when(right, b - 1).otherwise(b)
        nodes = F.concat(s["nodes"], F.when(left, node(level, a)).otherwise(none), F.when(right, node(level, b)).otherwise(none))
        up = lambda x: F.floor(x / 2).cast("int")
        return F.struct(F.when(a_next <= b_next, up(a_next)).otherwise(F.lit(1)).alias("a"), F.when(a_next <= b_next, up(b_next)).otherwise(F.lit(0)).alias("b"), nodes.alias("nodes"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(STEPS + 1)), start, climb)["nodes"]


def codes_in_range_table(valid: DataFrame, ranges: DataFrame) -> DataFrame:
    """``outcome`` and the columns of ``valid`` for each code whose first ``n``
    characters lie in ``[lo, hi]`` (lexically) of a row of ``ranges`` (outcome, n,
    lo, hi). A code in several ranges of one outcome is returned once, in ranges of
    several outcomes once for each. Null bounds, and ranges whose lo is above their
    hi, hold nothing. ``ranges`` is a config table; prefix lengths are few."""
    need(valid, ["code"], "codes")
    need(ranges, ["outcome", "n", "lo", "hi"], "ranges")
    sound = ranges.where(F.col("lo").isNotNull() & F.col("hi").isNotNull() & (F.col("lo") <= F.col("hi"))).select(
        "outcome", F.col("n").cast("int").alias("_n"), "lo", "hi"
    )
    lengths = bounded_values(sound, "_n", 1_000)
    bounds = sound.select("_n", F.explode(F.array("lo", "hi")).alias("_p"))
    points = F.broadcast(bounds.groupBy("_n").agg(F.array_sort(F.collect_set("_p")).alias("_points")))
    stretches = sound.join(points, "_n").select(
        "outcome", "_n", F.explode(_nodes_of_stretch(_place(F.col("_points"), F.col("lo")), _place(F.col("_points"), F.col("hi")))).alias("_at")
    )
    nodes = stretches.select("outcome", F.col("_n").alias("_rn"), F.col("_at.level").alias("_rlevel"), F.col("_at.node").alias("_rnode")).distinct()
    if not lengths:
        return valid.select(F.lit("").alias("outcome"), *valid.columns).limit(0)
    levels = F.sequence(F.lit(0), F.lit(STEPS + 1))
    asked = (
        valid.where(F.col("code").isNotNull())
        .select("*", F.explode(F.array(*[F.lit(n) for n in lengths])).alias("_n"))
        .join(points, "_n")
        .withColumn("_place", _place(F.col("_points"), F.expr("substring(code, 1, _n)")).cast("int"))
        .select(*valid.columns, "_n", "_place", F.explode(levels).alias("_level"))
        .withColumn("_node", F.call_function("shiftright", F.col("_place"), F.col("_level")))
    )
    same = (F.col("_n") == F.col("_rn")) & (F.col("_level") == F.col("_rlevel")) & (F.col("_node") == F.col("_rnode"))
    side = bounded_broadcast(nodes, MAX_BROADCAST_RANGES * 2 * STEPS, probe=nodes)
    return asked.join(side, same).select("outcome", *valid.columns).distinct()
