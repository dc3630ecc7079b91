"""A mergeable Bloom filter as a small table, built by an aggregate.

Keys that are too many to broadcast still shrink the other side of their join: a
filter of fixed size is broadcast instead and applied row-locally, and the exact
join follows. The filter is *split into blocks*: a key's block is one row of
eight 64-bit words, and the key sets one bit in each word, so the aggregate is
``bit_or`` (partial map-side, mergeable over years or days) and a look-up is one
hash join and eight comparisons, all inside generated code.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dxcohort.functions.expressions import BROADCAST_BYTES
from dxcohort.session import materialize

WORDS = 8
#: Measured size of a hash relation per block (key and eight words).
BLOCK_BYTES = 176
#: Largest filter: what a broadcast may hold.
MAX_BLOCKS = BROADCAST_BYTES // BLOCK_BYTES
#: Bits a key should have (about one false positive in 500); with more keys than
#: fit, a full filter has fewer for each.
BITS_PER_KEY = 16
#: Below this many bits a key the filter passes about everything.
LEAST_BITS = 3

_BITS = [f"_bits{i}" for i in range(WORDS)]


def blocks_for(n_keys: int, most: int = MAX_BLOCKS) -> int:
    """Blocks of a filter for ``n_keys`` keys; 0 if it would let everything pass."""
    if n_keys * LEAST_BITS > most * WORDS * 64:
        return 0
    return max(1, min(most, -(-n_keys * BITS_PER_KEY // (WORDS * 64))))


def _key(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Key columns as they are hashed: whole numbers of any width alike."""
    whole = (T.ByteType, T.ShortType, T.IntegerType)
    return [F.col(c).cast("long") if isinstance(df.schema[c].dataType, whole) else F.col(c) for c in cols]


def _block(key: Sequence[Column], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(blocks)).cast("int")


def _masks(key: Sequence[Column]) -> list[Column]:
    """One bit for each word, from six bits of a second hash each."""
    second = F.xxhash64(F.lit("second hash"), *key)
    return [_bit(F.shiftright(second, 6 * i)) for i in range(WORDS)]


def _bit(x: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63).cast("long")).cast("int"))


def bloom_table(keys: DataFrame, cols: Sequence[str], blocks: int) -> DataFrame:
    """The filter: at most ``blocks`` rows of a block number and its words."""
    key = _key(keys, cols)
    bits = [m.alias(n) for m, n in zip(_masks(key), _BITS, strict=True)]
    return keys.select(_block(key, blocks).alias("_block"), *bits).groupBy("_block").agg(*[F.bit_or(n).alias(n) for n in _BITS])


def merge_blooms(a: DataFrame, b: DataFrame) -> DataFrame:
    """The filter of both key sets; both have the same number of blocks."""
    return a.unionByName(b).groupBy("_block").agg(*[F.bit_or(n).alias(n) for n in _BITS])


def might_hold(df: DataFrame, cols: Sequence[str], bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``df`` whose key may be in the filter: all rows with a key that
    is, and a few others. The filter is broadcast; its size is fixed by ``blocks``."""
    key = _key(df, cols)
    tests = [F.col(n).bitwiseAND(m) != 0 for n, m in zip(_BITS, _masks(key), strict=True)]
    kept = df.join(F.broadcast(bloom), _block(key, blocks) == F.col("_block"))
    return kept.where(reduce(lambda x, y: x & y, tests)).select(*df.columns)


def towards_keys(df: DataFrame, keys: DataFrame, cols: Sequence[str], max_keys: int) -> tuple[DataFrame, bool]:
    """``df`` without most rows that have no key in ``keys`` (distinct, cheap to
    read twice), row-locally, so that little of it reaches an exact join; and
    whether all of them are gone already. Up to ``max_keys`` keys are broadcast
    themselves, more as a Bloom filter; with more keys than a filter can tell
    apart ``df`` is returned as it is."""
    n = keys.count()
    if n <= max_keys:
        return df.join(F.broadcast(keys), list(cols), "left_semi"), True
    blocks = blocks_for(n)
    if not blocks:
        return df, False
    return might_hold(df, cols, materialize(bloom_table(keys, cols, blocks), "bloom"), blocks), False
