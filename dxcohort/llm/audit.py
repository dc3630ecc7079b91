"""Filter interaction audit: what each filter removes in every order of them.

Four filters look at a text alone; the fifth removes a text that a smaller
doc_id holds as well. *Duplicates* are found with radix tries: whole texts go
into a compressed trie whose terminals hold the smallest doc_id. Each task first
puts its own rows into tries, so a text leaves a task's block once however many
copies it has; then texts are range-partitioned by an adaptive prefix, which
grows where many bytes share a short one, and each range is put into tries
again. A text that is frequent over many blocks is met in salted parts first.

*Interaction.* A row's failed filters are a mask; rows collapse to counts by
part, mask and label, and all orders are answered from those counts.

Defined results: a null text is empty, a null lang is the part "". Rows without
a doc_id neither are nor make duplicates and have no label; rows that share a
doc_id do not make each other duplicates, and each counts. Several labels of one
doc_id count if any of them does. Very long texts are nodes of a trie like
others; one that exceeds a block stands in a trie of its own. Extra columns are
ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxcohort.llm.common import ship, staged

# The filters' letters in the order of their bits, and limits.
LETTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITALS_PERCENT = 10
SIGNS = b"#$%&*|"

DUPLICATE = 1 << LETTERS.index("E")
_CAPITALS = bytes(range(65, 91))
_FOLLOWING = bytes(range(0x80, 0xC0))

#: Bytes of a trie (texts and nodes) before it is traversed and emptied.
BLOCK_BYTES = 8 << 20
NODE_BYTES = 250
#: Bytes of texts in one range.
RANGE_BYTES = 16 << 20
#: First length of a prefix, and its growth where it is too frequent.
FIRST_PREFIX, GROWTH = 8, 4
#: Prefixes above the bound are at most this many at each length (8 bytes each are broadcast).
MOST_HEAVY = 400_000

_ROW = "doc_id long, part string, mask int, n long, text binary"


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()
    points = len(text.translate(None, _FOLLOWING))
    failed = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words),
        100 * (len(text) - len(text.translate(None, _CAPITALS))) > MOST_CAPITALS_PERCENT * points,
        len(text.translate(None, SIGNS)) != len(text),
    )
    return sum(1 << k for k, f in enumerate(failed) if f)


class Trie:
    """A compressed trie of byte strings. Nodes are [label, children by first
    byte, terminal]; a terminal is [smallest id, mask, rows by part]."""

    def __init__(self) -> None:
        self.root: list = [b"", {}, None]
        self.size = 0

    def insert(self, text: bytes, doc: int, mask: int, rows: dict[str, int]) -> tuple | None:
        """Put a text in; (id, mask, rows by part) that a smaller id beats."""
        node = self._node(text)
        held = node[2]
        if held is None:
            node[2] = [doc, mask, dict(rows)]
            return None
        if doc > held[0]:
            return doc, mask, rows
        if doc == held[0]:
            for part, n in rows.items():
                held[2][part] = held[2].get(part, 0) + n
            return None
        beaten, node[2] = tuple(held), [doc, mask, dict(rows)]
        return beaten

    def _node(self, text: bytes) -> list:
        node, at, n = self.root, 0, len(text)
        while at < n:
            children = node[1]
            child = children.get(text[at])
            if child is None:
                node = children[text[at]] = [text[at:], {}, None]
                self.size += n - at + NODE_BYTES
                break
            label = child[0]
            if not text.startswith(label, at):
                k = _common(label, text, at)
                child[0] = label[k:]
                child = children[text[at]] = [label[:k], {label[k]: child}, None]
                self.size += NODE_BYTES
            node, at = child, at + len(child[0])
        return node

    def terminals(self) -> Iterator[tuple[bytes, list]]:
        """Texts in byte order, each with its terminal."""
        path = [(b"", self.root)]
        while path:
            before, (label, children, held) = path.pop()
            text = before + label
            if held is not None:
                yield text, held
            path.extend((text, children[b]) for b in sorted(children, reverse=True))


def _common(label: bytes, text: bytes, at: int) -> int:
    """Length of the common beginning of ``label`` and ``text[at:]``, which differ."""
    low, high = 1, min(len(label), len(text) - at)
    while low < high:
        k = (low + high + 1) // 2
        if text.startswith(label[low:k], at + low):
            low = k
        else:
            high = k - 1
    return low


class _Rows:
    """Rows on their way out of a task."""

    def __init__(self) -> None:
        self.kept: list[tuple] = []
        self.bytes = 0

    def add(self, doc: int | None, mask: int, rows: dict[str, int], text: bytes | None = None) -> None:
        for part, n in rows.items():
            self.kept.append((doc, part, mask, n, text))
            self.bytes += 64 + len(text or b"")

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.kept, strict=True)) or [[]] * 5
        types = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary())
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "part", "mask", "n", "text"])
        self.kept, self.bytes = [], 0
        return out


def _tries(rows: Iterator[tuple], whole_keys: bool) -> Iterator[pa.RecordBatch]:
    """Rows (key, doc_id, part, mask, n, text) through tries. Beaten rows leave
    without a text, flagged; of the others each text leaves once. With
    ``whole_keys`` rows come by key and a trie is emptied between keys only."""
    trie, out, last = Trie(), _Rows(), None

    def emptied() -> Iterator[pa.RecordBatch]:
        for text, (doc, mask, parts) in trie.terminals():
            out.add(doc, mask, parts, text)
            if out.bytes >= BLOCK_BYTES // 4:
                yield out.batch()

    for key, doc, part, mask, n, text in rows:
        if trie.size >= BLOCK_BYTES and not (whole_keys and key == last):
            yield from emptied()
            trie = Trie()
        last = key
        beaten = trie.insert(text, doc, mask, {part: n})
        if beaten is not None:
            out.add(beaten[0], beaten[1] | DUPLICATE, beaten[2])
        if out.bytes >= BLOCK_BYTES // 4:
            yield out.batch()
    yield from emptied()
    yield out.batch()


def _block_rows(docs: DataFrame) -> DataFrame:
    """Masks, and each block's texts once, from one pass over ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lost = _Rows()

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc, part, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    mask = text_mask(text)
                    if doc is None:
                        lost.add(None, mask, {part: 1})
                    else:
                        yield None, doc, part, mask, 1, text

        for out in _tries(rows(), False):
            yield out
            if lost.kept:
                yield lost.batch()
        if lost.kept:
            yield lost.batch()

    picked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    return picked.mapInArrow(run, _ROW)


def _prefix(length: int):
    return F.substring("text", 1, length)


def adaptive_keys(rows: DataFrame, bound: int) -> DataFrame:
    """``rows`` with ``key``, a prefix of the text: the shortest of 8, 32, 128, ...
    bytes that holds at most ``bound`` bytes of texts, and ``whole``, set where
    the text ends within a prefix that holds more. Prefixes are counted over all
    rows; a hash names them, as two that share one would be longer, not wrong."""
    open_rows, length, levels = rows.select("text"), FIRST_PREFIX, []
    while True:
        counts = open_rows.groupBy(F.xxhash64(_prefix(length)).alias("_h")).agg(F.sum(F.length("text") + 1).alias("_bytes"))
        heavy = staged(counts.where(F.col("_bytes") > bound).select("_h"), "op13-heavy")
        if heavy.isEmpty():
            break
        levels.append((length, heavy))
        same = F.xxhash64(_prefix(length)) == F.col("_h")
        open_rows = open_rows.where(F.length("text") > length).join(F.broadcast(heavy), same, "left_semi")
        length *= GROWTH
    whole = F.lit(False)
    longer = F.lit(True)
    key = _prefix(FIRST_PREFIX)
    for k, (length, heavy) in enumerate(levels):
        side = heavy.select(F.col("_h").alias(f"_h{k}"))
        rows = rows.join(F.broadcast(side), F.xxhash64(_prefix(length)) == F.col(f"_h{k}"), "left")
        longer = longer & F.col(f"_h{k}").isNotNull()
        whole = whole | (longer & (F.length("text") <= length))
        key = F.when(longer, _prefix(length * GROWTH)).otherwise(key)
    return rows.select("doc_id", "part", "mask", "n", "text", key.alias("key"), whole.alias("whole"))


def _merged(rows: DataFrame, parts: int, *keys) -> DataFrame:
    """Rows of a range of keys through tries; sorted, so that a range larger than
    a block is met key by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _tries((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)), True)

    ranged = rows.repartitionByRange(parts, "key", *keys).sortWithinPartitions("key")
    return ranged.select("key", "doc_id", "part", "mask", "n", "text").mapInArrow(run, _ROW)


def flagged(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (all five filters) and n, the rows that share them."""
    spark = docs.sparkSession
    ship(spark)
    blocks = staged(_block_rows(docs), "op13-blocks")
    narrow = ("doc_id", "part", "mask", "n")
    texts = blocks.where(F.col("text").isNotNull())
    total = texts.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))
    keyed = adaptive_keys(texts, max(total // (4 * parts), total // MOST_HEAVY, 1))
    # Copies of a frequent text come from many blocks: square root many parts meet first.
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(max(2, int(parts**0.5))))
    hot = staged(_merged(keyed.where("whole").withColumn("salt", salt), parts, "salt"), "op13-hot")
    hot_texts = hot.where(F.col("text").isNotNull()).withColumn("key", F.col("text"))
    met = _merged(keyed.where("not whole").drop("whole").unionByName(hot_texts), parts)
    settled = blocks.where(F.col("text").isNull()).unionByName(hot.where(F.col("text").isNull())).unionByName(met)
    return settled.groupBy(*narrow[:3]).agg(F.sum("n").alias("n"))


_ORDERS = ["".join(p) for p in permutations(LETTERS)]


def _tables() -> tuple[np.ndarray, ...]:
    """For each (order, step): the masks kept, removed here, and failing although
    removed earlier; and the filter's number."""
    masks = np.arange(32)
    kept, removed, redundant, which = [], [], [], []
    for order in _ORDERS:
        before = 0
        for letter in order:
            bit = 1 << LETTERS.index(letter)
            fails, gone = (masks & bit) > 0, (masks & before) > 0
            removed.append(fails & ~gone)
            redundant.append(fails & gone)
            before |= bit
            kept.append((masks & before) == 0)
            which.append(LETTERS.index(letter))
    return np.array(kept), np.array(removed), np.array(redundant), np.array(which)


def interactions(cells: DataFrame) -> DataFrame:
    """All orders and steps of each part, from its counts by mask and label."""
    schema = (
        "part string, filter_order string, step int, kept long, removed long, redundant long, "
        "unique_fails long, good_lost long, toxic_lost long, shapley long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, removed, redundant, which = _tables()
        orders, steps = np.repeat(_ORDERS, 5), np.tile(np.arange(1, 6, dtype=np.int32), len(_ORDERS))
        for batch in batches:
            for row in batch.to_pylist():
                n, good, toxic = np.zeros((3, 32), np.int64)
                for c in row["cells"]:
                    n[c["mask"]] += c["n"]
                    good[c["mask"]] += c["n"] if c["good"] else 0
                    toxic[c["mask"]] += c["n"] if c["toxic"] else 0
                gone = removed @ n
                shapley = np.array([gone[which == k].sum() for k in range(5)])
                alone = np.array([n[1 << k] for k in range(5)])
                yield pa.RecordBatch.from_pydict({
                    "part": [row["part"]] * len(steps), "filter_order": orders.tolist(), "step": steps,
                    "kept": kept @ n, "removed": gone, "redundant": redundant @ n, "unique_fails": alone[which],
                    "good_lost": removed @ good, "toxic_lost": removed @ toxic, "shapley": shapley[which],
                })

    # At most 32 masks x 4 labels for a part.
    packed = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells"))
    return packed.mapInArrow(run, schema)


def op13_filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every part, order and step, with what the filter removes there."""
    rows = flagged(docs)
    marks = (
        labels.where(F.col("doc_id").isNotNull() & ((F.col("quality") == 1) | (F.col("toxic") == 1)))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    )
    # Rows without an id have no label: they stay out of the join, where they would meet in one task.
    named = rows.where(F.col("doc_id").isNotNull()).join(marks, "doc_id", "left").select("part", "mask", "n", "good", "toxic")
    lost = rows.where(F.col("doc_id").isNull()).select("part", "mask", "n", F.lit(None).cast("boolean").alias("good"), F.lit(None).cast("boolean").alias("toxic"))
    marked = named.unionByName(lost).select("part", "mask", "n", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    return interactions(marked.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")))


#: Table-wide duplicates by a window, failures as a list, and each mask's first failure in each order.
ORACLE_SQL = r"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS lo FROM d),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT w.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
  [len(ws) < 100, 100 * len(list_distinct(ws)) < 80 * len(ws), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
   regexp_matches(t, '[#$%&*|]'), coalesce(lo < w.doc_id, false)] AS f
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
cells AS (SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE toxic) AS x FROM m GROUP BY part, f),
five AS (SELECT unnest(range(1, 6)) AS i),
orders AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM five a, five b, five c, five d, five e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
firsts AS (SELECT c.*, o.o, coalesce(list_position(list_transform(o.o, lambda k: c.f[k]), true), 9) AS first_fail FROM cells c, orders o),
steps AS (SELECT part, o, s.i AS step,
  sum(CASE WHEN first_fail > s.i THEN n ELSE 0 END) AS kept, sum(CASE WHEN first_fail = s.i THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN f[o[s.i]] AND first_fail < s.i THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN f[o[s.i]] AND len(list_filter(f, lambda b: b)) = 1 THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN first_fail = s.i THEN g ELSE 0 END) AS good_lost, sum(CASE WHEN first_fail = s.i THEN x ELSE 0 END) AS toxic_lost
  FROM firsts, five s GROUP BY part, o, s.i)
SELECT part, array_to_string(list_transform(o, lambda k: substr('ABCDE', k, 1)), '') AS filter_order, CAST(step AS INTEGER) AS step,
  CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, o[step]) AS BIGINT) AS shapley
FROM steps"""
