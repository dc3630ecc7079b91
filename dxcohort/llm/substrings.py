"""Substring dedup by doubling: passages of words that other documents hold as well.

Windows are searched at 7, 13, 26, 52, ... words, each length about twice the one
before. A window of the next length is looked at only where its two halves are
repeated, so texts that are told apart at a short length cost nothing further;
the search ends when no candidate survives. At the first length one window of
seven in each run of 13 words is enough: the one of least hash (a text has the
same one wherever it stands), so a fifth to a quarter of all places is sent.

*Rounds.* Documents are dealt out once, packed into compressed blocks in a table
bucketed by ``slot`` in the shared folder. In each round a block sends the
different hashes of its candidates, once each with the smallest doc_id that holds
them, to the hash's range; the answer is two bits for each: known to another
block, and known there with a smaller doc_id. Answers meet their block through a
join on the bucketing, without another exchange of texts. A passage that stands in
a third of all documents is so one entry for each block, not one for each document.

Windows are compared by 64-bit hashes (words over ``LONG_WORD`` bytes by BLAKE2b).

Defined results: a null text has no words. Rows without a doc_id are kept whole
and take nothing from others; rows that share a doc_id take nothing from each
other, and each has its own result. Documents under 13 words are kept whole. A
very long text is a block of its own. Repeated rows are rows; extra columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxcohort.llm.common import Words, mix, runs, shingles, ship, staged
from dxcohort.session import scratch_path

#: Words of a window whose repeats are removed, and of the first length searched.
WINDOW, FIRST = 13, 7
#: Texts of one partition, of one slot (a block, or more), and of one block (more
#: if one text has more), and those whose hashes make one range.
PART_BYTES, SLOT_BYTES, BLOCK_BYTES, RANGE_BYTES = 64 << 20, 1 << 20, 16 << 20, 16 << 20
LONG_WORD = 128

_A, _B = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_BLOCK = "slot int, block int, ids array<long>, sizes array<long>, data binary"
_ASKED = "range int, slot int, block int, hashes binary, lows binary"
_TOLD = "slot int, block int, range int, shared binary, smaller binary"


# --- blocks ---------------------------------------------------------------------------

def blocks(docs: DataFrame) -> tuple[DataFrame, int]:
    """The documents in blocks of a bucketed table, and the number of hash ranges.
    Slots and ranges follow the bytes of the texts, not the number of partitions."""
    spark = docs.sparkSession
    ship(spark)
    picked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    total = picked.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))
    slots, ranges = -(-total // SLOT_BYTES) + 1, -(-total // RANGE_BYTES) + 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        held: dict[int, list] = {}
        sizes: dict[int, int] = {}
        numbers: dict[int, int] = {}

        def flush(slot: int) -> pa.RecordBatch:
            rows, number = held.pop(slot), numbers.get(slot, 0)
            sizes[slot], numbers[slot] = 0, number + 1
            return pa.RecordBatch.from_pydict({
                "slot": pa.array([slot], pa.int32()), "block": pa.array([number], pa.int32()),
                "ids": pa.array([[i for i, _ in rows]], pa.list_(pa.int64())),
                "sizes": pa.array([[len(t) for _, t in rows]], pa.list_(pa.int64())),
                "data": pa.array([squeeze(b"".join(t for _, t in rows))], pa.binary()),
            })

        for batch in batches:
            for slot, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault(slot, []).append((doc, text))
                sizes[slot] = sizes.get(slot, 0) + len(text)
                if sizes[slot] >= BLOCK_BYTES:
                    yield flush(slot)
        for slot in list(held):
            yield flush(slot)

    # The seat keeps repeated rows apart, so that no slot is hot.
    seat = F.monotonically_increasing_id()
    dealt = picked.withColumn("slot", F.pmod(F.xxhash64("doc_id", seat), F.lit(slots)).cast("int")).select("slot", "doc_id", "text")
    name = f"op11_{uuid.uuid4().hex}"
    packed = dealt.repartition(n, "slot").mapInArrow(pack, _BLOCK)
    packed.write.bucketBy(n, "slot").option("path", scratch_path(spark, "op11-blocks")).option("compression", "none").saveAsTable(name)
    corpus = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files stay, and the frame has their place and buckets
    return corpus, ranges


class Block:
    """Texts of a block, their words' hashes and places."""

    def __init__(self, ids: list, sizes: list, data: bytes):
        import zstandard

        self.raw = zstandard.ZstdDecompressor().decompress(data) if sum(sizes) else b""
        self.off = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))]).astype(np.int64)
        self.known = np.array([i is not None for i in ids], bool)
        self.ids = np.array([i or 0 for i in ids], np.int64)
        hashes, counts = [], []
        text = np.frombuffer(self.raw, np.uint8)
        for a, b in runs(self.off):
            w = Words(text[self.off[a] : self.off[b]], self.off[a : b + 1] - self.off[a])
            hashes.append(_word_hashes(w))
            counts.append(w.counts())
        self.counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.document = np.repeat(np.arange(len(self.counts)), self.counts)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])

    def texts(self) -> Iterator[bytes]:
        for a, b in zip(self.off[:-1], self.off[1:], strict=True):
            yield self.raw[a:b]


def _word_hashes(w: Words) -> np.ndarray:
    """The shared kernel's hashes; a long word's by BLAKE2b, as crafted long words
    can share a polynomial hash."""
    h = w.hashes(False)
    for k in np.flatnonzero(w.ends - w.starts > LONG_WORD):
        word = w.data[w.starts[k] : w.ends[k]].tobytes()
        h[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return h


# --- levels ----------------------------------------------------------------------------

class Entries:
    """Windows of one length at ``places``; each different hash once, in order,
    with the smallest and largest doc_id that holds it."""

    def __init__(self, places: np.ndarray, hashes: np.ndarray, ids: np.ndarray):
        self.places, self.ids = places, ids
        self.hashes, self.at = np.unique(hashes, return_inverse=True)
        self.low = np.full(len(self.hashes), np.iinfo(np.int64).max)
        self.high = np.full(len(self.hashes), np.iinfo(np.int64).min)
        np.minimum.at(self.low, self.at, ids)
        np.maximum.at(self.high, self.at, ids)

    def ranges(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of hashes that occur, and where each begins (one more at the end)."""
        r = ((self.hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
        which, first = np.unique(r, return_index=True)
        return which, np.append(first, len(r))

    def told(self, answers: dict[int, tuple[bytes, bytes]], n: int) -> tuple[np.ndarray, np.ndarray]:
        """For each place: another document holds the window; one of smaller id does."""
        shared, smaller = np.zeros((2, len(self.hashes)), bool)
        which, first = self.ranges(n)
        for r, a, b in zip(which.tolist(), first[:-1], first[1:], strict=True):
            if r in answers:
                for out, bits in zip((shared, smaller), answers[r], strict=True):
                    out[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
        return (shared | (self.low < self.high))[self.at], smaller[self.at] | (self.low[self.at] < self.ids)


def climb(b: Block, answers: list[dict], n: int) -> tuple[Entries | None, tuple[np.ndarray, np.ndarray] | None]:
    """The windows to ask for after ``answers`` to the lengths before, and the
    places and flags of the last length answered."""
    doc_ids = b.ids[b.document]
    length = FIRST
    h = shingles(b.words, FIRST)

    def inside(places: np.ndarray, length: int) -> np.ndarray:
        places = places[places + length <= len(b.words)]
        same = b.document[places] == b.document[places + length - 1]
        return places[same & b.known[b.document[places]]]

    whole = inside(np.arange(max(len(b.words) - WINDOW + 1, 0)), WINDOW)
    best, anchor = h[whole], whole.copy()
    for j in range(1, WINDOW - FIRST + 1):
        other = h[whole + j]
        better = other < best
        best, anchor = np.where(better, other, best), np.where(better, whole + j, anchor)
    places = np.unique(anchor)
    entries, last = Entries(places, h[places], doc_ids[places]), None
    for level, told in enumerate(answers):
        shared, smaller = entries.told(told, n)
        last = entries.places, smaller
        marked = np.zeros(len(b.words) + 1, bool)
        marked[entries.places[shared]] = True
        step = WINDOW - FIRST if level == 0 else length
        h = mix(h[: max(len(h) - step, 0)] * _A + h[step:] * _B)
        length += step
        if level == 0:
            places = whole[marked[anchor]]
        else:
            places = inside(entries.places[shared], length)
            places = places[marked[places + step]]
        entries = Entries(places, h[places], doc_ids[places])
    return entries, last


def _with_answers(corpus: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Each block with all answers of its slot: level, block, range, two bit strings."""
    if not levels:
        return corpus.select("*", F.lit(None).cast("array<struct<level:int,block:int,range:int,shared:binary,smaller:binary>>").alias("told"))
    rows = None
    for k, told in enumerate(levels):
        one = told.select("slot", F.struct(F.lit(k).alias("level"), "block", "range", "shared", "smaller").alias("_t"))
        rows = one if rows is None else rows.unionByName(one)
    return corpus.join(rows.groupBy("slot").agg(F.collect_list("_t").alias("told")), "slot", "left").select(*corpus.columns, "told")


def _blocks_of(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[tuple[int, int, Block, list[dict]]]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            answers: list[dict] = [{} for _ in range(levels)]
            for t in row["told"] or ():
                if t["block"] == row["block"]:
                    answers[t["level"]][t["range"]] = t["shared"], t["smaller"]
            yield row["slot"], row["block"], Block(row["ids"], row["sizes"], row["data"]), answers


def _answer(group: pa.Table) -> pa.Table:
    """Of a range of hashes: which are known to several blocks, and which with a
    smaller doc_id. Rows without any are left out."""
    parts = [np.frombuffer(x, np.uint64) for x in group.column("hashes").to_pylist()]
    ends = np.cumsum([len(p) for p in parts])
    hashes = np.concatenate(parts)
    lows = np.concatenate([np.frombuffer(x, np.int64) for x in group.column("lows").to_pylist()])
    order = np.argsort(hashes, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(hashes[order]) != 0])
    size = np.diff(np.append(first, len(order)))
    shared, smaller = np.zeros((2, len(hashes)), bool)
    shared[order] = np.repeat(size > 1, size)
    smaller[order] = np.repeat(np.minimum.reduceat(lows[order], first), size) < lows[order]
    out = []
    keys = zip(*(group.column(c).to_pylist() for c in ("slot", "block", "range")), strict=True)
    for key, a, b in zip(keys, np.r_[0, ends[:-1]], ends, strict=True):
        if shared[a:b].any():
            out.append((*key, np.packbits(shared[a:b]).tobytes(), np.packbits(smaller[a:b]).tobytes()))
    columns = list(zip(*out, strict=True)) or [[]] * 5
    types = (pa.int32(),) * 3 + (pa.binary(),) * 2
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["slot", "block", "range", "shared", "smaller"])


def _round(corpus: DataFrame, ranges: int, levels: list[DataFrame]) -> DataFrame:
    """The answers to the next length; empty if no candidate is repeated."""
    asked = len(levels)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, block, b, answers in _blocks_of(batches, asked):
            e, _ = climb(b, answers, ranges)
            which, first = e.ranges(ranges)
            spans = list(zip(first[:-1], first[1:], strict=True))
            yield pa.RecordBatch.from_pydict({
                "range": pa.array(which, pa.int32()),
                "slot": pa.array([slot] * len(which), pa.int32()), "block": pa.array([block] * len(which), pa.int32()),
                "hashes": pa.array([e.hashes[x:y].tobytes() for x, y in spans], pa.binary()),
                "lows": pa.array([e.low[x:y].tobytes() for x, y in spans], pa.binary()),
            })

    questions = _with_answers(corpus, levels).mapInArrow(ask, _ASKED)
    return staged(questions.groupBy("range").applyInArrow(_answer, _TOLD), "op11-answers")


# --- results ------------------------------------------------------------------------------

def strip_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, ``kept``, the
    words that stay. A word goes if a window of 13 words over it also starts in a
    document with a smaller doc_id."""
    corpus, ranges = blocks(docs)
    levels: list[DataFrame] = []
    for _ in range(2):  # 7 words, then 13
        levels.append(_round(corpus, ranges, levels))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, b, answers in _blocks_of(batches, 2):
            _, (places, smaller) = climb(b, answers, ranges)
            edge = np.zeros(len(b.words) + WINDOW + 1, np.int64)
            edge[places[smaller]] += 1
            edge[places[smaller] + WINDOW] -= 1
            gone = np.cumsum(edge)[: len(b.words)] > 0
            removed = np.add.reduceat(np.append(gone, False), b.starts[:-1]) * (b.counts > 0) if len(b.counts) else np.zeros(0, np.int64)
            kept = []
            for d, text in enumerate(b.texts()):
                words = text.split()
                if removed[d]:
                    words = compress(words, (~gone[b.starts[d] : b.starts[d + 1]]).tolist())
                kept.append(b" ".join(words))
            out = {
                "doc_id": pa.array([i if k else None for i, k in zip(b.ids.tolist(), b.known.tolist(), strict=True)], pa.int64()),
                "n_words": pa.array(b.counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            }
            if with_text:
                out["kept"] = pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept binary" if with_text else "")
    out = _with_answers(corpus, levels).mapInArrow(strip, schema)
    return out.withColumn("kept", F.col("kept").cast("string")) if with_text else out


def longest_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and ``longest``, the words of the longest window (13, 26, 52, ...)
    that also starts in a document with a smaller doc_id; 0 without any. Doubles
    until no candidate survives."""
    corpus, ranges = blocks(docs)
    levels = [_round(corpus, ranges, [])]
    while not (told := _round(corpus, ranges, levels)).isEmpty():
        levels.append(told)
    rounds = len(levels)
    # Windows that only documents of one block share are not in the answers; the
    # block goes on by itself where the rounds have ended.

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, b, answers in _blocks_of(batches, rounds):
            longest, length, level = np.zeros(len(b.counts), np.int64), FIRST, 1
            while True:
                _, last = climb(b, (answers + [{}] * level)[: level + 1], ranges)
                length += WINDOW - FIRST if level == 1 else length
                if not len(last[0]):
                    break
                longest[np.unique(b.document[last[0][last[1]]])] = length
                level += 1
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([i if k else None for i, k in zip(b.ids.tolist(), b.known.tolist(), strict=True)], pa.int64()),
                "longest": pa.array(longest, pa.int64()),
            })

    return _with_answers(corpus, levels).mapInArrow(measure, "doc_id long, longest long")


def op11_substring_dedup(docs: DataFrame) -> DataFrame:
    return strip_repeats(docs, with_text=False)


#: All windows with their words, and the smallest doc_id of each.
ORACLE_SQL = r"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT k, doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS w
  FROM (SELECT k, doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d WHERE len(ws) >= 13)),
hits AS (SELECT k, i FROM (SELECT k, i, doc_id, min(doc_id) OVER (PARTITION BY w) AS lo FROM starts) WHERE lo < doc_id),
gone AS (SELECT DISTINCT k, i + j AS i FROM hits, range(13) r(j)),
words AS (SELECT k, ws[i] AS w, i FROM (SELECT k, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)),
kept AS (SELECT k, string_agg(w, ' ' ORDER BY i) AS t FROM words WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.k = words.k AND g.i = words.i) GROUP BY k),
n AS (SELECT k, count(*) AS n FROM gone GROUP BY k)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (k) LEFT JOIN n USING (k)"""
