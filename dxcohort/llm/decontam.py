"""Benchmark decontamination by the q-gram lemma.

Texts are compared as their letters and digits, lower-cased (decorations,
punctuation and white space drop out). Every benchmark item is covered by
windows of ``WINDOW`` such characters, one from every start; a document is
contaminated by an item if some region of it aligns to one of the item's
windows with at most 5 % edits (``EDIT_PERCENT``). So every verbatim passage of
``WINDOW`` characters is found, wherever it begins. Of a shorter item nine
tenths are enough, but no fewer than ``LEAST_CHARS``.

* Lemma: a region within e edits of a window of w characters shares at least
  w + 1 - Q * (e + 1) of its q-grams with it, all within e diagonals of
  the alignment's first one. Shared q-grams are counted in overlapping bands of
  2e + 2 diagonals, e + 1 apart, so every run of e + 1 diagonals lies whole in
  one band.
* Regions that reach the count are verified by a banded alignment.

The benchmark is a stated query set: it is read in blocks of at most
``BLOCK_CHARS`` characters, each broadcast in turn, against all documents.
An item with fewer than ``LEAST_CHARS`` letters and digits matches where its
words stand next to each other, exactly and whole (an item of one common word is
in every document that has the word: leave such items out); one without any
letter or digit matches nothing. An item without an id counts as any other, its pairs
have a null item_id. Null or empty texts match nothing; repeated rows are
judged one by one; empty tables give empty results; extra columns are ignored
(``drop_contaminated`` carries them along).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxcohort.llm.common import ship, worker_tables

Q = 12
WINDOW = 50
EDIT_PERCENT = 5
LEAST_CHARS = 30
#: Benchmark characters broadcast at once: about 40 MB with the q-gram table.
BLOCK_CHARS = 2_000_000
#: Letters of a document that are in memory as q-grams at once.
SLICE = 1_000_000
#: Windows that are aligned at once.
PAIRS = 10_000
_TABLE_BITS = 22

_KEEP = np.zeros(0x3000, bool)
_KEEP[[c for c in range(0x3000) if chr(c).isalnum()]] = True
_WORD = re.compile(r"[^\W_]+")
_MUL = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


def letters(text: str) -> np.ndarray:
    """Lower-cased letters and digits as code points (from U+3000 on, all)."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return c[(c >= 0x3000) | _KEEP[np.minimum(c, 0x2FFF)]]


def words(text: str) -> list[str]:
    """Runs of letters and digits, lower-cased."""
    return _WORD.findall(text.lower())


def grams(c: np.ndarray) -> np.ndarray:
    """Hashes of all runs of Q = 12 code points: of 3, 3 + 3 and 6 + 6."""
    if len(c) < Q:
        return np.zeros(0, np.uint64)
    h = c.astype(np.uint64)
    h = (h[:-2] << np.uint64(42)) ^ (h[1:-1] << np.uint64(21)) ^ h[2:]  # exact: 21 bits a code point
    h *= _MUL[0]
    h ^= h >> np.uint64(29)
    h = h[:-3] * _MUL[1] + h[3:]
    h ^= h >> np.uint64(31)
    return h[:-6] * _MUL[2] + h[6:]


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h * _MUL[0]) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


class Windows:
    """(start, length, edits, least grams) of the windows of an item, one from every start."""

    def __init__(self, chars: int):
        self.length = max(min(chars, LEAST_CHARS), min(WINDOW, chars * 9 // 10)) if chars >= LEAST_CHARS else 0
        self.edits = self.length * EDIT_PERCENT // 100
        self.need = self.length + 1 - Q * (self.edits + 1)
        self.n = chars - self.length + 1 if self.length else 0

    def __len__(self) -> int:
        return self.n

    def __iter__(self) -> Iterator[tuple[int, int, int, int]]:
        return ((start, self.length, self.edits, self.need) for start in range(self.n))


class Block:
    """Some benchmark items, their windows and an index of their q-grams."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids, self.chars = ids, [letters(t) for t in texts]
        self.windows = [Windows(len(c)) for c in self.chars]
        hashes, items, places = [], [], []
        for k, c in enumerate(self.chars):
            if not self.windows[k]:
                continue
            h = grams(c)
            hashes.append(h)
            items.append(np.full(len(h), k))
            places.append(np.arange(len(h)))
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hash = h[order]
        self.item = np.concatenate(items)[order] if items else np.zeros(0, np.int64)
        self.place = np.concatenate(places)[order] if places else np.zeros(0, np.int64)
        self.short: dict[str, list[tuple[list[str], int]]] = {}  # by first word
        for k, t in enumerate(texts):
            if 0 < len(self.chars[k]) < LEAST_CHARS:
                w = words(t)
                self.short.setdefault(w[0], []).append((w, k))
        self.seen = np.zeros(1 << _TABLE_BITS, bool)
        self.seen[_slot(self.hash)] = True

    def hits(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document place, item, item place) of every shared q-gram."""
        h = grams(c)
        at = np.flatnonzero(self.seen[_slot(h)])
        low = np.searchsorted(self.hash, h[at], "left")
        n = np.searchsorted(self.hash, h[at], "right") - low
        at, low, n = at[n > 0], low[n > 0], n[n > 0]
        entry = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.repeat(at, n), self.item[entry], self.place[entry]


def banded_many(windows: np.ndarray, text: np.ndarray, low: np.ndarray, width: int, edits: int) -> np.ndarray:
    """For each row of ``windows``: least edits of an alignment to ``text`` on the
    ``width`` diagonals (text place - window place) from its ``low`` on; edits + 1
    if there are more. Only the cells of the band are kept for each step."""
    far = edits + 1
    steps = np.arange(width)
    place = low[:, None] + steps  # text characters used before, by diagonal, at row 0
    row = np.where((place >= 0) & (place <= len(text)), 0, far)
    for i in range(windows.shape[1]):
        j = i + place  # the text character that row i + 1 uses on each diagonal
        inside = (j >= 0) & (j < len(text))
        miss = text[np.clip(j, 0, max(len(text) - 1, 0))] != windows[:, i, None] if len(text) else np.ones(j.shape, bool)
        new = np.where(inside, row + miss, far)
        # the window character without a partner: from the next diagonal above
        new[:, :-1] = np.minimum(new[:, :-1], np.where((j[:, :-1] + 1 >= 0) & (j[:, :-1] + 1 <= len(text)), row[:, 1:] + 1, far))
        new = np.minimum.accumulate(new - steps, axis=1) + steps  # text characters without a partner
        row = np.where((j + 1 >= 0) & (j + 1 <= len(text)), np.minimum(new, far), far)
    return row.min(axis=1)


def banded(window: np.ndarray, text: np.ndarray, low: int, high: int, edits: int) -> int | None:
    """The same for one window, on the diagonals ``low`` to ``high``; None beyond ``edits``."""
    got = int(banded_many(window[None, :], text, np.array([low]), high - low + 1, edits)[0])
    return got if got <= edits else None


def _rich(diag: np.ndarray, spot: np.ndarray, windows: Windows, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(window start, band) pairs with enough different shared q-grams, of the
    ``size`` q-grams of an item. Band b holds the diagonals from b * step to (b + 2) * step - 1."""
    half = diag // (windows.edits + 1)
    key = np.unique(np.concatenate([half, half - 1]) * size + np.concatenate([spot, spot]))
    band, place = key // size, key % size
    # ``need`` neighbours of one band within a window: a start per run of places
    reach, n = windows.length - Q, windows.need
    first = np.arange(max(len(key) - n + 1, 0))
    last = first + n - 1
    tight = (band[first] == band[last]) & (place[last] - place[first] <= reach)
    band, from_, to = band[first[tight]], np.maximum(place[last[tight]] - reach, 0), np.minimum(place[first[tight]], windows.n - 1)
    keep = from_ <= to
    band, from_, to = band[keep], from_[keep], to[keep]
    n = to - from_ + 1
    start = np.repeat(from_ - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    pairs = np.unique(np.repeat(band, n) * size + start)
    return pairs % size, pairs // size


def window_edits(c: np.ndarray, block: Block) -> dict[tuple[int, int], int]:
    """(item number, window number) -> least edits, of the windows that align."""
    out: dict[tuple[int, int], int] = {}
    at, item, place = block.hits(c)
    order = np.argsort(item, kind="stable")
    at, item, place = at[order], item[order], place[order]
    items, low, count = np.unique(item, return_index=True, return_counts=True)
    for k, a, n in zip(items.tolist(), low.tolist(), count.tolist(), strict=True):
        windows = block.windows[k]
        if n < windows.need:
            continue
        chars, (w, e) = block.chars[k], (windows.length, windows.edits)
        starts, bands = _rich(at[a : a + n] - place[a : a + n], place[a : a + n], windows, len(chars) - Q + 1)
        if not len(starts):
            continue
        whole = np.lib.stride_tricks.sliding_window_view(chars, w)
        step = e + 1
        best = np.full(windows.n, e + 1)
        for i in range(0, len(starts), PAIRS):
            s, b = starts[i : i + PAIRS], bands[i : i + PAIRS]
            got = banded_many(whole[s], c, b * step + s - e, 2 * step + 2 * e, e)
            np.minimum.at(best, s, got)
        for number in np.flatnonzero(best <= e).tolist():
            out[k, number] = int(best[number])
    return out


def matches(c: np.ndarray, block: Block) -> dict[int, tuple[int, int]]:
    """item number -> (windows that align, least edits) for one document, in
    slices that overlap by more than an aligned region."""
    best: dict[tuple[int, int], int] = {}
    for low in range(0, max(len(c), 1), SLICE):
        for key, e in window_edits(c[low : low + SLICE + 2 * WINDOW], block).items():
            best[key] = min(e, best.get(key, e))
    out: dict[int, tuple[int, int]] = {}
    for (k, _), e in best.items():
        n, least = out.get(k, (0, e))
        out[k] = (n + 1, min(least, e))
    return out


def text_matches(text: str, block: Block) -> dict[int, tuple[int, int]]:
    """``matches`` of a text, and the short items whose words it holds in a row."""
    out = matches(letters(text), block)
    if block.short:
        w = words(text)
        for i, first in enumerate(w):
            for item, k in block.short.get(first, ()):
                if w[i : i + len(item)] == item:
                    out[k] = (1, 0)
    return out


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[Block]:
    """The benchmark in blocks of bounded size, one on the driver at a time."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    for item_id, text in rows.toLocalIterator():
        if ids and size + len(text) > block_chars:
            yield Block(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(item_id)
        texts.append(text)
        size += len(text)
    if ids:
        yield Block(ids, texts)


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows (of the item that align), edits (the least)
    for every document row and item that it contains."""
    spark = docs.sparkSession
    ship(spark)
    schema = "doc_id long, item_id long, n_windows int, edits int"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for block in blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            worker_tables("decontam")
            block = sent.value
            for batch in batches:
                out = {"doc_id": [], "item_id": [], "n_windows": [], "edits": []}
                ids, texts = batch.column(0), batch.column(1)
                for d in range(batch.num_rows):
                    text = texts[d].as_py()
                    if not text:
                        continue
                    for k, (n, e) in text_matches(text, block).items():
                        for name, v in zip(out, (ids[d].as_py(), block.ids[k], n, e), strict=True):
                            out[name].append(v)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": pa.array(out["doc_id"], pa.int64()), "item_id": pa.array(out["item_id"], pa.int64()),
                     "n_windows": pa.array(out["n_windows"], pa.int32()), "edits": pa.array(out["edits"], pa.int32())}
                )

        part = rows.mapInArrow(scan, schema)
        found = part if found is None else found.union(part)
    return found if found is not None else spark.createDataFrame([], schema)


def op8_benchmark_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminations(docs, benchmark)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The document rows that contain no item, all columns unchanged; judged in
    place, block by block."""
    spark = docs.sparkSession
    ship(spark)
    for block in blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            worker_tables("decontam")
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text"))
                clean = [not (t := texts[d].as_py()) or not text_matches(t, sent.value) for d in range(batch.num_rows)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(scan, docs.schema)
    return docs
