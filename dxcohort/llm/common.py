"""Shared helpers: table access, staged tables, and a word kernel on Arrow text.

The kernel finds words (runs of bytes other than ASCII white space) and hashes
them for many documents at once with numpy, straight from the Arrow buffers.
Hashes are 64 bits wide; within one document two different words or shingles
share one with probability below 1e-10.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from dxcohort.session import scratch_path

#: Documents are handled in runs of about this many bytes (bounded memory).
CHUNK_BYTES = 1 << 20
#: Rows of an Arrow batch, unless the session asks for fewer.
BATCH_ROWS = 1000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_SEAT = _rng.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context, and
    keep Arrow batches small: texts are long, so rows are a poor measure."""
    sc = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if any(os.path.basename(str(p)) == "dxcohort_pkg.zip" for p in sc._python_includes):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="dxcohort-zip-"), "dxcohort_pkg.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("dxcohort", os.path.relpath(path, root)))
    sc.addPyFile(target)


_TABLES: dict[str, dict] = {}


def worker_tables(operator: str) -> dict:
    """What a Python worker keeps between tasks for one operator. Those of
    others are dropped, so a worker that goes from stage to stage holds one."""
    for other in [o for o in _TABLES if o != operator]:
        del _TABLES[other]
    return _TABLES.setdefault(operator, {})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_text(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column (null: empty) and each row's offsets in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def runs(off: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer document stands alone."""
    low, n = 0, len(off) - 1
    while low < n:
        high = int(np.searchsorted(off, off[low] + limit, "right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for key, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[key] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Words of consecutive documents: byte ranges, and each document's first word."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off = data, off
        n = len(data)
        self.solid = ~_SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = self.solid[:-1], self.solid[1:]
        self.starts = np.flatnonzero(self.solid & (~before | edge[:-1]))
        self.ends = np.flatnonzero(self.solid & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, off)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def per_document(self, flags: np.ndarray) -> np.ndarray:
        """Sums over each document of a number for each byte."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[self.off])

    def hashes(self, lower: bool) -> np.ndarray:
        up, down = _powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((_BYTE_LOWER if lower else _BYTE)[self.data] * up[: len(self.data)], out=total[1:])
        return mix((total[self.ends] - total[self.starts]) * down[self.starts])


def shingles(words: np.ndarray, k: int = 3) -> np.ndarray:
    """Hashes of all runs of ``k`` (up to 16) words; rows are cut by the caller."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(k), np.uint64)
    for i in range(k):
        total += words[i : i + n] * _SEAT[i]
    return mix(total)


def shingle_rows(w: Words, lower: bool, k: int = 3) -> Iterator[np.ndarray]:
    """Each document's shingle hashes, in text order, repeats included; with
    fewer than ``k`` words the whole sequence is the only one."""
    h = w.hashes(lower)
    s = shingles(h, k)
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        if b - a >= k:
            yield s[a : b - k + 1]
        elif b > a:
            yield shingles(h[a:b], int(b - a))
        else:
            yield s[:0]
