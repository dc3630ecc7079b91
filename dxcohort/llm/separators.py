"""Token counts of flat token files by a scan for end-of-document ids.

A flat token file holds ids of a fixed width and nothing else: no index, no
header; every document ends with the end id. The scan cuts each file into
blocks of ids, finds the end ids of a block with one vectorised comparison, and
stitches documents that cross blocks: a prefix scan over the blocks of a file
gives, for each block, the number of documents that end before it and the place
of the last end before it.

``write_flat_files`` makes such files from a table, one for each task, with the
rows in the task's order. Tasks write under names of their own attempt and only
the files named by finished tasks are read, so lost or repeated attempts do no
harm. Null and empty texts hold the end id alone; extra columns are ignored; an
empty table makes no files, and an empty result. Ids after the last end id of a
file are a document of their own with ``ended`` false.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dxcohort.llm.common import ship, staged
from dxcohort.llm.tokens import encoded, encoder, tokenizer_path
from dxcohort.session import scratch_path

#: The end-of-document id of the public 50k byte-level vocabulary.
END_ID = 50256
#: Ids that one step of the scan reads.
BLOCK_IDS = 1 << 20


#: Hadoop's names of a store, and the Arrow file systems' name of it.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def arrow_uri(uri: str) -> str:
    """A Hadoop path as Arrow's file systems know it."""
    scheme, mark, rest = uri.partition("://")
    if uri.startswith("dbfs:/"):
        return "/dbfs/" + uri[len("dbfs:") :].lstrip("/")
    return SCHEMES.get(scheme, scheme) + mark + rest if mark else uri


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    uri = arrow_uri(uri)
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def write_flat_files(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """file_no, path, width (bytes of an id) and n_bytes of the files written."""
    ship(docs.sparkSession)
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, out, size = TaskContext.get(), None, 0
        kind = np.dtype("<u2" if max(encoder(path).size, end_id + 1) <= 1 << 16 else "<u4")
        end = np.array([end_id], kind).tobytes()
        for _, coded in encoded(batches, path):
            if out is None:
                store, base = _store(folder)
                store.create_dir(base, recursive=True)
                name = f"{base}/part-{context.partitionId():06d}-{context.taskAttemptId()}.bin"
                out = store.open_output_stream(name)
            block = b"".join(np.frombuffer(x, np.uint32).astype(kind).tobytes() + end for x in coded)
            out.write(block)
            size += len(block)
        if out is not None:
            out.close()
            full = folder.rstrip("/") + name[len(base) :]
            yield pa.RecordBatch.from_pydict({
                "file_no": pa.array([context.partitionId()], pa.int32()), "path": [full],
                "width": pa.array([kind.itemsize], pa.int32()), "n_bytes": pa.array([size], pa.int64()),
            })

    rows = docs.select(F.col("text").cast("string").alias("text"))
    return staged(rows.mapInArrow(run, "file_no int, path string, width int, n_bytes long"), "op10-files")


def separator_ends(files: DataFrame, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row for each block of each file: file_no, block, base (place of its
    first id), n_ids and ends (places in the file of its end ids)."""
    ship(files.sparkSession)
    span = F.col("width") * F.lit(block_ids)
    blocks = files.where("n_bytes > 0").select(
        "file_no", "path", "width", "n_bytes",
        F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("n_bytes") - 1) / span).cast("long"))).alias("block"),
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                store, name = _store(r["path"])
                low = r["block"] * block_ids * r["width"]
                n = min(block_ids * r["width"], r["n_bytes"] - low)
                with store.open_input_file(name) as f:
                    raw = f.read_at(n, low)
                ids = np.frombuffer(raw, "<u2" if r["width"] == 2 else "<u4")
                ends = np.flatnonzero(ids == end_id) + r["block"] * block_ids
                yield pa.RecordBatch.from_pydict({
                    "file_no": pa.array([r["file_no"]], pa.int32()), "block": pa.array([r["block"]], pa.int64()),
                    "n_ids": pa.array([len(ids)], pa.int64()), "ends": pa.array([ends], pa.list_(pa.int64())),
                })

    tasks = files.sparkSession.sparkContext.defaultParallelism * 4
    return blocks.repartition(tasks).mapInArrow(scan, "file_no int, block long, n_ids long, ends array<long>")


def document_tokens(files: DataFrame, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """file_no, doc_no (place of the document in its file, from 0), start
    (place of its first id), n_tokens (with the end id) and ended."""
    blocks = staged(separator_ends(files, end_id, block_ids), "op10-ends")
    before = Window.partitionBy("file_no").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.select("file_no", "block", "n_ids", F.size("ends").cast("long").alias("n"), F.array_max("ends").alias("last"))
    carried = sums.select(
        "file_no", "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.max("last").over(before) + 1, F.lit(0)).alias("open_from"),
    )
    joined = blocks.where(F.size("ends") > 0).join(carried, ["file_no", "block"])
    starts = F.concat(F.array("open_from"), F.transform(F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0))), lambda e: e + 1))
    ended = joined.select("file_no", "docs_before", F.posexplode(F.arrays_zip(starts.alias("start"), F.col("ends").alias("end")))).select(
        "file_no", (F.col("docs_before") + F.col("pos")).alias("doc_no"), F.col("col.start").alias("start"),
        (F.col("col.end") + 1 - F.col("col.start")).alias("n_tokens"), F.lit(True).alias("ended"),
    )
    rest = sums.groupBy("file_no").agg(F.sum("n").alias("doc_no"), F.coalesce(F.max("last") + 1, F.lit(0)).alias("start"), F.sum("n_ids").alias("total"))
    open_ones = rest.where("total > start").select("file_no", "doc_no", "start", (F.col("total") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.union(open_ones)


def op10_token_counts(docs: DataFrame) -> DataFrame:
    """Flat files of all whole texts, then one row for each document found in
    them. The files carry no ids: doc_no is the document's place in its file."""
    folder = scratch_path(docs.sparkSession, "op10-flat")
    return document_tokens(write_flat_files(docs, folder))
