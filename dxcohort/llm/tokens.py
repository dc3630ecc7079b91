"""Token ids: encoding, and a compact file format of frequency-ranked ids.

*Encoding.* ``ByteBpe`` gives what the tokenizers library gives for a whole text.
The byte-level split starts a new piece at a space unless white space stands
on both sides of it, so a text is cut there, and before a line end between two
characters that are no white space; a bounded table keeps the ids of known words,
and new ones go to the library together. A mark like "." that ends a word after a
letter is a piece of its own and is set apart, so "word," and "word" are known as
one. Texts with other runs of white space, or with the text of a special token, are
encoded whole.

*Format.* Ids are replaced by their rank by frequency over all documents (ties:
the smaller id first). Ranks are stored in 1 to 4 bytes; the lengths are in
separate control bytes, four of 2 bits in each. ``decode`` looks lengths and
masks up in numpy tables. The files are blocks of documents in ascending order
of doc_id, kept in Parquet so that Spark's committers write them to any store:
``part`` and ``block`` number them, ``first`` is the place of the block's first
id within its part, and control and data bytes are columns of their own. The
rank table is written beside them. Workers drop the table of known words before
they count, write or read ids.

A null or empty text holds the end id alone. Rows that share a doc_id stay next
to each other in a fixed order; null ids come first; extra columns are ignored;
an empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dxcohort.llm.common import CHUNK_BYTES, arrow_text, runs, ship, staged, worker_tables
from dxcohort.session import scratch_path

END_ID = 2
#: Words whose ids are known (a full table keeps the frequent ones), and their ids
#: (with more than these the table is begun anew).
TABLE_ENTRIES, TABLE_IDS = 800_000, 8_000_000
#: Longer words are not known beyond one slice of texts.
KEEP_CHARS = 48
#: New words that go to the library as one text.
GROUP_WORDS = 1000
#: Ids in a block of the file (more if one document has more), and in a part.
BLOCK_IDS = 1 << 18
PART_IDS = 8_000_000

# A space with white space before it and after it, or at the end; a space before a
# line end (a word that begins with a line end has none before it).
_UNSURE = re.compile(r"\s (?:\s|\Z)| \n")
#: Marks that are set apart at the end of a word, after an ASCII letter.
MARKS = ".,;:!?"
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, np.uint8)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[list(MARKS.encode())] = np.arange(1, len(MARKS) + 1)


def tokenizer_path() -> str:
    """The public 50k byte-level vocabulary; every function takes another path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ByteBpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.cuts = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not spec.get("normalizer")
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.starts_word, self.starts_line = np.zeros((2, self.size), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.starts_word[i] = token.startswith("\u0120")  # the byte-level sign of a space
            self.starts_line[i] = token.startswith("\u010a")  # and of a line end
        self.marks = np.frombuffer(b"\0\0\0\0" + b"".join(self._library(list(MARKS))), np.uint32) if self.cuts else np.zeros(0, np.uint32)
        self.cuts = self.cuts and len(self.marks) == 1 + len(MARKS)
        self._forget()

    def _forget(self) -> None:
        """Known words by row, and each row's ids: a stretch of one array."""
        self.known: dict[str, int] = {}
        self.start, self.count, self.hits = np.zeros((3, 0), np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _shrink(self) -> None:
        """Of a full table the words met most often stay, half of it at most, and
        none that was met once: most words of a text are rare."""
        least = max(2, int(np.sort(self.hits)[-(TABLE_ENTRIES // 2) :][0]))
        stay = np.flatnonzero(self.hits > least if (self.hits >= least).sum() > TABLE_ENTRIES // 2 else self.hits >= least)
        row = np.full(len(self.start), -1)
        row[stay] = np.arange(len(stay))
        self.known = {w: r for w, r in zip(self.known, row[list(self.known.values())].tolist(), strict=True) if r >= 0}
        start, count = self.start[stay], self.count[stay]
        ends = np.cumsum(count)
        self.ids = self.ids[np.repeat(start - ends + count, count) + np.arange(count.sum())]
        self.start, self.count, self.hits = ends - count, count, np.ones(len(stay), np.int64)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """New rows for different words, the ids of " " + word each (of the word alone
        if it begins with a line end). Words without other white space go to the library
        as running text, whose ids are cut at the spaces and line ends; each other one
        by itself."""
        clean, lines, rest = [], [], []
        for w in words:
            bare = w[1:] if w[:1] == "\n" else w
            (rest if not bare or bare != bare.strip() else clean if bare is w else lines).append(w)
        spaced = b"".join(self._library([" " + " ".join(clean[i : i + GROUP_WORDS]) for i in range(0, len(clean), GROUP_WORDS)]))
        cut = b"".join(self._library(["".join(lines[i : i + GROUP_WORDS]) for i in range(0, len(lines), GROUP_WORDS)]))
        text, n = np.frombuffer(spaced + cut, np.uint32), len(spaced) // 4
        begins = np.concatenate([np.flatnonzero(self.starts_word[text[:n]]), n + np.flatnonzero(self.starts_line[text[n:]])])
        alone = self._library([w if w[:1] == "\n" else " " + w for w in rest])
        counts = np.concatenate([np.diff(np.append(begins, len(text))), np.array([len(x) // 4 for x in alone], np.int64)])
        if len(counts) != len(words):
            raise ValueError("the vocabulary does not mark the beginnings of words")
        first = len(self.start)
        self.known.update(zip(clean + lines + rest, range(first, first + len(counts)), strict=True))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(counts) - counts])
        self.count, self.hits = np.concatenate([self.count, counts]), np.append(self.hits, np.zeros(len(counts), np.int64))
        self.ids = np.concatenate([self.ids, text, np.frombuffer(b"".join(alone), np.uint32)])

    def _rows(self, words: list[str]) -> np.ndarray:
        """The rows of different words; new ones are learnt together."""
        known = self.known.get
        rows = [known(w, -1) for w in words]
        new = [w for w, r in zip(words, rows) if r < 0]
        if new:
            self._learn(new)
            rows = [known(w) if r < 0 else r for w, r in zip(words, rows)]
            for w in new:
                if len(w) > KEEP_CHARS:
                    del self.known[w]
        return np.array(rows, np.int64)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text (unsigned 32-bit little-endian). Words are told apart
        by Arrow, so Python sees each different word of ``texts`` once; the ids of
        all occurrences are gathered by their rows."""
        if len(self.start) >= TABLE_ENTRIES:
            self._shrink()
        if len(self.ids) >= TABLE_IDS:
            self._forget()
        out: list = [None] * len(texts)
        plain = [k for k, t in enumerate(texts) if self.cuts and not _UNSURE.search(t) and not any(x in t for x in self.special)]
        whole = sorted(set(range(len(texts))).difference(plain))
        for k, ids in zip(whole, self._library([texts[k] for k in whole]), strict=True):
            out[k] = ids
        if not plain:
            return out
        words = pc.split_pattern(pa.array([_cut_lines(texts[k]) for k in plain], pa.large_string()), " ")
        ends = words.offsets.to_numpy()
        coded = words.values.dictionary_encode()
        at, different = coded.indices.to_numpy(), coded.dictionary
        first = np.zeros(len(at), bool)
        first[ends[:-1]] = True  # no space before it: another word for the library
        firsts = self._library(_strings(different, at[first]))
        mark, stems = _marked(different)
        stems = stems.dictionary_encode()
        at, marked = stems.indices.to_numpy()[at[~first]], mark[at[~first]]
        used = np.flatnonzero(np.bincount(at, minlength=len(stems.dictionary)))
        row = np.zeros(len(stems.dictionary), np.int64)
        row[used] = self._rows(_strings(stems.dictionary, used))
        rows = row[at]
        self.hits += np.bincount(rows, minlength=len(self.hits))
        count = self.count[rows] + (marked > 0)
        total = np.concatenate([[0], np.cumsum(count)])
        place = np.repeat(self.start[rows] - total[:-1], count) + np.arange(total[-1])
        last = total[1:][marked > 0] - 1
        place[last] = 0
        ids = self.ids[place]
        ids[last] = self.marks[marked[marked > 0]]
        bounds = total[ends - np.arange(len(ends))]
        for k, alone, a, b in zip(plain, firsts, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            out[k] = alone + ids[a:b].tobytes()
        return out


def _cut_lines(text: str) -> str:
    """With a space before each line end, if all have other characters than white
    space on both sides."""
    lines = text.split("\n")
    if len(lines) > 1 and all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
        return " \n".join(lines)
    return text


def _marked(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """For each word the place in ``MARKS``, from 1, of a mark that ends it after a
    letter (0: none), and the words without these marks."""
    data, off = arrow_text(words)
    mark, long = np.zeros(len(words), np.uint8), np.flatnonzero(np.diff(off) > 1)
    end = off[1:][long]
    mark[long] = _MARK[data[end - 1]] * _LETTER[data[end - 2]]
    return mark, pc.if_else(pa.array(mark > 0), pc.utf8_slice_codeunits(words, 0, -1), words)


def _strings(column: pa.Array, places: np.ndarray) -> list[str]:
    """Python strings at ``places`` (by way of numpy: several times faster than ``to_pylist``)."""
    return column.take(pa.array(places)).to_numpy(zero_copy_only=False).tolist()


def encoder(path: str) -> ByteBpe:
    """One encoder for each Python worker and vocabulary, so its table is kept. The
    library's threads are off: each worker has one core, and they spin on others'."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    held = worker_tables("tokens")
    if path not in held:
        held[path] = ByteBpe(path)
    return held[path]


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches with a text column, in slices of about a megabyte, and their ids."""
    e = encoder(path)
    for batch in batches:
        texts, low = [], 0
        size = 0
        for d, t in enumerate(batch.column(batch.schema.get_field_index("text"))):
            texts.append(t.as_py() or "")
            size += len(texts[-1])
            if size >= CHUNK_BYTES or d == batch.num_rows - 1:
                yield batch.slice(low, d + 1 - low), e.encode(texts)
                texts, low, size = [], d + 1, 0


# --- variable-length coding --------------------------------------------------------

_CODES = np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3
#: For each control byte: the lengths of its four values, and their masks.
LENGTHS = (_CODES + 1).astype(np.uint8)
MASKS = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)[_CODES]


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, np.uint32)
    code = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    padded = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    padded[: len(v)] = code
    quad = padded.reshape(-1, 4)
    control = quad[:, 0] | quad[:, 1] << 2 | quad[:, 2] << 4 | quad[:, 3] << 6
    data = v.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values, by table lookup of lengths and masks."""
    c = np.frombuffer(control, np.uint8)
    lengths = LENGTHS[c].ravel()[:n]
    start = np.cumsum(lengths, dtype=np.int64) - lengths
    d = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = d[start].astype(np.uint32)
    for i in (1, 2, 3):
        out |= d[start + i].astype(np.uint32) << np.uint32(8 * i)
    return out & MASKS[c].ravel()[:n]


# --- writing and reading -------------------------------------------------------------

def token_table(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, seq (a fixed order of the rows), n_tokens and the ids with the
    end id, compressed; written once, because ranks need all of it first."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze, end = zstandard.ZstdCompressor(level=1).compress, np.array([end_id], np.uint32).tobytes()
        narrow = np.uint16 if max(encoder(path).size, end_id + 1) <= 1 << 16 else np.uint32
        task, row = TaskContext.get().partitionId(), 0
        for batch, coded in encoded(batches, path):
            ids = [np.frombuffer(x + end, np.uint32) for x in coded]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "seq": pa.array([(task << 40) + row + i for i in range(len(ids))], pa.int64()),
                "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                "ids": pa.array([squeeze(x.astype(narrow).tobytes()) for x in ids], pa.binary()),
            })
            row += len(ids)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return staged(rows.mapInArrow(run, "doc_id long, seq long, n_tokens long, ids binary"), "op1-tokens")


def _expand(blob: bytes, n: int) -> np.ndarray:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    return np.frombuffer(raw, np.uint16 if len(raw) == 2 * n else np.uint32)


def ranked_ids(tokens: DataFrame) -> tuple[np.ndarray, int]:
    """All ids that occur, most frequent first, and the number of tokens. At most
    a row for each id of the vocabulary reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables("token-files")
        total = np.zeros(0, np.int64)
        for batch in batches:
            sizes = batch.column(1).to_pylist()
            for low, high in runs(np.concatenate([[0], np.cumsum(sizes)]), BLOCK_IDS):
                blobs = batch.column(0).slice(low, high - low).to_pylist()
                c = np.bincount(np.concatenate([_expand(b, n) for b, n in zip(blobs, sizes[low:high], strict=True)]))
                if len(c) > len(total):
                    total = np.concatenate([total, np.zeros(len(c) - len(total), np.int64)])
                total[: len(c)] += c
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "n": pa.array(total[ids], pa.int64())})

    rows = tokens.select("ids", "n_tokens").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    rows.sort(key=lambda r: (-r["n"], r["id"]))
    return np.array([r["id"] for r in rows], np.uint32), sum(r["n"] for r in rows)


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> None:
    """Encode ``docs`` and write their ids in ascending order of doc_id to
    ``folder``/blocks, and the rank table to ``folder``/ranks."""
    spark = docs.sparkSession
    tokens = token_table(docs, path or tokenizer_path(), end_id)
    order, total = ranked_ids(tokens)
    spark.createDataFrame([(order.tobytes(),)], "ids binary").coalesce(1).write.parquet(f"{folder}/ranks")
    rank = np.zeros(int(order.max()) + 1 if len(order) else 1, np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    sent = spark.sparkContext.broadcast(rank)  # 4 bytes for each id of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables("token-files")
        part, block, first = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal block, first
            ids = np.concatenate([_expand(b, n) for _, n, b in held])
            control, data = pack(sent.value[ids])
            sizes = pack(np.array([n for _, n, _ in held], np.uint32))
            out = pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()),
                "first": pa.array([first], pa.int64()), "n_tokens": pa.array([len(ids)], pa.int64()),
                "doc_ids": pa.array([[d for d, _, _ in held]], pa.list_(pa.int64())),
                "size_control": pa.array([sizes[0]], pa.binary()), "size_data": pa.array([sizes[1]], pa.binary()),
                "control": pa.array([control], pa.binary()), "data": pa.array([data], pa.binary()),
            })
            block, first = block + 1, first + len(ids)
            held.clear()
            return out

        size = 0
        for batch in batches:
            for d, n, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                held.append((d, n, blob.as_py()))
                size += n
                if size >= BLOCK_IDS:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    parts = max(1, -(-total // PART_IDS))
    ordered = tokens.repartitionByRange(parts, "doc_id", "seq").sortWithinPartitions("doc_id", "seq").select("doc_id", "n_tokens", "ids")
    ordered.mapInArrow(
        run,
        "part int, block int, first long, n_tokens long, doc_ids array<long>, size_control binary, size_data binary, control binary, data binary",
    ).write.option("compression", "none").parquet(f"{folder}/blocks")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 from
    the files of ``write_token_files``."""
    ship(spark)
    order = np.frombuffer(spark.read.parquet(f"{folder}/ranks").first()["ids"], np.uint32)
    sent = spark.sparkContext.broadcast(order)
    blocks = spark.read.parquet(f"{folder}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables("token-files")
        for batch in batches:
            for r in batch.to_pylist():
                ids = sent.value[unpack(r["control"], r["data"], r["n_tokens"])].astype("<u4")
                sizes = unpack(r["size_control"], r["size_data"], len(r["doc_ids"])).astype(np.int64)
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([r["part"]] * len(sizes), pa.int32()),
                    "doc_id": pa.array(r["doc_ids"], pa.int64()),
                    "start": pa.array(r["first"] + ends - sizes, pa.int64()),
                    "n_tokens": pa.array(sizes, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(ids[b - n : b].tobytes()) for b, n in zip(ends, sizes, strict=True)], pa.int64()),
                })

    rows = blocks.mapInArrow(run, "part int, doc_id long, start long, n_tokens long, ids_crc32 long")
    # One row for each part (a file); their running sum is a list of that length.
    before, starts = 0, []
    for r in sorted(blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect(), key=lambda r: r["part"]):
        starts.append((r["part"], before))
        before += r["n"]
    offsets = spark.createDataFrame(starts, "part int, before long")
    return rows.join(F.broadcast(offsets), "part").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op1_token_files(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    folder = scratch_path(spark, "op1-files")
    write_token_files(docs, folder)
    return read_token_files(spark, folder)
