from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from dxcohort.llm import separators as s
from dxcohort.session import scratch_path


def scan(spark, tmp_path, arrays, block_ids, width=2):
    rows = []
    for k, a in enumerate(arrays):
        path = tmp_path / f"f{k}.bin"
        path.write_bytes(np.array(a, f"<u{width}").tobytes())
        rows.append((k, str(path), width, len(a) * width))
    files = spark.createDataFrame(rows, "file_no int, path string, width int, n_bytes long")
    return sorted(tuple(r) for r in s.document_tokens(files, 9, block_ids).collect())


def brute(arrays):
    out = []
    for k, a in enumerate(arrays):
        start = n = 0
        for at, v in enumerate(a):
            if v == 9:
                out.append((k, n, start, at + 1 - start, True))
                start, n = at + 1, n + 1
        if start < len(a):
            out.append((k, n, start, len(a) - start, False))
    return sorted(out)


@pytest.mark.parametrize("block_ids", [1, 2, 3, 7, 1000])
@pytest.mark.parametrize("width", [2, 4])
def test_against_brute_force(spark, tmp_path, block_ids, width):
    r = np.random.default_rng(block_ids)
    arrays = [
        [], [9], [1], [9, 9, 9], [1, 2, 3, 9], [1] * 40 + [9], [9] + [1] * 40, [1] * 14 + [9, 9] + [2] * 14,
        r.choice([1, 2, 9], 60).tolist(), (r.integers(0, 300, 200) * 257 % 65536).tolist(),
    ]
    assert scan(spark, tmp_path, arrays, block_ids, width) == brute(arrays)


def test_query(spark, make_docs, odd_rows):
    from dxcohort.llm.tokens import ByteBpe, tokenizer_path

    got = s.op10_token_counts(make_docs(odd_rows, extra=True)).collect()
    want = [len(x) // 4 + 1 for x in ByteBpe(tokenizer_path()).encode([t or "" for _, t in odd_rows])]
    assert Counter(r["n_tokens"] for r in got) == Counter(want) and all(r["ended"] for r in got)
    assert s.op10_token_counts(make_docs([])).collect() == []


def test_files_of_lost_attempts_are_ignored(spark, make_docs):
    folder = scratch_path(spark, "test-op10")
    files = s.write_flat_files(make_docs([(1, "one two")]), folder)
    store, base = s._store(folder)
    with store.open_output_stream(f"{base}/part-000000-999.bin") as f:
        f.write(b"\x01\x00\x50\xc4" * 100)
    assert [(r["doc_no"], r["n_tokens"]) for r in s.document_tokens(files).collect()] == [(0, 3)]


def test_stores_of_hadoop_paths():
    from dxcohort.llm.separators import arrow_uri

    assert [arrow_uri(x) for x in ("s3a://b/k/x", "s3n://b/k", "s3://b/k", "hdfs://n:1/x", "gs://b/x", "file:///t/x", "/t/x", "dbfs:/t/x", "dbfs:///t/x")] == [
        "s3://b/k/x", "s3://b/k", "s3://b/k", "hdfs://n:1/x", "gs://b/x", "file:///t/x", "/t/x", "/dbfs/t/x", "/dbfs/t/x"
    ]
