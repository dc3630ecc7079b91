from __future__ import annotations

import random

import corpus_pipeline
from dxcohort.llm import decontam, jaccard, pii, quality
from dxcohort.llm.common import table
from llm.test_decontam import prose
from llm.test_jaccard import brute as jaccard_brute
from llm.test_quality import brute as quality_brute

DIR = "/root/testdata/sf0.001"


def test_each_stage_against_brute_force(spark):
    """Every stage on all that its predecessor kept, its decisions in effect."""
    docs = table(spark, DIR, "documents")
    rows = {r["doc_id"]: r for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "pii", "sentencepiece"]

    out = steps["quality_rules"](spark, docs, DIR)
    good = {i for i, r in rows.items() if quality_brute(r["text"])[-1]}
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == good

    out = steps["ngram_jaccard_join"](spark, out, DIR)
    parts = jaccard_brute([(i, rows[i]["text"]) for i in sorted(good)], jaccard.STAGE_K, jaccard.STAGE_PERCENT)
    stay = {c for _, _, c in parts}
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == sorted(stay)

    out = steps["benchmark_decontamination"](spark, out, DIR)
    squeezed = lambda t: "".join(map(chr, decontam.letters(t)))
    items = [squeezed(r["text"]) for r in table(spark, DIR, "benchmark").collect()]
    clean = {i for i in stay if not any(x in squeezed(rows[i]["text"]) for x in items)}
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == clean

    out = steps["pii"](spark, out, DIR)
    texts = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == docs.columns and set(texts) == clean
    for i, r in texts.items():
        assert r["n_chars"] == len(r["text"]) and pii.base_spans(r["text"]) == []
        assert r["text"] == pii.redacted(rows[i]["text"], pii.base_spans(rows[i]["text"])) or "[" in r["text"]

    last = {r["doc_id"]: r for r in corpus_pipeline.run(spark, DIR).collect()}
    import sentencepiece

    from dxcohort.llm.pieces import model_path

    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    assert set(last) == clean
    assert all(last[i]["ids"] == library.encode(texts[i]["text"]) for i in clean)


def test_planted_cases(spark, make_docs, tmp_path):
    """Copies, a benchmark passage, junk and personal data among clean documents."""
    r = random.Random(1)
    vocabulary = [f"{a}{b}{c}" for a in "bdkmt" for b in ("an", "el", "or") for c in ("ing", "ed", "er", "s")]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    clean = [(k, text(r.randint(60, 200))) for k in range(30)]
    words = clean[3][1].split()
    words[5] = "changed"
    item = prose(r, 30)
    rows = clean + [(100, clean[2][1]), (101, " ".join(words)), (102, text(70) + " " + item + " " + text(20)), (103, "word " * 80), (104, None)]
    rows += [(105, text(80) + " mail me at jane@example.com " + text(10))]
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {x["doc_id"]: x for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    long_enough = {k for k, t in clean if quality.MIN_WORDS <= len(t.split())}
    assert set(got) == long_enough | {105}
    assert got[105]["n_chars"] == len(rows[-1][1]) - len("jane@example.com") + len("[EMAIL]")


def test_empty_documents(spark, make_docs, tmp_path):
    make_docs([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
