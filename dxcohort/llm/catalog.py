"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from dxcohort.llm import audit, decontam, html, jaccard, licenses, pieces, pii, quality, repair, secrets, separators, substrings, tokens
from dxcohort.llm.common import table


def _on(name: str, operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


def _decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.op8_benchmark_decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.op13_filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_files": _on("documents", tokens.op1_token_files),
        "op2_html_extraction": _on("pages", html.op2_html_extraction),
        "op3_ngram_jaccard_join": _on("documents", jaccard.op3_ngram_jaccard_join),
        "op4_secret_scan": _on("documents", secrets.op4_secret_scan),
        "op5_license_scan": _on("documents", licenses.op5_license_scan),
        "op6_quality_rules": _on("documents", quality.op6_quality_rules),
        "op7_pii": _on("documents", pii.op7_pii),
        "op8_benchmark_decontamination": _decontamination,
        "op9_sentencepiece": _on("documents", pieces.op9_sentencepiece),
        "op10_token_counts": _on("documents", separators.op10_token_counts),
        "op11_substring_dedup": _on("documents", substrings.op11_substring_dedup),
        "op12_conversation_repair": _on("conversations", repair.op12_conversation_repair),
        "op13_filter_audit": _audit,
        "pipeline": corpus_pipeline.run,
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op3_ngram_jaccard_join": jaccard.ORACLE_SQL,
        "op6_quality_rules": quality.ORACLE_SQL,
        "op11_substring_dedup": substrings.ORACLE_SQL,
        "op12_conversation_repair": repair.ORACLE_SQL,
        "op13_filter_audit": audit.ORACLE_SQL,
    }
