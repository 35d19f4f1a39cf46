"""The registered queries of this package, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from inkveil.llm import (
    dart_minhash, decontaminate, hidden_markov, language, packing, quality_crf, resampling, rule_ledger, spelling, sql, suffix_dedup,
    top_k, toxicity, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(_table(spark, sf_dir, "documents"))


def op3_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op4_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.class_ids(_table(spark, sf_dir, "documents"))


def op5_language_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ledger.verdicts(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failures", "base_failed", "kept")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("item_ids")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op10_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.scores(_table(spark, sf_dir, "documents"))


def op11_maxscore_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(_table(spark, sf_dir, "embeddings"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality_crf, op2_suffix_dedup, op3_warc_normaliser, op4_dart_minhash, op5_language_bayes, op6_toxicity,
        op7_rule_ledger, op8_decontamination, op9_best_fit_packing, op10_hidden_markov, op11_maxscore_top_k,
        op12_importance_resampling, op13_spelling_variants)}


def statements() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express; the others are held against brute force or held-out rows in the tests."""
    return {
        "op3_warc_normaliser": sql.WARC, "op7_rule_ledger": sql.RULE_LEDGER, "op8_decontamination": sql.DECONTAMINATION,
        "op11_maxscore_top_k": sql.TOP_K, "op12_importance_resampling": sql.RESAMPLING, "op13_spelling_variants": sql.SPELLING}
