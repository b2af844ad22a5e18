"""Registered queries of the training-data operators and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import best_fit, bpe, chat_pref, decontam, merkle, odd_sketch, periodic_runs, pii, rule_ledger, secret_scan, suffix_index, url_rules, zstd_quality
from tidewater.llm.util import table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def op2_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_pref.preferences(table(spark, sf_dir, "conversations"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_index.repeats(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zstd_quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents"))


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ledger.judge(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return best_fit.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_preferences": op2_preferences,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_personal_data": op5_personal_data,
    "op6_bpe": op6_bpe,
    "op7_quality": op7_quality,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_rules": op9_rules,
    "op10_decontamination": op10_decontamination,
    "op11_best_fit": op11_best_fit,
    "op12_merkle": op12_merkle,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL: dict[str, str] = {
    "op2_preferences": chat_pref.PREFERENCES_SQL,
    "op4_url_filter": url_rules.judge_sql(),
    "op9_rules": rule_ledger.judge_sql(),
    "op10_decontamination": decontam.contamination_sql(),
    "op12_merkle": merkle.manifest_sql(),
}
