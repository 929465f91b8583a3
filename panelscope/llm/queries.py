"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelscope.llm import centroids, fingerprint, host_reputation, html_main, language, merkle, mixture, neardup, ngram_lm, packing, quality_rank, quality_rules, secret_scan
from panelscope.llm.store import released


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's file, the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op3_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packs(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_quartile_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.main_texts(table(spark, sf_dir, "pages"))


def op7_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rank.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_reputation.judged(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.report(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores, tries = ngram_lm.scored(table(spark, sf_dir, "documents"))
    if tries is not None:
        released(tries)
    return scores


def op12_ns_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_language_id": op2_language_id,
    "op3_sequence_packing": op3_sequence_packing,
    "op4_quartile_fingerprint": op4_quartile_fingerprint,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_main_text": op6_main_text,
    "op7_quality_ranking": op7_quality_ranking,
    "op8_url_reputation": op8_url_reputation,
    "op9_source_mix": op9_source_mix,
    "op10_quality_rules": op10_quality_rules,
    "op11_ngram_lm": op11_ngram_lm,
    "op12_ns_clusters": op12_ns_clusters,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES: dict[str, str] = {
    "op8_url_reputation": host_reputation.ORACLE,
    "op9_source_mix": mixture.ORACLE,
    "op12_ns_clusters": centroids.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
