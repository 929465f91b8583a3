"""Corpus pipeline: stages over `documents`, each written as Parquet and reread as the next one's input.

Every stage takes the documents that its predecessor kept and works on all of
them; all but the last return the columns of `documents`, the last the packed
pieces. A stage reads only the columns it names, so further columns pass
through; empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelscope.llm import mixture, neardup, packing, quality_rules, secret_scan
from panelscope.llm.queries import table, tokenizer_path
from panelscope.llm.store import stored


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, rejected ones go."""
    return quality_rules.kept(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the least id."""
    return neardup.kept(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in a text replaced by its kind."""
    return secret_scan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, in training order; one that it takes twice is there twice."""
    return mixture.curriculum(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.packs(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", drop_low_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("source mix", mix_sources),
    ("packing", pack),
]

#: Tokenisation, text hashing and recursive decoding have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.lower().replace(" ", "-"))
    return docs
