"""Registered queries of the training-data operators: each applies its
operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import langid, quality, toxicity
from .common import table
from .conversation_repair import repair_conversations
from .decontaminate import contamination
from .exact_dedup import exact_dedup
from .html_extract import extract_main_text
from .license_scan import scan_licenses
from .mixing import mix_sources
from .oracle import ORACLE_SQL
from .ranked_search import ranked_search
from .secret_scan import find_secrets
from .simhash import simhash_groups
from .token_store import token_output


def op1_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(table(spark, sf_dir, "conversations"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("blocks")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_poisson_mixing,
        op2_secret_scan,
        op3_quality,
        op4_html_extract,
        op5_token_file,
        op6_toxicity,
        op7_decontaminate,
        op8_simhash,
        op9_language,
        op10_exact_dedup,
        op11_conversation_repair,
        op12_license_scan,
        op13_ranked_search,
    )
}

__all__ = ["QUERIES", "ORACLE_SQL"]
