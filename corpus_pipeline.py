"""A training corpus from ``documents``: five operators in sequence.

Every stage is ``(spark, docs, sf_dir) -> DataFrame`` over all that the stage
before it kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evstar.llm import quality
from evstar.llm.common import passing_copies, quoted, stored, table
from evstar.llm.decontaminate import remove_documents
from evstar.llm.mixing import mix_sources
from evstar.llm.simhash import RADIUS, SHINGLE_WORDS, keep_one_row
from evstar.llm.token_store import token_output


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier, fitted on the labelled
    documents among ``docs``, rejects."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked fingerprints, with its smallest
    ``doc_id``."""
    return keep_one_row(docs, SHINGLE_WORDS, RADIUS)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which a benchmark window occurs."""
    return remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents to the sources' target weights, in global random
    order, which the files it is written to keep; each copy is a row."""
    return mix_sources(docs).select(*map(quoted, docs.columns))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token files in the shuffled order of its input and reads them
    back, one row per copy."""
    return token_output(docs, by_id=False)


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontaminate_stage),
    ("source_mixing", mixing_stage),
    ("token_output", token_stage),
]

#: The classifier and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet into
    the shared folder and read back as the next stage's input. What a stage
    and the one before it wrote goes when its result is complete."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with passing_copies(spark) as copies:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
            result = copies.pop()
            copies += before
        before = [result]
    return STAGES[-1][1](spark, docs, sf_dir)
