"""A bounded sample of labelled documents for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import keep_first
from .common import held_out, stored


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, size: int) -> DataFrame:
    """``doc_id, text, label, draw`` of at most ``size`` documents: labelled
    ids with the smallest hash; held-out and null ids are never taken.

    A null label is no label; an id labelled both ways takes the larger
    label; of rows that share an id one is taken, the one whose text has the
    smallest hash. ``size`` bounds the rows, and the side that is broadcast.
    ``draw`` is a hash for splitting. Other columns do not matter.
    """
    known = labels.select(F.col("doc_id").alias("sample_id"), F.col(label).cast("int").alias("sample_label"))
    known = known.filter(F.col("sample_label").isNotNull() & F.col("sample_id").isNotNull() & ~held_out(F.col("sample_id")))
    ids = known.groupBy("sample_id").agg(F.max("sample_label").alias("sample_label"))
    ids = ids.withColumn("draw", F.xxhash64("sample_id")).orderBy("draw", "sample_id").limit(size)
    ids = F.broadcast(stored(ids, "sample-ids"))
    rows = docs.select(F.col("doc_id").alias("row_id"), F.coalesce(F.col("text"), F.lit("")).alias("row_text"))
    joined = rows.join(ids, F.col("row_id") == F.col("sample_id")).select(
        F.col("row_id").cast("long").alias("doc_id"), F.col("row_text").alias("text"), F.col("sample_label").alias("label"), "draw"
    )
    # one row of an id in every map task, before the exchange
    return keep_first(joined, ["doc_id"], [F.xxhash64("text"), F.col("text")])
