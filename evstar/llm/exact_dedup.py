"""Exact dedup by skew-safe combining, in DataFrame functions only.

Texts are equal when identical after lower-casing A-Z; the row with the
largest ``doc_id`` stays. The work runs in three steps, and each groups on
the digest *and* the whole normalised text, so two texts that share a digest
never merge:

1. every map task combines its own rows (partial aggregation);
2. rows of a digest are merged per salt, so a text that a third of all rows
   share is spread over ``SALTS`` reducers;
3. the salt winners (at most ``SALTS`` per text) are combined globally.

A row's salt comes from its place in the input, not from its id, so rows that
share an id are spread, too. The rows' ids, digests and salts are written once;
the salts a digest occupies are a bit mask, and labels reach the rows through a
join on (digest, salt) in which no key holds more than about a ``1/SALTS`` part
of the largest group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Reducers one group of equal texts is spread over (bits of a long).
SALTS = 64

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. All-ASCII texts take the built-in ``lower``,
    which is the same there and several times faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept,
    text_sha256``.

    - A null text counts as the empty text.
    - A null ``doc_id`` never wins against a number; if all ids of a group
      are null, ``keep_id`` is null and its rows count as kept.
    - Rows that repeat a ``doc_id`` with equal text are told apart by
      nothing: each is counted in ``group_size`` and all get the same
      labels (all kept when the id is the largest).
    - An empty table gives an empty result; other columns are ignored.

    ``digest`` maps the normalised text to the grouping digest; weaker ones
    than sha256 only cost time, since contents are always compared.
    """
    rows = docs.select(F.col("doc_id"), ascii_lower(F.coalesce(F.col("text"), F.lit(""))).alias("norm"))
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    rows = rows.select("doc_id", "norm", digest(F.col("norm")).alias("digest"), salt.alias("salt"))
    places = stored(rows.drop("norm"), "dedup-rows")
    merged = rows.groupBy("digest", "salt", "norm").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")
    )
    winners = merged.groupBy("digest", "norm").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    winners = stored(
        winners.select("digest", "keep_id", "group_size", sha256_hex(F.col("norm")).alias("text_sha256")),
        "dedup-winners",
    )
    contents = winners.groupBy("digest").agg(
        F.count(F.lit(1)).alias("contents"),
        F.max("keep_id").alias("keep_id"),
        F.max("group_size").alias("group_size"),
        F.max("text_sha256").alias("text_sha256"),
    )
    masks = places.groupBy("digest").agg(F.bit_or(F.expr("shiftleft(1L, salt)")).alias("mask"))
    salts = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda s: F.expr("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), s)) != 0)
    single = contents.filter("contents = 1").join(masks, "digest").select(
        "digest", F.explode(salts).alias("salt"), "keep_id", "group_size", "text_sha256"
    )
    labelled = places.join(stored(single, "dedup-classes"), ["digest", "salt"])
    shared = contents.filter("contents > 1").select("digest")
    if not shared.isEmpty():  # digests that several texts share: compare the texts themselves
        clash = rows.join(shared, "digest", "left_semi")
        own = clash.groupBy("digest", "norm").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        own = own.withColumn("text_sha256", sha256_hex(F.col("norm")))
        labelled = labelled.unionByName(clash.join(own, ["digest", "norm"]).drop("norm"))
    return labelled.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
