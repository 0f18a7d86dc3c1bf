"""Mixing sources to target weights by Poisson replication, in DataFrame
functions only.

A source with share ``w`` of the target and size ``s`` (characters of text)
gets the mean repetition rate ``w * total / s``. Each document inverts a
Poisson distribution with that mean at a uniform number hashed from its id,
its text and a seed, is exploded by the count it gets, and all copies are
shuffled globally by a hash. Rows with the same id and text are told apart by
their place in the input, so each draws for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: A mean above this is drawn as a sum of that many equal independent parts,
#: which keeps each part's distribution table short.
MAX_MEAN = 16.0
#: Rate tables of up to this many sources are broadcast; larger ones join by
#: a shuffle, in which adaptive execution splits a hot source.
MAX_BROADCAST_SOURCES = 10_000
SEED = 17
#: Keys that rows with one id and text are spread over.
SALTS = 16


def hash_uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts joined by ``:``: its
    first 13 hex digits over 2^52."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def mixing_rates(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """One row per source: its size, mean repetition rate, the number of
    parts the mean is split into, and the cumulative distribution of a part.

    Without ``weights`` a source's share is proportional to the square root
    of its size. A source missing from ``weights`` has weight 0. A source
    without any text keeps its rows once on average (rate 1).
    """
    sizes = docs.groupBy(F.col("source").alias("mix_source")).agg(
        F.sum(F.length(F.coalesce(F.col("text"), F.lit("")))).alias("chars")
    )
    if weights is None:
        weight = F.sqrt(F.col("chars").cast("double"))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("mix_source") == name, F.lit(float(value))).otherwise(weight)
    sizes = stored(sizes.withColumn("weight", weight), "mix-sizes")
    total = sizes.agg(F.sum("chars").alias("chars"), F.sum("weight").alias("weight")).first()
    share = F.col("weight") / F.lit(total["weight"] or 1.0)
    rate = F.when(F.col("chars") == 0, 1.0).otherwise(share * F.lit(total["chars"] or 0) / F.nullif(F.col("chars"), F.lit(0)))
    rates = sizes.withColumn("rate", rate)
    rates = rates.withColumn("mix_parts", F.greatest(F.ceil(F.col("rate") / MAX_MEAN).cast("int"), F.lit(1)))
    rates = rates.withColumn("mean", F.col("rate") / F.col("mix_parts"))
    terms = F.sequence(F.lit(1), F.ceil(F.col("mean") + 12 * F.sqrt("mean") + 16).cast("int"))
    first = F.exp(-F.col("mean"))

    def add(acc: Column, k: Column) -> Column:
        last = F.element_at(acc, -1)
        p = last["p"] * F.col("mean") / k
        return F.concat(acc, F.array(F.struct(p.alias("p"), (last["c"] + p).alias("c"))))

    steps = F.aggregate(terms, F.array(F.struct(first.alias("p"), first.alias("c"))), add)
    return rates.withColumn("mix_cdf", F.transform(steps, lambda x: x["c"]))


def _row_names(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__mix_row``, a text that names each row: its id, a hash
    of its text, and 0, or its place in the input where other rows have the
    same id and text. Documents take part in a join only if there are such."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    named = F.concat_ws(":", doc_id, F.md5(F.coalesce(F.col("text"), F.lit(""))))
    repeats = docs.select(named.alias("__mix_of")).groupBy("__mix_of").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeats = stored(repeats.select("__mix_of"), "mix-repeats")
    if repeats.isEmpty():
        return docs.select("*", F.concat(named, F.lit(":0")).alias("__mix_row"))
    place = F.monotonically_increasing_id()
    rows = docs.select("*", named.alias("__mix_name"), place.alias("__mix_place"), F.pmod(place, F.lit(SALTS)).cast("int").alias("__mix_salt"))
    spread = repeats.select("__mix_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__mix_part"))
    joined = rows.join(spread, (F.col("__mix_name") == F.col("__mix_of")) & (F.col("__mix_salt") == F.col("__mix_part")), "left")
    number = F.when(F.col("__mix_of").isNull(), 0).otherwise(F.col("__mix_place") + 1)
    row = F.concat_ws(":", "__mix_name", number.cast("string")).alias("__mix_row")
    return joined.select("*", row).drop("__mix_name", "__mix_place", "__mix_salt", "__mix_of", "__mix_part")


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, seed: int = SEED) -> DataFrame:
    """Copies of ``docs`` in global random order, with ``n_copies`` (of the
    document), ``copy_no`` (from 1) and ``shuffle_key`` added.

    A document drawn zero times has no row. A null source is a source of its
    own; a null text has size 0. Rows that repeat a ``doc_id`` (or have none)
    draw each for itself, also where the text repeats. An empty table gives an
    empty result. Input columns named like a result column, or beginning with
    ``__mix_``, are replaced.
    """
    rates = mixing_rates(docs, weights).select(*[F.col(c).alias(f"__{c}") for c in ("mix_source", "mix_parts", "mix_cdf")])
    rates = stored(rates, "mix-rates")
    if rates.count() <= MAX_BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    taken = {"n_copies", "copy_no", "shuffle_key", "__mix_row", "__mix_name", "__mix_place", "__mix_salt", "__mix_of", "__mix_part", "__mix_source", "__mix_parts", "__mix_cdf"}
    named = _row_names(docs.drop(*[c for c in docs.columns if c.lower() in taken]))
    joined = named.join(rates, F.col("source").eqNullSafe(F.col("__mix_source")))
    # A uniform number for each part, then how many table entries it passes.
    draws = F.transform(
        F.sequence(F.lit(1), F.col("__mix_parts")), lambda j: hash_uniform(F.col("__mix_row"), F.lit(seed), j)
    )
    counts = F.transform(draws, lambda u: F.size(F.filter("__mix_cdf", lambda c: c <= u)))
    n = F.aggregate(counts, F.lit(0), lambda a, x: a + x)
    counted = joined.select("*", n.alias("n_copies")).filter("n_copies > 0").drop("__mix_source", "__mix_parts", "__mix_cdf")
    copies = counted.select("*", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy_no"))
    key = F.md5(F.concat_ws(":", F.lit("order"), F.col("__mix_row"), F.lit(seed), F.col("copy_no")))
    keyed = copies.select("*", key.alias("shuffle_key")).drop("__mix_row")
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
