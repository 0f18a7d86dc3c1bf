"""Connected components of an edge table, as rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Parts a node's edges are spread over in a join, so that the centre of a
#: large component is not one key.
SALTS = 16


def _to_smallest(edges: DataFrame, minima: DataFrame) -> DataFrame:
    """``(v, m)`` for every edge ``(u, v)``: its end and the minimum of ``u``."""
    spread = minima.select("u", "m", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    salted = edges.select("u", "v", F.pmod(F.hash("v"), F.lit(SALTS)).alias("s"))
    return salted.join(spread, ["u", "s"]).select("v", "m")


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (long columns ``a`` and
    ``b``) that is not the smallest of its component.

    Alternates two steps until nothing changes: every larger neighbour of a
    node is linked to the smallest node it sees, then every smaller one. The
    rounds grow with the logarithm of the longest chain. Each round's edges
    are written to the shared folder, so lost executors cost one round.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, before = stored(e, "cc"), None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        minima = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _to_smallest(both.filter("v > u"), minima).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _to_smallest(large, lower).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(lower.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        e = stored(small, "cc")
        state = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
