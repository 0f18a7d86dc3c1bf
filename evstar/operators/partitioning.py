"""Parallelism guard for CPU-heavy row-wise work (JSON building/parsing)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def ensure_parallelism(scan: DataFrame, target: int | None = None) -> DataFrame:
    """Round-robin a plain scan over ``target`` tasks (default: the cluster's
    cores) when it has fewer splits than that; no row is dropped.

    A large input already has at least one split per core and passes
    through without a shuffle; a small one read as one or two splits gets
    spread so per-row work uses every core. For plain scans only: counting
    the splits of one plans it and runs no job, but an input that already
    holds an exchange would run its stages.
    """
    target = target or scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= target else scan.repartition(target)
