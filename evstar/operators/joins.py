"""Joins of the star schema.

No broadcast hints: Catalyst broadcasts a side only when its estimated size
is under ``spark.sql.autoBroadcastJoinThreshold`` (that is the size check),
and AQE re-checks with the real shuffle sizes at runtime. Beyond the
threshold the join is a sort-merge join, and AQE's skew-join splits hot
partitions of the large side (a customer with a third of the orders, or the
NULL keys of guest orders) into several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    take: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Attach ``take`` columns of ``dim`` to ``fact`` by equal ``on``.

    Only ``on`` + ``take`` are read from the dimension (F10); a NULL or
    unmatched key yields NULLs on a left join. The dimension key is expected
    to be unique (checked by the ``unique`` test, not here).
    """
    return fact.join(dim.select(on, *take), on=on, how=how)


def missing_parents(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child key values (non-NULL) with no parent row, with their row counts.

    Both sides are reduced to distinct keys first (partial aggregation in
    every map task), so a key that is hot on either side reaches the
    anti-join as a single row.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias(column))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    parents = parent.select(F.col(field).alias("__parent_key")).filter(F.col("__parent_key").isNotNull()).distinct()
    return keys.join(parents, keys[column] == parents["__parent_key"], "left_anti")
