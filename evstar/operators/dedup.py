"""Keep one row per key.

``row_number() = 1`` over a key window. Catalyst turns the filter into a
``WindowGroupLimit``: a Partial top-1 per key inside every map task before
the shuffle and a Final one after it. A hot key (even one holding a third of
all rows) therefore ships at most one row per map task, so the exchange
does not skew. Null keys form one group, as in SQL window partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__evstar_rn"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keep_first(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[Column]) -> DataFrame:
    """Rows ranked first within each key by ``order_by`` (QUALIFY row_number()=1)."""
    if not keys:
        raise ValueError("keep_first needs at least one key column")
    window = Window.partitionBy(*[_col(k) for k in keys]).orderBy(*order_by)
    return df.withColumn(_RN, F.row_number().over(window)).filter(F.col(_RN) == 1).drop(_RN)


def first_delivery(
    df: DataFrame,
    key: str = "event_id",
    order: Sequence[str] = ("ingested_at", "kafka_offset"),
) -> DataFrame:
    """One row per event: the earliest ingested copy, then the lowest offset.

    Ascending with NULLs last, the warehouse convention.
    """
    return keep_first(df, [key], [F.col(c).asc_nulls_last() for c in order])


def latest_version(
    df: DataFrame,
    key: str | Sequence[str],
    version: str = "snapshot_date",
    tiebreak: Sequence[Column] = (),
) -> DataFrame:
    """Newest version of each key (W2, W3): ``version`` descending, NULLs first.

    ``tiebreak`` orders rows sharing the same version; without one, which of
    two same-day copies wins is unspecified.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return keep_first(df, keys, [F.col(version).desc_nulls_first(), *tiebreak])


def merge_latest(
    latest: DataFrame | None,
    snapshot: DataFrame,
    key: str | Sequence[str],
    version: str = "snapshot_date",
    tiebreak: Sequence[Column] = (),
) -> DataFrame:
    """Latest version per key after adding one new snapshot to a table that
    already holds the latest version per key (incremental W2/W3).

    Folding the snapshots in date order gives the same rows as
    :func:`latest_version` over all of them, while each step reads only
    the current latest table and the new snapshot, not the whole history.
    Exact when every snapshot date is merged once, after its final write.
    """
    rows = snapshot if latest is None else latest.unionByName(snapshot)
    return latest_version(rows, key, version, tiebreak)
