"""Incremental latest-snapshot tables for the catalogs (W2/W3 without
re-reading the whole snapshot history on every build).

``{latest_root}/state-N`` holds the latest version per id after state ``N``;
``{latest_root}/merged`` lists, per state, the snapshot days in it with a
signature of their files. A refresh lists the day folders (no row is read)
and merges the days that are new, in any order: a day that arrives after a
newer one is merged like any other, since the later date wins. A day whose
files changed after it was merged cannot be taken out again, so the table is
then rebuilt from all snapshots. Either way the result equals the full
latest-snapshot view. States before the last two are removed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import latest_version, merge_latest
from ..sources.catalogs import read_snapshots
from ..storage import Folders
from .build import materialize

_MERGED = "state int, day string, signature string"
KEPT_STATES = 2


def snapshot_days(spark: SparkSession, catalogs_root: str, name: str) -> dict[str, str]:
    """Each snapshot day with a signature of its files (names, sizes, times),
    from the listing alone."""
    root = f"{catalogs_root.rstrip('/')}/{name}"
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").load(root)
    except AnalysisException:  # no snapshot so far
        return {}
    one = F.concat_ws("|", "path", F.col("length").cast("string"), F.col("modificationTime").cast("string"))
    day = F.regexp_extract("path", r"/snapshot_date=([^/]+)/", 1)
    by_day = files.groupBy(day.alias("day")).agg(F.sha2(F.concat_ws(",", F.array_sort(F.collect_list(one))), 256).alias("signature"))
    return {r["day"]: r["signature"] for r in by_day.filter("day <> ''").collect()}  # one row per day


def _merged(spark: SparkSession, latest_root: str) -> tuple[int, dict[str, str]]:
    try:
        rows = spark.read.schema(_MERGED).parquet(f"{latest_root}/merged").collect()
    except AnalysisException:  # nothing merged yet
        return 0, {}
    state = max((r["state"] for r in rows), default=0)
    return state, {r["day"]: r["signature"] for r in rows if r["state"] == state}


def refresh_latest(spark: SparkSession, catalogs_root: str, name: str, latest_root: str, key: str) -> DataFrame:
    """Bring the latest-per-``key`` table of catalog ``name`` up to date and return it."""
    days = snapshot_days(spark, catalogs_root, name)
    state, merged = _merged(spark, latest_root)
    new = sorted(days.keys() - merged.keys())
    changed = any(days.get(day) != signature for day, signature in merged.items())
    if state and not new and not changed:
        return spark.read.parquet(f"{latest_root}/state-{state}")
    snaps = read_snapshots(spark, catalogs_root, name)
    if changed or not state:
        latest = latest_version(snaps, key)
    else:
        fresh = snaps.filter(F.col("snapshot_date").isin([F.lit(d).cast("date") for d in new]))  # opens these days only
        latest = merge_latest(spark.read.parquet(f"{latest_root}/state-{state}"), latest_version(fresh, key), key)
    latest = materialize(latest, f"{latest_root}/state-{state + 1}")
    entries = [(state + 1, day, signature) for day, signature in sorted(days.items())]
    spark.createDataFrame(entries, _MERGED).coalesce(1).write.mode("append").parquet(f"{latest_root}/merged")
    if state + 1 > KEPT_STATES:
        Folders(spark).remove(f"{latest_root}/state-{state + 1 - KEPT_STATES}")
    return latest
