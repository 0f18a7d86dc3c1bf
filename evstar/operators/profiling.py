"""Lake and topic profiles (A1-A10, O1-O3).

Everything is a distributed aggregate returning a few rows; nothing is
collected per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lake_summary(df: DataFrame, key: str = "event_id") -> DataFrame:
    """``total_rows``, ``distinct_event_ids``, ``duplicate_rows`` (A1, A2).

    A NULL id counts as one distinct value (like a Python set). One group-by
    with map-side partial counts, then a global sum.
    """
    per_key = df.groupBy(F.col(key)).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_rows"),
        F.count(F.lit(1)).cast("long").alias("distinct_event_ids"),
    ).withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_event_ids"))


def rows_per_type(df: DataFrame, type_col: str = "event_type", key: str = "event_id") -> DataFrame:
    """Non-NULL ids per event type (A3)."""
    return df.groupBy(type_col).agg(F.count(key).cast("long").alias("n_events"))


def partition_counts(df: DataFrame, partition: str = "partition") -> DataFrame:
    """Messages per topic partition, ordered by partition (A4, O2)."""
    return df.groupBy(partition).agg(F.count(F.lit(1)).cast("long").alias("n_messages")).orderBy(partition)


def key_summary(df: DataFrame, key: str = "key") -> DataFrame:
    """``messages_without_key`` and ``distinct_keys``."""
    return df.agg(
        F.count_if(F.col(key).isNull()).cast("long").alias("messages_without_key"),
        F.count_distinct(F.col(key)).cast("long").alias("distinct_keys"),
    )


def key_affinity(df: DataFrame, key: str = "key", partition: str = "partition") -> DataFrame:
    """Keys seen on more than one partition, with the sorted partition list.

    The per-key set is bounded by the number of topic partitions, and it is
    built partially in every map task before the shuffle.
    """
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.array_sort(F.collect_set(partition)).alias("partitions"))
        .filter(F.size("partitions") > 1)
    )


def lake_files(spark: SparkSession, path: str, suffix: str = "*.parquet") -> DataFrame:
    """Every data file under ``path`` (recursively) with its size.

    Uses the binary-file source without its content column, so only the
    file listing is read.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", suffix)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("path").alias("file_path"), F.col("length").alias("file_size"))
    )


def rows_per_file(rows: DataFrame) -> DataFrame:
    """``file_path, file_size, n_rows, n_sizes`` of every file that rows come
    from (A9); ``rows`` carries the two ``_metadata`` columns."""
    return rows.groupBy("file_path").agg(
        F.max("file_size").alias("file_size"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("file_size").alias("n_sizes"),
    )


def latest_files(files: DataFrame, n: int = 3) -> DataFrame:
    """The last ``n`` files by path (O1): a top-k report, the limit is the feature."""
    return files.orderBy(F.col("file_path").desc()).limit(n)


def schema_report(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Column names and types of ``df`` (A10); metadata only, no data read."""
    return spark.createDataFrame([(n, t) for n, t in df.dtypes], "column_name string, data_type string")
