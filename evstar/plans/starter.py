"""The starter model pair (M14): a literal union, then a filter on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def my_first_model(spark: SparkSession) -> DataFrame:
    """Two literal rows, ``1`` and NULL, kept by UNION ALL."""
    one = spark.sql("SELECT CAST(1 AS INT) AS id")
    null = spark.sql("SELECT CAST(NULL AS INT) AS id")
    return one.unionByName(null)


def my_second_model(first: DataFrame) -> DataFrame:
    """Rows of the first model with ``id = 1``."""
    return first.filter(F.col("id") == 1)
