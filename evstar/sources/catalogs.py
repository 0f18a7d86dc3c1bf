"""Dated catalog snapshots.

Layout: ``{root}/{name}/snapshot_date=YYYY-MM-DD/*.json``. Writing a day
replaces only that day's folder (dynamic partition overwrite), so re-running
the same day is idempotent and other days stay.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATALOG_SCHEMAS = {
    "products": T.StructType(
        [
            T.StructField("product_id", T.StringType()),
            T.StructField("product_name", T.StringType()),
            T.StructField("category", T.StringType()),
            T.StructField("unit_price", T.DecimalType(10, 2)),
        ]
    ),
    "customers": T.StructType(
        [
            T.StructField("customer_id", T.StringType()),
            T.StructField("full_name", T.StringType()),
            T.StructField("email", T.StringType()),
            T.StructField("city", T.StringType()),
            T.StructField("country", T.StringType()),
            T.StructField("signup_date", T.DateType()),
        ]
    ),
}


def write_snapshot(df: DataFrame, root: str, name: str, snapshot_date: str | dt.date) -> None:
    """Write ``df`` as the ``snapshot_date`` version of catalog ``name``."""
    day = dt.date.fromisoformat(str(snapshot_date))
    write_snapshots(df.withColumn("snapshot_date", F.lit(day)), root, name)


def write_snapshots(df: DataFrame, root: str, name: str) -> None:
    """Write rows that carry their own ``snapshot_date`` in one job; every
    date present is replaced, every other date is kept."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .json(f"{root.rstrip('/')}/{name}")
    )


def read_export(spark: SparkSession, name: str, file: str) -> DataFrame:
    """A catalog export (one JSON array), checked: a text that is cut short or
    does not fit the schema raises, and so does an export without records or
    with a record that has no id."""
    schema = CATALOG_SCHEMAS[name]
    df = spark.read.schema(schema).options(multiLine=True, mode="FAILFAST").json(file)
    key = schema.fields[0].name
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("ids")).first()
    if not seen["n"] or seen["n"] != seen["ids"]:
        raise ValueError(f"{file}: {seen['n']} records, {seen['ids']} with a {key}")
    return df


def read_snapshots(spark: SparkSession, root: str, name: str, json_array: bool = False) -> DataFrame:
    """All snapshots of catalog ``name`` with their ``snapshot_date`` (DATE).

    ``json_array=True`` reads files holding one JSON array each (the
    producer's export format, one record per element); the default reads
    JSON lines as written by :func:`write_snapshot`. The schema is explicit,
    so nothing is inferred and the date partition is typed. A broken record
    raises rather than turning into NULLs.
    """
    schema = T.StructType(CATALOG_SCHEMAS[name].fields + [T.StructField("snapshot_date", T.DateType())])
    return spark.read.schema(schema).options(multiLine=json_array, mode="FAILFAST").json(f"{root.rstrip('/')}/{name}")
