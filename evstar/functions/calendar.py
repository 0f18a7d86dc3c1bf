"""Calendar helpers: date spine, smart date key and calendar attributes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c: str | Column) -> Column:
    """Smart date key YYYYMMDD as INT (F13 / C2+C3).

    Accepts a DATE or a TIMESTAMP (truncated to its date in the session time
    zone). Computed arithmetically, so no string formatting per row.
    """
    d = F.to_date(_col(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_day_of_week(c: str | Column) -> Column:
    """ISO day of week, Monday=1 .. Sunday=7."""
    return (F.weekday(_col(c)) + 1).cast("int")


def is_weekend(c: str | Column) -> Column:
    """Saturday or Sunday (F16)."""
    return iso_day_of_week(c).isin(6, 7)


def calendar_columns(day: str | Column = "date_day") -> list[Column]:
    """The calendar dimension's attribute columns for a DATE column (M6)."""
    d = _col(day)
    return [
        date_key(d).alias("date_key"),
        d.alias("calendar_date"),
        F.year(d).cast("int").alias("calendar_year"),
        F.quarter(d).cast("int").alias("calendar_quarter"),
        F.month(d).cast("int").alias("calendar_month"),
        F.monthname(d).alias("month_name"),
        F.dayofmonth(d).cast("int").alias("day_of_month"),
        iso_day_of_week(d).alias("day_of_week"),
        F.dayname(d).alias("day_name"),
        is_weekend(d).alias("is_weekend"),
    ]


def date_spine(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """One row per day, ``start`` inclusive, ``end`` exclusive.

    Rows come from ``spark.range`` so generation is split over tasks; the
    row count is the number of calendar days, not a function of the data.
    """
    start_d = dt.date.fromisoformat(str(start))
    end_d = dt.date.fromisoformat(str(end))
    n_days = max((end_d - start_d).days, 0)
    return spark.range(n_days).select(
        F.date_add(F.lit(start_d), F.col("id").cast("int")).alias("date_day")
    )


def date_spine_covering(df: DataFrame, c: str | Column) -> DataFrame:
    """Day spine from the first to the last date found in ``df[c]``, inclusive.

    Lazy: one global min/max aggregate (partial per task, one row shuffled),
    then the day sequence is exploded. The sequence length is the calendar
    span of the data (days), which stays small however many rows there are.
    """
    d = F.to_date(_col(c))
    bounds = df.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    return bounds.select(
        F.explode(F.sequence(F.col("lo"), F.col("hi"), F.expr("INTERVAL 1 DAY"))).alias("date_day")
    )
