"""Model inputs derived from a folder of the driver's tables (see
:mod:`evstar.sources.testdata` for the stand-in rules)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..sources import testdata as td
from ..sources.tables import read_table
from . import marts, staging


class Inputs:
    """Lazily built DataFrames over ``sf_dir``; nothing runs until an action."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def messages(self) -> DataFrame:
        return td.topic_messages(self.table("events"))

    @cached_property
    def lake_rows(self) -> DataFrame:
        return td.lake_rows(self.messages)

    @cached_property
    def raw_events(self) -> DataFrame:
        return td.raw_events(self.table("events"))

    @cached_property
    def raw_products(self) -> DataFrame:
        return td.product_snapshots(self.table("part"))

    @cached_property
    def raw_customers(self) -> DataFrame:
        return td.customer_snapshots(self.table("customer"), self.table("nation"))

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw_events)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw_products)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw_customers)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return marts.dim_customers(self.stg_customers)

    @cached_property
    def dim_products(self) -> DataFrame:
        return marts.dim_products(self.stg_products)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return marts.fact_orders(self.stg_orders, self.dim_customers, self.dim_products)
