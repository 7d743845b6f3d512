"""Where queries and their SQL oracles are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver's tables as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(key: str, sql: str | None = None):
    def register(make: Callable[[Tables], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir: make(Tables(spark, sf_dir))
        if sql:
            ORACLES[key] = sql
        return make

    return register
