"""Loader for the parquet tables of a data directory (one file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(data_dir: str, name: str) -> str:
    return os.path.join(data_dir, f"{name}.parquet")


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it (see ``explain`` ReadSchema/PushedFilters)."""
    return spark.read.parquet(table_path(data_dir, name))


class Tables:
    """Attribute access to the tables of one directory: ``Tables(spark, d).events``."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.data_dir = data_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            # One DataFrame per table, so column references taken from it stay valid across joins.
            if name not in self._cache:
                self._cache[name] = read_table(self.spark, self.data_dir, name)
            return self._cache[name]
        raise AttributeError(name)
