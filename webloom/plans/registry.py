"""Registry of runnable queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy access to the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def stream_path(self, name: str) -> str:
        """A glob for the table: a file stream takes a folder or a glob, not one file's name."""
        return f"{self.root}/{name}[.]parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap
