"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """The third of the rows that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


BROADCAST_ROWS = 1_000_000


def small_side(keys: DataFrame) -> DataFrame:
    """``keys``, a written table of a few numbers a row, to be broadcast if it has at most BROADCAST_ROWS rows.

    With more rows the join shuffles both sides; the result is the same.
    """
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def wrapped(df: DataFrame, **values: Column) -> DataFrame:
    """``df`` with each row in one struct "whole" beside the given columns, so no name of ``df`` can clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole"), *[v.alias(k) for k, v in values.items()])
