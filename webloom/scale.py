"""Building blocks that stay exact when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.session import cut_lineage

def _same(left: str, right: str, cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


def position_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, out: str = "pos"
) -> DataFrame:
    """Exact 0-based position of every row within its key, hot keys included.

    ``chunk`` must grow with ``order`` (a day of a timestamp, ``id div 100000``).
    Rows are numbered within (key, chunk), so one key is spread over many tasks;
    the offset of a chunk comes from the chunk sizes, which are a small table.
    """
    keys = list(keys)
    marked = df.withColumn("_chunk", chunk)
    sizes = marked.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    numbered = marked.withColumn("_rn", F.row_number().over(inner) - 1)
    joined = numbered.alias("l").join(offsets.alias("r"), _same("l", "r", [*keys, "_chunk"]))
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns],
        (F.col("l._rn") + F.col("r._before")).cast("bigint").alias(out),
    )


def global_index(df: DataFrame, order: Sequence[str | Column], out: str = "idx") -> DataFrame:
    """0-based index over the whole table in ``order`` (names or sort columns), without a single-task window.

    Range partitioning spreads the rows (a row number of the scan breaks ties, so
    equal sort keys can be split); the numbered parts are written once, and the
    offset of each part is a sum over one row per part.
    """
    tagged = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tagged.repartitionByRange(*order, "_tie").withColumn("_part", F.spark_partition_id())
    fixed = cut_lineage(ranged, "ranged")
    sizes = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_before"))
    inner = Window.partitionBy("_part").orderBy(*order, "_tie")
    return (
        fixed.withColumn("_rn", F.row_number().over(inner) - 1)
        .join(offsets, "_part")
        .withColumn(out, (F.col("_rn") + F.col("_before")).cast("bigint"))
        .drop("_rn", "_before", "_part", "_tie")
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key, the lowest in ``order``, by an aggregation that combines before the shuffle (a sort aggregate when rows hold strings)."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
        .select(*keys, *[F.col("_r")[c].alias(c) for c in rest])
        .select(*df.columns)
    )


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key, the highest in ``order``."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
        .select(*keys, *[F.col("_r")[c].alias(c) for c in rest])
        .select(*df.columns)
    )


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, out: str = "rank") -> DataFrame:
    """The first ``n`` rows of each key. The constant bound lets Spark prune each
    task's rows before the shuffle, so a hot key sends at most n rows per task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= n)
