"""Set operations over entity and lexicon tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_entities(sources: Sequence[DataFrame]) -> DataFrame:
    """Distinct union of one-column sources."""
    return reduce(DataFrame.unionByName, sources).distinct()


def tier_entities(a: DataFrame, b: DataFrame, c: DataFrame, curated: DataFrame, key: str = "name") -> DataFrame:
    """Presence of every name in three sources and its tier: 1 curated or in a and b,
    2 in exactly one of a and b, 3 in c only. One shuffle by name for all five sets."""
    marked = [
        df.select(key, *[F.lit(f == flag).alias(f) for f in ("in_a", "in_b", "in_c", "curated")])
        for flag, df in (("in_a", a), ("in_b", b), ("in_c", c), ("curated", curated))
    ]
    flags = reduce(DataFrame.unionByName, marked).groupBy(key).agg(
        *[F.max(f).alias(f) for f in ("in_a", "in_b", "in_c", "curated")]
    )
    both = F.col("in_a") & F.col("in_b")
    tier = F.when(F.col("curated") | both, 1).when(F.col("in_a") | F.col("in_b"), 2).otherwise(3)
    return flags.select(
        key, "in_a", "in_b", "in_c", "curated", tier.alias("tier"),
        (both & F.col("in_c")).alias("in_all"), (both & ~F.col("in_c")).alias("in_ab_only"),
    )


def lexicon_core_diff(new: DataFrame, auto: DataFrame, tokens: Column, key: str = "term") -> DataFrame:
    """Words longer than one character: ``core`` when in both lists, ``diff`` when new
    only and none of the word's tokens is a core word."""
    long_new = new.where(F.length(key) > 1).select(key).distinct()
    long_auto = auto.where(F.length(key) > 1).select(key).distinct()
    core = long_new.join(long_auto, key, "left_semi")
    rest = long_new.join(long_auto, key, "left_anti")
    spoiled = (
        rest.withColumn("_t", F.explode(tokens))
        .join(core.select(F.col(key).alias("_t")), "_t", "left_semi")
        .select(key)
    )
    diff = rest.join(spoiled, key, "left_anti")
    return core.withColumn("kind", F.lit("core")).unionByName(diff.withColumn("kind", F.lit("diff")))


def merge_index_files(sources: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Priority union of (name, key_num) tables: the earlier source wins per name."""
    tagged = [
        df.select("name", "key_num", F.lit(i).alias("priority"), F.lit(label).alias("source"))
        for i, (label, df) in enumerate(sources)
    ]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("name")
        .agg(F.min(F.struct("priority", "key_num", "source")).alias("_m"))
        .select("name", "_m.key_num", "_m.source")
    )


def index_lines(merged: DataFrame) -> DataFrame:
    """``key_num <tab> name`` lines, sorted by name."""
    return merged.orderBy("name").select(F.concat_ws("\t", F.col("key_num").cast("string"), "name").alias("line"))


def effective_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
