"""Connected components by alternating star steps, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every identifier in ``links`` (a, b); a component is named by its least identifier.

    Large and small star steps (Kiveris and others, 2014) shorten all paths to their least node; a node with
    very many neighbours is an aggregation and an ordinary join. Every pass is a written table. The number of
    passes grows with the logarithm of the longest path. Self links give components of one.
    """
    alone = links.where("a = b").select(F.col("a").alias("id"))
    edges = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(root, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        edges = cut_lineage(small.select("e.*").where("a <> b").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    members = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    known = members.unionByName(roots)
    rest = alone.distinct().join(known.select("id"), "id", "left_anti")
    return known.unionByName(rest.select("id", F.col("id").alias("component")))
