"""Look-ups and entity links.

No join forces a broadcast: the planner broadcasts a side only when its measured
size is under the threshold, and otherwise shuffles and splits skewed keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.scale import last_per_key


def map_name(df: DataFrame, column: str, mapper: DataFrame, out: str) -> DataFrame:
    """Mapped value of ``column`` (mapper: raw, mapped), falling back to the raw value."""
    one = mapper.groupBy("raw").agg(F.max("mapped").alias("_m"))
    return (
        df.join(one, F.col(column) == F.col("raw"), "left")
        .withColumn(out, F.coalesce("_m", column))
        .drop("raw", "_m")
    )


def attach_rank(df: DataFrame, ranks: DataFrame, column: str) -> DataFrame:
    """Add ``searchscore`` from ranks (word, total, seq); the last value of a word wins."""
    last = last_per_key(ranks.select("word", "total", "seq"), ["word"], ["seq"])
    return df.join(last.select(F.col("word").alias(column), F.col("total").alias("searchscore")), column, "left")


def without_rank(df: DataFrame, ranks: DataFrame, column: str) -> DataFrame:
    """Distinct names that have no rank."""
    return df.select(column).distinct().join(ranks.select(F.col("word").alias(column)), column, "left_anti")


def best_entity_per_alias(entities: DataFrame) -> DataFrame:
    """(alias, nid): of the entities sharing an alias, the one with the longest alias list."""
    pairs = entities.select("nid", F.size("alias").alias("_n"), F.explode("alias").alias("alias"))
    return pairs.groupBy("alias").agg(F.max(F.struct("_n", "nid")).alias("_b")).select("alias", F.col("_b.nid").alias("nid"))


def link_entity(df: DataFrame, column: str, entities: DataFrame) -> DataFrame:
    """Add the linked ``nid`` of a name; unmatched names keep null."""
    best = best_entity_per_alias(entities)
    return df.join(best.withColumnRenamed("alias", column), column, "left")


def alias_or_name_lookup(names: DataFrame, entities: DataFrame, prices: DataFrame) -> DataFrame:
    """Prices of each asked name: by entity id when an alias matches, else by equal name."""
    linked = link_entity(names.select("name"), "name", entities)
    by_id = linked.where("nid is not null").alias("a").join(
        prices.alias("p"), F.col("a.nid") == F.col("p.nid")
    )
    by_name = linked.where("nid is null").alias("a").join(prices.alias("p"), F.col("a.name") == F.col("p.name"))
    rest = [F.col(f"p.{c}") for c in prices.columns if c not in ("name", "nid")]
    cols = [F.col("a.name").alias("asked"), F.col("p.name").alias("name"), F.col("p.nid").alias("nid"), *rest]
    return by_id.select(*cols).unionByName(by_name.select(*cols))


def join_answers(questions: DataFrame, answers: DataFrame, n: int = 3) -> DataFrame:
    """Each question with the answers of its first ``n`` answer ids, in order; missing
    answers are skipped, a question without answers stays."""
    ids = questions.select(
        *[c for c in questions.columns if c != "answer_ids"],
        F.posexplode_outer(F.slice("answer_ids", 1, n)).alias("_pos", "answer_id"),
    )
    keep = [c for c in questions.columns if c != "answer_ids"]
    return (
        ids.join(answers.select("answer_id", "content"), "answer_id", "left")
        .groupBy(*keep)
        .agg(F.array_sort(F.collect_list(F.when(F.col("content").isNotNull(), F.struct("_pos", "content")))).alias("_a"))
        .select(*keep, F.transform("_a", lambda x: x["content"]).alias("answers"))
    )


def compare_sources(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Entities of both sources with their attributes side by side."""
    left = a.select(key, F.struct(*[c for c in a.columns if c != key]).alias("a"))
    right = b.select(key, F.struct(*[c for c in b.columns if c != key]).alias("b"))
    return left.join(right, key)


def dict_semi(df: DataFrame, words: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(words, list(on), "left_semi")


def dict_anti(df: DataFrame, words: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(words, list(on), "left_anti")


def range_filter(
    c: Column, lo: object = None, hi: object = None, lo_open: bool = False, hi_open: bool = False
) -> Column | None:
    """Range predicate with open or closed bounds; a bound of None is unbounded, and
    two unbounded sides give None."""
    parts = []
    if lo is not None:
        parts.append(c > F.lit(lo) if lo_open else c >= F.lit(lo))
    if hi is not None:
        parts.append(c < F.lit(hi) if hi_open else c <= F.lit(hi))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0] & parts[1]
