"""URL projections, routing, frontier and crawl-log operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.functions import fixed_values as V
from webloom.functions.ids import url_key


def expand_urls(seeds: DataFrame, templates: Sequence[str], lo: Column, hi: Column, value: Column) -> DataFrame:
    """One URL per seed, template and page number. ``{v}`` is the encoded seed value,
    ``{n}`` the page number."""
    pages = seeds.withColumn("_v", F.url_encode(value)).withColumn("page", F.explode(F.sequence(lo, hi)))
    urls = F.array(
        *[F.replace(F.replace(F.lit(t), F.lit("{v}"), F.col("_v")), F.lit("{n}"), F.col("page").cast("string")) for t in templates]
    )
    return pages.withColumn("url", F.explode(urls)).drop("_v")


def route_url(df: DataFrame, url: str, patterns: Sequence[tuple[str, str]] = V.QUESTION_URLS) -> DataFrame:
    """Add (label, item_id) of the first matching pattern; unknown URLs are dropped."""
    found = F.coalesce(
        *[
            F.when(
                F.rlike(F.col(url), F.lit(p)),
                F.struct(F.lit(label).alias("label"), F.regexp_extract(url, p, 1).alias("item_id")),
            )
            for label, p in patterns
        ]
    )
    return df.withColumn("_f", found).where("_f is not null").select(*df.columns, "_f.label", "_f.item_id")


def new_links(found: DataFrame, visited: DataFrame, url: str = "url") -> DataFrame:
    """Distinct found URLs whose key is not known yet."""
    keyed = found.select(url).withColumn("url_key", url_key(F.col(url))).dropDuplicates(["url_key"])
    return keyed.join(visited.select(url_key(F.col(url)).alias("url_key")), "url_key", "left_anti")


def missing_items(expected: DataFrame, seen: DataFrame, skip: DataFrame, key: str) -> DataFrame:
    """Expected items neither skipped nor seen."""
    return expected.select(key).distinct().join(skip, key, "left_anti").join(seen, key, "left_anti")


def miss_counts(expected: DataFrame, seen: DataFrame, skip: DataFrame, key: str) -> DataFrame:
    """Both counts of the report: distinct seen items and misses."""
    miss = missing_items(expected, seen, skip, key).agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("miss"))
    all_seen = seen.select(key).distinct().agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("seen"))
    return all_seen.unionByName(miss)


def attempt_status(
    attempts: DataFrame, now: Column, timeout: int = 180, max_fail: int = 3, item: str = "item"
) -> DataFrame:
    """State of each item: ``done`` after a finish, else ``running``, and past the
    timeout ``requeue`` or, once attempts + 1 exceeds ``max_fail``, ``failed``."""
    last_done = attempts.groupBy(item).agg(F.max(F.when(F.col("kind") == "done", F.col("ts"))).alias("last_done"))
    # Starts are counted per (item, second) first, so that a hot item meets the join pre-aggregated.
    starts = (
        attempts.where("kind = 'start'")
        .groupBy(item, F.col("ts"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    open_starts = (
        starts.join(last_done.where("last_done is not null"), item, "left")
        .where(F.col("last_done").isNull() | (F.col("ts") > F.col("last_done")))
        .groupBy(item)
        .agg(F.sum("_n").alias("attempts"), F.min("ts").alias("started"))
    )
    out = last_done.select(item).join(open_starts, item, "left")
    n = F.coalesce(F.col("attempts"), F.lit(0))
    late = (F.unix_timestamp(now) - F.unix_timestamp("started")) > timeout
    return out.select(
        item,
        n.cast("bigint").alias("attempts"),
        F.when(n == 0, "done").when(~late, "running").when(n + 1 > max_fail, "failed").otherwise("requeue").alias("status"),
    )


def batch_progress(status: DataFrame, batch: str) -> DataFrame:
    """Totals per batch of a table with one status per item."""

    def n(cond: Column) -> Column:
        return F.count(F.when(cond, 1))

    s = F.col("status")
    return status.groupBy(batch).agg(
        F.count(F.lit(1)).alias("total"), n(s == "done").alias("success"), n(s == "failed").alias("failed"),
        n(~s.isin("done", "failed")).alias("remaining"), n(s == "error").alias("exceptions"),
    )


def mean_cost_of_others(df: DataFrame, batch: str, cost: Column, gap: Column) -> DataFrame:
    """Per batch: mean cost, the sum of the other batches' means, and the wait left of ``gap``."""
    means = df.groupBy(batch).agg(F.avg(cost).alias("mean_cost"))
    total = means.agg(F.sum("mean_cost")).scalar()
    others = total - F.col("mean_cost")
    return means.withColumn("others", others).withColumn("wait", F.greatest(gap - F.col("others"), F.lit(0.0)))


def proxy_score(events: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """Score of each proxy after its ordered log of ``use`` and ``failure`` entries.

    A use lowers the score by one; a failure sets a negative score to 0 and evicts a
    proxy that stands at 0; an evicted or unknown proxy ignores failures and enters
    again with its next use. The score therefore depends on a short look-back only:
    after a use it is minus the uses since the last failure, after a failure it is 0
    when the entry before was a use, else the proxy is out (null). An eviction is the
    second failure after a use. Entries are looked at within (key, chunk); only the
    last two entries of a chunk are carried to the next, so a hot key is spread.
    """
    keys = list(keys)
    e = events.withColumn("_c", chunk).withColumn("_f", F.col("kind") == "failure")
    inner = Window.partitionBy(*keys, "_c").orderBy(*order)
    rows = (
        e.withColumn("_rn", F.row_number().over(inner))
        .withColumn("_p1", F.lag("_f", 1).over(inner))
        .withColumn("_p2", F.lag("_f", 2).over(inner))
    )
    at = F.struct(*order)
    chunks = rows.groupBy(*keys, "_c").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(~F.col("_f"), 1)).alias("uses"),
        F.count(F.when(F.col("_f"), 1)).alias("failures"),
        F.max_by("_f", at).alias("last1"),
        F.max_by("_p1", at).alias("last2"),
        F.max(F.when(F.col("_rn") == 1, F.col("_f"))).alias("first1"),
        F.max(F.when(F.col("_rn") == 2, F.col("_f"))).alias("first2"),
        F.count(F.when(F.col("_f") & F.col("_p1") & ~F.col("_p2"), 1)).alias("evict_in"),
        F.max(F.when(F.col("_f"), F.col("_rn"))).alias("last_fail_rn"),
    )
    over = Window.partitionBy(*keys).orderBy("_c")
    prev1 = F.lag("last1").over(over)
    prev2 = F.when(F.lag("n").over(over) >= 2, F.lag("last2").over(over)).otherwise(F.lag("last1", 2).over(over))
    linked = chunks.withColumn("_q1", prev1).withColumn("_q2", prev2)
    at_first = F.when(F.col("first1") & F.col("_q1") & ~F.col("_q2"), 1).otherwise(0)
    at_second = F.when(F.col("first2") & F.col("first1") & ~F.col("_q1"), 1).otherwise(0)
    # Uses after the last failure: the tail of the last chunk with a failure, plus all later uses.
    with_fail = F.when(F.col("last_fail_rn").isNotNull(), F.col("_c"))
    tail = F.col("n") - F.coalesce(F.col("last_fail_rn"), F.lit(0))
    last_fail_chunk = F.max(with_fail).over(Window.partitionBy(*keys))
    final = (
        linked.withColumn("_lf", last_fail_chunk)
        .withColumn("_tail", F.when(F.col("_lf").isNull() | (F.col("_c") >= F.col("_lf")), tail).otherwise(0))
        .withColumn("_seen2", F.when(F.col("n") >= 2, F.col("last2")).otherwise(F.col("_q1")))
        .groupBy(*keys)
        .agg(
            F.sum("uses").alias("uses"), F.sum("failures").alias("failures"),
            F.sum(F.col("evict_in") + at_first + at_second).alias("evictions"),
            F.max_by("last1", "_c").alias("_last"), F.max_by("_seen2", "_c").alias("_before"), F.sum("_tail").alias("_run"),
        )
    )
    score = F.when(~F.col("_last"), -F.col("_run")).when(F.col("_before") == F.lit(False), F.lit(0))
    return final.select(*keys, "uses", "failures", "evictions", score.cast("bigint").alias("score"))


def pass_ratio(checks: DataFrame, item: str, ok: Column, ratio: float) -> DataFrame:
    """Items whose successes reach ``ratio`` of their tries."""
    return (
        checks.groupBy(item)
        .agg(F.count(F.lit(1)).alias("tries"), F.count(F.when(ok, 1)).alias("successes"))
        .where(F.col("successes") >= F.col("tries") * ratio)
    )


def hex_position_entropy(df: DataFrame, digest: Column) -> DataFrame:
    """Shannon entropy of each digit position over all digests."""
    digits = df.select(F.posexplode(F.split(digest, "(?!$)")).alias("position", "digit"))
    counts = digits.groupBy("position", "digit").agg(F.count(F.lit(1)).alias("n"))
    # h = log2(N) - sum(n log2 n) / N, one aggregation over at most 16 digits per position
    total = F.sum("n")
    return counts.groupBy("position").agg(
        (F.log2(total) - F.sum(F.col("n") * F.log2("n")) / total).alias("entropy")
    )
