"""Top-k, tiers, blocks, rates, paging and samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.operators.stats import seeded_order
from webloom.scale import global_index, position_in_group, top_per_group
from webloom.session import cut_lineage


def recommended_first(results: DataFrame, query: str = "query") -> DataFrame:
    """First recommended row of each query."""
    return top_per_group(
        results.where("is_recommend = 1"), [query], [F.asc("result_index")], 1, "_r"
    ).drop("_r")


def pick_question(results: DataFrame, query: str = "query") -> DataFrame:
    """One or two question ids per query: the recommended one and the most approved one
    when its approvals are higher, else only the first normal question. Equal approvals:
    the last one counts."""
    rec = F.col("is_recommend") == 1
    per = results.groupBy(query).agg(
        F.min_by(F.when(rec, F.struct("question_id", "cnt_like")), F.when(rec, F.col("result_index"))).alias("_rec"),
        F.min_by(F.when(~rec, F.col("question_id")), F.when(~rec, F.col("result_index"))).alias("_first"),
        F.max(F.when(~rec & F.col("cnt_like").isNotNull(), F.struct("cnt_like", "result_index", "question_id"))).alias("_max"),
    )
    better = F.coalesce(F.col("_max.cnt_like"), F.lit(-1)) > F.coalesce(F.col("_rec.cnt_like"), F.lit(0))
    both = F.filter(F.array(F.col("_rec.question_id"), F.col("_max.question_id")), lambda x: x.isNotNull())
    return per.select(query, F.when(better, both).otherwise(F.array("_first")).alias("picks"))


def good_questions(results: DataFrame, min_likes: int = 3) -> DataFrame:
    return results.where((F.col("is_recommend") == 1) | (F.col("cnt_like") >= min_likes)).select("question_id").distinct()


def merge_pages(results: DataFrame, query: str, limit: int, page_size: int = 10) -> DataFrame:
    """Pages of each query in one list; the index goes on across pages."""
    max_pages = (limit - 1) // page_size + 1
    pages = results.where(F.col("page") < max_pages)
    return position_in_group(pages, [query], ["idx"], F.col("page"), "_p").withColumn(
        "result_index", F.col("_p") + 1
    ).drop("_p")


def entity_tiering(candidates: DataFrame, name: str, score: str) -> DataFrame:
    """Tier of each candidate of a name: only_one, ok (score >= 100), candidate or bad;
    once a name has an ok candidate, its others are dropped."""
    per = candidates.groupBy(name).agg(F.count(F.lit(1)).alias("_n"), F.max(F.col(score) >= 100).alias("_ok"))
    s = F.col(score)
    tier = (
        F.when(F.col("_n") == 1, "only_one").when(s >= 100, "ok").when(F.col("_ok"), None)
        .when(s > -100, "candidate").otherwise("bad")
    )
    return candidates.join(per, name).withColumn("tier", tier).where("tier is not null").drop("_n", "_ok")


def top_share_per_group(df: DataFrame, group: str, item: str, share: float = 0.3) -> DataFrame:
    """Items of each group by count: the top int(n * share + 0.99) of its n items, without
    items counted once. Items counted once come last, so they are left out before ranking. Places come from one index over all
    groups, laid out by sampled bounds of group, count and item, so neither a large group nor equal counts gather in one task."""
    counts = cut_lineage(df.groupBy(group, item).agg(F.count(F.lit(1)).alias("cnt")), "share-counts")
    sizes = counts.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    indexed = global_index(counts.where("cnt > 1"), [F.col(group).asc(), F.col("cnt").desc(), F.col(item).asc()], "_i")
    starts = indexed.groupBy(group).agg(F.min("_i").alias("_first"))
    keep = F.floor(F.col("_n") * share + 0.99)
    placed = indexed.join(sizes.join(starts, group), group)
    return placed.where(F.col("_i") - F.col("_first") < keep).select(group, item, "cnt")


def latest_report_block(rows: DataFrame, page: str, idx: str, report: str) -> DataFrame:
    """Rows of a page before its report time first changes.

    Where each report time of a page begins is an aggregation; the change is where the second one begins. One table of
    pages and changes is joined to the rows; before that only the three columns are read.
    """
    begins = rows.groupBy(page, report).agg(F.min(idx).alias("_change"))
    second = top_per_group(begins, [page], [F.asc("_change")], 2, "_nth").where("_nth = 2").select(page, "_change")
    out = rows.join(second, page, "left")
    return out.where(F.col("_change").isNull() | (F.col(idx) < F.col("_change"))).drop("_change")


def rate_in_last_minute(calls: DataFrame, key: str, ts: str, order: str, seconds: int = 60, threshold: int = 10) -> DataFrame:
    """Per call: calls of the key within the last ``seconds``, mean gap among them, and
    whether the threshold is passed.

    Calls of one instant are counted first; calls without a time are left out. Windows run within (key, time slot); every instant is
    also handed to the following slot, which is all the look-back needed, so a hot key is spread over its slots. Beside the
    instants stand marks where their look-back begins. Counts run on from the start of a slot, so a slot is read once, however
    many calls a look-back holds: the calls of a look-back are the count at the instant less the count at its mark.
    """
    span = seconds * 1_000_000
    timed = calls.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp")))
    slot = F.floor(F.col("_at") / span)
    instants = timed.where("_at is not null").groupBy(F.col(key).alias("_key"), "_at").agg(F.count(F.lit(1)).alias("_c")).withColumn("_own", slot)
    points = instants.select("_key", "_at", "_c", "_own", F.explode(F.array(F.col("_own"), F.col("_own") + 1)).alias("_slot"), F.col("_at").alias("_t"))
    marks = instants.select("_key", "_at", F.lit(0).cast("bigint").alias("_c"), "_own", F.col("_own").alias("_slot"), (F.col("_at") - span).alias("_t"))
    kind = lambda df, n: df.withColumn("_kind", F.lit(n))  # a mark stands before a call of its instant
    both = kind(points, 1).unionByName(kind(marks, 0))
    on = Window.partitionBy("_key", "_slot").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("_key", "_slot").orderBy(F.desc("_t"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, 0)
    counted = both.withColumn("_n", F.sum("_c").over(on)).withColumn("_next", F.last(F.when(F.col("_kind") == 1, F.col("_t")), ignorenulls=True).over(back))
    mark = F.col("_kind") == 0
    per = counted.where(F.col("_slot") == F.col("_own")).groupBy("_key", "_at").agg(
        (F.max(F.when(~mark, F.col("_n"))) - F.max(F.when(mark, F.col("_n")))).alias("calls"), F.max(F.when(mark, F.col("_next"))).alias("_first")
    ).withColumnRenamed("_at", "_then")
    n = F.col("calls")
    return (
        timed.join(per, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_at") == F.col("_then")))
        .withColumn("mean_gap", F.when(n > 1, (F.col("_at") - F.col("_first")) / 1e6 / (n - 1)))
        .withColumn("over", n > threshold)
        .select(*calls.columns, "calls", "mean_gap", "over")
    )


def min_over_samples(samples: DataFrame, series: str, order: Sequence[str], chunk: Column, value: str,
                     size: int = 6, limit: float = 500.0) -> DataFrame:
    """Blocks of ``size`` consecutive samples whose smallest value passes ``limit``."""
    placed = position_in_group(samples, [series], order, chunk, "_pos")
    return (
        placed.groupBy(series, F.floor(F.col("_pos") / size).alias("block"))
        .agg(F.min(value).alias("min_value"), F.count(F.lit(1)).alias("_n"))
        .where((F.col("_n") == size) & (F.col("min_value") > limit))
        .drop("_n")
    )


#: A page is sorted within a range of at most so many rows; a pass over the order columns cuts it at so many places.
PAGE_RANGE, PAGE_CUTS = 100_000, 24


def _before(names: Sequence[str], down: Sequence[bool], row: Sequence[object]) -> Column:
    """Whether a row comes before the given values of ``names``: ascending with nulls first, descending with nulls last."""
    out = F.lit(False)
    for name, falls, value in reversed(list(zip(names, down, row, strict=True))):
        c = F.col(name)
        if value is None:
            less = c.isNotNull() if falls else F.lit(False)
        else:
            less = F.coalesce(c > F.lit(value), F.lit(False)) if falls else F.coalesce(c < F.lit(value), F.lit(True))
        out = less | (c.eqNullSafe(F.lit(value)) & out)
    return out


def page(df: DataFrame, order: Sequence[str], offset: int, limit: int, most: int = PAGE_RANGE) -> DataFrame:
    """One page in ``order`` with the total row count in ``total``.

    ``order`` names columns, a leading minus makes one descending; nulls come first in ascending and last in descending order, and rows
    with equal columns come in the order of a hash of the row, so that pages do not overlap. The hash leaves out maps, which have none,
    and timestamps, which may be those of the call.

    Only counts are taken of all rows: passes over the order columns count the rows before some sampled places and go on
    between the two that hold the page, until the range has at most ``most`` rows (or twice the page); only that range is sorted. Nothing is written. The range stays
    wider only when a page begins or ends among more equal rows than that.
    """
    down = [*[c.startswith("-") for c in order], False]
    names = [f"_o{i}" for i in range(len(down))]
    fixed = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "timestamp" not in kind]
    tie = F.xxhash64(*fixed) if fixed else F.lit(0)
    keyed = df.select(*df.columns, *[F.col(c.removeprefix("-")).alias(n) for c, n in zip(order, names)], tie.alias(names[-1]))
    keys = keyed.select(*names)
    total = keys.count()
    low, high, skipped, held, idle = F.lit(True), F.lit(True), 0, total, 0
    while held > max(most, 2 * limit) and offset < total and idle < 3:
        inside = keys.where(low & high)
        cuts = inside.orderBy(F.xxhash64(*names, F.monotonically_increasing_id(), F.lit(held + idle))).limit(PAGE_CUTS).collect()
        under = [_before(names, down, r) for r in cuts]
        upto = [b | reduce(Column.__and__, [F.col(n).eqNullSafe(F.lit(v)) for n, v in zip(names, r)]) for b, r in zip(under, cuts)]
        places = [*zip(under, cuts), *zip(upto, cuts)]
        counts = inside.agg(*[F.count_if(cond).alias(f"c{i}") for i, (cond, _) in enumerate(places)]).first()
        known = sorted(zip(counts, range(len(places)), strict=True))
        starts = [(n, i) for n, i in known if n <= offset - skipped]
        ends = [(n, i) for n, i in known if n >= offset + limit - skipped]
        first, last = starts[-1][0] if starts else 0, ends[0][0] if ends else held
        idle = idle + 1 if last - first == held else 0
        if starts:
            low = low & ~places[starts[-1][1]][0]
        if ends:
            high = high & places[ends[0][1]][0]
        skipped, held = skipped + first, last - first
        if starts and ends and places[starts[-1][1]][1] == places[ends[0][1]][1]:
            skipped, idle = offset, 3  # all that is left is one row over and over: any of it makes the page
    sorted_ = keyed.where(low & high).orderBy(*[F.col(n).desc() if d else F.col(n).asc() for n, d in zip(names, down)])
    rows = sorted_.offset(max(0, offset - skipped)).limit(limit)
    return rows.select(*df.columns, F.lit(total).cast("bigint").alias("total"))


def systematic_sample(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """Every k-th row in ``order``, k = rows div n, ``n`` rows in all."""
    indexed = global_index(df, order, "_i")
    step = F.greatest(F.floor(df.agg(F.count(F.lit(1))).scalar() / n), F.lit(1))
    return indexed.where((F.col("_i") % step == 0) & (F.col("_i") / step < n)).drop("_i")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 1) -> DataFrame:
    """A repeatable random sample of ``n`` rows."""
    return df.orderBy(seeded_order(key, seed), key).limit(n)
