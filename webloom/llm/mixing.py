"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue that sends its documents in shuffled order, again from the start when
it is through, at most ``cap`` times. A document's virtual finish time is the number of words its
queue has sent by then, divided by the source's target; taking documents in order of that
time, until the total budget is spent, gives every source its share at any moment.

Nothing is gathered: words are summed per (source, chunk of the shuffled order), and the
place where the budget ends is found by cutting virtual time into ranges, summing each, and
cutting again the one range in which the budget runs out, until that range is small enough to be sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webloom.llm.common import table, wrapped
from webloom.scale import global_index, position_in_group
from webloom.session import cut_lineage

CHUNK_ROWS = 2_000  # documents of a source numbered in one task
RANGES = 512  # virtual-time ranges summed per pass
SORT_ROWS = 50_000  # a range of so few entries is sorted


def word_count(text: Column) -> Column:
    """Runs of anything but the six ASCII blanks; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sources: DataFrame, weights: Sequence[int], cap: int) -> DataFrame:
    """Targets per source: (source, source_size, rank, target) from (source, source_size).

    Sources in code-point order, null last, take ``weights`` in turn and share the sum of all sizes by
    weight; what a source would get above ``cap`` times its size is shared again among the others.
    """
    ranked = global_index(sources.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "rank").drop("_null")
    weighed = cut_lineage(
        ranked.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))),
        "sources",
    )
    most = F.col("source_size") * cap
    total = int(weighed.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0  # words per unit of weight
    while True:
        full = F.col("weight") * F.lit(level) >= most
        spent, open_weight = weighed.agg(
            F.sum(F.when(full, most).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))
        ).first()
        if not open_weight:
            break
        raised = (total - int(spent)) / int(open_weight)
        if raised <= level:
            break
        level = raised
    share = F.col("weight") * F.lit(level)
    return weighed.select("source", "source_size", "rank", F.when(share >= most, most.cast("double")).otherwise(share).alias("target"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1), cap: int = 3, seed: str = "mix",
) -> DataFrame:
    """One row per document: (doc_id, size, source_size, target, taken, times, text_hash, source).

    ``times`` is how often the mix takes the document (0 to ``cap``), ``taken`` the words that
    makes. The shuffled order is that of md5(seed + id), so reruns agree. Documents without a
    word are never taken. A null source is a source of its own; a null id sorts as the empty
    string; rows repeated whole are separate documents. An empty table, or one without words, takes nothing. Other columns are not read.
    """
    sized = cut_lineage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary")).alias("key"),
        F.xxhash64(text_col).alias("text_hash"),
    ), "sized")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(per_source, weights, cap)

    rows = sized.count()
    n_chunks = rows // CHUNK_ROWS + 1
    chunk = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32) * n_chunks).cast("int")
    cut = sized.withColumn("chunk", chunk)
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy("source", "chunk").agg(F.sum("size").alias("words"))
        .withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    )
    t = targets.withColumnRenamed("source", "s")
    offsets = offsets.join(t, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumnsRenamed({"source": "s", "chunk": "c"})
    inner = Window.partitionBy("source", "chunk").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    sent = cut.withColumn("run", F.sum("size").over(inner))
    placed = cut_lineage(
        sent.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")))
        .select("doc_id", "text_hash", "source", "size", "source_size", "target", "rank", (F.col("before") + F.col("run")).alias("sent")),
        "queues",
    )

    def finish(turn: int) -> Column:
        return (F.col("sent") + F.col("source_size") * turn) / F.col("target")

    entries = placed.where("size > 0").select(
        "size", "rank", F.posexplode(F.array(*[finish(i) for i in range(cap)])).alias("turn", "finish"), "sent"
    )
    last = _last_taken(entries, int(placed.agg(F.sum("size")).first()[0] or 0))
    if last is None:
        times: Column = F.lit(0)
    else:
        here = [F.struct(finish(i).alias("finish"), F.col("rank"), F.col("sent")) for i in range(cap)]
        end = F.struct(F.lit(last[0]).alias("finish"), F.lit(last[1]).cast("bigint").alias("rank"), F.lit(last[2]).cast("bigint").alias("sent"))
        times = sum((F.when(h <= end, 1).otherwise(0) for h in here), F.lit(0))
    times = F.when(F.col("size") > 0, times).otherwise(0)
    return placed.select(
        "doc_id", "size", "source_size", F.col("target"), (F.col("size") * times).cast("bigint").alias("taken"),
        times.cast("int").alias("times"), "text_hash", "source",
    )


def _last_taken(entries: DataFrame, budget: int) -> tuple | None:
    """(finish, rank, sent) of the last entry that still fits the budget, in global order."""
    low, high, spent = 0.0, entries.agg(F.max("finish")).first()[0], 0
    if not high or not budget:
        return None
    high = float(high) * 1.0000001
    while True:
        width = (high - low) / RANGES
        inside = entries.where((F.col("finish") >= low) & (F.col("finish") < high))
        place = F.least(F.floor((F.col("finish") - F.lit(low)) / F.lit(width)), F.lit(RANGES - 1))
        sums = inside.groupBy(place.cast("int").alias("place")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"), F.min("finish").alias("a"), F.max("finish").alias("b")
        ).orderBy("place").collect()  # at most RANGES rows
        for s in sums:
            if spent + s["words"] > budget:
                break
            spent += s["words"]
        else:  # everything fits
            low, high = sums[-1]["a"], sums[-1]["b"]
            spent -= sums[-1]["words"]
            s = sums[-1]
            break
        if s["n"] <= SORT_ROWS or s["a"] == s["b"]:
            low, high = s["a"], s["b"]
            break
        low, high = s["a"], float(s["b"]) * (1 + 1e-15) if s["b"] else s["b"]
    order = Window.orderBy("finish", "rank", "sent").rowsBetween(Window.unboundedPreceding, 0)
    # at most SORT_ROWS entries, or one entry per source that ties at a single instant
    small = entries.where((F.col("finish") >= low) & (F.col("finish") <= high)).withColumn("total", F.sum("size").over(order))
    best = small.where(F.col("total") + spent <= budget).agg(F.max(F.struct("finish", "rank", "sent"))).first()[0]
    if best is None:
        best = entries.where(F.col("finish") < low).agg(F.max(F.struct("finish", "rank", "sent"))).first()[0]
    return tuple(best) if best is not None else None


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken, columns unchanged.

    Rows that agree in id, source and text share what the mix takes of them as evenly as it goes; which of them gets one
    more is arbitrary. Rows with a null id or source are taken like any others, texts without a word (null, empty, blank) never. An empty
    table gives an empty result.
    """
    id_col, text_col, source_col = options.get("id_col", "doc_id"), options.get("text_col", "text"), options.get("source_col", "source")
    chosen = cut_lineage(
        mix(docs, **options).groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.col("source").alias("from"))
        .agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("n")).where("times > 0"), "chosen"
    )
    rows = wrapped(docs, own_id=F.col(id_col), own_hash=F.xxhash64(text_col), own_source=F.col(source_col))
    same = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("hash")) & F.col("own_source").eqNullSafe(F.col("from"))
    taken = rows.join(chosen.where("n = 1"), same).select("whole", "times")
    repeated = chosen.where("n > 1")
    if not repeated.isEmpty():
        # numbered within what one task wrote, so that no group of equal rows is numbered in one place
        several = rows.join(repeated, same).withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id())
        placed = position_in_group(cut_lineage(several, "repeated"), ["id", "hash", "from"], ["row"], F.col("part"), "nth")
        share = F.floor(F.col("times") / F.col("n")) + F.when(F.col("nth") < F.col("times") % F.col("n"), 1).otherwise(0)
        taken = taken.unionByName(placed.select("whole", share.alias("times")).where("times > 0"))
    return taken.select("whole", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times")))).select("whole.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5('mix' || coalesce(doc_id::varchar, '')) as key
  from documents
), sources as (
  select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight,
         row_number() over (order by source nulls last) - 1 as rank
  from (select source, sum(size)::bigint as source_size from sized group by source)
), levels as (
  select *, coalesce(sum(3 * source_size) over o, 0) as full_words,
         (select sum(weight) from sources) - coalesce(sum(weight) over o, 0) as open_weight
  from sources window o as (order by 3.0 * source_size / weight, rank rows between unbounded preceding and 1 preceding)
), level as (
  select arg_min(((select sum(source_size) from sources) - full_words)::double / open_weight::double, full_words) as words from levels
  where weight * (((select sum(source_size) from sources) - full_words)::double / open_weight::double) <= 3 * source_size
), targets as (
  select source, source_size, rank, case when weight * words >= 3 * source_size then (3 * source_size)::double else weight * words end as target
  from sources, level
), queues as (
  select s.doc_id, s.size, t.source_size, t.target, t.rank, s.key,
         sum(s.size) over (partition by s.source order by s.key, s.doc_id, s.size rows unbounded preceding)::bigint as sent
  from sized s join targets t on s.source is not distinct from t.source
), entries as (
  select q.*, e.turn, (sent + source_size * e.turn)::double / target as finish
  from queues q, (select unnest([0, 1, 2]) as turn) e where size > 0
), taken as (
  select *, sum(size) over (order by finish, rank, sent rows unbounded preceding) as total from entries
)
select q.doc_id, q.size, q.source_size, q.target, coalesce(x.taken, 0)::bigint as taken
from queues q left join (
  select rank, sent, sum(size)::bigint as taken from taken where total <= (select sum(size) from sized) group by rank, sent
) x on q.rank = x.rank and q.sent = x.sent and q.size > 0
"""
