"""Relations between items by common beginnings, endings and parts.

Sorted, the items that begin with an item follow it without a gap; an ending is a beginning of the reversed items.
``affix_groups`` rests on this: one pass over the sorted items, holding only the chain of items that begin the present one, sees for
each item all it is related to, without a row per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.scale import global_index
from webloom.session import GrowingTable, cut_lineage

NONE = (1 << 63) - 1
_ROWS = 10_000
GRAMS = [1, 2, 4, 8]


def _places(ranked: DataFrame) -> DataFrame:
    """(side, part, key, r, own) of (r, item): the items in sorted parts, plainly (side 0) and reversed (side 1).

    An item that begins the first key of a later part is put into that part as well (not ``own``), so that
    a part holds all that its items begin with.
    """
    keyed = ranked.select("r", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("item").alias("key")), F.struct(F.lit(1).alias("side"), F.reverse("item").alias("key")))).alias("k")
    ).select("k.side", "k.key", "r")
    own = cut_lineage(keyed.repartitionByRange("side", "key").withColumn("part", F.spark_partition_id()), "affix-own")
    lengths = ranked.agg(F.sort_array(F.collect_set(F.length("item")))).scalar()
    first = own.groupBy("side", "part").agg(F.min("key").alias("first")).withColumn("lengths", lengths)
    begins = F.transform(F.filter("lengths", lambda n: n < F.length("first")), lambda n: F.substring(F.col("first"), F.lit(1), n))
    chains = first.select("side", "part", F.explode(begins).alias("key")).join(own.select("side", "key", "r"), ["side", "key"])
    return cut_lineage(
        own.withColumn("own", F.lit(True)).unionByName(chains.withColumn("own", F.lit(False))).select("side", "part", "key", "r", "own"), "affix-places"
    )


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.repartition("side", "part").sortWithinPartitions("side", "part", "key")


def _lists(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in columns], strict=True)


def _least_related(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(r, m) of (side, part, key, r, value) in order: the least value among the items that begin an item or that it begins."""
    out: list[tuple[int, int]] = []
    chain: list[list] = []  # key, r, value, least above, least below
    at = None

    def leave() -> None:
        _, r, value, above, below = chain.pop()
        least = min(above, below)
        if least != NONE:
            out.append((r, least))
        if chain:
            chain[-1][4] = min(chain[-1][4], value, below)

    def batch() -> pa.RecordBatch:
        got = pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["r", "m"])
        out.clear()
        return got

    for side, part, key, r, value in _lists(batches, ["side", "part", "key", "r", "value"]):
        while chain and (at != (side, part) or not key.startswith(chain[-1][0])):
            leave()
        at = (side, part)
        above = min(chain[-1][2], chain[-1][3]) if chain else NONE
        chain.append([key, r, value, above, NONE])
        if len(out) >= _ROWS:
            yield batch()
    while chain:
        leave()
    yield batch()


def _related_to_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(head, member) of (side, part, key, r, own, head) in order: each item with the head among those that begin it, and each head
    with those, if the head comes first by ``r``. A pair that is related on both sides is listed on the plain one."""
    out: list[tuple[str, str]] = []
    chain: list[tuple] = []  # key, r, the head at or above as (key, r)
    at = None

    def batch() -> pa.RecordBatch:
        got = pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.string()) for i in (0, 1)], names=["head", "member"])
        out.clear()
        return got

    for side, part, key, r, own, head in _lists(batches, ["side", "part", "key", "r", "own", "head"]):
        while chain and (at != (side, part) or not key.startswith(chain[-1][0])):
            chain.pop()
        at = (side, part)
        lead = chain[-1][2] if chain else None  # of items that begin one another at most one is a head
        if not own:
            found = []
        elif head:
            found = [(key, other) for other, rank, _ in chain if r < rank and not (side and key.endswith(other))]
        else:
            found = [(lead[0], key)] if lead and lead[1] < r and not (side and key.endswith(lead[0])) else []
        out.extend((a[::-1], b[::-1]) if side else (a, b) for a, b in found)
        chain.append((key, r, (key, r) if head else lead))
        if len(out) >= _ROWS:
            yield batch()
    yield batch()


def containment_pairs(words: DataFrame, column: str = "term") -> DataFrame:
    """Words made redundant by a shorter word they contain. Null and the empty word count for nothing.

    A word is looked up by one of its grams, of 1, 2, 4 or 8 characters, whichever is the longest that it has room for: the one that the
    fewest words hold. Words hold grams as rows of an id, so rows are linear in a word's length. A word that is itself a gram needs no
    further check; the other hits are compared in full, the shorter words of a longer one in a few arrays.
    """
    c = F.col("term")
    w = words.select(F.col(column).alias("term")).where(c != "").distinct()
    w = cut_lineage(w.withColumn("id", F.monotonically_increasing_id()), "terms")
    letters = w.select("id", F.length(c).alias("size"), F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0)).alias("letters"))

    def grams(n: int) -> Column:
        made = F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda at: F.array_join(F.slice("letters", at, n), ""))
        return F.when(F.col("size") >= n, made).otherwise(F.array().cast("array<string>"))

    every = F.array_distinct(F.flatten(F.array(*map(grams, GRAMS))))
    held = cut_lineage(letters.select("id", "size", F.explode(every).alias("gram")), "grams")
    size_of = F.length("gram")
    whole = w.where(F.length(c).isin(GRAMS)).select(F.col("term").alias("gram"))
    sure = held.where(size_of < F.col("size")).join(whole, "gram", "left_semi").select("id").distinct()
    sure = cut_lineage(sure, "redundant")
    # the other shorter words, each by its rarest gram of the length that fits
    room = F.greatest(*[F.when(F.col("size") >= n, n) for n in GRAMS])
    counts = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    open_ = held.join(sure, "id", "left_anti")  # whoever contains a redundant word contains the word that made it so
    own = open_.where((size_of == room) & (size_of < F.col("size"))).join(counts, "gram")
    index = own.groupBy("id").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"), F.max("size").alias("least"))
    index = index.withColumnRenamed("id", "short")
    hits = open_.join(index, "gram").where("least < size").select("id", "short")
    shorts = hits.join(w.select(F.col("id").alias("short"), c.alias("part")), "short")
    packed = shorts.groupBy("id", F.pmod(F.xxhash64("short"), F.lit(16)).alias("pack")).agg(F.collect_list("part").alias("parts"))
    found = packed.join(w, "id").where(F.exists("parts", lambda x: F.contains(c, x))).select("id")
    return w.join(sure.unionByName(found).distinct(), "id", "left_semi").select(c.alias(column))


def affix_groups(items: DataFrame, column: str = "item", rank: str = "rank") -> DataFrame:
    """Greedy grouping of ranked distinct items: (head, member).

    In rank order (equal ranks by item), an item that no earlier head matches becomes a head and takes
    every later item that shares a prefix or suffix with it; a member can belong to several heads. Null and empty items match nothing.

    A pass finds for each open item the first open item that it is related to: who comes before all of these is a head.
    A second one takes out what the new heads are related to. The open items soon become few; passes are as many as the longest chain
    of decisions. Rows are never pairs but for the result.
    """
    named = items.where(F.col(column) != "").select(F.col(column).alias("item"), F.col(rank).alias("rank"))
    ranked = cut_lineage(global_index(named, ["rank", "item"], "r").select("r", "item"), "affix-ranked")
    places = _places(ranked)

    def least(rows: DataFrame, value: Column) -> DataFrame:
        scanned = _in_order(rows.select("side", "part", "key", "r", value.alias("value"))).mapInArrow(_least_related, "r bigint, m bigint")
        return scanned.groupBy("r").agg(F.min("m").alias("m"))

    open_, heads = ranked.select("r"), None
    rows = places
    while True:
        first = least(rows, F.col("r"))
        marked = open_.join(first, "r", "left").select("r", (F.coalesce("m", F.lit(NONE)) > F.col("r")).alias("head"))
        marked = cut_lineage(marked, "affix-marked")
        fresh = marked.where("head").select("r")
        if heads is None:
            heads = GrowingTable(fresh, "affix-heads")
        else:
            heads.add(fresh)
        taken = least(places.join(marked, "r"), F.when(F.col("head"), F.col("r")).otherwise(F.lit(NONE)))
        open_ = cut_lineage(marked.where("not head").select("r").join(taken, "r", "left_anti"), "affix-open")
        if open_.isEmpty():
            break
        rows = places.join(open_, "r", "left_semi")
    led = places.join(heads.all().withColumn("head", F.lit(True)), "r", "left").withColumn("head", F.coalesce("head", F.lit(False)))
    return _in_order(led).mapInArrow(_related_to_heads, "head string, member string")
