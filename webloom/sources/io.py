"""Reading records and lexicons, and the write paths with their key rules."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.scale import first_per_key, global_index, last_per_key, position_in_group

CORRUPT = "_corrupt_record"
#: Bytes of a shard, about, that one task takes.
PART_BYTES = 1 << 26


def parse_json_lines(df: DataFrame, column: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(records, malformed) of a text column; blank lines are skipped, bad lines are kept aside."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    keep = [c for c in df.columns if c != column]
    parsed = (
        df.where(F.rlike(F.col(column), F.lit(r"\S")))
        .select(*keep, F.col(column).alias("_line"), F.from_json(column, wide, options).alias("_r"))
    )
    broken = F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull()
    good = parsed.where(~broken).select(*keep, *[F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields])
    return good, parsed.where(broken).select(*keep, F.col("_line").alias("line"))


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(records, malformed lines) of JSON-lines files."""
    return parse_json_lines(spark.read.text(path), "value", schema)


def lexicon_terms(lines: DataFrame, column: str = "value") -> DataFrame:
    line = F.trim(F.col(column))
    return (
        lines.select(line.alias("_line"))
        .where((F.col("_line") != "") & ~F.startswith(F.col("_line"), F.lit("#")))
        .select(F.split("_line", " ")[0].alias("term"))
        .distinct()
    )


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Distinct terms of a lexicon file: comments and blank lines dropped, first token kept."""
    return lexicon_terms(spark.read.text(path))


def effective_lexicon(base: DataFrame, minus: DataFrame, plus: DataFrame) -> DataFrame:
    """(base - minus) + plus, distinct."""
    return base.join(minus, "term", "left_anti").unionByName(plus).distinct()


def read_batches(spark: SparkSession, root: str, prefix: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(records, malformed lines) of every batch folder ``root/<prefix>*``, both with ``batch`` and ``batch_date``."""
    lines = spark.read.text(f"{root.rstrip('/')}/{prefix}*").select("value", F.col("_metadata.file_path").alias("_path"))

    def dated(df: DataFrame) -> DataFrame:
        batch = F.element_at(F.split("_path", "/"), -2)
        return df.withColumn("batch", batch).withColumn(
            "batch_date", F.try_to_timestamp(F.regexp_extract("batch", r"(\d{8})$", 1), F.lit("yyyyMMdd")).cast("date")
        ).drop("_path")

    records, malformed = parse_json_lines(lines, "value", schema)
    return dated(records), dated(malformed)


def newest_batch(df: DataFrame, batch: str = "batch") -> DataFrame:
    """Rows of the batch with the greatest name."""
    newest = df.agg(F.max(batch)).scalar()
    return df.where(F.col(batch) == newest)


def shard_of(key: Column, n: int) -> Column:
    """sha1(key) as a number, modulo ``n``; the digest is folded four hex digits at a time."""
    digest, rest = F.sha1(key), F.lit(0).cast("bigint")
    for at in range(1, 41, 4):
        digits = F.conv(F.substring(digest, at, 4), 16, 10).cast("bigint")
        rest = (rest * 65536 + digits) % n
    return rest.cast("int")


def compact_objects(df: DataFrame, key: str, n: int) -> DataFrame:
    """Assign every small object to one of ``n`` shards, spread evenly by digest. A shard of more than ``PART_BYTES`` is
    dealt over several tasks by a hash of the key, so a task's share does not grow with the table."""
    kinds = (T.StringType, T.BinaryType)
    sizes = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, kinds)]
    held = df.agg(F.sum(reduce(Column.__add__, sizes, F.lit(16).cast("bigint")))).first()[0] or 0
    parts = max(1, math.ceil(held / n / PART_BYTES))
    part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    return df.withColumn("shard", shard_of(F.col(key), n)).repartition(n * parts, "shard", part)


def write_compacted(df: DataFrame, key: str, n: int, path: str) -> None:
    """Write the shards as JSON lines, one folder per shard, with a file for every part of a large one."""
    compact_objects(df, key, n).write.partitionBy("shard").json(path)


def insert_new(df: DataFrame, target: DataFrame, key: str, order: Sequence[str], refresh: bool = False) -> DataFrame:
    """Target after a unique-key insert. The first row of a key wins and stored keys
    are kept; with ``refresh`` the new rows replace the stored ones."""
    fresh = first_per_key(df, [key], order).select(*target.columns)
    if refresh:
        return target.join(fresh.select(key), key, "left_anti").unionByName(fresh)
    return target.unionByName(fresh.join(target.select(key), key, "left_anti"))


def upsert_by_id(df: DataFrame, target: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Target after indexing ``df`` by id: the last row of an id wins."""
    fresh = last_per_key(df, [key], order).select(*target.columns)
    return target.join(fresh.select(key), key, "left_anti").unionByName(fresh)


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def investment_claims(investments: DataFrame, key: str, chunk: Column) -> DataFrame:
    """(key, pos, p, o, rid): claims to append to documents, three per investment in the order of
    ``seq``, with the group ids ``_111, _222, ...``."""
    placed = position_in_group(investments, [key], ["seq"], chunk, "_inv")
    rid = F.concat(F.lit("_"), ((F.col("_inv") + 1) * 111).cast("string"))

    def claim(p: str, o: Column) -> Column:
        return F.struct(F.lit(p).alias("p"), o.cast("string").alias("o"), rid.alias("rid"))

    three = F.array(claim("对外投资", F.lit(None)), claim("子公司名称", F.col("name")), claim("source.url", F.col("url")))
    return placed.select(key, "_inv", F.posexplode(three).alias("_n", "_c")).select(key, (F.col("_inv") * 3 + F.col("_n")).alias("pos"), "_c.*")


def update_nested(claims: DataFrame, patch: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """``claims`` (key, pos, ...) after appending the rows of ``patch`` to the documents they belong to; patches
    without a document are ignored. A document's claims stay rows, so it may have any number of them."""
    own = claims.groupBy(key).agg(F.max("pos").alias("_last"))
    known = patch.join(documents.select(key).distinct(), key, "left_semi").join(own, key, "left")
    return claims.unionByName(known.withColumn("pos", F.col("pos") + F.coalesce(F.col("_last") + 1, F.lit(0))).select(*claims.columns))


def paged(df: DataFrame, order: Sequence[str], page_size: int = 2000) -> DataFrame:
    """``df`` with its sorted index and page number."""
    return global_index(df, order).withColumn("page", F.floor(F.col("idx") / page_size).cast("bigint"))


def write_paged(df: DataFrame, order: Sequence[str], path: str, page_size: int = 2000) -> None:
    """Sorted export in pages of fixed size; arrays become comma-separated text."""
    flat = df.select(
        *[F.concat_ws(",", c).alias(c) if isinstance(df.schema[c].dataType, T.ArrayType) else F.col(c) for c in df.columns]
    )
    pages = paged(flat, order, page_size)
    pages.repartition("page").sortWithinPartitions("page", "idx").drop("idx").write.partitionBy("page").csv(path, header=True)


def latest_page(accessed: DataFrame, cached: DataFrame, contents: DataFrame, batch_id: str) -> DataFrame:
    """Newest content per URL hash over all batches that share the name of ``batch_id``
    without its trailing digits."""
    prefix = batch_id.rstrip("0123456789")
    hashes = accessed.where(F.startswith("batch_id", F.lit(prefix))).select("url_hash").distinct()
    newest = (
        cached.join(hashes, "url_hash", "left_semi")
        .groupBy("url_hash")
        .agg(F.max(F.struct("created_time", "id")).alias("_m"))
        .select("url_hash", F.col("_m.id").alias("cached_id"), F.col("_m.created_time").alias("created_time"))
    )
    return newest.join(contents.select("cached_id", "content"), "cached_id")


MALFORMED = "(malformed)"
LOG_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("date", "batch_id", "groups", "url")]
)


def access_log(lines: DataFrame, column: str) -> DataFrame:
    """Accesses per batch and day of JSON log lines; lines that cannot be read are counted under the batch ``MALFORMED``."""
    rows, malformed = parse_json_lines(lines.select(column), column, LOG_SCHEMA)
    counts = rows.groupBy("batch_id", F.to_date("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    lost = malformed.groupBy(F.lit(MALFORMED).alias("batch_id"), F.lit(None).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return counts.unionByName(lost)


