"""Exact deduplication: sorted runs of digests, merged in a tree of binomial rounds.

Every scan task makes one run: its documents' digests, sorted, one entry per text. Runs
are then merged ``ARITY`` at a time; after round r an entry belongs to run
``first_run div ARITY**r``, until a single run is left. An entry is
(digest, check) with the identifier that stays so far and the number of rows, so a text
that a third of all rows share is one entry per task from the first round on. A run is laid
out over many tasks by the hash of (run, digest), so no round gathers a run in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webloom.llm.common import table, wrapped
from webloom.session import cut_lineage

ARITY = 8


def _keeper(keep: str, value: Column) -> Column:
    return F.max(value) if keep == "largest" else F.min(value)


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        F.sha2(body.cast("binary"), 256).alias("digest"),
        F.struct(F.octet_length(body).alias("bytes"), F.xxhash64(body).alias("hash")).alias("check"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per input row: (doc_id, keep_id, group_size, kept, text_sha256, n_bytes).

    Texts are equal when their bytes are; a null text is the empty text. ``keep`` is
    "smallest" or "largest": which identifier of a group stays. Two texts are one group only
    if the digest and, independently of it, length and a second hash agree ("verified"). A null
    identifier counts as the lowest, so it stays under "largest" only when no other is there, and
    under "smallest" whenever it is there. Rows repeated with one identifier and text stay apart in
    group_size, and exactly one of them is kept. An empty table gives an empty result. Other columns of
    ``docs`` are not read.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep!r}")
    tagged = _digests(docs, id_col, text_col).select(
        "*", F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("row")
    )
    rows = cut_lineage(tagged, "digests")
    # nulls first: struct order puts a null field lowest
    level = rows.select("run", "digest", "check", F.struct("id", "row").alias("best"), F.lit(1).cast("bigint").alias("n"))
    last_run = rows.agg(F.max("run")).first()[0] or 0
    while True:
        level = (
            level.withColumn("run", F.floor(F.col("run") / ARITY).cast("int"))
            .groupBy("run", "digest", "check")
            .agg(_keeper(keep, F.col("best")).alias("best"), F.sum("n").alias("n"))
        )
        last_run //= ARITY
        if not last_run:
            break
        level = cut_lineage(level.sortWithinPartitions("run", "digest"), "runs")
    merged = level.select("digest", "check", F.col("best").alias("best"), F.col("n").alias("group_size"))
    return rows.join(merged, ["digest", "check"]).select(
        F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("digest").alias("text_sha256"),
        F.col("check.bytes").cast("bigint").alias("n_bytes"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, all their columns unchanged: one row for each text.

    A null text is the empty text; of rows repeated with one id and text one stays, whichever. A null id counts as the lowest. An empty table
    gives an empty result; columns of any name may be there.
    """
    stay = exact_dedup(docs, id_col, text_col, keep).where("kept").select("keep_id", "text_sha256")
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = wrapped(docs, id=F.col(id_col), digest=F.sha2(body.cast("binary"), 256))
    left = rows.join(stay, (F.col("digest") == F.col("text_sha256")) & F.col("id").eqNullSafe(F.col("keep_id")), "left_semi")
    # what is left of a text has one identifier; its repeated rows are few, and only they are compared
    nth = F.row_number().over(Window.partitionBy("digest").orderBy("id"))
    return left.withColumn("nth", nth).where("nth = 1").select("whole.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = exact_dedup(table(spark, sf_dir, "documents"), keep="largest")
    return got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = """
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = max(doc_id) over g as kept, sha256(coalesce(text, '')) as text_sha256
from documents window g as (partition by coalesce(text, ''))
"""
