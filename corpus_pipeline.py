"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), reads all that its predecessor kept, and returns a DataFrame; all but the last return
the columns of ``documents``. ``run`` writes each stage's result as Parquet and reads it again for the next.

Every stage takes rows with nulls in any column, empty and very long texts, repeated rows, further columns of any name, and an empty table, which
stays empty. A null text counts as the empty text: it is not toxic, is a copy of other empty texts, is like no other text, and is never
taken by the mix. A row with a null id is scored like any other, counts as the lowest id among equal texts, and is nobody's near copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webloom.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from webloom.llm.common import held_out, table
from webloom.session import scratch_path

#: Some stages cannot be put in SQL (a trained model, weighted samples); tests/llm/test_pipeline.py checks the run by brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more by the clause grammar go."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~held_out(labels["doc_id"])))
    return toxicity.keep_clean(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays, once if it is repeated."""
    return exact_dedup.drop_copies(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays; a text without a word is in no group."""
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those without a word never."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens, packed into sequences."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
