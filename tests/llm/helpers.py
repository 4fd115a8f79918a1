"""Small tables for the operators' tests."""

import os

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Column names that operators use themselves: they must not disturb.
CLASHES = "id row key size n digest check best rank target finish kept keep_id component label item bytes shard slot run name k1 a b words at nth _id _digest _hash _times".split()


def documents(spark, rows, extra=True):
    """A documents table of (doc_id, text[, lang[, source]]) with columns of clashing names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None) for r in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string")
    if extra:
        for c in CLASHES:
            df = df.selectExpr("*", f"'x' as `{c}`")
    return df


def load(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (None, "a null id"), (5, "é" * 3000), (6, "same text here"), (6, "same text here"), (7, "same text here")]
