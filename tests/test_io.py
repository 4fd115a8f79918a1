"""Sources and sinks on real files."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.operators import pages
from webloom.sources import io

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def test_read_records_keeps_bad_lines(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"a": 1, "b": "x"}\n\n   \n{"a": 2\n{"b": "y"}\n')
    good, bad = io.read_records(spark, str(tmp_path / "r.json"), SCHEMA)
    assert {tuple(r) for r in good.collect()} == {(1, "x"), (None, "y")}
    assert [r.line for r in bad.collect()] == ['{"a": 2']


def test_read_lexicon(spark, tmp_path):
    (tmp_path / "l.txt").write_text("# note\n  red 5 n\nred\n\nblue\n")
    assert {r.term for r in io.read_lexicon(spark, str(tmp_path / "l.txt")).collect()} == {"red", "blue"}


def test_read_batches_and_newest(spark, tmp_path):
    for day in ("20240101", "20240103"):
        d = tmp_path / f"daily-{day}"
        d.mkdir()
        (d / "x").write_text(json.dumps({"a": int(day), "b": "v"}) + "\n")
    (tmp_path / "other-20250101").mkdir()
    (tmp_path / "other-20250101" / "x").write_text('{"a": 9}\n')
    df, broken = io.read_batches(spark, str(tmp_path), "daily-", SCHEMA)
    assert {(r.a, r.batch, str(r.batch_date)) for r in df.collect()} == {
        (20240101, "daily-20240101", "2024-01-01"), (20240103, "daily-20240103", "2024-01-03"),
    }
    assert [r.a for r in io.newest_batch(df).collect()] == [20240103]


def test_write_compacted(spark, tmp_path):
    df = spark.createDataFrame([(str(i), f"body {i}") for i in range(50)], "key string, body string")
    io.write_compacted(df, "key", 4, str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert back.count() == 50
    assert {r.shard for r in back.select("shard").distinct().collect()} <= {0, 1, 2, 3}


def test_large_shards_are_dealt_over_several_tasks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(io, "PART_BYTES", 4_000, raising=False)
    df = spark.createDataFrame([(str(i), "x" * 100) for i in range(400)] + [(None, "y")], "key string, body string")
    held = io.compact_objects(df, "key", 2).withColumn("task", F.spark_partition_id()).groupBy("shard", "task").count().collect()
    assert sum(r["count"] for r in held) == 401 and max(r["count"] for r in held) < 150
    io.write_compacted(df, "key", 2, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 401


def test_write_paged(spark, tmp_path):
    df = spark.createDataFrame([(i, ["x", str(i)]) for i in range(25)], "k int, tags array<string>").repartition(3)
    io.write_paged(df, ["k"], str(tmp_path / "pages"), page_size=10)
    back = spark.read.option("header", True).csv(str(tmp_path / "pages"))
    assert {r.page: r.n for r in back.groupBy("page").agg(F.count("*").alias("n")).collect()} == {0: 10, 1: 10, 2: 5}
    assert back.where("k = 7").first().tags == "x,7"


def test_insert_and_upsert(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 20, 1), ("c", 30, 2), ("c", 31, 3)], "k string, v int, seq int")
    rows = lambda df: {tuple(r) for r in df.collect()}
    assert rows(io.insert_new(new, target, "k", ["seq"])) == {("a", 1), ("b", 2), ("c", 30)}
    assert rows(io.insert_new(new, target, "k", ["seq"], refresh=True)) == {("a", 1), ("b", 20), ("c", 30)}
    assert rows(io.upsert_by_id(new, target, "k", ["seq"])) == {("a", 1), ("b", 20), ("c", 31)}


def test_update_then_upsert_keeps_every_claim(spark):
    docs = spark.createDataFrame([("d",), ("e",)], "id string")
    own = spark.createDataFrame([("d", 0, "name", "D", None)], "id string, pos long, p string, o string, rid string")
    inv = spark.createDataFrame([("d", i, f"n{i}", "u") for i in range(5)] + [("e", 1, "m", "u"), ("zz", 1, "n", "u")], "id string, seq long, name string, url string")
    claims = io.update_nested(own, io.investment_claims(inv, "id", F.expr("seq div 2")), docs, "id")
    rows = claims.orderBy("id", "pos").collect()
    assert [(r.id, r.pos) for r in rows] == [("d", i) for i in range(16)] + [("e", i) for i in range(3)]
    assert [r.rid for r in rows if r.p == "子公司名称"] == ["_111", "_222", "_333", "_444", "_555", "_111"]
    keyed = claims.withColumn("key", F.concat_ws("/", "id", F.col("pos").cast("string"))).withColumn("seq", F.lit(0))
    stored = io.upsert_by_id(keyed, keyed.drop("seq").limit(0), "key", ["seq"])
    assert stored.count() == 19


def test_read_dump(spark, tmp_path):
    (tmp_path / "d.txt").write_text("Alpha\n@@@LINK=Beta\n</>\nGamma\ntext\n</>\n")
    got = {tuple(r) for r in pages.read_dump(spark, str(tmp_path / "d.txt")).collect()}
    assert got == {("Alpha", "Beta"), ("Gamma", None)}


def test_latest_page_strips_batch_digits(spark):
    accessed = spark.createDataFrame([("h1", "daily-2024"), ("h2", "weekly-2024")], "url_hash string, batch_id string")
    cached = spark.createDataFrame([(1, "h1", 1), (2, "h1", 2), (3, "h2", 9)], "id int, url_hash string, created_time int")
    contents = spark.createDataFrame([(1, "old"), (2, "new"), (3, "other")], "cached_id int, content string")
    got = io.latest_page(accessed, cached, contents, "daily-2099").collect()
    assert [(r.url_hash, r.content) for r in got] == [("h1", "new")]


def test_shard_is_digest_modulo_n(spark):
    import hashlib

    keys = [f"key-{i}" for i in range(40)] + [""]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for n in (1, 7, 1000, 99991):
        got = [r[0] for r in df.select(io.shard_of(F.col("k"), n)).collect()]
        assert got == [int(hashlib.sha1(k.encode()).hexdigest(), 16) % n for k in keys]
