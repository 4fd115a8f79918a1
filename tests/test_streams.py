"""Streams over several files give what the static job gives."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from webloom.streaming import streams


def land(spark, tmp_path, batches, ddl):
    """One parquet folder per batch, in order of arrival."""
    root = tmp_path / "in"
    schema = spark.createDataFrame([], ddl).schema
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(root / f"b{i}"))
    return streams.file_stream(spark, str(root / "*"), schema, files_per_batch=1)


def at(minutes, seconds=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes, seconds=seconds)


def test_item_fails_after_repeated_timeouts(spark, tmp_path):
    rows = [(1, "start", at(m), m) for m in (0, 10, 20)] + [(2, "start", at(1), 100), (2, "done", at(2), 101), (9, "start", at(600), 102)]
    rows.sort(key=lambda r: r[2])
    s = land(spark, tmp_path, [rows[:2], rows[2:4], rows[4:]], "item long, kind string, ts timestamp, seq long")
    got = streams.run_available(streams.attempt_timeouts(s), "t-attempts").orderBy("at").collect()
    assert [(r.item, r.status, r.attempts) for r in got] == [(1, "requeue", 1), (1, "requeue", 2), (1, "failed", 3)]
    assert got[0]["at"] == at(3)


def test_dedupe_within_delay(spark, tmp_path):
    s = land(spark, tmp_path, [[("a", at(0))], [("a", at(5)), ("b", at(6))]], "k string, ts timestamp")
    out = streams.run_available(streams.dedupe_stream(s, ["k"], "ts"), "t-dedupe")
    assert sorted(r.k for r in out.collect()) == ["a", "b"]


def test_windows_match_batch(spark, tmp_path):
    rows = [("x", at(m), 600.0 + m) for m in range(0, 90, 2)] + [("y", at(m), 100.0) for m in range(0, 90, 7)]
    rows.sort(key=lambda r: r[1])
    s = land(spark, tmp_path, [rows[:20], rows[20:40], rows[40:]], "target string, ts timestamp, value double")
    static = spark.createDataFrame(rows, "target string, ts timestamp, value double")
    end = at(88) - dt.timedelta(minutes=1)
    live = {tuple(r) for r in streams.run_available(streams.latency_alerts(s, "ts", "target", "value"), "t-lat").collect()}
    batch = {tuple(r) for r in streams.latency_alerts(static, "ts", "target", "value").collect() if r.start + dt.timedelta(minutes=3) <= end}
    assert live == batch and live


def test_quiet_period_waits_for_silence(spark, tmp_path):
    s = land(spark, tmp_path, [[("b1", at(0)), ("b1", at(20))], [("b2", at(30))], [("b2", at(55))]], "batch string, ts timestamp")
    got = streams.run_available(streams.quiet_period(s, "ts", "batch"), "t-quiet").collect()
    assert [(r.batch, r.n) for r in got] == [("b1", 2)]


def test_late_rows(spark):
    rows = [(0, at(0)), (1, at(50)), (2, at(10)), (3, at(49)), (4, at(60)), (5, at(5))]
    df = spark.createDataFrame(rows, "n int, ts timestamp")
    for width in (1, 2, 10):
        got = {r.n for r in streams.late_rows(df, "ts", "n", F.expr(f"n div {width}"), 600).collect()}
        assert got == {2, 5}


def test_question_stream_upserts(spark, tmp_path):
    s = land(spark, tmp_path, [[(1, "什么是长城", 1), (2, "你好", 2)], [(1, "什么是长城？", 3)]], "id int, question string, n int")
    stored = spark.createDataFrame([(1, "墙")], "id int, answer string")
    out = streams.run_upsert(streams.question_stream(s, stored, "question", ["id"]), "t-q", ["id"], ["n"])
    assert [(r.id, r.question, r.answer) for r in out.collect()] == [(1, "什么是长城？", "墙")]


def test_upsert_sink_keeps_few_runs(spark, tmp_path):
    path, want, rng = str(tmp_path / "sink"), {}, random.Random(7)
    write = streams.upsert_sink(path, ["k"], ["n"])
    for number in range(75):
        rows = [(rng.randrange(40), number * 10 + i) for i in range(rng.randrange(4))]
        batch = spark.createDataFrame(rows, "k int, n int").coalesce(1)
        for _ in range(1 + (number % 8 == 7 or number == 63)):  # a batch that is done twice does no harm
            write(batch, number)
        want.update({k: n for k, n in sorted(rows, key=lambda r: r[1])})
        if number in (0, 6, 7, 8, 62, 63, 74):
            got = streams.read_upserted(spark, path, ["k"], ["n"])
            assert {r.k: r.n for r in got.collect()} == want and got.columns == ["k", "n"]
            assert len(streams.runs_in_use(spark, path)) <= 14
    stored = spark.read.parquet(*streams.runs_in_use(spark, path)).count()
    assert stored <= 40 * 2 + 3 * 8  # live rows once a level, and the last batches


def test_a_batch_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "sink")
    write = streams.upsert_sink(path, ["k"], ["n"])
    batch = lambda number: spark.createDataFrame([(1, number), (number + 10, number)], "k int, n int").coalesce(1)
    for number in range(7):
        write(batch(number), number)
    before = sorted(streams.read_upserted(spark, path, ["k"], ["n"]).collect())
    monkeypatch.setattr(streams, "last_per_key", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        write(batch(7), 7)  # its run is written, the merge is not
    monkeypatch.undo()
    assert sorted(streams.read_upserted(spark, path, ["k"], ["n"]).collect()) == before
    write(batch(7), 7)
    got = {r.k: r.n for r in streams.read_upserted(spark, path, ["k"], ["n"]).collect()}
    assert got == {1: 7, **{n + 10: n for n in range(8)}}


def test_an_item_with_very_many_entries(spark, tmp_path):
    n = 300_000
    root = str(tmp_path / "in" / "b0")
    kind = F.when(F.col("id") == n - 1, "done").when(F.col("id") % 3 == 0, "start").otherwise("error")
    rows = spark.range(n).select(F.lit(5).cast("long").alias("item"), kind.alias("kind"), F.timestamp_seconds(F.lit(1.7e9) + F.col("id") * 100).alias("ts"), F.col("id").alias("seq"))
    rows.repartition(3).write.parquet(root)
    later = spark.range(1).select(F.lit(6).cast("long").alias("item"), F.lit("start").alias("kind"), F.timestamp_seconds(F.lit(1.9e9)).alias("ts"), F.lit(n).cast("long").alias("seq"))
    later.write.parquet(str(tmp_path / "in" / "b1"))
    got = streams.run_available(streams.attempt_timeouts(streams.file_stream(spark, str(tmp_path / "in" / "*"), rows.schema), timeout=180), "t-many")
    # every third entry starts an attempt, which has run out two entries later
    assert got.where("item = 5").count() == n // 3 and got.where("status = 'requeue'").count() == 2
