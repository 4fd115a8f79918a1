"""Live jobs on Structured Streaming, each usable on a static table too.

Sinks are parquet folders under the shared checkpoint folder; every query keeps its
own checkpoint there, so a restarted query goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from webloom.operators.textops import is_fact_question_regex
from webloom.scale import last_per_key
from webloom.session import scratch_path


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """Stream of the parquet files that land under ``path`` (a folder or a glob)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_available(df: DataFrame, label: str) -> DataFrame:
    """Process all available input in append mode and return what the sink holds."""
    spark = df.sparkSession
    out, mark = scratch_path(spark, label), scratch_path(spark, f"{label}-state")
    query = (
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


# --- windows -----------------------------------------------------------------


def dedupe_stream(df: DataFrame, keys: list[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """The first row of a key; later rows are dropped while the key is remembered, which is
    ``delay`` in event time. A static table is deduplicated as a whole."""
    if not df.isStreaming:
        return df.dropDuplicates(keys)
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def _watermarked(df: DataFrame, ts: str, delay: str) -> DataFrame:
    return df.withWatermark(ts, delay) if df.isStreaming else df


def daily_counts(df: DataFrame, ts: str, keys: list[str], delay: str = "1 hour") -> DataFrame:
    """Rows per key and day; a day is final once the watermark passes its end."""
    return (
        _watermarked(df, ts, delay).groupBy(F.window(ts, "1 day"), *keys).agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("day"), *keys, "n")
    )


def daily_delta(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Change of each day's count against the key's previous day in the table. There is one
    row per key and day, so a key's window stays small."""
    w = Window.partitionBy(*keys).orderBy("day")
    return counts.withColumn("delta", F.col("n") - F.lag("n").over(w))


def quiet_period(df: DataFrame, ts: str, key: str, gap: str = "30 minutes", delay: str = "0 seconds") -> DataFrame:
    """Bursts of a key that ended with ``gap`` of silence: (key, first, last, n)."""
    return (
        _watermarked(df, ts, delay).groupBy(F.session_window(ts, gap).alias("_s"), key)
        .agg(F.min(ts).alias("first"), F.max(ts).alias("last"), F.count(F.lit(1)).alias("n"))
        .select(key, "first", "last", "n")
    )


def latency_alerts(df: DataFrame, ts: str, target: str, value: str, size: str = "3 minutes", limit: float = 500.0,
                   delay: str = "1 minute") -> DataFrame:
    """Windows of a target in which even the smallest latency passes the limit."""
    return (
        _watermarked(df, ts, delay).groupBy(F.window(ts, size), target).agg(F.min(value).alias("min_value"))
        .where(F.col("min_value") > limit).select(F.col("window.start").alias("start"), target, "min_value")
    )


def health_rounds(df: DataFrame, ts: str, target: str, value: str, size: str = "3 minutes", limit: float = 500.0,
                  delay: str = "1 minute") -> DataFrame:
    """Per window: ``all_ok``, ``all_bad`` or ``some_bad`` over the targets seen in it."""
    per = _watermarked(df, ts, delay).groupBy(F.window(ts, size).alias("_w"), target).agg((F.min(value) > limit).alias("bad"))
    rounds = per.groupBy(F.window(F.window_time("_w"), size).alias("_r")).agg(
        F.count(F.lit(1)).alias("targets"), F.count(F.when(F.col("bad"), 1)).alias("n_bad")
    )
    state = F.when(F.col("n_bad") == 0, "all_ok").when(F.col("n_bad") == F.col("targets"), "all_bad").otherwise("some_bad")
    return rounds.select(F.col("_r.start").alias("start"), "targets", "n_bad", state.alias("state"))


def sliding_rate(df: DataFrame, ts: str, key: str, size: str = "60 seconds", step: str = "10 seconds", delay: str = "1 minute") -> DataFrame:
    """Calls of a key per sliding window."""
    return (
        _watermarked(df, ts, delay).groupBy(F.window(ts, size, step), key).agg(F.count(F.lit(1)).alias("calls"))
        .select(F.col("window.start").alias("start"), key, "calls")
    )


def late_rows(df: DataFrame, ts: str, arrival: str, chunk: Column, seconds: int) -> DataFrame:
    """Rows of a stored table that came more than ``seconds`` after a later event, in order
    of ``arrival``: what a watermark of that delay may drop. Maxima run within chunks of
    arrivals, the maximum before a chunk comes from one row per chunk."""
    rows = df.withColumn("_c", chunk)
    tops = rows.groupBy("_c").agg(F.max(ts).alias("_top"))
    # One row per chunk: this window is over the chunk table, not over the rows.
    before = Window.orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("_c", F.max("_top").over(before).alias("_before"))
    inner = Window.partitionBy("_c").orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.join(tops, "_c").withColumn("_seen", F.greatest(F.max(ts).over(inner), F.col("_before")))
    late = F.unix_micros(F.col("_seen").cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))
    return seen.where(late > seconds * 1_000_000).select(*df.columns, (late / 1_000_000).alias("late_by"))


# --- keyed state -------------------------------------------------------------

ATTEMPT_OUT = T.StructType([
    T.StructField("item", T.LongType()), T.StructField("status", T.StringType()),
    T.StructField("attempts", T.IntegerType()), T.StructField("at", T.TimestampType()),
])
ATTEMPT_STATE = T.StructType([T.StructField("attempts", T.IntegerType()), T.StructField("started", T.LongType())])


START, DONE = 1, 2


def attempt_events(timeout: int, max_fail: int) -> Callable:
    """State function of one item: (attempts, start of the open attempt in ms, -1 if none)."""
    wait = timeout * 1000

    def verdict(item: int, attempts: int, started: int) -> tuple:
        status = "failed" if attempts + 1 > max_fail else "requeue"
        return item, status, attempts, pd.Timestamp(started + wait, unit="ms")

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        attempts, started = state.get if state.exists else (0, -1)
        out = []
        if state.hasTimedOut:
            if started >= 0:
                out.append(verdict(key[0], attempts, started))
            started = -1
        else:
            # of an entry only its place, moment and kind are held: a million entries of an item are some 20 MB
            held = [
                (f["ts"].astype("datetime64[us]").astype("int64").to_numpy(), f["seq"].to_numpy(),
                 np.select([f["kind"] == "start", f["kind"] == "done"], [START, DONE], 0).astype(np.int8))
                for f in batches
            ]
            micros, seq, kinds = (np.concatenate(column) for column in zip(*held, strict=True))
            del held
            for i in np.lexsort((seq, micros)):
                kind, at = kinds[i], int(micros[i]) // 1000
                if 0 <= started < at - wait:  # the attempt had run out before this entry
                    out.append(verdict(key[0], attempts, started))
                    started = -1
                if kind == START:
                    attempts += 1
                    started = at if started < 0 else started
                elif kind == DONE:
                    attempts, started = 0, -1
        if attempts or started >= 0:
            state.update((attempts, started))
            if started >= 0:
                state.setTimeoutTimestamp(max(started + wait, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=["item", "status", "attempts", "at"]).astype({"attempts": "int32"})

    return update


def attempt_timeouts(df: DataFrame, timeout: int = 180, max_fail: int = 3, delay: str = "1 minute") -> DataFrame:
    """(item, status, attempts, at): an attempt open for more than ``timeout`` seconds of
    event time is requeued, or failed once attempts + 1 exceeds ``max_fail``; a finish
    clears the item. Input stream: item, kind (start, done, ...), ts, seq.

    An item's entries of one micro-batch are ordered in memory, as numbers of 17 bytes an entry; the size of a batch
    (``files_per_batch`` of the source) bounds what a hot item can hold.
    """
    return (
        df.withWatermark("ts", delay).groupBy("item")
        .applyInPandasWithState(attempt_events(timeout, max_fail), ATTEMPT_OUT, ATTEMPT_STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )


# --- questions ---------------------------------------------------------------


def question_stream(questions: DataFrame, answers: DataFrame, question: str, keys: list[str], is_fact: Column | None = None) -> DataFrame:
    """Factual questions with their best stored answer (null when there is none)."""
    rule = is_fact_question_regex(F.col(question)) if is_fact is None else is_fact
    return questions.where(rule).join(answers, keys, "left")


#: Runs of one level that are merged into one run of the next.
FAN = 8


def _digits(count: int) -> list[int]:
    """How many runs each level holds after ``count`` batches."""
    out = []
    while count:
        out.append(count % FAN)
        count //= FAN
    return out


def _run(path: str, level: int, slot: int) -> str:
    return f"{path}/level{level}-run{slot}"


def upsert_sink(path: str, keys: list[str], order: list[str]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that stores each batch as a run and merges ``FAN`` runs of a level into one of the next, which
    keeps the last row of a key only.

    A run is written where no run in use is, and comes into use with the batch number written last. So a
    repeated batch writes the same runs again, whatever broke off before, and the number of runs grows with the logarithm of the
    batches. Rows carry their batch in ``_batch``.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("_batch", F.lit(number).cast("bigint"))
        rows.write.mode("overwrite").parquet(_run(path, 0, number % FAN))
        count, level = number + 1, 0
        while count % FAN == 0:
            runs = spark.read.schema(rows.schema).parquet(*[_run(path, level, i) for i in range(FAN)])
            count, level = count // FAN, level + 1
            merged = last_per_key(runs, keys, ["_batch", *order])
            merged.write.mode("overwrite").parquet(_run(path, level, (count - 1) % FAN))
        spark.range(1).select(F.lit(number).cast("bigint").alias("number")).coalesce(1).write.mode("overwrite").parquet(f"{path}/last")

    return write


def runs_in_use(spark: SparkSession, path: str) -> list[str]:
    count = spark.read.parquet(f"{path}/last").first()["number"] + 1
    return [_run(path, level, slot) for level, n in enumerate(_digits(count)) for slot in range(n)]


def read_upserted(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame:
    """Current rows of an upsert sink: per key the last by batch and ``order``."""
    return last_per_key(spark.read.parquet(*runs_in_use(spark, path)), keys, ["_batch", *order]).drop("_batch")


def run_upsert(df: DataFrame, label: str, keys: list[str], order: list[str]) -> DataFrame:
    """Process all available input into an upsert sink and return its current rows."""
    spark = df.sparkSession
    out, mark = scratch_path(spark, label), scratch_path(spark, f"{label}-state")
    query = (
        df.writeStream.foreachBatch(upsert_sink(out, keys, order)).option("checkpointLocation", mark).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return read_upserted(spark, out, keys, order)
