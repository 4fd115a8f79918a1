"""Streaming jobs over the event and conversation files, checked against their static twins."""

from pyspark.sql import functions as F

from webloom.plans.qa_queries import qa_pairs
from webloom.plans.registry import query
from webloom.scale import global_index
from webloom.streaming import streams


def events(t):
    """The event file as a stream, with a time-zoned event time."""
    s = streams.file_stream(t.spark, t.stream_path("events"), t.events.schema)
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def _text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def _mark(delay):
    return f"(select make_timestamp((epoch_us(max(ts)) // 1000) * 1000) - interval '{delay}' from events)"


@query(
    "question_stream",
    """with p as (select u.conv_id, u.turn, u.text as question, a.text as answers from conversations u left join conversations a
      on a.conv_id = u.conv_id and a.turn = u.turn + 1 and a.role = 'assistant' where u.role = 'user')
    select * from p where regexp_matches(question, '(the|que|und)') and length(question) < 600""",
)
def _(t):
    s = streams.file_stream(t.spark, t.stream_path("conversations"), t.conversations.schema)
    q = s.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    stored = qa_pairs(t).where("answers is not null").select("conv_id", "turn", "answers")
    fact = F.rlike("question", F.lit("(the|que|und)")) & (F.length("question") < 600)
    return streams.run_upsert(streams.question_stream(q, stored, "question", ["conv_id", "turn"], fact), "questions", ["conv_id", "turn"], ["question"])


@query("dedupe_stream", "select distinct user_id, event_type from events")
def _(t):
    d = streams.dedupe_stream(events(t), ["user_id", "event_type"], "ts", "60 days")
    return streams.run_available(d.select("user_id", "event_type"), "dedupe")


_DAILY = f"""select strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') as day, event_type, count(*) as n from events
    group by date_trunc('day', ts), event_type having date_trunc('day', ts) + interval '1 day' <= {_mark('1 hour')}"""


@query("daily_counts_stream", _DAILY)
def _(t):
    return streams.run_available(streams.daily_counts(events(t), "ts", ["event_type"]), "daily").select(_text("day"), "event_type", "n")


@query("daily_delta", f"select day, event_type, n, n - lag(n) over (partition by event_type order by day) as delta from ({_DAILY})")
def _(t):
    counts = streams.run_available(streams.daily_counts(events(t), "ts", ["event_type"]), "daily")
    return streams.daily_delta(counts, ["event_type"]).select(_text("day"), "event_type", "n", "delta")


@query(
    "attempt_timeout_stream",
    """with recursive e as (select user_id as item, case event_type when 'purchase' then 'done' when 'error' then 'error' else 'start' end as kind, epoch_us(ts) // 1000 as ms,
      row_number() over (partition by user_id order by ts, event_id) as i from events),
    w as (select item, 0::bigint as i, 0 as attempts, cast(null as bigint) as started, cast(null as varchar) as status, 0 as tried, cast(null as bigint) as out_at from (select distinct item from e)
      union all select e.item, e.i, case e.kind when 'start' then w.attempts + 1 when 'done' then 0 else w.attempts end,
      case e.kind when 'start' then case when w.started is null or w.started < e.ms - 7200000 then e.ms else w.started end when 'done' then null
        else case when w.started < e.ms - 7200000 then null else w.started end end,
      case when w.started < e.ms - 7200000 then case when w.attempts + 1 > 3 then 'failed' else 'requeue' end end, w.attempts, w.started + 7200000
      from w join e on e.item = w.item and e.i = w.i + 1),
    z as (select item, status, tried as attempts, out_at from w where status is not null
      union all select item, case when attempts + 1 > 3 then 'failed' else 'requeue' end, attempts, started + 7200000 from w
      where started is not null and started + 7200000 < (select max(ms) from e) - 60000 and (item, i) in (select item, max(i) from e group by 1))
    select item, status, attempts, strftime(make_timestamp(out_at * 1000), '%Y-%m-%d %H:%M:%S') as "at" from z""",
)
def _(t):
    kind = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "error", "error").otherwise("start")
    s = events(t).select(F.col("user_id").alias("item"), kind.alias("kind"), "ts", F.col("event_id").alias("seq"))
    out = streams.run_available(streams.attempt_timeouts(s, timeout=7200), "attempts")
    return out.select("item", "status", "attempts", _text("at"))


@query(
    "quiet_period_stream",
    f"""with m as (select *, case when ts - lag(ts) over (partition by user_id order by ts) >= interval '30 minutes' then 1 else 0 end as cut from events),
    s as (select *, sum(cut) over (partition by user_id order by ts rows unbounded preceding) as s from m)
    select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as first, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last, count(*) as n from s
    group by user_id, s having max(ts) + interval '30 minutes' <= {_mark('0 minutes')}""",
)
def _(t):
    out = streams.run_available(streams.quiet_period(events(t), "ts", "user_id"), "quiet")
    return out.select("user_id", _text("first"), _text("last"), "n")


_SLOT3 = "time_bucket(interval '3 minutes', ts, timestamp '1970-01-01')"


@query(
    "latency_alert_stream",
    f"""select strftime({_SLOT3}, '%Y-%m-%d %H:%M:%S') as start, event_type, min(value) as min_value from events
    group by {_SLOT3}, event_type having min(value) > 60 and {_SLOT3} + interval '3 minutes' <= {_mark('1 minute')}""",
)
def _(t):
    out = streams.run_available(streams.latency_alerts(events(t), "ts", "event_type", "value", limit=60.0), "latency")
    return out.select(_text("start"), "event_type", "min_value")


_HOUR = "time_bucket(interval '60 minutes', ts, timestamp '1970-01-01')"


@query(
    "health_rounds_stream",
    f"""with p as (select {_HOUR} as w, event_type, min(value) > 20 as bad from events group by {_HOUR}, event_type having {_HOUR} + interval '60 minutes' <= {_mark('1 minute')})
    select strftime(w, '%Y-%m-%d %H:%M:%S') as start, count(*) as targets, count(*) filter (bad) as n_bad,
    case when count(*) filter (bad) = 0 then 'all_ok' when count(*) filter (bad) = count(*) then 'all_bad' else 'some_bad' end as state from p group by w""",
)
def _(t):
    out = streams.run_available(streams.health_rounds(events(t), "ts", "event_type", "value", "60 minutes", 20.0), "health")
    return out.select(_text("start"), "targets", "n_bad", "state")


@query(
    "sliding_rate_stream",
    f"""with w as (select event_type, time_bucket(interval '10 seconds', ts, timestamp '1970-01-01') - to_seconds(10 * k) as start from events, (select unnest(range(0, 6)) as k))
    select strftime(start, '%Y-%m-%d %H:%M:%S') as start, event_type, count(*) as calls from w group by all having w.start + interval '60 seconds' <= {_mark('1 minute')}""",
)
def _(t):
    return streams.run_available(streams.sliding_rate(events(t), "ts", "event_type"), "sliding").select(_text("start"), "event_type", "calls")


@query(
    "late_rows",
    """with r as (select event_id, ts, max(ts) over (order by (event_id * 7919) % 1000003, event_id rows between unbounded preceding and 1 preceding) as seen from events)
    select event_id, round((epoch_us(seen) - epoch_us(ts)) / 1e6, 3) as late_by from r where epoch_us(seen) - epoch_us(ts) > 86400000000""",
)
def _(t):
    e = global_index(t.events.select("event_id", "ts"), [(F.col("event_id") * 7919) % 1000003, F.col("event_id")], "arrival")
    out = streams.late_rows(e, "ts", "arrival", F.floor(F.col("arrival") / 10_000), 86400)
    return out.select("event_id", F.round("late_by", 3).alias("late_by"))
