"""URL and crawl-log operators over the driver tables."""

from pyspark.sql import functions as F

from webloom.functions import ids
from webloom.operators import urls
from webloom.plans.registry import query

_URL = "case page_id % 4 when 0 then replace(url, '://', '://bob@') when 1 then replace(url, '.com', '.com:8080') else url end"


@query(
    "url_domain",
    rf"""select page_id, regexp_replace(regexp_replace(regexp_extract(u, '^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)', 1), '^.+@', ''), ':.+$', '') as domain,
    sha1(u) as url_key from (select page_id, {_URL} as u from pages)""",
)
def _(t):
    u = F.expr(_URL)
    return t.pages.select("page_id", ids.url_domain(u).alias("domain"), ids.url_key(u).alias("url_key"))


@query(
    "expand_urls",
    """select p_partkey, p as page, replace(replace(tpl, '{v}', replace(p_name, ' ', '+')), '{n}', cast(p as varchar)) as url
    from part, lateral (select unnest(range(0, p_size % 4 + 1)) as p), (values ('http://a/{v}?pn={n}'), ('http://b/{n}/{v}')) v(tpl)""",
)
def _(t):
    out = urls.expand_urls(
        t.part, ["http://a/{v}?pn={n}", "http://b/{n}/{v}"], F.lit(0).cast("bigint"), (F.col("p_size") % 4).cast("bigint"), F.col("p_name")
    )
    return out.select("p_partkey", "page", "url")


_ROUTES = [("blog", r"blog\..+/([0-9]+)"), ("page", r"/en/([0-9]+)"), ("other", r"https://.+/([^/]+)$")]


@query(
    "route_url",
    "select page_id, label, item_id from (select page_id, case "
    + " ".join(f"when regexp_matches(url, '{p}') then '{n}'" for n, p in _ROUTES)
    + " end as label, case "
    + " ".join(f"when regexp_matches(url, '{p}') then regexp_extract(url, '{p}', 1)" for n, p in _ROUTES)
    + " end as item_id from pages) where label is not null",
)
def _(t):
    return urls.route_url(t.pages.select("page_id", "url"), "url", _ROUTES).select("page_id", "label", "item_id")


_HREF = r'href="([^"]+)"'


@query(
    "new_links",
    rf"""select distinct u as url, sha1(u) as url_key from (select unnest(regexp_extract_all(html, '{_HREF}', 1)) as u from pages)
    where u not in (select unnest(regexp_extract_all(html, '{_HREF}', 1)) from pages where url like 'https%')""",
)
def _(t):
    def links(df):
        return df.select(F.explode(F.regexp_extract_all("html", F.lit(_HREF), 1)).alias("url"))

    return urls.new_links(links(t.pages), links(t.pages.where("url like 'https%'")))


_SEEN = "select distinct doc_id from labels"
_MISS = "select doc_id from documents where doc_id not in (select doc_id from labels) and lang <> 'fr'"


@query("missing_items", _MISS)
def _(t):
    return urls.missing_items(t.documents, t.labels.select("doc_id"), t.documents.where("lang = 'fr'").select("doc_id"), "doc_id")


@query("miss_counts", f"select 'miss' as what, count(*) as n from ({_MISS}) union all select 'seen', count(*) from ({_SEEN})")
def _(t):
    return urls.miss_counts(t.documents, t.labels.select("doc_id"), t.documents.where("lang = 'fr'").select("doc_id"), "doc_id")


def attempts(t):
    """user_id is the item, event kinds stand for start, finish and error."""
    kind = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "error", "error").otherwise("start")
    return t.events.select(F.col("user_id").alias("item"), kind.alias("kind"), F.col("ts").cast("timestamp").alias("ts"))


_STATUS = """with a as (select user_id as item, case event_type when 'purchase' then 'done' when 'error' then 'error' else 'start' end as kind, ts
      from events),
    d as (select item, max(ts) filter (kind = 'done') as last_done from a group by 1),
    o as (select a.item, count(*) as attempts, min(ts) as started from a join d using (item)
      where kind = 'start' and (last_done is null or ts > last_done) group by 1),
    s as (select item, coalesce(attempts, 0) as attempts, case when coalesce(attempts, 0) = 0 then 'done'
      when epoch(timestamp '2024-01-31') - floor(epoch(started)) <= 86400 then 'running' when attempts + 1 > 3 then 'failed' else 'requeue' end as status
      from d left join o using (item))"""


def _status(t):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    return urls.attempt_status(attempts(t), now, timeout=86400)


@query("attempt_status", _STATUS + " select item, attempts, status from s")
def _(t):
    return _status(t)


@query(
    "batch_progress",
    _STATUS
    + """ select item % 10 as batch, count(*) as total, count(*) filter (status = 'done') as success, count(*) filter (status = 'failed') as failed,
    count(*) filter (status not in ('done', 'failed')) as remaining, count(*) filter (status = 'error') as exceptions from s group by 1""",
)
def _(t):
    return urls.batch_progress(_status(t).withColumn("batch", F.col("item") % 10), "batch")


@query(
    "mean_cost_of_others",
    """with m as (select event_type, avg(value) as m from events group by 1)
    select event_type, round(m, 6) as mean_cost, round((select sum(m) from m) - m, 6) as others,
    round(greatest(200 - ((select sum(m) from m) - m), 0), 6) as wait from m""",
)
def _(t):
    out = urls.mean_cost_of_others(t.events, "event_type", F.col("value"), F.lit(200.0))
    return out.select("event_type", *[F.round(c, 6).alias(c) for c in ("mean_cost", "others", "wait")])


@query(
    "proxy_score",
    """with e as (select user_id, ts, event_id, event_type = 'error' as f from events),
    r as (select *, lag(f, 1) over w as p1, lag(f, 2) over w as p2, row_number() over w as i from e window w as (partition by user_id order by ts, event_id)),
    g as (select user_id, count(*) filter (not f) as uses, count(*) filter (f) as failures, count(*) filter (f and p1 and not p2) as evictions,
      count(*) as n, coalesce(max(i) filter (f), 0) as lf, arg_max(f, i) as l1, arg_max(p1, i) filter (i > 1) as l2 from r group by 1)
    select user_id, uses, failures, evictions, case when not l1 then lf - n when l2 = false then 0 end as score from g""",
)
def _(t):
    log = t.events.select(
        "user_id", "ts", F.col("event_id").alias("seq"), F.when(F.col("event_type") == "error", "failure").otherwise("use").alias("kind")
    )
    return urls.proxy_score(log, ["user_id"], F.date_trunc("hour", "ts"))


@query(
    "pass_ratio",
    """select user_id, count(*) as tries, count(*) filter (event_type <> 'error') as successes from events group by 1
    having count(*) filter (event_type <> 'error') >= count(*) * 0.8""",
)
def _(t):
    return urls.pass_ratio(t.events, "user_id", F.col("event_type") != "error", 0.8)


@query(
    "hex_position_entropy",
    """with c as (select i - 1 as position, substr(h, i, 1) as d, count(*) as n from (select sha1(text) as h from documents),
      (select cast(unnest(range(1, 41)) as int) as i) group by all),
    p as (select position, n / sum(n) over (partition by position) as p from c)
    select position, round(-sum(p * log2(p)), 6) as entropy from p group by 1""",
)
def _(t):
    out = urls.hex_position_entropy(t.documents, F.sha1("text"))
    return out.select("position", F.round("entropy", 6).alias("entropy"))
