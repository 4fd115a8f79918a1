"""Sources and sinks over the driver tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.plans.registry import query
from webloom.session import scratch_path
from webloom.sources import io

_LINES = "case event_id % 50 when 7 then '{\"k\": ' when 9 then '  ' else props end"


@query(
    "read_records",
    f"""select k, count(*) as n from (select event_id, {_LINES} as p from events where event_id % 50 not in (7, 9)) e,
    lateral (select cast(json_extract(p, '$.k') as int) as k) group by k
    union all select -1, count(*) from events where event_id % 50 = 7""",
)
def _(t):
    lines = t.events.select(F.expr(_LINES).alias("value"))
    good, bad = io.parse_json_lines(lines, "value", T.StructType([T.StructField("k", T.IntegerType())]))
    n = F.count(F.lit(1)).alias("n")
    return good.groupBy("k").agg(n).unionByName(bad.agg(n).select(F.lit(-1).alias("k"), "n"))


_TERMS = "case p_partkey % 10 when 0 then '# ' || p_name when 1 then '   ' else '  ' || p_name || ' ' || p_brand end"


@query(
    "read_lexicon",
    f"""select distinct split_part(w, ' ', 1) as term from (select trim({_TERMS}) as w from part) where w <> '' and not starts_with(w, '#')""",
)
def _(t):
    return io.lexicon_terms(t.part.select(F.expr(_TERMS).alias("value")))


@query(
    "effective_lexicon",
    """select p_name as term from part where p_name not in (select p_name from part where p_size > 45)
    union select p_brand from part where p_type = 'PROMO'""",
)
def _(t):
    term = t.part.select(F.col("p_name").alias("term"))
    minus = t.part.where("p_size > 45").select(F.col("p_name").alias("term"))
    return io.effective_lexicon(term, minus, t.part.where("p_type = 'PROMO'").select(F.col("p_brand").alias("term")))


@query(
    "newest_batch",
    """select o_orderkey, b as batch from (select o_orderkey, 'daily-' || strftime(o_orderdate, '%Y%m%d') as b from orders)
    where b = (select max('daily-' || strftime(o_orderdate, '%Y%m%d')) from orders)""",
)
def _(t):
    return io.newest_batch(t.orders.select("o_orderkey", F.concat(F.lit("daily-"), F.date_format("o_orderdate", "yyyyMMdd")).alias("batch")))


def _duck_shard(digest: str, n: int) -> str:
    rest = "0::bigint"
    for at in range(1, 41, 4):
        rest = f"(({rest}) * 65536 + cast('0x' || substr({digest}, {at}, 4) as bigint)) % {n}"
    return rest


@query(
    "compact_objects",
    f"""select cast({_duck_shard('h', 7)} as int) as shard, count(*) as n, cast(sum(length(text)) as bigint) as chars
    from (select sha1(cast(doc_id as varchar)) as h, text from documents) group by 1""",
)
def _(t):
    d = io.compact_objects(t.documents.select(F.col("doc_id").cast("string").alias("key"), "text"), "key", 7)
    return d.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


def _duck_insert(refresh: bool) -> str:
    fresh = """select o_custkey, o_orderkey, o_totalprice from orders where o_orderdate >= timestamp '1997-01-01'
      qualify row_number() over (partition by o_custkey order by o_orderkey) = 1"""
    stored = """select o_custkey, o_orderkey, o_totalprice from orders where o_orderdate < timestamp '1997-01-01'
      qualify row_number() over (partition by o_custkey order by o_orderkey) = 1"""
    if refresh:
        return f"with f as ({fresh}), s as ({stored}) select * from s where o_custkey not in (select o_custkey from f) union all select * from f"
    return f"with f as ({fresh}), s as ({stored}) select * from s union all select * from f where o_custkey not in (select o_custkey from s)"


def _orders(t, cond):
    return t.orders.where(cond).select("o_custkey", "o_orderkey", "o_totalprice")


@query("insert_new", _duck_insert(False))
def _(t):
    stored = io.first_per_key(_orders(t, "o_orderdate < timestamp_ntz '1997-01-01'"), ["o_custkey"], ["o_orderkey"])
    return io.insert_new(_orders(t, "o_orderdate >= timestamp_ntz '1997-01-01'"), stored, "o_custkey", ["o_orderkey"])


@query("insert_refresh", _duck_insert(True))
def _(t):
    stored = io.first_per_key(_orders(t, "o_orderdate < timestamp_ntz '1997-01-01'"), ["o_custkey"], ["o_orderkey"])
    return io.insert_new(_orders(t, "o_orderdate >= timestamp_ntz '1997-01-01'"), stored, "o_custkey", ["o_orderkey"], refresh=True)


@query(
    "upsert_by_id",
    """with f as (select o_custkey, o_orderkey, o_totalprice from orders
      qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1),
    s as (select c_custkey as o_custkey, cast(-1 as bigint) as o_orderkey, c_acctbal as o_totalprice from customer)
    select * from s where o_custkey not in (select o_custkey from f) union all select * from f""",
)
def _(t):
    stored = t.customer.select(
        F.col("c_custkey").alias("o_custkey"), F.lit(-1).cast("bigint").alias("o_orderkey"), F.col("c_acctbal").alias("o_totalprice")
    )
    return io.upsert_by_id(_orders(t, "true"), stored, "o_custkey", ["o_orderkey"])


@query("duplicate_ids", "select o_custkey, count(*) as n from orders group by all having count(*) > 1")
def _(t):
    return io.duplicate_ids(t.orders, "o_custkey")


@query(
    "update_nested",
    """with c as (select s_suppkey, p_partkey, p_name, row_number() over (partition by s_suppkey order by p_partkey) - 1 as i
      from part join supplier on p_partkey % 90 = s_suppkey)
    select s_suppkey, 0 as pos, 'name' as p, s_name as o, null as rid from supplier
    union all select s_suppkey, i * 3 + 1, '对外投资', null, '_' || cast((i + 1) * 111 as varchar) from c
    union all select s_suppkey, i * 3 + 2, '子公司名称', p_name, '_' || cast((i + 1) * 111 as varchar) from c
    union all select s_suppkey, i * 3 + 3, 'source.url', cast(p_partkey as varchar), '_' || cast((i + 1) * 111 as varchar) from c""",
)
def _(t):
    inv = t.part.select(
        (F.col("p_partkey") % 90).alias("s_suppkey"), F.col("p_partkey").alias("seq"), F.col("p_name").alias("name"),
        F.col("p_partkey").cast("string").alias("url"),
    )
    patch = io.investment_claims(inv, "s_suppkey", F.expr("seq div 100000"))
    own = t.supplier.select("s_suppkey", F.lit(0).cast("bigint").alias("pos"), F.lit("name").alias("p"), F.col("s_name").alias("o"), F.lit(None).cast("string").alias("rid"))
    return io.update_nested(own, patch, t.supplier, "s_suppkey")


@query(
    "write_paged",
    """select (row_number() over (order by o_totalprice, o_orderkey) - 1) // 2000 as page, o_orderkey,
    row_number() over (order by o_totalprice, o_orderkey) - 1 as idx from orders""",
)
def _(t):
    return io.paged(t.orders.select("o_totalprice", "o_orderkey"), ["o_totalprice", "o_orderkey"]).select("page", "o_orderkey", "idx")


@query(
    "latest_page",
    """with a as (select sha1(url) as url_hash, page_id, case page_id % 3 when 0 then 'daily-2024010' else 'weekly-2024010' end
      || cast(page_id % 7 as varchar) as batch_id from pages),
    c as (select url_hash, event_id as id, ts as created_time, props as content from events join a on user_id = page_id)
    select url_hash, id as cached_id, cast(created_time as varchar) as created, content from c
    where url_hash in (select url_hash from a where starts_with(batch_id, 'daily-'))
    qualify row_number() over (partition by url_hash order by created_time desc, id desc) = 1""",
)
def _(t):
    a = t.pages.select(
        F.sha1("url").alias("url_hash"), "page_id",
        F.concat(F.when(F.col("page_id") % 3 == 0, "daily-2024010").otherwise("weekly-2024010"), (F.col("page_id") % 7).cast("string")).alias("batch_id"),
    )
    cached = t.events.join(a, F.col("user_id") == F.col("page_id")).select(
        "url_hash", F.col("event_id").alias("id"), F.col("ts").alias("created_time")
    )
    contents = t.events.select(F.col("event_id").alias("cached_id"), F.col("props").alias("content"))
    out = io.latest_page(a, cached, contents, "daily-20240105")
    return out.select("url_hash", "cached_id", F.col("created_time").cast("string").alias("created"), "content")


_BAD = "event_id % 41 = 0"


def _log_lines(t):
    whole = F.to_json(
        F.struct(
            F.col("ts").cast("string").alias("date"), F.concat(F.lit("b"), (F.col("user_id") % 10).cast("string")).alias("batch_id"),
            F.col("event_type").alias("groups"), F.concat(F.lit("http://x/"), F.col("event_id").cast("string")).alias("url"),
        )
    )
    return F.when(F.expr(_BAD), F.substring(whole, F.lit(1), F.length(whole) - 9)).otherwise(whole)


@query(
    "access_log",
    f"""select 'b' || cast(user_id % 10 as varchar) as batch_id, cast(ts as date) as day, count(*) as n from events where not {_BAD} group by all
    union all select '(malformed)', null, count(*) from events where {_BAD} having count(*) > 0""",
)
def _(t):
    return io.access_log(t.events.select(_log_lines(t).alias("line")), "line")


@query(
    "read_batches",
    f"""select 'daily-2024010' || cast(user_id % 3 + 1 as varchar) as batch, make_date(2024, 1, cast(user_id % 3 + 1 as int)) as batch_date, count(*) filter (not {_BAD}) as records,
    count(*) filter ({_BAD}) as malformed, count(distinct event_type) filter (not {_BAD}) as kinds from events where user_id % 4 < 3 group by all""",
)
def _(t):
    """Lines written as batch folders, also of another batch name, and read back."""
    path = scratch_path(t.spark, "batches")
    name = F.concat(F.when(F.col("user_id") % 4 < 3, "daily-2024010").otherwise("weekly-2024010"), (F.col("user_id") % 3 + 1).cast("string"))
    lines = t.events.select(_log_lines(t).alias("value"), name.alias("name"))
    for batch in sorted(r["name"] for r in lines.select("name").distinct().collect()):  # six folder names
        lines.where(F.col("name") == batch).select("value").write.text(f"{path}/{batch}")
    good, bad = io.read_batches(t.spark, path, "daily-", io.LOG_SCHEMA)
    counted = good.groupBy("batch", "batch_date").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("groups").alias("kinds"))
    lost = bad.groupBy("batch").agg(F.count(F.lit(1)).alias("malformed"))
    return counted.join(lost, "batch", "left").select("batch", "batch_date", "records", F.coalesce("malformed", F.lit(0)).alias("malformed"), "kinds")


@query("write_compacted", "select count(*) as n, sum(length(text)) as chars from documents")
def _(t):
    """Shards written as JSON lines and read back."""
    path = scratch_path(t.spark, "shards")
    io.write_compacted(t.documents.select(F.col("doc_id").cast("string").alias("key"), "text"), "key", 7, path)
    back = t.spark.read.schema("key string, text string, shard int").json(path)
    return back.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query(
    "written_pages",
    """with r as (select (row_number() over (order by o_totalprice, o_orderkey) - 1) // 2000 as page, o_orderkey from orders)
    select page, count(*) as n, min(o_orderkey) as low, max(o_orderkey) as high from r group by 1""",
)
def _(t):
    """Pages written as CSV and read back."""
    path = scratch_path(t.spark, "pages")
    io.write_paged(t.orders.select("o_totalprice", "o_orderkey"), ["o_totalprice", "o_orderkey"], path)
    back = t.spark.read.csv(path, header=True, schema="o_totalprice double, o_orderkey long, page long")
    return back.groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))
