"""Ranking and sampling over the driver tables."""

from pyspark.sql import functions as F

from webloom.functions import fixed_values as V
from webloom.functions.text import keyword_score
from webloom.operators import ranking
from webloom.plans.registry import query

# One search result per order: the customer is the query.
_RES = """(select o_custkey as query, o_orderkey as result_index, 'q' || cast(o_orderkey % 500 as varchar) as question_id,
    cast(case when o_orderpriority = '1-URGENT' then 1 else 0 end as int) as is_recommend,
    case when o_orderkey % 5 = 0 then null else cast(floor(o_totalprice) as bigint) % 9 end as cnt_like from orders)"""


def results(t):
    return t.orders.select(
        F.col("o_custkey").alias("query"), F.col("o_orderkey").alias("result_index"),
        F.concat(F.lit("q"), (F.col("o_orderkey") % 500).cast("string")).alias("question_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("is_recommend"),
        F.when(F.col("o_orderkey") % 5 != 0, F.floor("o_totalprice") % 9).alias("cnt_like"),
    )


@query("recommended_first", f"select * from {_RES} where is_recommend = 1 qualify row_number() over (partition by query order by result_index) = 1")
def _(t):
    return ranking.recommended_first(results(t))


@query(
    "pick_question",
    f"""with r as (select query, arg_min(question_id, result_index) filter (is_recommend = 1) as rid,
      arg_min(coalesce(cnt_like, -99), result_index) filter (is_recommend = 1) as rl, arg_min(question_id, result_index) filter (is_recommend = 0) as fid from {_RES} group by 1),
    m as (select query, question_id as mid, cnt_like as ml from {_RES} where is_recommend = 0 and cnt_like is not null
      qualify row_number() over (partition by query order by cnt_like desc, result_index desc) = 1)
    select query, coalesce(case when coalesce(ml, -1) > coalesce(nullif(rl, -99), 0) then case when rid is null then mid else rid || ',' || mid end else fid end, '') as picks
    from r left join m using (query)""",
)
def _(t):
    return ranking.pick_question(results(t)).select("query", F.array_join("picks", ",").alias("picks"))


@query("good_questions", f"select distinct question_id from {_RES} where is_recommend = 1 or cnt_like >= 8")
def _(t):
    return ranking.good_questions(results(t), 8)


@query(
    "merge_pages",
    """select l_partkey, l_orderkey, l_linenumber, row_number() over (partition by l_partkey order by l_linenumber, l_orderkey, l_quantity, l_extendedprice) as result_index
    from lineitem where l_linenumber - 1 < 3""",
)
def _(t):
    rows = t.lineitem.select(
        F.col("l_partkey"), (F.col("l_linenumber") - 1).alias("page"), F.struct("l_orderkey", "l_quantity", "l_extendedprice").alias("idx")
    )
    out = ranking.merge_pages(rows, "l_partkey", limit=30)
    return out.select("l_partkey", F.col("idx.l_orderkey").alias("l_orderkey"), (F.col("page") + 1).alias("l_linenumber"), "result_index")


_SCORE = "cast(p_size * 12 - 250 as int)"


@query(
    "entity_tiering",
    f"""with c as (select p_partkey, p_name || p_brand as name, {_SCORE} as score, count(*) over (partition by p_name || p_brand) as n,
      max(case when {_SCORE} >= 100 then 1 else 0 end) over (partition by p_name || p_brand) as ok from part)
    select p_partkey, name, score, case when n = 1 then 'only_one' when score >= 100 then 'ok' when score > -100 then 'candidate' else 'bad' end as tier
    from c where n = 1 or score >= 100 or ok = 0""",
)
def _(t):
    c = t.part.select("p_partkey", F.concat("p_name", "p_brand").alias("name"), F.expr("cast(p_size * 12 - 250 as int)").alias("score"))
    return ranking.entity_tiering(c, "name", "score").select("p_partkey", "name", "score", "tier")


_D = "text || case doc_id % 4 when 0 then '中药名本草' when 1 then '电影熔点' else '' end"
_S = "source || case doc_id % 3 when 0 then '草药' when 1 then '人物' else '' end"


def _sum(col, weights):
    return " + ".join(f"case when contains({col}, '{k}') then {w} else 0 end" for k, w in weights.items())


@query(
    "describe_score",
    f"select doc_id, cast({_sum('d', V.ENTITY_KEYWORDS)} + {_sum('s', V.SAME_AS_KEYWORDS)} as int) as score from (select doc_id, {_D} as d, {_S} as s from documents)",
)
def _(t):
    return t.documents.select(
        "doc_id", (keyword_score(F.expr(_D), V.ENTITY_KEYWORDS) + keyword_score(F.expr(_S), V.SAME_AS_KEYWORDS)).alias("score")
    )


@query(
    "top_share_per_group",
    """with c as (select l_suppkey as grp, l_partkey % 200 as tag, count(*) as cnt from lineitem group by all),
    r as (select *, row_number() over (partition by grp order by cnt desc, tag) as rn, count(*) over (partition by grp) as n from c)
    select grp, tag, cnt from r where rn <= floor(n * 0.3 + 0.99) and cnt > 1""",
)
def _(t):
    rows = t.lineitem.select(F.col("l_suppkey").alias("grp"), (F.col("l_partkey") % 200).alias("tag"))
    return ranking.top_share_per_group(rows, "grp", "tag")


@query(
    "latest_report_block",
    """with e as (select user_id, event_id, cast(ts as date) as report from events),
    f as (select *, first_value(report) over (partition by user_id order by event_id) as f from e),
    g as (select *, max(case when report <> f then 1 else 0 end) over (partition by user_id order by event_id rows unbounded preceding) as ch from f)
    select user_id, event_id, report from g where ch = 0""",
)
def _(t):
    return ranking.latest_report_block(t.events.select("user_id", "event_id", F.to_date("ts").alias("report")), "user_id", "event_id", "report")


@query(
    "rate_in_last_minute",
    """with e as (select event_id, event_type, epoch_us(ts) as a from events),
    r as (select event_id, a, count(*) over w as calls, min(a) over w as f from e
      window w as (partition by event_type order by a range between 3600000000 preceding and current row))
    select event_id, calls, round(case when calls > 1 then (a - f) / 1e6 / (calls - 1) end, 3) as mean_gap, calls > 3 as over from r""",
)
def _(t):
    out = ranking.rate_in_last_minute(t.events.select("event_id", "event_type", "ts"), "event_type", "ts", "event_id", seconds=3600, threshold=3)
    return out.select("event_id", "calls", F.round("mean_gap", 3).alias("mean_gap"), "over")


@query(
    "min_over_samples",
    """with r as (select event_type, value, (row_number() over (partition by event_type order by ts, event_id) - 1) // 6 as block from events)
    select event_type, block, min(value) as min_value from r group by all having count(*) = 6 and min(value) > 20""",
)
def _(t):
    return ranking.min_over_samples(t.events, "event_type", ["ts", "event_id"], F.date_trunc("hour", "ts"), "value", limit=20.0)


@query("page", "select o_orderkey, o_totalprice, (select count(*) from orders) as total from orders order by o_totalprice desc, o_orderkey limit 20 offset 40")
def _(t):
    return ranking.page(t.orders.select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 40, 20)


@query("page_deep", "select o_orderkey, o_totalprice, (select count(*) from orders) as total from orders order by o_totalprice desc, o_orderkey limit 200 offset 12000")
def _(t):
    o = t.orders.select("o_orderkey", "o_totalprice")
    return ranking.page(o, ["-o_totalprice", "o_orderkey"], 12000, 200)


@query("page_narrowed", "select l_orderkey, l_linenumber, l_shipdate, (select count(*) from lineitem) as total from lineitem order by l_shipdate desc, l_orderkey, l_linenumber desc limit 300 offset 2500")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    return ranking.page(rows, ["-l_shipdate", "l_orderkey", "-l_linenumber"], 2500, 300, most=1000)


@query(
    "systematic_sample",
    """with r as (select o_orderkey, row_number() over (order by o_orderkey) - 1 as i, count(*) over () // 300 as k from orders)
    select o_orderkey from r where i % k = 0 and i / k < 300""",
)
def _(t):
    return ranking.systematic_sample(t.orders.select("o_orderkey"), ["o_orderkey"], 300)


@query("seeded_sample", "select o_orderkey from orders order by md5(cast(o_orderkey as varchar) || ':7'), o_orderkey limit 100")
def _(t):
    return ranking.seeded_sample(t.orders.select("o_orderkey"), "o_orderkey", 100, seed=7)
