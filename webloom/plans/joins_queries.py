"""Join operators over the driver tables."""

from pyspark.sql import functions as F

from webloom.functions.text import words
from webloom.operators import affix, joins
from webloom.plans.registry import query


@query(
    "map_name",
    """with m as (select p_name as raw, max(n_name) as mapped from part join nation on p_partkey % 40 = n_nationkey where p_size > 40 group by 1)
    select p_partkey, coalesce(mapped, p_name) as entity from part left join m on p_name = raw""",
)
def _(t):
    mapper = t.part.where("p_size > 40").join(t.nation, F.col("p_partkey") % 40 == F.col("n_nationkey")).select(
        F.col("p_name").alias("raw"), F.col("n_name").alias("mapped")
    )
    return joins.map_name(t.part.select("p_partkey", "p_name"), "p_name", mapper, "entity").select("p_partkey", "entity")


def _ranks(t):
    d = t.part.where("p_size > 20")
    return d.select(
        F.concat_ws(" ", "p_name", "p_type").alias("word"), F.col("p_size").alias("total"), F.col("p_partkey").alias("seq")
    )


def _named(t):
    return t.part.select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("word"))


@query(
    "attach_rank",
    """with r as (select p_name || ' ' || p_type as word, p_size as total from part where p_size > 20
      qualify row_number() over (partition by p_name || ' ' || p_type order by p_partkey desc) = 1)
    select p_partkey, p_name || ' ' || p_type as word, total as searchscore from part left join r on p_name || ' ' || p_type = word""",
)
def _(t):
    return joins.attach_rank(_named(t), _ranks(t), "word")


@query(
    "without_rank",
    """select distinct p_name || ' ' || p_type || p_brand as word from part where p_name || ' ' || p_type || p_brand not in
    (select p_name || ' ' || p_type || p_brand from part where p_size > 20)""",
)
def _(t):
    w = F.concat(F.concat_ws(" ", "p_name", "p_type"), F.col("p_brand")).alias("word")
    return joins.without_rank(t.part.select(w), t.part.where("p_size > 20").select(w), "word")


_ALIASES = "p_name, p_name || ' ' || lower(p_type), p_brand"


def _entities(t):
    more = F.when(F.col("p_size") % 2 == 0, F.array("p_name", F.concat_ws(" ", F.col("p_name"), F.lower("p_type")), F.col("p_brand")))
    return t.part.where("p_size > 25").select(F.col("p_partkey").alias("nid"), F.coalesce(more, F.array("p_name")).alias("alias"))


_DUCK_BEST = f"""e as (select p_partkey as nid, case when p_size % 2 = 0 then [{_ALIASES}] else [p_name] end as alias from part where p_size > 25),
    x as (select nid, length(alias) as n, unnest(alias) as alias from e),
    best as (select alias, nid from x qualify row_number() over (partition by alias order by n desc, nid desc) = 1)"""


@query(
    "link_entity",
    f"""with {_DUCK_BEST} select p_partkey, nid from (select *, case p_partkey % 3 when 0 then p_name when 1 then p_name || ' ' || lower(p_type)
    else p_type end as asked from part) left join best on asked = alias""",
)
def _(t):
    asked = F.expr("case p_partkey % 3 when 0 then p_name when 1 then p_name || ' ' || lower(p_type) else p_type end")
    return joins.link_entity(t.part.select("p_partkey", asked.alias("asked")), "asked", _entities(t)).select("p_partkey", "nid")


@query(
    "alias_or_name_lookup",
    f"""with {_DUCK_BEST}, a as (select distinct p_name || ' ' || lower(p_type) as asked from part union select distinct p_name || '-' from part),
    p as (select case when p_partkey % 5 = 0 then p_name || '-' else p_name end as name, p_partkey as nid, p_retailprice as price from part),
    l as (select asked, nid from a left join best on asked = alias)
    select l.asked, p.name, p.nid, p.price from l join p on l.nid = p.nid union all
    select l.asked, p.name, p.nid, p.price from l join p on l.nid is null and l.asked = p.name""",
)
def _(t):
    asked = t.part.select(F.concat_ws(" ", F.col("p_name"), F.lower("p_type")).alias("name")).union(
        t.part.select(F.concat("p_name", F.lit("-")))
    ).distinct()
    prices = t.part.select(
        F.when(F.col("p_partkey") % 5 == 0, F.concat("p_name", F.lit("-"))).otherwise(F.col("p_name")).alias("name"),
        F.col("p_partkey").alias("nid"), F.col("p_retailprice").alias("price"),
    )
    return joins.alias_or_name_lookup(asked, _entities(t), prices)


@query(
    "join_answers",
    """with q as (select conv_id, turn, text from conversations where role = 'user'),
    a as (select conv_id, turn, text from conversations where role = 'assistant' and length(text) > 200),
    i as (select conv_id, turn, unnest(range(1, 6)) as k from q)
    select q.conv_id, q.turn, coalesce(string_agg(a.text, '|' order by k), '') as answers from q
    left join i on q.conv_id = i.conv_id and q.turn = i.turn and k <= 3 left join a on a.conv_id = q.conv_id and a.turn = q.turn + k group by 1, 2""",
)
def _(t):
    c = t.conversations
    aid = lambda k: F.concat_ws(":", "conv_id", (F.col("turn") + k).cast("string"))
    q = c.where("role = 'user'").select("conv_id", "turn", F.array(*[aid(k) for k in range(1, 6)]).alias("answer_ids"))
    a = c.where("role = 'assistant' and length(text) > 200").select(aid(0).alias("answer_id"), F.col("text").alias("content"))
    return joins.join_answers(q, a).select("conv_id", "turn", F.array_join("answers", "|").alias("answers"))


@query(
    "compare_sources",
    """select p_partkey as k, p_name as a_name, p_size as a_size, s_name as b_name, s_acctbal as b_bal from part join supplier on p_partkey = s_suppkey""",
)
def _(t):
    a = t.part.select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    b = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"))
    return joins.compare_sources(a, b, "k").select(
        "k", F.col("a.name").alias("a_name"), F.col("a.size").alias("a_size"), F.col("b.name").alias("b_name"), F.col("b.bal").alias("b_bal")
    )


_TERM_SQL = """(select distinct unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) as term
    from documents)"""


@query(
    "containment_pairs",
    f"""with w as (select term from {_TERM_SQL} union select distinct lower(p_name) from part),
    lens as (select distinct length(term) as n from w),
    subs as (select term, substr(term, cast(i as int), n) as sub from w join lens on n < length(term), lateral (select unnest(range(1, length(term) - n + 2)) as i))
    select distinct subs.term from subs join w on subs.sub = w.term""",
)
def _(t):
    terms = t.documents.select(F.explode(words(F.col("text"))).alias("term")).union(t.part.select(F.lower("p_name"))).distinct()
    return affix.containment_pairs(terms)


@query(
    "affix_groups",
    f"""with recursive w as (select unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')) as item from documents),
    c as materialized (select item, row_number() over (order by count(*) desc, item) as r from w group by item),
    lens as (select distinct length(item) as n from c),
    cuts as (select r, substr(item, 1, n) as affix from c join lens on n < length(item) union select r, right(item, n) from c join lens on n < length(item)),
    pairs as materialized (select least(x.r, c.r) as early, greatest(x.r, c.r) as late from cuts x join c on c.item = x.affix),
    states as (select 0 as pass, r, 0 as s from c union all
      select t.pass + 1, t.r, case when t.s <> 0 then t.s when q.head then 2 when coalesce(q.members, true) then 1 else 0 end
      from states t left join (select late, bool_or(n.s = 1) as head, bool_and(n.s = 2) as members from pairs join states n on n.r = early group by late) q on q.late = t.r
      where exists (select 1 from states where s = 0)),
    heads as (select r from states where s = 1 and pass = (select max(pass) from states))
    select h.item as head, m.item as member from pairs join heads on heads.r = early join c h on h.r = early join c m on m.r = late""",
)
def _(t):
    tokens = t.documents.select(F.explode(words(F.col("text"))).alias("item"))
    counted = tokens.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    return affix.affix_groups(counted.select("item", F.struct(-F.col("n"), F.col("item")).alias("rank")))


@query("dict_semi", "select doc_id, lang from documents where doc_id in (select doc_id from labels where quality = 1)")
def _(t):
    return joins.dict_semi(t.documents.select("doc_id", "lang"), t.labels.where("quality = 1").select("doc_id"), ["doc_id"])


@query("dict_anti", "select doc_id, lang from documents where doc_id not in (select doc_id from labels)")
def _(t):
    return joins.dict_anti(t.documents.select("doc_id", "lang"), t.labels.select("doc_id"), ["doc_id"])


_RANGES = [
    ("[]", 1000, 2000, False, False), ("[}", 1000, 2000, False, True), ("{]", 1000, 2000, True, False), ("{}", 1000, 2000, True, True),
    ("[*", 1000, None, False, False), ("{*", 1000, None, True, False), ("*]", None, 2000, False, False), ("*}", None, 2000, False, True),
]


@query(
    "range_filter",
    " union all ".join(
        f"select '{n}' as form, count(*) as n from orders where "
        + " and ".join([f"o_orderkey {'>' if lo_open else '>='} {lo}"] * (lo is not None) + [f"o_orderkey {'<' if hi_open else '<='} {hi}"] * (hi is not None))
        for n, lo, hi, lo_open, hi_open in _RANGES
    ),
)
def _(t):
    hits = [
        F.count(F.when(joins.range_filter(F.col("o_orderkey"), lo, hi, a, b), 1)).alias(name) for name, lo, hi, a, b in _RANGES
    ]
    one = t.orders.agg(*hits)
    return one.select(F.explode(F.array(*[F.struct(F.lit(r[0]).alias("form"), F.col(r[0]).alias("n")) for r in _RANGES])).alias("r")).select("r.*")
