"""Network jobs over the driver tables: parts are companies, orders and suppliers agents."""

from pyspark.sql import functions as F

from webloom.functions import fixed_values as V
from webloom.operators import network
from webloom.plans.registry import query

_RULES = dict(
    min_length=4, credit="red", credit_keep="gizmo", shop_end="(rod|ring)$", shop_keep="(old ring)$", animals="hot", hospital_end="plate$",
    industry="(new|cold)", services="LARGE", hospital_word="plate", investor=["PROMO.*widget", "blue.*gear"], hospital=["plate$", "plate.*X"],
    clinic="(widget|anvil|gizmo)", labels=["invest", "hospital", "clinic"],
)
_CO = "p_type || ' ' || p_name"
_ZH = "case p_partkey % 8 when 0 then p_type || '医院' when 1 then '医疗' || p_name || '投资公司' when 2 then p_name || '药店' when 3 then '宠物医院' || p_name when 4 then '口腔诊所' || p_name when 5 then p_name || '电力公司' when 6 then '公司' else p_name || '医院路分店' end"


def _duck_company(n, r, matched="regexp_matches"):
    m = lambda p: f"{matched}({n}, '{p}')"
    return f"""case when length({n}) < {r['min_length']} then '' when not ({m(r['credit'])} and {m(r['credit_keep'])}) and (({m(r['shop_end'])} and not {m(r['shop_keep'])})
      or {m(r['animals'])} or (not {m(r['hospital_end'])} and {m(r['industry'])}) or {m(r['services'])}) then ''
      when {' or '.join(m(p) for p in r['investor'])} then '{r['labels'][0]}' when contains({n}, '{r['hospital_word']}') and ({' or '.join(m(p) for p in r['hospital'])}) then '{r['labels'][1]}'
      when {m(r['clinic'])} then '{r['labels'][2]}' else '' end"""


_ZH_RULES = dict(
    min_length=4, credit=V.COMPANY_CREDIT, credit_keep=V.COMPANY_CREDIT_KEEP, shop_end=V.COMPANY_SHOP_END, shop_keep=V.COMPANY_SHOP_KEEP, animals=V.COMPANY_ANIMALS,
    hospital_end=V.COMPANY_HOSPITAL_END, industry=V.COMPANY_INDUSTRY, services=V.COMPANY_SERVICES, hospital_word="医院", investor=V.MEDICAL_INVESTOR,
    hospital=V.HOSPITAL_NAME, clinic=V.CLINIC_NAME, labels=V.COMPANY_LABELS,
)


@query(
    "classify_company",
    f"select p_partkey, {_duck_company('n', _RULES)} as label, {_duck_company('z', _ZH_RULES)} as zh_label from (select p_partkey, {_CO} as n, {_ZH} as z from part)",
)
def _(t):
    return t.part.select(
        "p_partkey", network.classify_company(F.expr(_CO), network.CompanyRules(**_RULES)).alias("label"), network.classify_company(F.expr(_ZH)).alias("zh_label")
    )


_INV = "case p_partkey % 4 when 0 then p_name || '投资公司' when 1 then '医药' || p_name || '集团' when 2 then '莆田' || p_name || '信用' else p_name || '公司' end"


@query(
    "investment_company",
    f"""select p_partkey, regexp_matches(n, '{V.INVESTOR_ALWAYS}') or (regexp_matches(n, '{V.INVESTOR_COMPANY[0]}') and regexp_matches(n, '{V.INVESTOR_COMPANY[1]}'))
    or (regexp_matches(n, '{V.INVESTOR_GROUP[0]}') and regexp_matches(n, '{V.INVESTOR_GROUP[1]}')) as invests,
    {_duck_company('z', _ZH_RULES)} in ('医院投资', '医院公司') as strict from (select p_partkey, {_INV} as n, {_ZH} as z from part)""",
)
def _(t):
    return t.part.select(
        "p_partkey", network.is_investment_company(F.expr(_INV)).alias("invests"), network.is_medical_label(network.classify_company(F.expr(_ZH))).alias("strict")
    )


_AGENT = "case c_custkey % 3 when 0 then '王小明' when 1 then c_mktsegment || '贸易公司' else c_name end"


@query(
    "classify_agent",
    f"""select c_custkey, case when length(n) > 4 then 'company' else 'person' end as kind,
    case when length(n) > 4 and regexp_matches(n, '{V.AGENT_COMPANY}') then 'company' else 'person' end as kind2 from (select c_custkey, {_AGENT} as n from customer)""",
)
def _(t):
    n = F.expr(_AGENT)
    return t.customer.select("c_custkey", network.classify_agent(n).alias("kind"), network.classify_agent(n, V.AGENT_COMPANY).alias("kind2"))


def companies(t):
    """One nested company row per line item: supplier, order and part relations."""
    one = lambda c: F.array(F.struct(c.alias("name")))
    s = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    return t.lineitem.select(
        s("P", "l_partkey").alias("name"), s("S", "l_suppkey").alias("legal_person"), one(s("O", "l_orderkey")).alias("shareholders"),
        one(s("P", "l_partkey")).alias("executives"), one(s("P", "l_linenumber")).alias("invests"),
    )


_P, _S, _O = "'P' || cast(l_partkey as varchar)", "'S' || cast(l_suppkey as varchar)", "'O' || cast(l_orderkey as varchar)"


@query(
    "related_names",
    f"""with e as (select {_P} as company, {_S} as related from lineitem union select {_P}, {_O} from lineitem union select {_P}, 'P' || cast(l_linenumber as varchar) from lineitem)
    select company, count(*) as n, min(related) as first from e where company <> related group by 1""",
)
def _(t):
    e = network.related_names(companies(t))
    return e.groupBy("company").agg(F.count(F.lit(1)).alias("n"), F.min("related").alias("first"))


def edges(t):
    """Part (company) to order (agent) relations."""
    return t.lineitem.select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("company"), F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("related")
    ).distinct()


_EDGES = f"e as (select distinct {_P} as company, {_O} as related from lineitem)"
_SEEDS = "s as (select 'O' || cast(o_orderkey as varchar) as name from orders where o_orderstatus = 'F' and o_totalprice > 497000)"


def seeds(t):
    return t.orders.where("o_orderstatus = 'F' and o_totalprice > 497000").select(F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("name"))


@query(
    "candidate_companies",
    f"""with {_EDGES}, s as (select 'O' || cast(o_orderkey as varchar) as name from orders where o_orderstatus = 'F'),
    c as (select company, count(*) as related_cnt, count(*) filter (related in (select name from s)) as overlap from e group by 1),
    l as (select 'P' || cast(p_partkey as varchar) as company, case when p_type = 'PROMO' then 'promo' else '' end as label from part),
    r as (select company, label, coalesce(related_cnt, 0) as related_cnt, coalesce(overlap, 0) as overlap from l left join c using (company))
    select *, case when label <> '' then 'label' else 'related' end as why from r where label <> '' or (overlap >= 3 and related_cnt < 500 and overlap > related_cnt * 0.4)""",
)
def _(t):
    labels = t.part.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("company"), F.when(F.col("p_type") == "PROMO", "promo").otherwise("").alias("label")
    )
    s = t.orders.where("o_orderstatus = 'F'").select(F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("name"))
    return network.candidate_companies(edges(t), labels, s, share=0.4)


def _impact_pass(front: str, i: int) -> str:
    return f"""a{i} as (select company from u where related in (select name from {front}) group by company having count(*) >= max(size) * 0.04),
    g{i} as (select related as name from u where company in (select company from a{i}) group by 1 having count(*) >= 2),
    n{i} as (select name, coalesce(max(rtype) filter (rtype <> 'xcompany'), 'xcompany') as rtype from (select company as name, 'xcompany' as rtype from a{i} union all
      select name, case when length(name) <= 4 then 'person' else 'company' end from g{i}) where name not in (select name from {front}) group by 1),
    f{i} as (select * from {front} union all select name, {i}, rtype from n{i})"""


_IMPACT = f"""with {_EDGES}, {_SEEDS}, z as (select company, count(*) as size from e group by 1), u as (select * from e join z using (company) where size <= 500),
    f0 as (select distinct name, 0 as depth, 'person' as rtype from s), {', '.join(_impact_pass(f'f{i - 1}', i) for i in range(1, 6))}"""


@query("expand_co_impact", _IMPACT + " select name, depth, rtype from f5")
def _(t):
    return network.expand_co_impact(seeds(t), edges(t), share=0.04)


@query(
    "spread_pass_loose",
    f"""with {_EDGES}, {_SEEDS}, z as (select company, count(*) as size from e group by 1),
    a as (select company from e join z using (company) where related in (select name from s) group by company having count(*) >= max(size) * 0.04)
    select distinct related as name from e where company in (select company from a) and related not in (select name from s)""",
)
def _(t):
    return network.spread_pass_loose(seeds(t), edges(t), 0.04)


def invests(t):
    """A forest of part ids with some edges back up, so that there are cycles."""
    down = t.part.select(F.col("p_partkey").alias("src"), (F.col("p_partkey") * 2 + F.col("p_size") % 2).alias("dst"))
    return down.unionByName(t.part.where("p_size > 45").select(F.col("p_partkey").alias("src"), F.expr("p_partkey div 3").alias("dst")))


_TREE = "t as (select p_partkey as src, p_partkey * 2 + p_size % 2 as dst from part union all select p_partkey, p_partkey // 3 from part where p_size > 45)"


@query(
    "reachable",
    f"""with recursive {_TREE}, k as (select p_partkey as name from part where p_size <> 13),
    r as (select s_suppkey as name from supplier where s_nationkey < 5 union select t.dst from r join t on t.src = r.name where t.src in (select name from k))
    select name from r where name in (select name from k)""",
)
def _(t):
    selected = t.supplier.where("s_nationkey < 5").select(F.col("s_suppkey").alias("name"))
    return network.reachable(selected, invests(t), t.part.where("p_size <> 13").select(F.col("p_partkey").alias("name")))


@query(
    "layered_expand",
    f"""with recursive {_TREE}, s as (select s_suppkey as name from supplier where s_nationkey = 3),
    d as (select name, 0 as depth from s union select t.dst, d.depth + 1 from d join t on t.src = d.name where d.depth < 4),
    u as (select name, 0 as depth from s union select t.src, u.depth + 1 from u join t on t.dst = u.name where u.depth < 4)
    select name, cast(min(depth) as int) as depth, 'down' as direction from d group by 1 union all select name, cast(min(depth) as int), 'up' from u group by 1""",
)
def _(t):
    start = t.supplier.where("s_nationkey = 3").select(F.col("s_suppkey").alias("name"))
    up = invests(t).select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return network.layered_expand(start, invests(t), up, 4)


def _spread_pass(front: str, i: int) -> str:
    return f"""c{i} as (select a as name, 0.8 * (1 - exp(sum(ln(1 - p)))) as p from l join {front} on b = name group by a having count(*) >= max(deg) * 0.01),
    f{i} as (select * from {front} union all select name, {i}, p from c{i} where p >= 0.5 and name not in (select name from {front}))"""


@query(
    "noisy_or_spread",
    f"""with {_EDGES}, {_SEEDS}, z as (select company from e group by 1 having count(*) <= 500), w as (select * from e where company in (select company from z)),
    b as (select company as a, related as b from w union select related, company from w), g as (select a, count(*) as deg from b group by 1 having count(*) >= 2),
    l as (select b.a, b.b, deg from b join g using (a)), f0 as (select distinct name, 0 as depth, 0.9::double as p from s), {', '.join(_spread_pass(f'f{i - 1}', i) for i in range(1, 11))}
    select name, depth, round(p, 6) as p from f10""",
)
def _(t):
    out = network.noisy_or_spread(seeds(t), edges(t))
    return out.select("name", "depth", F.round("p", 6).alias("p"))


@query(
    "hospital_overlap",
    f"""with {_EDGES}, {_SEEDS}, c as (select company, count(*) as n from e where related in (select name from s)
      and company in (select 'P' || cast(p_partkey as varchar) from part where p_type = 'LARGE') group by 1)
    select count(*) as hospital_1, count(*) filter (n >= 2) as hospital_2 from c""",
)
def _(t):
    hospitals = t.part.where("p_type = 'LARGE'").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("name"))
    return network.hospital_overlap(edges(t), hospitals, seeds(t))


@query(
    "agent_report",
    _IMPACT + """ , q as (select distinct related as name, company from e where company in (select name from f5 where rtype = 'xcompany'))
    select name, rtype, depth, count(company) over (partition by name) as company_cnt, company from f5 left join q using (name) where rtype <> 'xcompany'""",
)
def _(t):
    return network.agent_report(network.expand_co_impact(seeds(t), edges(t), share=0.04), edges(t))


def rank_edges(t):
    """Part to supplier by quantity, and from a supplier to the part of the same number."""
    down = t.lineitem.select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("src"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("dst"), F.col("l_quantity").alias("weight")
    )
    up = t.supplier.where("s_acctbal > 2000").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("src"), F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("dst"), F.lit(1.0).alias("weight")
    )
    return down.unionByName(up)


def _duck_rank(undirected: bool, weighted: bool, personal: bool) -> str:
    """What the restart hands on, step after step until it is below all places that are compared, made to sum to 1."""
    w = "sum(weight)" if weighted else "1.0"
    raw = f"""r as (select {_P} as src, {_S} as dst, l_quantity as weight from lineitem union all
      select 'S' || cast(s_suppkey as varchar), 'P' || cast(s_suppkey as varchar), 1.0 from supplier where s_acctbal > 2000)"""
    e = "r" if not undirected else "(select * from r union all select dst, src, weight from r)"
    q = "case when name = 'P1' then 1.0 when name = 'S2' then 3.0 else 0.0 end" if personal else "1.0"
    return f"""with recursive {raw}, e as (select src, dst, {w} as w from {e} group by src, dst), o as (select src, sum(w) as o from e group by 1),
      l as materialized (select src, dst, 0.85 * w / o as w from e join o using (src)), n as (select src as name from e union select dst from e),
      b as materialized (select name, ({q})::double as q from n),
      x as (select 0 as step, name, q from b where q > 0 union all select step + 1, dst, sum(q * w) from x join l on src = name where step < 200 group by step, dst),
      y as (select name, sum(q) as y from x group by name)
    select name, round(coalesce(y, 0) / (select sum(y) from y), 6) as rank from b left join y using (name)"""


def _rounded(df):
    return df.select("name", F.round("rank", 6).alias("rank"))


@query("pagerank", _duck_rank(False, False, False))
def _(t):
    return _rounded(network.pagerank(rank_edges(t), tol=1e-7))


@query("pagerank_weighted", _duck_rank(False, True, False))
def _(t):
    return _rounded(network.pagerank(rank_edges(t), tol=1e-7, weight="weight"))


@query("pagerank_undirected_personalized", _duck_rank(True, False, True))
def _(t):
    who = t.supplier.where("s_suppkey = 1").select(F.lit("P1").alias("name"), F.lit(1.0).alias("weight")).unionByName(
        t.supplier.where("s_suppkey = 2").select(F.lit("S2").alias("name"), F.lit(3.0).alias("weight"))
    )
    return _rounded(network.pagerank(rank_edges(t), tol=1e-7, directed=False, personalization=who))


@query(
    "pagerank_converged",
    f"with t as ({_duck_rank(False, False, False)}) select count(*) as names, round(sum(rank), 3) as total, round(max(rank), 5) as most from t",
)
def _(t):
    ranks = network.pagerank(rank_edges(t), tol=1e-6)
    return ranks.agg(F.count(F.lit(1)).alias("names"), F.round(F.sum("rank"), 3).alias("total"), F.round(F.max("rank"), 5).alias("most"))


def regions(t):
    """Nations are cities, regions provinces; every nation has one district of a shared name."""
    n = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    province = F.concat("r_name", F.lit("省"))
    p = t.region.select(F.lit("province").alias("level"), F.concat("r_name", F.lit("省")).alias("name"), F.concat("r_name", F.lit("省")).alias("province"), F.concat(F.lit("p"), "r_name").alias("code"))
    c = n.select(F.lit("city").alias("level"), F.concat("n_name", F.lit("市")).alias("name"), province.alias("province"), F.concat(F.lit("c"), "n_name").alias("code"))
    d = n.select(F.lit("district").alias("level"), F.concat(F.lit("D"), (F.col("n_nationkey") % 20).cast("string"), F.lit("县")).alias("name"), province.alias("province"), F.concat(F.lit("d"), "n_name").alias("code"))
    return p.unionByName(c).unionByName(d)


_ALIAS = """n as (select n_nationkey as k, n_name as c, r_name as p from nation join region on n_regionkey = r_regionkey),
    a as (select distinct 'province' as level, unnest([r_name, r_name || '省']) as alias, r_name as province from region
      union select distinct 'city', unnest([c, c || '市']), p from n union select distinct 'district', unnest(['D' || cast(k % 20 as varchar), 'D' || cast(k % 20 as varchar) || '县']), p from n)"""


@query("unambiguous_alias", f"with {_ALIAS} select alias, min(province) as province from a group by 1 having count(distinct province) = 1")
def _(t):
    return network.unambiguous_alias(network.region_aliases(regions(t)))


_ADDR = "case c_custkey % 5 when 0 then n_name || '市' || c_name when 1 then c_name || '（' || r_name || '）' when 2 then 'D' || cast(n_nationkey % 20 as varchar(3)) || '县x' when 3 then 'nowhere' else r_name || '省' || n_name end"


@query(
    "guess_province",
    f"""with {_ALIAS}, lv as (select case level when 'province' then 0 else 1 end as rank, alias, min(province) as province from a where level <> 'district' group by level, alias having count(distinct province) = 1
      union all select 2, alias, min(province) from a group by alias having count(distinct province) = 1),
    x as (select c_custkey, unnest(['', {_ADDR}, 'EUROPE省']) as addr, generate_subscripts(['', 'a', 'b'], 1) as pos from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
    m as (select c_custkey, province from x join lv on starts_with(addr, alias) or contains(addr, '（' || alias || '）') where addr <> ''
      qualify row_number() over (partition by c_custkey order by pos, rank, length(alias) desc, alias) = 1)
    select c_custkey, coalesce(province, '') as province from customer left join m using (c_custkey)""",
)
def _(t):
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = c.select("c_custkey", F.array(F.lit(""), F.expr(_ADDR), F.lit("EUROPE省")).alias("addresses"))
    return network.guess_province(rows, "c_custkey", "addresses", network.region_aliases(regions(t)))


@query(
    "seed_stats",
    """with k as (select c_mktsegment as step, c_custkey as keyword from customer), s as (select o_custkey as keyword, count(*) as actual from orders where o_orderstatus = 'F' group by 1)
    select step, count(*) as keywords, count(actual) as searched, count(*) filter (actual is null) as missing, cast(coalesce(sum(actual), 0) as bigint) as total_actual,
    count(*) filter (actual > 5) as big from k left join s using (keyword) group by 1""",
)
def _(t):
    s = t.orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("keyword")).agg(F.count(F.lit(1)).alias("actual"))
    return network.seed_stats(t.customer.select(F.col("c_mktsegment").alias("step"), F.col("c_custkey").alias("keyword")), s, big=5)
