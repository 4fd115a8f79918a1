"""Record jobs over the driver tables: lineitem rows are quotes, parts products, suppliers markets."""

from pyspark.sql import functions as F

from webloom.functions import fixed_values as V
from webloom.operators import records, stats
from webloom.plans.registry import query
from webloom.scale import first_per_key


def _claims():
    return records.claims_text("claims").alias("claims")


def _tags():
    return F.array_join("tags", "|").alias("tags")


def quotes(t):
    """One priced row per line item with its product, market and place."""
    return (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            "l_orderkey", "l_linenumber", "p_name", "p_type", "p_brand", "s_name", "n_name", "n_nationkey",
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
            F.round("l_extendedprice", 0).cast("bigint").cast("string").alias("price"),
            F.format_string("http://s%d.example.com/p/%d", "s_suppkey", "p_partkey").alias("url"),
        )
    )


_Q = """q as (select l_orderkey, l_linenumber, p_name, p_type, p_brand, s_name, n_name, n_nationkey, strftime(l_shipdate, '%Y-%m-%d') as day,
      cast(cast(round(l_extendedprice, 0) as bigint) as varchar) as price, 's' || cast(s_suppkey as varchar) || '.example.com' as domain,
      'http://s' || cast(s_suppkey as varchar) || '.example.com/p/' || cast(p_partkey as varchar) as url
      from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey)"""


def price_rows(t):
    row = F.struct(
        F.col("day").alias("access_time"), F.col("p_name").alias("drug_name"), F.col("n_name").alias("origin"),
        F.col("s_name").alias("site"), F.col("p_type").alias("standards"), F.col("day").alias("price_date"), F.col("price"),
    )
    return quotes(t).select(F.col("url").alias("source"), F.array(row).alias("rows"))


def place_map(t):
    """Every third nation maps to a place word, the next to a spec word, the rest is unmapped."""
    k = F.col("n_nationkey") % 3
    mapped = F.when(k == 0, F.array(F.lit(V.PLACE_WORDS[0]))).when(k == 1, F.array(F.lit("spec"), F.lit(V.PLACE_WORDS[1])))
    return t.nation.select(F.col("n_name").alias("place"), mapped.alias("mapped")).where("mapped is not null")


_DUCK_MAPPED = "case n_nationkey % 3 when 0 then '|国内' when 1 then '|spec|国外' else '' end"
_SERIES = "p_name || '__' || n_name || '_' || s_name || '市场_' || p_type"
_PRICE_ROWS_SQL = f"""select sha1({_SERIES} || '_' || day || '_' || domain) as rid, {_SERIES} as series, {_SERIES} || '_' || domain as seriesid,
    p_name || '|' || n_name || '|' || s_name || '市场|' || p_type || {_DUCK_MAPPED} as tags,
    '商品名称=' || p_name || ';日期=' || day || ';价格=' || price || ';价格单位=元/千克;产地=' || n_name || ';报价地点=' || s_name || '市场;规格=' || p_type || ';币种=CNY' as claims,
    day as "recordDate", domain, sha1(url || '_' || day) as tracking from q"""


@query("price_records_rows", f"with {_Q} {_PRICE_ROWS_SQL}")
def _(t):
    r = records.price_records_rows(price_rows(t), place_map(t))
    return r.select(
        "rid", "series", "seriesid", _tags(), _claims(), "recordDate", F.col("source.domain").alias("domain"), F.col("source.trackingId").alias("tracking")
    )


@query(
    "price_records_pairs",
    f"""with {_Q}, r as (select *, left(day, 7) as month, price as p1 from q union all select *, '1999-01', '7' from q),
    s as (select *, p_name || '__' || p_brand || '__' || p_type as series from r)
    select sha1(series || '_' || month || '_' || domain) as rid, month || '-01' as "recordDate", p_name || '|' || p_brand || '|' || p_type as tags,
    '商品名称=' || p_name || ';日期=' || month || ';价格=' || p1 || ';价格单位=元/千克;产地=' || p_brand || ';规格=' || p_type || ';币种=CNY' as claims from s""",
)
def _(t):
    pair = lambda m, p: F.struct(m.alias("month"), p.alias("price"))
    df = quotes(t).select(
        F.col("url").alias("source"), F.col("p_name").alias("name"), F.concat_ws("/", "p_type", "p_brand").alias("specs"), F.col("day").alias("access_time"),
        F.array(pair(F.substring("day", 1, 7), F.col("price")), pair(F.lit("1999-01"), F.lit("7"))).alias("data"),
    )
    return records.price_records_pairs(df).select("rid", "recordDate", _tags(), _claims())


@query(
    "price_records_map",
    f"""with {_Q}, r as (select *, day as d, price as p1 from q where l_linenumber <> 3 union all select *, '1990-01-01', '7' from q where l_linenumber <> 3)
    select sha1(p_name || '__' || n_name || '_' || s_name || '_' || p_type || '_' || d || '_' || domain) as rid,
    p_name || '|' || n_name || '|' || s_name || '|' || p_type as tags,
    '商品名称=' || p_name || ';日期=' || d || ';价格=' || p1 || ';价格单位=元/千克;产地=' || n_name || ';报价地点=' || s_name || '市场;规格=' || p_type || ';币种=CNY' as claims from r""",
)
def _(t):
    history = F.when(F.col("l_linenumber") != 3, F.map_from_arrays(F.array(F.col("day"), F.lit("1990-01-01")), F.array(F.col("price"), F.lit("7"))))
    df = quotes(t).select(
        F.col("url").alias("source"), F.col("p_name").alias("name"), F.col("n_name").alias("productPlaceOfOrigin"), F.col("s_name").alias("sellerMarket"),
        F.col("p_type").alias("productGrade"), F.col("day").alias("access_time"), history.alias("price_history"),
    )
    return records.price_records_map(df).select("rid", _tags(), _claims())


@query(
    "price_records_list",
    f"""with {_Q} select sha1(p_name || '__' || n_name || '_' || s_name || '市场_' || p_type || '_' || day || '_' || domain) as rid,
    p_name || '|' || n_name || '|' || s_name || '市场|' || p_type || {_DUCK_MAPPED} as tags from q""",
)
def _(t):
    item = F.struct(F.concat("s_name", F.lit("药市")).alias("sellerMarket"), F.col("price"), F.col("day").alias("validDate"), F.col("day").alias("access_time"))
    df = quotes(t).select(
        F.col("url").alias("source"), F.col("p_name").alias("name"), F.col("n_name").alias("productPlaceOfOrigin"), F.col("p_type").alias("productGrade"),
        F.array(item).alias("price_data"),
    )
    return records.price_records_list(df, place_map(t)).select("rid", _tags())


@query(
    "price_records_nested",
    f"""with {_Q}, r as (select *, case when l_linenumber = 2 then null else day end as d, case when l_linenumber = 2 then null else price end as p1 from q)
    select p_brand || '_avg_' || s_name || '_' || p_type || '_' || coalesce(d, '') as id, d as "validDate", p1 as price, domain || '|' || p_brand as tags, p_name as area from r""",
)
def _(t):
    history = F.when(F.col("l_linenumber") != 2, F.map_from_arrays(F.array("day"), F.array("price"))).otherwise(F.create_map().cast("map<string,string>"))
    product = F.struct(
        F.col("p_brand").alias("variety"), F.col("p_type").alias("level"), F.lit("avg").alias("price_type"), F.lit("2000").alias("produce_year"),
        F.col("p_name").alias("produce_area"), history.alias("price_history"),
    )
    df = quotes(t).select(F.col("url").alias("source"), F.col("s_name").alias("market"), F.array(product).alias("product_list"))
    return records.price_records_nested(df).select("id", "validDate", "price", _tags(), F.col("productPlaceOfOrigin").alias("area"))


@query(
    "price_records_quote",
    """with e as (select event_id, cast(json_extract(props, '$.k') as varchar) as k, event_type, user_id, strftime(ts, '%Y-%m-%d') as day from events),
    f as (select *, case when user_id % 2 = 0 then 'place' || cast(user_id as varchar) else '' end as place, case when event_id % 3 = 0 then 'g' || k else '' end as grade from e)
    select event_id, sha1('item_' || event_type || '_' || place || '_agency_' || grade || '_' || day || '_a.example.com') as rid,
    '商品名称=item;价格=' || k || ';价格单位=元/吨;币种=CNY;日期=' || day || ';报价类型=' || event_type || ';报价机构=agency' ||
    case when place <> '' then ';出产地=' || place else '' end || case when grade <> '' then ';等级=' || grade else '' end ||
    case when event_id % 3 = 0 then ';等级x=' || grade else '' end || ';note=' || k as claims from f""",
)
def _(t):
    k = F.get_json_object("props", "$.k")
    detail = F.when(
        F.col("event_id") % 3 == 0,
        F.map_from_arrays(F.array(F.lit("等级x"), F.lit("empty"), F.lit("note")), F.array(F.concat(F.lit("g"), k), F.lit(""), k)),
    ).otherwise(F.map_from_arrays(F.array(F.lit("note")), F.array(k)))
    df = t.events.select(
        "event_id", F.lit("http://a.example.com/x").alias("source"), F.col("event_id").cast("string").alias("access_time"), F.lit("item").alias("name"),
        F.concat(k, F.lit("元/吨")).alias("quote"), F.col("event_type").alias("price_type"),
        F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("place"), F.col("user_id").cast("string"))).otherwise("").alias("place"),
        F.lit("agency").alias("agency"), F.date_format("ts", "yyyy-MM-dd").alias("published"), detail.alias("detail"),
    )
    out = records.price_records_quote(df)
    # the tracking id is the hash of url and access time: it leads back to the event
    back = t.events.select("event_id", F.sha1(F.concat_ws("_", F.lit("http://a.example.com/x"), F.col("event_id").cast("string"))).alias("tr"))
    return out.join(back, F.col("source.trackingId") == F.col("tr")).select("event_id", "rid", _claims())


@query("contract_filter", "select p_partkey, p_brand from part where contains(p_brand, '#2') and p_size > 12")
def _(t):
    df = t.part.withColumn("px", F.when(F.col("p_size") <= 12, "  ").otherwise("9.5"))
    return records.contract_filter(df, "p_brand", "px", "#2").select("p_partkey", "p_brand")


@query(
    "place_mapping",
    """select s_suppkey, 'a' || case n_nationkey % 3 when 0 then '|国内' when 1 then '|spec|国外' else '' end as tags,
    case n_nationkey % 3 when 0 then '国内' when 1 then '国外' end as country, 'a' || case n_nationkey % 3 when 1 then '|spec' else '' end as spec
    from supplier join nation on s_nationkey = n_nationkey""",
)
def _(t):
    named = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    rows = records.with_places(named, "n_name", place_map(t))
    country, spec = records.place_fields(F.array(F.lit("a")), F.col("mapped"))
    return rows.select(
        "s_suppkey", F.array_join(records.place_tags(F.array(F.lit("a")), F.col("mapped")), "|").alias("tags"), country.alias("country"),
        F.array_join(spec, "|").alias("spec"),
    )


@query(
    "series_meta",
    f"""with {_Q} select distinct {_SERIES} || '_' || domain as seriesid, domain as source_domain, p_name as name, cast(null as varchar) as kind,
    p_type || case n_nationkey % 3 when 1 then '|spec' else '' end as spec, case n_nationkey % 3 when 0 then '国内' when 1 then '国外' end as country from q""".replace(
        "n_name ||", "replace(n_name, '_', '-') ||"
    ),
)
def _(t):
    rows = price_rows(t).withColumn(
        "rows", F.transform("rows", lambda r: r.withField("origin", F.replace(r["origin"], F.lit("_"), F.lit("-"))))
    )
    mapping = place_map(t).withColumn("place", F.replace("place", F.lit("_"), F.lit("-")))
    meta = records.series_meta(records.price_records_rows(rows), mapping)
    name, kind, _, _, spec = V.SERIES_ATTRIBUTES
    return meta.select(
        "seriesid", "source_domain", F.col(name).alias("name"), F.col(kind).alias("kind"), F.array_join(spec, "|").alias("spec"),
        F.col(V.COUNTRY_FIELD).alias("country"),
    )


@query(
    "market_history_flatten",
    """select l_orderkey, l_linenumber, 'market ' || cast(l_suppkey as varchar) as "sellerMarket", strftime(l_shipdate, '%Y-%m-%d') as "validDate", l_quantity as price from lineitem""",
)
def _(t):
    cell = lambda p: F.array(F.lit("1"), p.cast("string"), F.lit("0"), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("flat"))
    line = lambda name, p: F.struct(name.alias("name"), F.array(cell(p)).alias("data"))
    chart = F.to_json(F.array(line(F.lit(V.OVERALL_TREND), F.lit(1)), line(F.concat(F.lit("market "), F.col("l_suppkey").cast("string")), F.col("l_quantity"))))
    df = t.lineitem.select(F.struct("l_orderkey", "l_linenumber").alias("k"), chart.alias("chart"))
    return records.market_history_flatten(df, "k", "chart").select("k.l_orderkey", "k.l_linenumber", "sellerMarket", "validDate", "price")


@query(
    "zip_history",
    """select l_orderkey, l_linenumber, case when l_returnflag = l_linestatus then l_returnflag || '=' || cast(l_linenumber as varchar)
    else l_returnflag || '=' || cast(cast(l_quantity as bigint) as varchar) || ',' || l_linestatus || '=' || cast(l_linenumber as varchar) end as history from lineitem""",
)
def _(t):
    m = records.zip_history(
        F.array("l_returnflag", "l_linestatus", F.lit("extra")), F.array(F.col("l_quantity").cast("bigint").cast("string"), F.col("l_linenumber").cast("string"))
    )
    flat = F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return t.lineitem.select("l_orderkey", "l_linenumber", flat.alias("history"))


def _materials(t):
    info = F.map_from_arrays(
        F.array(F.lit(V.MATERIAL_PROPERTIES[0]), F.lit(V.MATERIAL_PROPERTIES[1]), F.lit("other")),
        F.array(F.col("p_type"), F.when(F.col("p_size") % 2 == 0, "").otherwise("H2O"), F.lit("x")),
    )
    some = lambda cond, c: F.when(cond, F.array(c)).otherwise(F.array().cast("array<string>"))
    rows = t.part.select(
        F.format_string("http://m%d.example.com/1", (F.col("p_partkey") % 5)).alias("source"), F.concat_ws(" ", F.col("p_name"), F.col("p_partkey").cast("string")).alias("name"),
        F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_brand")).alias("usage"), some(F.col("p_size") > 20, F.col("p_brand")).alias("upstream"),
        some(F.col("p_size") < 30, F.col("p_type")).alias("downstream"), info.alias("info"),
    )
    entities = t.part.where("p_size > 25").select(F.col("p_partkey").alias("nid"), F.array(F.concat_ws(" ", F.col("p_name"), F.col("p_partkey").cast("string"))).alias("alias"))
    mapper = t.part.where("p_size > 30").select(F.concat_ws(" ", F.col("p_name"), F.col("p_partkey").cast("string")).alias("raw"), F.col("p_name").alias("mapped"))
    return records.material_records(rows, entities, mapper)


@query(
    "material_records",
    """select p_name || ' ' || cast(p_partkey as varchar) as name, case when p_size > 25 then p_partkey end as nid,
    case when p_size > 30 then p_name else p_name || ' ' || cast(p_partkey as varchar) end as entity, case when p_size % 3 <> 0 then p_brand end as description,
    case when p_size > 20 then p_brand end as up, case when p_size < 30 then p_type end as down, 'm' || cast(p_partkey % 5 as varchar) || '.example.com' as site,
    cast(case when p_size % 2 = 0 then 1 else 2 end as int) as n_props from part""",
)
def _(t):
    return _materials(t).select(
        "name", "nid", F.col("mainEntityOfPage").alias("entity"), "description", F.array_join("upstream_material", ",").alias("up"),
        F.array_join("downstream_material", ",").alias("down"), "site", F.size("properties").alias("n_props"),
    )


@query("updown_lookup", "select 'red plate 42' as name, p_brand as up, p_type as down from part where p_name || ' ' || cast(p_partkey as varchar) = 'red plate 42' and p_size > 20 and p_size < 30 union all select p_name || ' ' || cast(p_partkey as varchar), case when p_size > 20 then p_brand end, case when p_size < 30 then p_type end from part where p_partkey = 7")
def _(t):
    m = _materials(t)
    seven = t.part.where("p_partkey = 7").select(F.concat_ws(" ", F.col("p_name"), F.col("p_partkey").cast("string")).alias("n"))
    hit = m.where(F.col("name") == seven.scalar())
    cols = lambda df: df.select("name", F.array_join("upstream_material", ",").alias("up"), F.array_join("downstream_material", ",").alias("down"))
    both = records.updown_lookup(m, "red plate 42").where("upstream_material is not null and downstream_material is not null")
    return cols(both).unionByName(cols(hit))


@query(
    "wide_price_schema",
    """select p_brand || '__' || s_name || '_' || p_type as name, p_name as entity, 's' || cast(s_suppkey as varchar) || '.example.com|' || p_name as tags,
    strftime(l_shipdate, '%Y-%m') as month, cast(null as varchar) as seller from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey""",
)
def _(t):
    mapper = t.part.groupBy(F.concat_ws("#", F.col("p_brand"), F.col("p_name")).alias("raw")).agg(F.max("p_name").alias("mapped"))
    q = quotes(t)
    out = records.wide_price_rows(
        q, {"mainEntityOfPage_raw": F.concat_ws("#", "p_brand", "p_name"), "sellerMarket": F.col("s_name"), "productGrade": F.col("p_type"),
            "source": F.col("url"), "validDate": F.substring("day", 1, 7)}, mapper,
    )
    return out.select(
        F.regexp_replace("name", "#[a-z ]+_", "_").alias("name"), F.col("mainEntityOfPage").alias("entity"), _tags(), F.col("validMonth").alias("month"), "seller"
    )


@query(
    "news_records",
    """with d as (select doc_id, source, lang, case when doc_id % 17 = 0 then '' else split_part(text, chr(10), 1) end as title, text, n_chars from documents)
    select sha1(title || '_2024-01-0' || cast(doc_id % 9 as varchar) || 'T00_' || source || '.example.com') as rid, '新闻|' || lang || case when doc_id % 2 = 0 then '|kind' else '' end as tags,
    '标题=' || title || ';摘要=' || source || ';来源=src;日期=2024-01-0' || cast(doc_id % 9 as varchar) || ';链接=http://' || source || '.example.com/' || cast(doc_id as varchar) || ';正文=' || text as claims
    from d where title <> '' and n_chars > 200""",
)
def _(t):
    d = t.documents.select(
        "doc_id", "source", "lang", F.when(F.col("doc_id") % 17 == 0, "").otherwise(F.split("text", "\n")[0]).alias("title"), "text",
        F.when(F.col("n_chars") > 200, F.format_string("http://%s.example.com/%d", "source", "doc_id")).alias("url"),
        F.concat(F.lit("2024-01-0"), (F.col("doc_id") % 9).cast("string"), F.lit("T00")).alias("date"),
    )
    out = records.news_records(
        d, url=F.col("url"), title=F.col("title"), summary=F.col("source"), origin=F.lit("src"), date=F.col("date"), content=F.col("text"),
        tags=F.array(F.lit(V.NEWS_TAG), F.col("lang"), F.when(F.col("doc_id") % 2 == 0, "kind").otherwise("")), time=F.col("date"),
    )
    return out.select("rid", _tags(), _claims())


@query(
    "entity_records",
    """with d as (select doc_id, source, lang, regexp_replace(text, '^\\s+|\\s+$', '', 'g') as line from documents)
    select doc_id, sha1('e' || cast(doc_id as varchar) || '_' || source || '.example.com') as nid, 'e' || cast(doc_id as varchar) || '|' || lang || '|b' as alias,
    '实体定义=' || line || ';kind=' || case when doc_id % 2 = 0 then 'preferred' else 'first' end as claims from d where line <> ''""",
)
def _(t):
    f = lambda k, v: F.struct(F.lit(k).alias("k"), v.alias("v"))
    line = F.col("text")
    fields = lambda kind: F.array(
        f("kind", F.lit(kind)), f(V.ALIAS_FIELD, F.concat("lang", F.lit("，b。"))), f(V.SOURCE_FIELD, line), f("empty", F.lit(""))
    )
    book = lambda name, kind: F.struct(name.alias("book"), fields(kind).alias("fields"))
    d = t.documents.where(F.rlike(line, F.lit(r"\S"))).select(
        "doc_id", F.format_string("http://%s.example.com/x", "source").alias("source"), F.concat(F.lit("e"), F.col("doc_id").cast("string")).alias("name"),
        F.lit("t").alias("access_time"),
        F.array(book(F.lit("other"), "first"), book(F.when(F.col("doc_id") % 2 == 0, V.PREFERRED_BOOK).otherwise("third"), "preferred")).alias("books"),
    )
    out = records.entity_records(d)
    return out.select(
        F.regexp_extract(F.get("alias", F.lit(0)), r"(\d+)", 1).cast("bigint").alias("doc_id"), "nid", F.array_join("alias", "|").alias("alias"), _claims()
    )


@query(
    "company_records",
    """select s_suppkey, 'bal=' || cast(s_acctbal as varchar) || ';股东信息=_11;股东名称=h1_11;股东职务=boss_11;股东source_url=http://q/k' || cast(s_suppkey as varchar) || '/h1_11' ||
    ';股东信息=_22;股东名称=h2_22;股东职务=' || s_name || '_22' || case when s_suppkey % 2 = 0 then ';变更记录=_33;变更项目=p_33;变更时间=d_33;变更前=_33;变更后=a_33' else '' end ||
    ';主要人员=' || r || ';人员职务=ceo' || r || ';人员姓名=e' || r as claims, sha1(s_name || '_c.example.com') as nid
    from (select *, case when s_suppkey % 2 = 0 then '_44' else '_33' end as r from supplier)""",
)
def _(t):
    null = F.lit(None).cast("string")
    kv = lambda k, v: F.struct(F.lit(k).alias("k"), v.alias("v"))
    holder = lambda n, role, link: F.struct(F.lit(n).alias("name"), role.alias("role"), link.alias("link"))
    change = F.struct(F.lit("p").alias("project"), F.lit("d").alias("change_time"), null.alias("before_change"), F.lit("a").alias("after_change"))
    one = F.array(change)
    df = t.supplier.select(
        "s_suppkey", F.col("s_name").alias("name"), F.lit("http://c.example.com/x").alias("source"), F.lit("t").alias("access_time"),
        F.array(kv("bal", F.col("s_acctbal").cast("string")), kv("none", null)).alias("info"),
        F.array(holder("h1", F.lit("boss"), F.concat(F.lit("firm_k"), F.col("s_suppkey").cast("string"))), holder("h2", F.col("s_name"), null)).alias("shareholders"),
        F.when(F.col("s_suppkey") % 2 == 0, one).otherwise(F.slice(one, 1, 0)).alias("changes"),
        F.array(F.struct(F.lit("ceo").alias("position"), F.lit("e").alias("name"))).alias("executives"),
    )
    out = records.company_records(df, "http://q/{key_num}/{name}")
    return out.select(F.regexp_extract(F.get("alias", F.lit(0)), r"#0*(\d+)$", 1).cast("bigint").alias("s_suppkey"), _claims(), "nid")


@query(
    "record_search",
    f"""with {_Q}, r as ({_PRICE_ROWS_SQL}), f as (select * from r where list_contains(string_split(tags, '|'), 'ECONOMY')
      and (list_contains(string_split(tags, '|'), '国内') or list_contains(string_split(tags, '|'), 'spec')) and "recordDate" >= '1996-01-01' and "recordDate" < '1998-01-01')
    select series, "recordDate", cast(8 as int) as "totalClaim", (select count(*) from f) as total from f order by "recordDate" desc, series, claims limit 25 offset 50""",
)
def _(t):
    from webloom.operators.joins import range_filter

    r = records.price_records_rows(price_rows(t), place_map(t)).withColumn("flat", records.claims_text("claims"))
    out = records.record_search(
        r, all_of=["ECONOMY"], any_of=["国内", "spec"], dates=range_filter(F.col("recordDate"), "1996-01-01", "1998-01-01", hi_open=True),
        order=["-recordDate", "series", "flat"], offset=50, limit=25,
    )
    return out.select("series", "recordDate", "totalClaim", "total")


@query(
    "table_audit",
    """with a as (select 'orders' as name, count(*) as n_rows, max(o_orderdate) as newest from orders union all select 'events', count(*), max(ts) from events
      union all select 'lineitem', count(*), max(l_shipdate) from lineitem), e as (select unnest(['orders', 'events', 'clicks']) as name)
    select coalesce(a.name, e.name) as name, n_rows, cast(newest as varchar) as newest, case when n_rows is null then 'missing' when e.name is null then 'unexpected'
    when date '2024-02-01' - cast(newest as date) > 3 then 'stale' else 'ok' end as state from e full join a using (name)""",
)
def _(t):
    expected = t.orders.select(F.explode(F.array(*[F.lit(x) for x in ("orders", "events", "clicks")])).alias("name")).distinct()
    out = records.table_audit(
        expected, {"orders": (t.orders, "o_orderdate"), "events": (t.events, "ts"), "lineitem": (t.lineitem, "l_shipdate")},
        F.lit("2024-02-01").cast("date"),
    )
    return out.withColumn("newest", F.col("newest").cast("string"))


_PIPELINE_SQL = f"""with {_Q}, r as ({_PRICE_ROWS_SQL}),
    d as (select rid, domain, series, split_part(series, '_', 1) as product from r qualify row_number() over (partition by rid order by claims) = 1)
    select domain, count(*) as records, count(distinct series) as series, count(distinct product) as products, cast(0 as bigint) as news from d group by rollup (domain)"""


@query("price_pipeline", _PIPELINE_SQL)
def _(t):
    """Rows to records, places mapped, unique insert by record id, statistics per domain."""
    r = records.price_records_rows(price_rows(t), place_map(t)).select(
        F.col("rid"), F.col("series"), F.col("source.domain").alias("domain"), F.get("claims", F.lit(2))["o"].alias("price")
    )
    stored = first_per_key(r, ["rid"], ["price"])
    rows = stored.select("domain", "series", F.split("series", "_")[0].alias("product"), F.lit(False).alias("is_news"))
    return stats.domain_stats(rows)
