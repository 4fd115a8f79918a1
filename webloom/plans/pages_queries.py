"""Page extraction over the driver tables."""

from pyspark.sql import functions as F

from webloom.functions.text import strip_tags
from webloom.operators import pages
from webloom.plans.registry import query

_HTML = (
    "case page_id % 4 when 0 then replace(html, '</title>', '_百度知道</title>') "
    "when 1 then replace(html, '<title>', '<title>百度知道-信息提示</title><x>') when 2 then replace(html, '<title>', '<titel>') else html end"
)
_DUCK_TITLE = """case when contains(t, '_百度知道') then replace(t, '_百度知道', '') when t = '百度知道-信息提示' then '0' else '-1' end"""


@query("page_title", f"select page_id, {_DUCK_TITLE} as title from (select page_id, regexp_extract({_HTML}, '<title>(.*)</title>', 1) as t from pages)")
def _(t):
    return t.pages.select("page_id", pages.page_title(F.expr(_HTML)).alias("title"))


_QP = {
    "content": "<article>(.*?)(</article>|</div>)", "supplement": "<footer>(.*?)(</footer>|</div>)", "time": "<!-- ad (\\d+) -->",
    "asker": '<html lang="(.*?)">', "answer_id": '<a href="/([a-z]+)"',
}


def _duck_found(pattern):
    return f"case when regexp_matches(h, '{pattern}') then regexp_extract(h, '{pattern}', 1) end"


@query(
    "question_page",
    rf"""with p as (select page_id as id, {_HTML} as h from pages),
    q as (select id, {_DUCK_TITLE.replace('t, ', "regexp_extract(h, '<title>(.*)</title>', 1), ").replace('when t =', "when regexp_extract(h, '<title>(.*)</title>', 1) =")} as question,
      coalesce(regexp_replace(regexp_replace({_duck_found(_QP['content'])}, '<.*?>', chr(10), 'g'), '^\s+|\s+$', '', 'g'), '')
        || coalesce({_duck_found(_QP['supplement'])}, '') as question_content,
      {_duck_found(_QP['time'])} as question_time, {_duck_found(_QP['asker'])} as asker_username,
      array_to_string(regexp_extract_all(h, '{_QP['answer_id']}', 1), ',') as answer_ids from p)
    select * from q where question <> '0' and not contains(question_content, 'word-replace')""",
)
def _(t):
    p = t.pages.select("page_id", F.expr(_HTML).alias("h"))
    return pages.question_page(p, "page_id", "h", _QP).withColumn("answer_ids", F.array_join("answer_ids", ","))


@query(
    "answer_json",
    """select event_id, 'q' || cast(user_id as varchar) as question_id, cast(event_id as varchar) as answer_id,
    cast(event_id % 2 as int) as is_best, cast(event_id % 3 as int) as is_recommend, cast(null as int) as is_highquality,
    event_type as answer_time, 'c ' || event_type as content, cast(json_extract(props, '$.k') as int) as agreement, 7 as disagreement
    from events""",
)
def _(t):
    js = F.to_json(
        F.struct(
            F.concat(F.lit("q"), F.col("user_id").cast("string")).alias("encode_qid"), F.col("event_id").alias("id"),
            (F.col("event_id") % 2).alias("isBest"), (F.col("event_id") % 3).alias("isRecommend"), F.col("event_type").alias("createTime"),
            F.concat(F.lit("c "), "event_type").alias("content"), F.get_json_object("props", "$.k").cast("int").alias("valueNum"),
            F.lit(7).alias("valueBadNum"),
        )
    )
    return pages.answer_json(t.events.select("event_id", js.alias("js")), "js", ["event_id"])


@query(
    "normalise_headers",
    """with f as (select event_id, 'k' as h, json_extract_string(props, '$.k') as v, 0 as o from events union all
      select event_id, event_type, cast(user_id as varchar), 1 from events union all select event_id, 'note', '', 2 from events),
    m as (select event_id, case h when 'k' then 'quantity' when 'click' then 'quantity' when 'view' then 'seen' else h end as h, v, o from f),
    d as (select * from m qualify row_number() over (partition by event_id, h order by case when v = '' then 1 else 0 end, o) = 1)
    select event_id, string_agg(h || '=' || v, ',' order by h) as fields from d group by 1""",
)
def _(t):
    kv = F.map_from_arrays(
        F.array(F.lit("k"), F.col("event_type"), F.lit("note")),
        F.array(F.get_json_object("props", "$.k"), F.col("user_id").cast("string"), F.lit("")),
    )
    mapping = t.events.where("event_type in ('click', 'view')").select(
        F.col("event_type").alias("raw"), F.when(F.col("event_type") == "click", "quantity").otherwise("seen").alias("canonical")
    ).union(t.events.select(F.lit("k"), F.lit("quantity"))).distinct()
    out = pages.normalise_headers(t.events.select("event_id", kv.alias("fields")), "event_id", "fields", mapping)
    flat = F.array_join(F.array_sort(F.transform(F.map_entries("fields"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
    return out.select("event_id", flat.alias("fields"))


_BOOKS = (
    "case doc_id % 3 when 0 then '<hr /><p>【' || source || '】' || replace(replace(text, '<', ''), chr(10), '</p><p>') || '</p><p>【摘录】a</p><hr />end' "
    "when 1 then '<p>【' || lang || '】<strong>x</strong>【y】' || replace(replace(text, '<', ''), '. ', '</p><p>【z】') || '</p><hr />' else text end"
)


@query(
    "labelled_sections",
    rf"""with b as (select doc_id, case doc_id % 3 when 0 then '【' || source || '】' || replace(replace(text, '<', ''), chr(10), chr(1)) || chr(1) || '【摘录】a'
        when 1 then '【' || lang || '】x【y】' || replace(replace(text, '<', ''), '. ', chr(1) || '【z】') end as s from documents where doc_id % 3 < 2),
    l as (select doc_id, unnest(string_split(s, chr(1))) as line, generate_subscripts(string_split(s, chr(1)), 1) as i from b),
    g as (select *, sum(case when regexp_matches(line, '^【.+?】') then 1 else 0 end) over (partition by doc_id order by i) - 1 as g from l)
    select doc_id, 0 as book, cast(g as int) as ordinal, arg_min(regexp_extract(line, '^【(.+?)】', 1), i) as label,
    string_agg(case when regexp_matches(line, '^【.+?】') then regexp_replace(split_part(line, chr(10), 1), '【.+?】', '', 'g') || substr(line, length(split_part(line, chr(10), 1)) + 1)
      else line end, chr(10) order by i) as value from g group by doc_id, g""",
)
def _(t):
    return pages.labelled_sections(t.documents.select("doc_id", F.expr(_BOOKS).alias("html")), "doc_id", "html")


_BOX = ("<article>", "</article>")
_NF = {"title": "<h1[^>]*>([^<]*)", "public_date": "<h5[^>]*>([^<]*)", "body": "<p[^>]*>([^<]*)"}


@query(
    "notice_page",
    "with p as (select page_id, case when instr(tail, '</article>') > 0 then substr(tail, 1, instr(tail, '</article>') - 1) else tail end as h "
    "from (select page_id, substr(html, greatest(instr(html, '<article>'), 1)) as tail from pages)) select page_id, "
    + ", ".join(f"{_duck_found(p)} as {n}" for n, p in _NF.items())
    + " from p",
)
def _(t):
    cols = pages.notice_page(F.col("html"), _BOX, _NF)
    return t.pages.select("page_id", *[c.alias(n) for n, c in cols.items()])


_LINKED = "case page_id % 3 when 0 then replace(html, 'href=\"/', 'href=\"') when 1 then replace(html, 'href=\"/', 'href=\"//h.org/') else html end"


@query(
    "page_links",
    r"""with l as (select distinct page_id, url, unnest(regexp_extract_all(case page_id % 3 when 0 then replace(html, 'href="/', 'href="')
      when 1 then replace(html, 'href="/', 'href="//h.org/') else html end, 'href="([^"]*)"', 1)) as h from pages)
    select distinct page_id, case when regexp_matches(h, '^[a-zA-Z][a-zA-Z0-9+.\-]*:') then h
      when starts_with(h, '//') then regexp_extract(url, '^([a-z]+:)', 1) || h
      when h = '' then url
      when starts_with(h, '/') then regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || h
      else regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') || h end as link from l""",
)
def _(t):
    return pages.page_links(t.pages.select("page_id", "url", F.expr(_LINKED).alias("html")), "page_id", "url", "html")


@query("strip_tags", "select page_id, regexp_replace(html, '<[^>]*>', '', 'g') as body from pages")
def _(t):
    return t.pages.select("page_id", strip_tags(F.col("html")).alias("body"))


_DUMP = "chr(10) || p_name || ' ' || cast(p_partkey as varchar(9)) || chr(10) || case when p_size % 3 = 0 then '@@@LINK=' || p_brand || chr(10) else 'text' end"


@query(
    "dump_entries",
    "select p_name || ' ' || cast(p_partkey as varchar) as headword, case when p_size % 3 = 0 then p_brand end as alias from part",
)
def _(t):
    return pages.dump_entries(t.part.select(F.expr(_DUMP).alias("value")), "value")


@query(
    "page_error",
    """select page_id, case when page_id % 9 = 4 then 'status' when page_id % 7 = 2 then 'redirect' when length(html) < 2000 then 'short'
    when contains(html, 'spam') then 'error' end as reason from pages""",
)
def _(t):
    fetches = t.pages.select(
        "page_id", "url", F.when(F.col("page_id") % 7 == 2, F.concat("url", F.lit("/moved"))).otherwise(F.col("url")).alias("final_url"),
        F.when(F.col("page_id") % 9 == 4, 502).otherwise(200).alias("status"), F.col("html").alias("body"),
    )
    return pages.page_error(fetches, 2000, lambda body: F.contains(body, F.lit("spam"))).select("page_id", "reason")


_ENTRY = r"(?s)<title>(.+?)</title>.+?<article>(.+?)</article>"


@query(
    "dump_definitions",
    rf"""select regexp_replace(w, '^\s+|\s+$', '', 'g') as headword, regexp_replace(case when contains(i, '</p>') then regexp_extract(i, '(?s)^(.*)</p>', 1) else i end, '<[^>]*>', '', 'g') as definition
    from (select unnest(regexp_extract_all(html, '{_ENTRY}', 1)) as w, unnest(regexp_extract_all(html, '{_ENTRY}', 2)) as i from pages)""",
)
def _(t):
    return pages.dump_definitions(t.pages, "html", _ENTRY, "</p>")
