"""Counters and reports over the driver tables."""

from pyspark.sql import functions as F

from webloom.functions.text import words
from webloom.operators import stats
from webloom.operators.textops import word_matcher
from webloom.plans.registry import query

_TOKENS = r"(select unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')) as w from documents)"


def _words(t, name="w"):
    return t.documents.select(F.explode(words(F.col("text"))).alias(name))


@query("label_counts", "select event_type as label, count(*) as n from events group by 1")
def _(t):
    return stats.label_counts(t.events.select(F.concat_ws(":", "event_type", F.col("user_id").cast("string")).alias("lab")), "lab")


@query(
    "domain_stats",
    """select 'd' || cast(l_suppkey % 20 as varchar) as domain, count(*) filter (l_returnflag <> 'R') as records,
    count(distinct l_partkey) as series, count(distinct l_partkey % 50) as products, count(*) filter (l_returnflag = 'R') as news
    from lineitem group by rollup (1)""",
)
def _(t):
    rec = t.lineitem.select(
        F.concat(F.lit("d"), (F.col("l_suppkey") % 20).cast("string")).alias("domain"), F.col("l_partkey").alias("series"),
        (F.col("l_partkey") % 50).alias("product"), (F.col("l_returnflag") == "R").alias("is_news"),
    )
    return stats.domain_stats(rec)


@query(
    "snapshot_delta",
    """with c as (select event_type, date_trunc('day', ts) as d, count(*) as n from events group by all)
    select event_type, arg_min(n, d) as oldest, arg_max(n, d) as newest, arg_max(n, d) - arg_min(n, d) as delta from c
    where d >= timestamp '2024-01-05' and d < timestamp '2024-01-20' group by 1""",
)
def _(t):
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return stats.snapshot_delta(daily, "event_type", "n", "d", F.lit("2024-01-05").cast("date"), F.lit("2024-01-20").cast("date"))


@query(
    "attribute_frequency",
    """select a as attribute, count(*) as n from (select unnest(json_keys(props)) as a from events
    union all select 'type:' || event_type from events) group by 1""",
)
def _(t):
    keys = F.map_keys(F.from_json("props", "map<string,string>"))
    pairs = t.events.select(F.explode(F.concat(keys, F.array(F.concat(F.lit("type:"), "event_type")))).alias("attribute"))
    return stats.attribute_frequency(pairs)


@query(
    "class_attribute_tables",
    """select distinct 'tags' as what, p_name as key, p_brand as val from part
    union all select 'attribute', p_type, cast(count(*) as varchar) from part group by p_type""",
)
def _(t):
    tags, attrs = stats.class_tables(
        t.part.select(F.col("p_name").alias("entity"), F.col("p_brand").alias("tag")), t.part.select(F.col("p_type").alias("attribute"))
    )
    return tags.select(F.lit("tags").alias("what"), F.col("entity").alias("key"), F.col("tag").alias("val")).unionByName(
        attrs.select(F.lit("attribute").alias("what"), F.col("attribute").alias("key"), F.col("n").cast("string").alias("val"))
    )


def _labelled(t):
    return t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")


@query("existence_ratio", "select round(avg(case when quality is null then 0.0 else 1.0 end), 9) as ratio, count(*) as n from documents left join labels using (doc_id)")
def _(t):
    return stats.existence_ratio(_labelled(t), "quality").select(F.round("ratio", 9).alias("ratio"), "n")


@query("lacking_section", "select doc_id from documents left join labels using (doc_id) where quality is null")
def _(t):
    return stats.lacking(_labelled(t), "quality", "doc_id")


@query(
    "coverage",
    """select round(count(*) filter (doc_id in (select doc_id from labels)) / count(*), 9) as coverage, count(*) as tests
    from (select distinct doc_id from documents)""",
)
def _(t):
    return stats.coverage(t.documents, t.labels, "doc_id").select(F.round("coverage", 9).alias("coverage"), "tests")


@query("length_histogram", f"select cast(length(w) as int) as length, length(w) > 7 as is_long, count(*) as n from {_TOKENS} group by all")
def _(t):
    return stats.length_histogram(_words(t), "w")


_SPACED = "(select distinct unnest(string_split(text, ' ')) as w from documents)"


@query(
    "length_buckets",
    f"""select cast(case when length(w) in (1, 2, 3) then length(w) else 4 end as int) as bucket, count(*) as n from {_SPACED}
    where not (regexp_matches(w, '^[{stats.SYMBOLS.replace("'", "''")}]*$') and not regexp_matches(w, '^[A-Za-z0-9]+$')) group by 1""",
)
def _(t):
    terms = t.documents.select(F.explode(F.split("text", " ")).alias("w")).distinct()
    return stats.length_buckets(terms, "w").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


@query(
    "suffix_counts",
    """select s as suffix, count(*) as n from (select unnest([right(p_name, 1), right(p_name, 2), right(p_name, 3)]) as s from part)
    group by 1 order by n desc, s limit 1000""",
)
def _(t):
    return stats.suffix_counts(t.part, "p_name")


@query(
    "host_group_sum",
    """select regexp_extract(url, '(com|net|org)/(.*?)/', 2) as grp, cast(sum(page_id) as bigint) as total from pages
    where regexp_matches(url, '(com|net|org)/(.*?)/') group by rollup (1)""",
)
def _(t):
    pattern = "(com|net|org)/(.*?)/"
    pages = t.pages.where(F.rlike("url", F.lit(pattern))).select("url", "page_id")
    return stats.host_group_sum(pages, F.regexp_extract("url", pattern, 2), "page_id")


@query(
    "hit_rates",
    """with r as (select u.conv_id, u.turn, a.text as answer, case when u.conv_id % 7 = 0 then 'http://x.example/1' else 'http://y/1' end as url,
      u.conv_id as item_id from conversations u left join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1 and a.role = 'assistant'
      where u.role = 'user')
    select round(100 * count(*) filter (coalesce(answer, '') <> '' and not contains(url, 'x.example')) / count(*), 6) as hit_pct,
    round(100 * count(*) filter (coalesce(answer, '') <> '' and not contains(url, 'x.example') and item_id in (select doc_id from labels)) / count(*), 6) as known_pct
    from r""",
)
def _(t):
    c = t.conversations
    a = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    rows = c.where("role = 'user'").select("conv_id", "turn").join(a, ["conv_id", "turn"], "left").select(
        "answer", F.when(F.col("conv_id") % 7 == 0, "http://x.example/1").otherwise("http://y/1").alias("url"), F.col("conv_id").alias("item_id")
    )
    out = stats.hit_rates(rows, t.labels.select(F.col("doc_id").alias("item_id")), "x.example")
    return out.select(F.round("hit_pct", 6).alias("hit_pct"), F.round("known_pct", 6).alias("known_pct"))


@query(
    "duplicate_report",
    """with s as (select l_partkey as song_id, l_suppkey as artist_id from lineitem), a as (select s_suppkey % 97 as artist_id from supplier),
    p as (select artist_id, count(s.song_id) as n from (select distinct artist_id from a) a left join s using (artist_id) group by 1)
    select 'duplicate_artist' as what, cast(artist_id as varchar) as key, count(*) as n from a group by artist_id having count(*) > 1
    union all select 'duplicate_song', cast(song_id as varchar) || '__' || cast(artist_id as varchar), count(*) from s group by song_id, artist_id having count(*) > 1
    union all select 'songs_of_artist', cast(artist_id as varchar), n from p
    union all select 'total', 'total', cast(sum(n) as bigint) from p""",
)
def _(t):
    songs = t.lineitem.select(F.col("l_partkey").alias("song_id"), F.col("l_suppkey").alias("artist_id"))
    return stats.duplicate_report(songs, t.supplier.select((F.col("s_suppkey") % 97).alias("artist_id")))


@query(
    "search_completeness",
    """with e as (select o_custkey as keyword, cast(count(*) as bigint) as expected from orders group by 1),
    g as (select o_custkey as keyword, count(*) as collected, count(distinct l_partkey) as actual from orders join lineitem on o_orderkey = l_orderkey
      group by 1)
    select keyword, expected, coalesce(collected, 0) as collected, coalesce(actual, 0) as actual, expected <> coalesce(actual, 0) as mismatch
    from e left join g using (keyword)""",
)
def _(t):
    expected = t.orders.groupBy(F.col("o_custkey").alias("keyword"), F.col("o_orderstatus").alias("idx")).agg(F.count(F.lit(1)).alias("total"))
    items = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("keyword"), F.col("o_orderstatus").alias("idx"), F.col("l_partkey").alias("name")
    )
    return stats.search_completeness(expected, items)


_PRED = "case when length(text) > 1000 or contains(text, 'ing') then 1 else 0 end"
_LAB = f"(select doc_id, quality as target, {_PRED} as predicted from labels join documents using (doc_id))"


def _predicted(t):
    return t.labels.join(t.documents, "doc_id").select("doc_id", F.col("quality").alias("target"), F.expr(_PRED).alias("predicted"))


@query("confusion_matrix", f"select target, predicted, count(*) as n from {_LAB} group by all")
def _(t):
    return stats.confusion_matrix(_predicted(t), "target", "predicted")


_REPORT = """select label, round(case when p > 0 then tp / p else 0 end, 9) as precision, round(case when s > 0 then tp / s else 0 end, 9) as recall,
    round(case when tp > 0 then 2 * tp / (p + s) else 0 end, 9) as f1, s as support from
    (select label, count(*) filter (target = label and predicted = label) as tp, count(*) filter (predicted = label) as p,
      count(*) filter (target = label) as s from {src}, (select unnest([0, 1]) as label) group by 1)"""


def _rounded(df):
    return df.select("label", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("classification_report", _REPORT.format(src=_LAB))
def _(t):
    return _rounded(stats.classification_report(_predicted(t), "target", "predicted"))


@query(
    "evaluate",
    _REPORT.format(
        src="""(select k, case when k % 3 = 0 then 1 else 0 end as predicted, target from (
          select doc_id as k, quality as target, 0 as o, doc_id from labels where toxic = 0 union all
          select doc_id, toxic, 1, doc_id from labels)
          qualify row_number() over (partition by k order by o, target) = 1)"""
    ),
)
def _(t):
    first = t.labels.where("toxic = 0").groupBy(F.col("doc_id").alias("k")).agg(F.min("quality").alias("e"))
    second = t.labels.groupBy(F.col("doc_id").alias("k")).agg(F.min("toxic").alias("e"))
    return _rounded(stats.evaluate([first, second], F.when(F.col("k") % 3 == 0, 1).otherwise(0), "k", "e"))


@query(
    "error_lists",
    rf"""with e as (select doc_id, target, predicted, case when predicted = 1 then 'false_positive' else 'false_negative' end as kind from {_LAB}
    where target <> predicted union all (select doc_id, target, predicted, 'true_negative' from {_LAB} where target = 0 and predicted = 0
    order by md5(cast(doc_id as varchar) || ':1'), doc_id limit 20))
    select doc_id, target, predicted, kind, array_to_string(list_sort(list_intersect(list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> ''), ['que', 'the', 'und'])), ',') as matched
    from e join documents using (doc_id)""",
)
def _(t):
    rows = _predicted(t).join(t.documents.select("doc_id", "text"), "doc_id")
    out = stats.error_lists(rows, "doc_id", "target", "predicted", sample=20, matched=word_matcher(["the", "und", "que"])(F.col("text")))
    return out.select("doc_id", "target", "predicted", "kind", "matched")


@query("record_dictionary", "select distinct p_brand as domain, p_type as entity, p_name as name from part")
def _(t):
    return stats.record_dictionary(t.part, F.col("p_brand"), F.col("p_type"), F.col("p_name"))


@query(
    "checksum_diff",
    """with a as (select doc_id, text from documents where source <> 'src3'), b as (select doc_id, case when source = 'src4' then text || ' ' else text end as text
      from documents where source <> 'src5')
    select coalesce(a.doc_id, b.doc_id) as doc_id, case when a.doc_id is null then 'missing_left' when b.doc_id is null then 'missing_right' else 'mismatch' end as state
    from a full join b on a.doc_id = b.doc_id where md5(a.text) is distinct from md5(b.text)""",
)
def _(t):
    a = t.documents.where("source <> 'src3'").select("doc_id", "text")
    b = t.documents.where("source <> 'src5'").select(
        "doc_id", F.when(F.col("source") == "src4", F.concat("text", F.lit(" "))).otherwise(F.col("text")).alias("text")
    )
    return stats.checksum_diff(a, b, "doc_id", "text")
