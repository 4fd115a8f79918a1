"""Set operators over the driver tables."""

from pyspark.sql import functions as F

from webloom.functions.text import words
from webloom.operators import sets
from webloom.plans.registry import query


@query(
    "union_entities",
    """select p_name as name from part union select p_brand from part union select n_name from nation union select c_mktsegment from customer
    union select r_name from region union select s_name from supplier union select c_name from customer""",
)
def _(t):
    cols = [(t.part, "p_name"), (t.part, "p_brand"), (t.nation, "n_name"), (t.customer, "c_mktsegment"), (t.region, "r_name"),
            (t.supplier, "s_name"), (t.customer, "c_name")]
    return sets.union_entities([df.select(F.col(c).alias("name")) for df, c in cols])


_TOK = r"select distinct unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')) as name from documents where lang = "


def tokens(t, lang, name="name"):
    return t.documents.where(F.col("lang") == lang).select(F.explode(words(F.col("text"))).alias(name)).distinct()


@query(
    "tier_entities",
    f"""with a as ({_TOK}'en'), b as ({_TOK}'de'), c as ({_TOK}'fr'), cur as (select distinct p_name as name from part),
    u as (select name from a union select name from b union select name from c union select name from cur),
    f as (select name, name in (select name from a) as in_a, name in (select name from b) as in_b, name in (select name from c) as in_c,
      name in (select name from cur) as curated from u)
    select *, cast(case when curated or (in_a and in_b) then 1 when in_a or in_b then 2 else 3 end as int) as tier,
    in_a and in_b and in_c as in_all, in_a and in_b and not in_c as in_ab_only from f""",
)
def _(t):
    curated = t.part.select(F.col("p_name").alias("name")).distinct()
    return sets.tier_entities(tokens(t, "en"), tokens(t, "de"), tokens(t, "fr"), curated)


@query(
    "lexicon_core_diff",
    f"""with n as (select name as term from ({_TOK}'en') where length(name) > 1 union select p_name from part
      union select 'zz ' || name from ({_TOK}'es') where name <> ''),
    a as (select name as term from ({_TOK}'de') where length(name) > 1),
    core as (select term from n where term in (select term from a)), rest as (select term from n where term not in (select term from a)),
    bad as (select distinct term from (select term, unnest(string_split(term, ' ')) as w from rest) where w in (select term from core))
    select term, 'core' as kind from core union all select term, 'diff' from rest where term not in (select term from bad)""",
)
def _(t):
    es = tokens(t, "es", "w").select(F.concat(F.lit("zz "), "w").alias("term"))
    new = tokens(t, "en", "term").unionByName(t.part.select(F.col("p_name").alias("term"))).unionByName(es)
    return sets.lexicon_core_diff(new, tokens(t, "de", "term"), F.split("term", " "))


def _sources(t):
    part = lambda kind, off: t.part.where(F.col("p_type") != kind).select(
        F.concat_ws(" ", "p_name", "p_brand").alias("name"), (F.col("p_partkey") + off).alias("key_num")
    )
    return [("first", part("SMALL", 0)), ("second", part("LARGE", 100000)), ("third", part("PROMO", 200000))]


_MERGED = """m as (select name, key_num, source from (
      select p_name || ' ' || p_brand as name, p_partkey as key_num, 'first' as source, 0 as pr from part where p_type <> 'SMALL' union all
      select p_name || ' ' || p_brand, p_partkey + 100000, 'second', 1 from part where p_type <> 'LARGE' union all
      select p_name || ' ' || p_brand, p_partkey + 200000, 'third', 2 from part where p_type <> 'PROMO')
    qualify row_number() over (partition by name order by pr, key_num) = 1)"""


@query("merge_index_files", f"with {_MERGED} select cast(key_num as varchar) || chr(9) || name as line from m")
def _(t):
    return sets.index_lines(sets.merge_index_files(_sources(t)))


@query("effective_counts", f"with {_MERGED} select source, count(*) as n from m group by 1")
def _(t):
    return sets.effective_counts(sets.merge_index_files(_sources(t)))
