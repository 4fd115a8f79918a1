"""Knowledge-base jobs over the driver tables: parts are entities, their columns attributes."""

from pyspark.sql import functions as F

from webloom.functions import fixed_values as V
from webloom.operators import kb
from webloom.plans.registry import query

_ENT = (
    "case p_partkey % 7 when 0 then p_name || '_(' || p_brand || ')' when 1 then ' ' || p_name || '（' || p_type || '）' when 2 then '中国山脉' || p_brand "
    "when 3 then '<font color=red>' || p_name || '</font>' when 4 then '\ue41d' || p_name when 5 then '' else p_name || p_brand end"
)
_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def _dis(x):
    return f"case when regexp_matches({x}, '{V.DISAMBIGUATION}') then regexp_extract({x}, '{V.DISAMBIGUATION}', 1) else {x} end"


def _bra(x):
    return f"case when regexp_matches({x}, '{V.BRACKETED_NAME}') then regexp_extract({x}, '{V.BRACKETED_NAME}', 1) else {x} end"


@query(
    "extract_entities",
    f"""with e as (select *, {_ENT} as n from part),
    x as (select 'font' as kind, {_STRIP.format("case when starts_with(n, '<font') then replace(substr(n, instr(n, 'red>') + 4), '</font>', '') when regexp_matches(n, '^[' || chr(57344) || '-' || chr(61439) || ']') then null else n end")} as name from e
      union all select 'dump', p_name || ' ' || p_type from part union all select 'dump', p_brand from part where p_size % 3 = 0
      union all select 'labels', {_STRIP.format(_dis('n'))} from e union all select 'labels', p_brand from e
      union all select 'resource', {_dis(_STRIP.format('n'))} from e
      union all select 'titles', {_STRIP.format(_dis(_STRIP.format('n')))} from e where not regexp_matches({_STRIP.format(_dis(_STRIP.format('n')))}, '^[' || chr(57344) || '-' || chr(61439) || ']')
      union all select 'brackets', {_bra('n')} from e)
    select distinct kind, name from x where name is not null and name <> ''""",
)
def _(t):
    named = t.part.select(
        F.expr(_ENT).alias("n"), F.array(F.concat(F.lit(" "), "p_brand")).alias("al"),
        F.concat_ws("\n", F.concat_ws(" ", "p_name", "p_type"), F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(V.DUMP_LINK), "p_brand"))).alias("rec"),
    )
    out = None
    for kind, column, aliases in [
        ("font", "n", None), ("dump", "rec", None), ("labels", "n", "al"), ("resource", "n", None), ("titles", "n", None), ("brackets", "n", None),
    ]:
        part = kb.extract_entities(named, kind, column, aliases).select(F.lit(kind).alias("kind"), "name")
        out = part if out is None else out.unionByName(part)
    return out


def _fragment_lines(t):
    """Three kinds of fragments per part name and brand, empty ones among them."""
    key = F.concat_ws(" ", "p_name", "p_brand")
    arr = lambda c: F.to_json(F.array(c))
    body = (
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit('{"Tags": '), F.when(F.col("p_size") % 4 == 0, "[]").otherwise(arr(F.col("p_type"))), F.lit("}")))
        .when(F.col("p_partkey") % 3 == 1, F.concat(F.lit('{"Information": "'), F.when(F.col("p_size") % 4 == 0, "").otherwise(F.col("p_type")), F.lit('"}')))
        .otherwise(F.concat(F.lit('{"av pair": [["type", "'), "p_type", F.lit('"], ["size", "'), F.col("p_size").cast("string"), F.lit('"]]}')))
    )
    return t.part.select("p_partkey", F.concat(F.lit('{"'), key, F.lit('": '), body, F.lit("}")).alias("line"))


_MERGED = """f as (select p_name || ' ' || p_brand as entity, p_partkey as seq, case when p_partkey % 3 = 0 and p_size % 4 <> 0 then p_type end as tags,
      case when p_partkey % 3 = 1 and p_size % 4 <> 0 then p_type end as information,
      case when p_partkey % 3 = 2 then 'type=' || p_type || ',size=' || cast(p_size as varchar) end as pairs from part),
    m as (select entity, arg_min(tags, seq) filter (tags is not null) as tags, arg_min(information, seq) filter (information is not null) as information,
      arg_min(pairs, seq) filter (pairs is not null) as pairs from f group by 1)"""


def _merged(t):
    return kb.merge_fragments(kb.fragments(_fragment_lines(t), "line", "p_partkey"))


@query("merge_fragments", f"with {_MERGED} select * from m")
def _(t):
    pairs = F.array_join(F.transform("pairs", lambda p: F.array_join(p, "=")), ",")
    return _merged(t).select("entity", F.array_join("tags", ",").alias("tags"), "information", F.when(F.col("pairs").isNotNull(), pairs).alias("pairs"))


@query(
    "fragment_counts",
    f"""with {_MERGED}, c as (select count(tags) as a, count(information) as b, count(pairs) as c from m)
    select 'tags' as kind, a as n from c union all select 'information', b from c union all select 'pairs', c from c union all select 'count', a + b + c from c""",
)
def _(t):
    return kb.fragment_counts(_merged(t))


@query("tag_map", "select p_name || ' ' || p_brand as entity, case when arg_max(p_size, p_partkey) % 4 = 0 then '' else arg_max(p_type, p_partkey) end as tags from part where p_partkey % 3 = 0 group by 1")
def _(t):
    return kb.tag_map(kb.fragments(_fragment_lines(t), "line", "p_partkey")).select("entity", F.array_join("tags", ",").alias("tags"))


@query(
    "entity_dictionary",
    f"""with e as (select {_STRIP.format('(' + _ENT + ')')} as n from part), x as (select false as cut, n as name from e union all select true, {_bra('n')} from e)
    select distinct cut, name from x where name <> ''""",
)
def _(t):
    e = t.part.select(F.expr(_ENT).alias("n"))
    plain = kb.entity_dictionary(e, "n").select(F.lit(False).alias("cut"), "name")
    return plain.unionByName(kb.entity_dictionary(e, "n", without_brackets=True).select(F.lit(True).alias("cut"), "name"))


def part_pairs(t):
    """Columns of each part as ordered attribute pairs; the part name is the entity."""
    pair = lambda i, a, v: F.struct(F.lit(i).alias("o"), F.lit(a).alias("attribute"), v.alias("value"))
    pairs = F.array(
        pair(0, "brand", F.col("p_brand")), pair(1, V.CHINESE_NAME_ATTRIBUTE, F.col("p_name")), pair(2, V.ALIAS_ATTRIBUTES[0], F.concat("p_type", F.lit("x"))),
        pair(3, "size", F.col("p_size").cast("string")), pair(4, V.ALIAS_LABELS[2], F.col("p_brand")),
    )
    p = t.part.select(F.concat_ws(" ", "p_name", "p_type").alias("entity"), "p_partkey", F.explode(pairs).alias("p"))
    return p.select("entity", (F.col("p_partkey") * 10 + F.col("p.o")).alias("ord"), "p.attribute", "p.value")


@query(
    "eav_rows",
    """with p as (select p_name || ' ' || p_type as entity, p_partkey, 'brand' as attribute, p_brand as value from part union all
      select p_name || ' ' || p_type, p_partkey, 'size', cast(p_size as varchar) from part union all select p_name || ' ' || p_type, p_partkey, '其他名称', p_brand from part)
    select entity, attribute, row_number() over (partition by entity, attribute order by p_partkey) - 1 as pos, value from p""",
)
def _(t):
    return kb.eav_rows(part_pairs(t))


@query(
    "alias_map",
    """with p as (select p_name || ' ' || p_type as entity, p_partkey * 10 + 2 as o, p_type || 'x' as alias from part union all
      select p_name || ' ' || p_type, p_partkey * 10 + 4, p_brand from part)
    select entity, row_number() over (partition by entity order by o) - 1 as pos, alias from p""",
)
def _(t):
    return kb.alias_map(part_pairs(t))


@query(
    "attribute_mapping",
    "select a as attribute, case a when 'brand' then 'maker' else a end as attribute_name, (select count(*) from part) as n from (select unnest(['brand', '中文名', '别名', 'size', '其他名称']) as a)",
)
def _(t):
    known = part_pairs(t).where(F.length("attribute") == 5).select("attribute").distinct()
    mapping = known.select(F.col("attribute").alias("raw"), F.lit("maker").alias("mapped"))
    rows = kb.attribute_mapping(part_pairs(t), mapping)
    return rows.groupBy("attribute", "attribute_name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "definition_rows",
    """select doc_id, case when s = t then t else s || '##' || t end as short, array_to_string(list_filter(string_split(replace(t, '. ', '|||'), '|||'), lambda x: x <> ''), '##') as multi
    from (select doc_id, t, case when instr(t, '.') > 1 then substr(t, 1, instr(t, '.')) else t end as s from
      (select doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') as t from documents))""",
)
def _(t):
    multi = F.replace(F.regexp_replace("text", r"^\s+|\s+$", ""), F.lit(". "), F.lit(V.DEFINITION_BREAK))
    return t.documents.select(
        "doc_id", F.array_join(kb.definition_values(F.col("text"), stop="."), "##").alias("short"),
        F.array_join(kb.definition_values(multi, multi=True), "##").alias("multi"),
    )


def _values(t):
    return t.part.select(
        F.concat(F.when(F.col("p_partkey") % 2 == 0, F.concat("p_name", F.lit("("), "p_brand", F.lit(")"))).otherwise(F.col("p_name")), F.col("p_partkey").cast("string")).alias("entity"),
        F.lit("kind").alias("attribute"), F.lit("kind").alias("attribute_name"), F.explode(F.array(F.lit(0), F.lit(1))).alias("pos"), "p_type", "p_brand", "p_size",
    ).select("entity", "attribute", "attribute_name", "pos", F.when(F.col("pos") == 0, F.col("p_type")).otherwise("second").alias("value"),
             F.col("p_brand").alias("category"), F.col("p_size").alias("searchscore"))


_VALUES = "e as (select case when p_partkey % 2 = 0 then p_name || '(' || p_brand || ')' else p_name end || cast(p_partkey as varchar) as entity, p_type, p_brand, p_size from part)"


@query(
    "eav_document",
    rf"""with {_VALUES} select sha1(entity || '__kind') as id, entity, {_bra('entity')} as entity_name, 'kind' as attribute, 'kind' as attribute_name, p_type as value,
    'attribute' as kind, p_brand as category, p_size as searchscore from e""",
)
def _(t):
    return kb.eav_document(_values(t), "attribute")


@query(
    "document_tags",
    rf"""with {_VALUES}, x as (select *, sha1(entity || '__kind') as id, {_bra('entity')} as nm from e)
    select distinct id, unnest([entity, lower(entity), upper(entity), 'attribute', p_type || 'x'] || case when regexp_matches(entity, '{V.BRACKETED_NAME}') then [lower(nm), upper(nm)] else [] end) as tag from x""",
)
def _(t):
    aliases = _values(t).where("pos = 0").select("entity", F.concat("value", F.lit("x")).alias("alias"))
    return kb.document_tags(kb.eav_document(_values(t), "attribute"), aliases)


@query(
    "merge_aliases",
    """with e as (select distinct case when p_size % 5 = 0 then '山' || p_type || '山脉' else p_name end as entity from part),
    a as (select p_name as entity, unnest(string_split('长' || ',' || '黄河' || ',' || p_brand || ',大' || case when p_size % 2 = 0 then '海' else '江' end, ',')) as a from part
      union all select '山' || p_type || '山脉', '东' || case when p_size % 3 = 0 then '岳' else '山' end from part union all
      select entity, left(entity, length(entity) - 1) from e where ends_with(entity, '山脉')),
    k as (select distinct entity, a from a where entity in (select entity from e) and length(a) > 1 and (regexp_matches(a, '^[\\x{4E00}-\\x{9FFF}]+$')))
    select entity, a as alias from k""",
)
def _(t):
    e = t.part.select(F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("山"), "p_type", F.lit("山脉"))).otherwise(F.col("p_name")).alias("entity")).distinct()
    one = t.part.select(F.col("p_name").alias("entity"), F.concat(F.lit("长,黄河,"), "p_brand", F.lit(",大"), F.when(F.col("p_size") % 2 == 0, "海").otherwise("江")).alias("aliases"))
    two = t.part.select(F.concat(F.lit("山"), "p_type", F.lit("山脉")).alias("entity"), F.concat(F.lit("东"), F.when(F.col("p_size") % 3 == 0, "岳").otherwise("山")).alias("aliases"))
    return kb.merge_aliases([one, two], e)


@query(
    "kb_pipeline",
    """with p as (select p_name || ' ' || p_type as entity, p_partkey, unnest(['brand', 'size', '其他名称']) as attribute, unnest([p_brand, cast(p_size as varchar), p_brand]) as value from part),
    d as (select entity, attribute, arg_min(value, p_partkey) as value, count(*) as n_values from p group by all),
    g as (select p_name || ' ' || p_type as entity, 'T ' || p_brand as tag, row_number() over (partition by p_name || ' ' || p_type order by p_partkey desc) as i from part),
    a as (select p_name || ' ' || p_type as entity, p_type || 'x' as tag from part union all select p_name || ' ' || p_type, p_brand from part),
    w as (select entity, attribute, unnest([entity, lower(entity), upper(entity), 'attribute']) as tag from d union all select entity, attribute, tag from d join a using (entity)),
    c as (select entity, attribute, count(distinct tag) as n_tags, min(tag) as first_tag from w group by all)
    select sha1(d.entity || '__' || attribute) as id, d.entity, attribute, value, n_values, n_tags, first_tag, g.tag as category, cast(length(d.entity) as int) as searchscore
    from d join c using (entity, attribute) join g on g.entity = d.entity and g.i = 1""",
)
def _(t):
    """Pairs of all attributes to values, with rank, category and aliases; served documents and their tags."""
    from webloom.operators.joins import attach_rank

    pairs = part_pairs(t)
    values = kb.eav_rows(pairs)
    ranks = t.part.select(F.concat_ws(" ", "p_name", "p_type").alias("word"), F.col("p_partkey").alias("seq")).withColumn("total", F.length("word"))
    tagged = t.part.select(F.concat_ws(" ", "p_name", "p_type").alias("entity"), F.col("p_partkey").alias("seq"), F.concat(F.lit("T "), "p_brand").alias("tags"))
    category = kb.tag_map(tagged).withColumnRenamed("tags", "category")
    ranked = attach_rank(values, ranks, "entity").withColumn("attribute_name", F.col("attribute")).join(category, "entity", "left")
    docs = kb.eav_document(ranked, "attribute")
    tags = kb.document_tags(docs, kb.alias_map(pairs)).groupBy("id").agg(F.count(F.lit(1)).alias("n_tags"), F.min("tag").alias("first_tag"))
    counts = values.groupBy("entity", "attribute").agg(F.count(F.lit(1)).alias("n_values"))
    return docs.join(tags, "id").join(counts, ["entity", "attribute"]).select(
        "id", "entity", "attribute", "value", "n_values", "n_tags", "first_tag", "category", "searchscore"
    )
