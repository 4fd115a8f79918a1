"""Column functions applied to whole tables."""

from pyspark.sql import functions as F

from webloom.functions import fixed_values as V
from webloom.functions import ids, text
from webloom.plans.registry import query

# Derived texts: the same expression runs in Spark and in the checking SQL.
CJK_PART = (
    "case p_partkey % 8 when 0 then '你知道' || p_name || '是什么' when 1 then '告诉我为何' || p_name "
    "when 2 then '“' || p_name || '”在那里' when 3 then '跟我说' || p_name || '。价格12.5元/千克' "
    "when 4 then '介绍一下' || p_name || '的历史！！' when 5 then '我国' || p_name || '？' "
    "when 6 then '你可能喜欢' || p_name || '...' else p_name end"
)
NAMES = (
    "case p_partkey % 9 when 0 then p_name || '_(' || p_brand || ')' when 1 then p_name || '（' || p_type || '）' "
    "when 2 then '中国' || '山脉' when 3 then '纺织有限公司' when 4 then '<b>' || p_name || '</b>' "
    "when 5 then '《' || p_name || '》' when 6 then '长江' when 7 then '河' else p_name end"
)


def duck_chain(expr: str, rules) -> str:
    """Nested regexp_replace calls of the checking SQL."""
    for pattern, repl in rules:
        pattern, repl = pattern.replace("'", "''"), repl.replace("$1", r"\1")
        expr = f"regexp_replace({expr}, '{pattern}', '{repl}', 'g')"
    return expr


def duck_strip(expr: str) -> str:
    return rf"regexp_replace({expr}, '^\s+|\s+$', '', 'g')"


@query(
    "extract_zh",
    rf"""select p_partkey, {duck_strip(f"regexp_replace({CJK_PART}, '[^{V.CJK}]', '', 'g')")} as zh,
    {duck_strip(f"regexp_replace({CJK_PART}, '[^a-z ]', '', 'g')")} as latin from part""",
)
def _(t):
    c = F.expr(CJK_PART)
    return t.part.select("p_partkey", text.extract_zh(c).alias("zh"), text.extract_zh(c, "a-z ").alias("latin"))


@query(
    "only_zh_word_space",
    rf"""select doc_id, not regexp_matches(text, '[^{V.CJK}\w\s]') as plain,
    not regexp_matches(text, '[^\p{{L}}.,\w\s]') as latin_plain from documents""",
)
def _(t):
    return t.documents.select(
        "doc_id", text.only_word_space(F.col("text")).alias("plain"),
        text.only_word_space(F.col("text"), r"\p{L}.,").alias("latin_plain"),
    )


def _duck_clean_answers(src: str, marks: str, commas: str, letters: str) -> str:
    return rf"""select doc_id, regexp_replace(case
      when t = src or regexp_matches(t, '[{marks}]') then regexp_replace(t, '([{marks}])[^{marks}]*$', '\1', 'g')
      when regexp_matches(t, '^[{letters}]{{20,1000}}$') then ''
      when length(t) > 80 and not regexp_matches(t, '[a-zA-Z]{{2,100}}') then
        case when instr(substr(t, 81), ' ') > 1 then substr(t, 1, 79 + instr(substr(t, 81), ' ')) else t end
      when length(t) > 120 then regexp_replace(t, '[{commas}][^{commas}]*$', '', 'g')
      else t end, '^\s+|\s+$', '', 'g') as answer
    from (select doc_id, src, regexp_replace(src, '\.{{3,10}}$', '') as t from (select doc_id, {src} as src from documents))"""


@query("clean_answers", _duck_clean_answers("text", V.SENTENCE_MARKS, V.COMMAS, V.CJK))
def _(t):
    return t.documents.select("doc_id", text.clean_answers(F.col("text")).alias("answer"))


_DOTTED = "case doc_id % 3 when 0 then text || '....' when 1 then replace(replace(text, '.', ''), ',', '，') || '...' else text end"


@query("clean_answers_latin", _duck_clean_answers(_DOTTED, ".!?", ",，", "a-zA-Z"))
def _(t):
    return t.documents.select("doc_id", text.clean_answers(F.expr(_DOTTED), ".!?", ",，", "a-zA-Z").alias("answer"))


@query("clean_question", f"select p_partkey, {duck_chain(f'lower({CJK_PART})', V.QUESTION_CLEANUP)} as question from part")
def _(t):
    return t.part.select("p_partkey", text.clean_question(F.expr(CJK_PART)).alias("question"))


@query("rewrite_query", f"select p_partkey, {duck_chain(CJK_PART, V.QUERY_REWRITE)} as question from part")
def _(t):
    return t.part.select("p_partkey", text.rewrite_query(F.expr(CJK_PART)).alias("question"))


@query("answer_filter_word", f"select doc_id, regexp_extract(text, '{V.ANSWER_FILTER}', 0) as word from documents")
def _(t):
    return t.documents.select("doc_id", text.answer_filter_word(F.col("text")).alias("word"))


_FACED = "case conv_id % 3 when 0 then '@bot ' || text || '😀~~' when 1 then '[smile]' || text || '☀！？' else text end"


@query("strip_emoji", f"select conv_id, turn, regexp_replace({_FACED}, '{V.EMOJI}', '', 'g') as body from conversations")
def _(t):
    return t.conversations.select("conv_id", "turn", text.strip_emoji(F.expr(_FACED)).alias("body"))


def duck_chat_question(src: str) -> str:
    inner = duck_chain(f"({src}) || ' '", [(V.EMOJI, ""), (V.MENTION, "")])
    return duck_chain(duck_strip(inner), [(V.QUESTION_TAIL, "")])


@query("clean_chat_question", f"select conv_id, turn, {duck_chat_question(_FACED)} as question from conversations")
def _(t):
    return t.conversations.select("conv_id", "turn", text.clean_chat_question(F.expr(_FACED)).alias("question"))


_LATIN_FOREIGN = r"[^\p{L}，。？！,\d\w\.!?\-\s]"
_RUNS = "case turn % 2 when 0 then replace(text, 'e', 'eeee') || '....' else text end"


@query(
    "clean_chat_answer",
    f"""with a as (select conv_id, turn, {duck_chain(_FACED, [(V.EMOJI, ''), (V.BRACKET_TAG, ''), (V.FACE_MARKS, ''), (V.ANSWER_TAIL, '')])} as t
      from conversations),
    b as (select conv_id, turn, case when regexp_matches(t, '{_LATIN_FOREIGN}') then '' else t end as t from a),
    ch as (select conv_id, turn, unnest(string_split(t, '')) as c, generate_subscripts(string_split(t, ''), 1) as i from b),
    k as (select *, lag(c, 1) over w as p1, lag(c, 2) over w as p2 from ch window w as (partition by conv_id, turn order by i)),
    r as (select conv_id, turn, string_agg(c, '' order by i) as answer from k
      where c = '.' or not coalesce(c = p1 and c = p2, false) group by all)
    select b.conv_id, b.turn, coalesce(answer, '') as answer from b left join r using (conv_id, turn)""",
)
def _(t):
    return t.conversations.select("conv_id", "turn", text.clean_chat_answer(F.expr(_FACED), _LATIN_FOREIGN).alias("answer"))


@query(
    "collapse_repeats",
    f"""with ch as (select conv_id, turn, unnest(string_split({_RUNS}, '')) as c,
      generate_subscripts(string_split({_RUNS}, ''), 1) as i from conversations),
    k as (select *, lag(c, 1) over w as p1, lag(c, 2) over w as p2 from ch window w as (partition by conv_id, turn order by i))
    select conv_id, turn, string_agg(c, '' order by i) as body from k
    where c = '.' or not coalesce(c = p1 and c = p2, false) group by all""",
)
def _(t):
    return t.conversations.select("conv_id", "turn", text.collapse_repeats(F.expr(_RUNS)).alias("body"))


def _duck_screen(src: str, max_length: int) -> str:
    reject = " or ".join("regexp_matches(q, '" + p.replace("'", "''") + "')" for p in V.SCREEN_REJECT)
    out = duck_strip(duck_chain("q", V.SCREEN_CLEAN))
    return rf"""select p_partkey, case when length(q) = 0 or {reject} or length(o) > {max_length} then '' else {duck_strip('o')} end as question
      from (select *, regexp_replace({out}, '.+\s+.+', '，', 'g') as o from (select p_partkey, {duck_strip(src)} as q from part))"""


_SCREENED = (
    "case p_partkey % 6 when 0 then '  为什么天是蓝的  ' when 1 then p_name when 2 then '师傅你好' || p_name "
    "when 3 then '天气 怎么样' when 4 then '[微笑]今天吃什么' else '你好世界' || repeat('很', cast(p_size as int)) end"
)


@query("screen_question", _duck_screen(_SCREENED, 15))
def _(t):
    return t.part.select("p_partkey", text.screen_question(F.expr(_SCREENED)).alias("question"))


@query(
    "first_sentence",
    "select doc_id, case when instr(text, '.') > 1 then substr(text, 1, instr(text, '.')) else text end as summary from documents",
)
def _(t):
    return t.documents.select("doc_id", text.first_sentence(F.col("text"), ".").alias("summary"))


@query(
    "entity_names",
    rf"""select p_partkey, case when regexp_matches(n, '{V.DISAMBIGUATION}') then regexp_extract(n, '{V.DISAMBIGUATION}', 1) else n end as plain,
    case when regexp_matches(n, '{V.BRACKETED_NAME}') then regexp_extract(n, '{V.BRACKETED_NAME}', 1) else n end as unbracketed,
    regexp_replace(n, '{V.LABEL_TAG}', '', 'g') as untagged,
    case when regexp_matches(n, '{V.ENTITY_NAME}') then regexp_extract(n, '{V.ENTITY_NAME}', 1) end as searchable,
    regexp_matches(n, '{V.PURE_CHINESE}') as chinese,
    regexp_matches(n, '{V.PURE_CHINESE}') and length(n) > 1 as long_chinese
    from (select p_partkey, {NAMES} as n from part)""",
)
def _(t):
    n = F.col("n")
    return t.part.select("p_partkey", F.expr(NAMES).alias("n")).select(
        "p_partkey", text.drop_disambiguation(n).alias("plain"), text.drop_brackets(n).alias("unbracketed"),
        text.drop_label_tags(n).alias("untagged"), text.entity_filter(n).alias("searchable"),
        text.is_chinese(n).alias("chinese"), text.is_long_pure(n).alias("long_chinese"),
    )


@query(
    "split_pure_tokens",
    r"""select w, regexp_matches(w, '^[a-z]+$') and length(w) > 1 as pure, count(*) as n
    from (select unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')) as w from documents)
    group by all""",
)
def _(t):
    w = t.documents.select(F.explode(text.words(F.col("text"))).alias("w"))
    return w.groupBy("w").agg(F.count(F.lit(1)).alias("n")).withColumn("pure", text.is_long_pure(F.col("w"), "^[a-z]+$"))


def _duck_suffix(src: str, suffixes, special) -> str:
    arms = " ".join(
        f"when ends_with({src}, '{w}') then left({src}, length({src}) - {len(special[1]) if w == special[0] else len(w)})" for w in suffixes
    )
    return f"case {arms} end"


@query(
    "strip_generic_suffix",
    f"""select p_partkey, {_duck_suffix('n', V.GENERIC_SUFFIXES, V.RANGE_SUFFIX)} as stem,
    {_duck_suffix('p_name', ['widget', 'gear', ' rod', 'ring'], (' rod', 'd'))} as latin_stem
    from (select *, {NAMES} as n from part)""",
)
def _(t):
    return t.part.select(
        "p_partkey", text.strip_generic_suffix(F.expr(NAMES)).alias("stem"),
        text.strip_generic_suffix(F.col("p_name"), ["widget", "gear", " rod", "ring"], (" rod", "d")).alias("latin_stem"),
    )


_QUOTE = "cast(p_size as varchar(9)) || '.5元/' || lower(p_type)"


@query(
    "split_number_unit",
    f"select p_partkey, regexp_replace({_QUOTE}, '[^0-9.]', '', 'g') as price, regexp_replace({_QUOTE}, '[0-9.]', '', 'g') as unit from part",
)
def _(t):
    q = F.expr(_QUOTE)
    return t.part.select("p_partkey", text.number_part(q).alias("price"), text.unit_part(q).alias("unit"))


_LEAD = "case doc_id % 2 when 0 then cast(n_chars as varchar(20)) || ' ' || text else text end"


@query(
    "leading_number",
    f"""select doc_id, split_part(s, ' ', 1) as lead from (select doc_id, {_LEAD} as s from documents)
    where regexp_matches(split_part(s, ' ', 1), '^[0-9]+$')""",
)
def _(t):
    d = t.documents.select("doc_id", text.leading_number(F.expr(_LEAD)).alias("lead"))
    return d.where(F.col("lead").isNotNull())


@query(
    "excel_serial_date",
    "select p_partkey, strftime(date '1900-01-01' + cast(p_size * 800 - 2 as int), '%Y-%m-%d') as day from part",
)
def _(t):
    return t.part.select("p_partkey", ids.excel_serial_date(F.col("p_size") * 800).alias("day"))


@query(
    "epoch_to_month",
    """select strftime(timestamp '1970-01-01' + to_seconds(event_id * 86400), '%Y-%m') as month, count(*) as n
    from events group by all""",
)
def _(t):
    m = t.events.select(ids.epoch_to_month(F.col("event_id") * 86400).alias("month"))
    return m.groupBy("month").agg(F.count(F.lit(1)).alias("n"))


_MONTH = "case o_orderkey % 3 when 0 then substring(cast(o_orderdate as varchar(30)), 1, 7) when 1 then substring(cast(o_orderdate as varchar(30)), 1, 10) else '1999' end"


@query(
    "month_to_date",
    f"""select o_orderkey, length({_MONTH}) = 7 as valid, case when length({_MONTH}) = 7 then ({_MONTH}) || '-01' else {_MONTH} end as day
    from orders""",
)
def _(t):
    m = F.expr(_MONTH)
    return t.orders.select("o_orderkey", ids.valid_month(m).alias("valid"), ids.month_to_date(m).alias("day"))


_RELEASE = (
    "case when o_orderkey % 5 = 0 then '未知' else cast(year(o_orderdate) as varchar(4)) || '年' || cast(month(o_orderdate) as varchar(2)) "
    "|| '月' || cast(day(o_orderdate) as varchar(2)) || '日' end"
)


@query(
    "cn_release_date",
    "select o_orderkey, case when o_orderkey % 5 = 0 then 0 else cast(epoch(date_trunc('day', o_orderdate)) as bigint) end as released from orders",
)
def _(t):
    return t.orders.select("o_orderkey", ids.cn_release_date(F.expr(_RELEASE)).alias("released"))


@query(
    "stable_ids",
    """select p_partkey, sha1(p_name || '_' || p_brand || '_' || p_type) as rid, sha1(p_name || '_' || p_brand) as nid,
    sha1(p_brand || '_' || cast(p_size as varchar)) as tracking, sha1(p_name || '__' || p_type) as eav, md5(p_name) as m from part""",
)
def _(t):
    c = F.col
    return t.part.select(
        "p_partkey", ids.record_id(c("p_name"), c("p_brand"), c("p_type")).alias("rid"),
        ids.entity_id(c("p_name"), c("p_brand")).alias("nid"), ids.tracking_id(c("p_brand"), c("p_size")).alias("tracking"),
        ids.attribute_id(c("p_name"), c("p_type")).alias("eav"), ids.text_md5(c("p_name")).alias("m"),
    )


_MARKET = "case s_suppkey % 2 when 0 then s_name || '市场' else replace(s_name, 'Supplier', '药市') end"


@query(
    "normalise_market",
    f"select s_suppkey, case when ends_with(m, '市场') then m else m || '市场' end as market from (select s_suppkey, replace({_MARKET}, '药市', '市场') as m from supplier)",
)
def _(t):
    return t.supplier.select("s_suppkey", text.normalise_market(F.expr(_MARKET), synonyms=[("药市", "市场")]).alias("market"))


@query(
    "split_spec",
    """select p_partkey, split_part(s, '/', 1) as grade, case when s like '%/%' then split_part(s, '/', 2) end as origin
    from (select p_partkey, case p_partkey % 4 when 0 then p_type else p_type || '/' || p_brand end as s from part)""",
)
def _(t):
    grade, origin = text.split_spec(F.expr("case p_partkey % 4 when 0 then p_type else p_type || '/' || p_brand end"))
    return t.part.select("p_partkey", grade.alias("grade"), origin.alias("origin"))


_ALIASES = (
    "case p_partkey % 3 when 0 then p_name || '（《' || p_brand || '》），' || p_type || '、' || p_brand "
    "when 1 then p_name || '[' || p_type || ']，' || p_brand || '。' else p_name || '(' || p_type || ');' || p_brand end"
)


@query(
    "clean_alias_text",
    f"select p_partkey, array_to_string(string_split({duck_chain(_ALIASES, V.ALIAS_CLEANUP)}, '-'), '|') as aliases from part",
)
def _(t):
    return t.part.select("p_partkey", F.array_join(text.clean_alias_text(F.expr(_ALIASES)), "|").alias("aliases"))


@query(
    "tokens_to_tags",
    """select doc_id, array_to_string(list_filter(regexp_split_to_array(replace(text, ', ', '、'), '[ 、]'), lambda x: x <> ''), '|') as tags
    from documents""",
)
def _(t):
    tags = text.keyword_tags(F.replace(F.col("text"), F.lit(", "), F.lit("、")))
    return t.documents.select("doc_id", F.array_join(tags, "|").alias("tags"))


_TITLE = "p_name || case p_partkey % 3 when 0 then '安国' when 1 then '玉林亳州' else '' end"


@query(
    "title_market_tags",
    f"""select p_partkey, array_to_string(list_filter([{', '.join(f"case when contains(s, '{w}') then '{w}市场' end" for w in V.NEWS_MARKETS)}],
    lambda x: x is not null), '|') as tags from (select p_partkey, {_TITLE} as s from part)""",
)
def _(t):
    return t.part.select("p_partkey", F.array_join(text.title_tags(F.expr(_TITLE)), "|").alias("tags"))


_REGION = (
    "case n_nationkey % 5 when 0 then '广西壮族自治区' when 1 then '河北省' when 2 then '恩施土家族苗族自治州' when 3 then n_name || '市' else n_name || '县' end"
)
_LONG = "(" + "?|".join(p for p in V.PEOPLES if len(p) > 2) + ")"


def _duck_region(level: str) -> str:
    removed, suffix = V.REGION_RULES[level]
    norm = duck_chain(_REGION, [(_LONG, ""), ("(" + "|".join(V.PEOPLES) + ")", ""), (removed, "")])
    return f"""select s_suppkey, n as norm_{level}, case when length(n) > 2 then regexp_replace(n, '{suffix}', '') else n end as compact_{level}
      from (select s_suppkey, {norm} as n from supplier join nation on s_nationkey = n_nationkey)"""


@query(
    "normalise_region",
    "select * from " + " join ".join(
        f"({_duck_region(level)}) {level}" + ("" if level == "province" else " using (s_suppkey)") for level in V.REGION_RULES
    ),
)
def _(t):
    named = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    cols = []
    for level in V.REGION_RULES:
        norm, compact = text.normalise_region(F.expr(_REGION), level)
        cols += [norm.alias(f"norm_{level}"), compact.alias(f"compact_{level}")]
    return named.select("s_suppkey", *cols)


_DESC = "lower(p_name) || case p_partkey % 4 when 0 then '中药材本草' when 1 then '电影' when 2 then '学名' else '' end"


@query(
    "keyword_score",
    f"""select p_partkey, cast({' + '.join(f"case when contains(d, '{k}') then {w} else 0 end" for k, w in V.ENTITY_KEYWORDS.items())} as int) as score,
    cast(case when contains(p_name, 'red') then 3 else 0 end + case when contains(p_name, 'gear') then -2 else 0 end as int) as latin_score
    from (select *, {_DESC} as d from part)""",
)
def _(t):
    return t.part.select(
        "p_partkey", text.keyword_score(F.expr(_DESC), V.ENTITY_KEYWORDS).alias("score"),
        text.keyword_score(F.col("p_name"), {"red": 3, "gear": -2}).alias("latin_score"),
    )


@query(
    "copy_fields",
    """select c_custkey, coalesce(nullif(s_name, ''), c_name) as name_over, coalesce(nullif(c_name, ''), s_name, c_name) as name_fill,
    coalesce(s_acctbal, c_acctbal) as bal_over from
    (select c_custkey, case when c_custkey % 3 = 0 then '' else c_name end as c_name, c_acctbal from customer)
    left join supplier on c_custkey = s_suppkey""",
)
def _(t):
    from webloom.operators.records import copy_fields

    left = t.customer.select(
        "c_custkey", F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_name")).alias("name"), F.col("c_acctbal").alias("bal")
    )
    right = t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"))
    over = copy_fields(left, right, ["c_custkey"], ["name", "bal"], incremental=False)
    fill = copy_fields(left, right, ["c_custkey"], ["name"], incremental=True)
    return over.select("c_custkey", F.col("name").alias("name_over"), F.col("bal").alias("bal_over")).join(
        fill.select("c_custkey", F.col("name").alias("name_fill")), "c_custkey"
    )
