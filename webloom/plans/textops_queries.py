"""Text analytics over the driver tables."""

from pyspark.sql import functions as F

from webloom.functions import fixed_values as V
from webloom.functions.text import words
from webloom.operators import textops, topics
from webloom.plans.functions_queries import CJK_PART, duck_chain
from webloom.plans.registry import query


def duck_words(c="text"):
    return rf"list_filter(regexp_split_to_array(lower({c}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"


@query("tokenize_spaced", f"select doc_id, cast(length({duck_words()}) as int) as n, array_to_string({duck_words()}, ' ') as tokens from documents")
def _(t):
    w = words(F.col("text"))
    return t.documents.select("doc_id", F.size(w).alias("n"), F.array_join(w, " ").alias("tokens"))


TERMS = ["是什么", "告诉我", "为何", "在那里", "价格", "介绍", "一下", "历史", "我国", "可能", "喜欢", "什么"]


def _lexicon(t):
    """One term per part, so that all occur."""
    at = (F.col("p_partkey") % len(TERMS) + 1).cast("int")
    return t.part.select(F.element_at(F.array(*[F.lit(x) for x in TERMS]), at).alias("term")).distinct()


@query(
    "tokenize_lexicon",
    rf"""with recursive p as (select p_partkey, unnest(regexp_extract_all(s, '([A-Za-z0-9]+|[^\sA-Za-z0-9]+)')) as piece,
      generate_subscripts(regexp_extract_all(s, '([A-Za-z0-9]+|[^\sA-Za-z0-9]+)'), 1) as k from (select p_partkey, {CJK_PART} as s from part)),
    l as (select unnest({TERMS}) as term),
    w as (select p_partkey, k, piece, 1 as pos, cast(null as varchar) as tok, 0 as spot from p union all
      select p_partkey, k, piece, pos + n, substr(piece, pos, n), pos from (select *, case when regexp_matches(piece, '^[A-Za-z0-9]') then cast(length(piece) as int)
        else coalesce((select max(cast(length(term) as int)) from l where starts_with(substr(piece, pos), term)), 1) end as n from w where pos <= length(piece)))
    select p_partkey, string_agg(tok, '|' order by k, spot) as tokens from w where tok is not null group by 1""",
)
def _(t):
    rows = t.part.select("p_partkey", F.expr(CJK_PART).alias("s"))
    return textops.tokenize(rows, "p_partkey", "s", _lexicon(t)).select("p_partkey", F.array_join("tokens", "|").alias("tokens"))


_GROUPS = [("alpha", 1, ["red", "hot"]), ("beta", 2, ["gear", "ring", "cold"])]


@query(
    "detect_groups",
    """with g as (select unnest(['red', 'hot', 'gear', 'ring', 'cold']) as word, unnest(['alpha', 'alpha', 'beta', 'beta', 'beta']) as grp, unnest([1, 1, 2, 2, 2]) as rank),
    s as (select p_partkey, case when p_size = 7 then p_name || '啪啪啪' else p_name end as s from part),
    w as (select p_partkey, unnest(list_distinct(string_split(s, ' '))) as word from s where not contains(s, '啪啪啪')),
    h as (select p_partkey, rank, grp, string_agg(word, ',' order by word) as matched from w join g using (word) group by all)
    select p_partkey, grp, matched from h qualify row_number() over (partition by p_partkey order by rank) = 1
    union all select p_partkey, 'skip_phrase', '啪啪啪' from s where contains(s, '啪啪啪')""",
)
def _(t):
    tokens = F.split("p_name", " ")
    rank = F.when(F.col("word").isin("red", "hot"), 1).when(F.col("word").isin("gear", "ring", "cold"), 2)
    groups = t.part.select(F.explode(tokens).alias("word")).distinct().withColumn("rank", rank).where("rank is not null")
    groups = groups.withColumn("grp", F.when(F.col("rank") == 1, "alpha").otherwise("beta"))
    df = t.part.select("p_partkey", F.when(F.col("p_size") == 7, F.concat("p_name", F.lit(V.FIXED_SKIP_PHRASE))).otherwise(F.col("p_name")).alias("s"))
    return textops.detect_groups(df, "p_partkey", "s", groups).withColumn("matched", F.array_join("matched", ","))


@query(
    "detect_user_words",
    f"""with w as (select doc_id, unnest(list_distinct({duck_words()})) as word from documents), u as (select distinct unnest(string_split(p_name, ' ')) as word from part union select 'on' union select 'of')
    select doc_id, 'skip_words_user' as grp, string_agg(word, ',' order by word) as matched from w join u using (word) group by 1""",
)
def _(t):
    user = t.part.select(F.explode(F.concat(F.split("p_name", " "), F.array(F.lit("on"), F.lit("of")))).alias("word")).distinct()
    out = textops.detect_groups(t.documents, "doc_id", "text", user.withColumn("grp", F.lit("x")).withColumn("rank", F.lit(1)), user_words=user)
    return out.withColumn("matched", F.array_join("matched", ","))


def _duck_fact(q, variant):
    allow = " or ".join(f"regexp_matches({q}, '{p}')" for p in V.FACT_ALLOW)
    if variant == "exempt":
        body = f"case when regexp_matches({q}, '{V.FACT_DENY}') then regexp_matches({q}, '{V.FACT_EXEMPT}') else {allow} end"
    elif variant == "rewritten":
        cleaned = duck_chain(f"lower({q})", [*V.QUESTION_CLEANUP, (V.HOMELAND_PHRASES, "")])
        body = f"case when regexp_matches({cleaned}, '{V.FACT_DENY}') then false else {allow} end"
    else:
        body = f"case when regexp_matches({duck_chain(q, [(V.FACT_EXEMPT, '')])}, '{V.FACT_DENY}') then false else {allow} end"
    return f"case when coalesce({q}, '') = '' then false else {body} end"


_Q = f"case when p_size = 9 then null when p_size = 8 then '' else {CJK_PART} end"


@query(
    "is_fact_question_regex",
    "select p_partkey, " + ", ".join(f"{_duck_fact('q', v)} as {v}" for v in ("clean", "rewritten", "exempt")) + f" from (select p_partkey, {_Q} as q from part)",
)
def _(t):
    q = F.expr(_Q)
    return t.part.select("p_partkey", *[textops.is_fact_question_regex(q, v).alias(v) for v in ("clean", "rewritten", "exempt")])


DENY, ALLOW, PRONOUNS = ["they", "hot", "ich"], ["what", "un", "the", "red"], ["it", "cold", "que"]


def duck_fact_tokens(q):
    cleaned = duck_chain(f"lower({q})", [*V.QUESTION_CLEANUP, (V.HOMELAND_PHRASES, ""), (V.KEYWORD_SPACING, r" \1 ")])
    return f"list_distinct({duck_words(cleaned)})"


def duck_is_fact(q, toks):
    lst = lambda items: "[" + ", ".join(f"'{x}'" for x in items) + "]"
    hit = lambda items: f"list_sort(list_intersect({toks}, {lst(items)}))"
    talk = f"regexp_extract({q}, '{V.SMALL_TALK}', 0)"
    cond = lambda pick: f"""case when coalesce({q}, '') = '' then {pick(False, "'[-]问题空'")} when {talk} <> '' then {pick(False, f"'[-]闲聊:' || {talk}")}
      when length({hit(DENY)}) > 0 then {pick(False, f"'[-]黑名单:' || array_to_string({hit(DENY)}, '/')")}
      when length({hit(ALLOW)}) > 0 then {pick(True, f"'[+]白名单:' || array_to_string({hit(ALLOW)}, '/')")}
      when length({toks}) between 1 and 9 and length({hit(PRONOUNS)}) > 0 then {pick(False, f"'[-]词性指代:' || array_to_string({hit(PRONOUNS)}, '/')")}
      when length({toks}) between 1 and 9 then {pick(True, "'[+]词性名词'")} else {pick(False, "'[-]其他'")} end"""
    return cond(lambda fact, note: str(fact).lower()), cond(lambda fact, note: note)


_FACT, _NOTE = duck_is_fact("q", "k")


@query(
    "is_fact_question",
    f"""with s as (select conv_id, turn, text as q from conversations union all select -p_partkey, p_size, {CJK_PART} from part)
    select conv_id, turn, {_FACT} as fact, {_NOTE} as note from (select *, {duck_fact_tokens('q')} as k from s)""",
)
def _(t):
    s = t.conversations.select("conv_id", "turn", F.col("text").alias("q")).unionByName(
        t.part.select((-F.col("p_partkey")).alias("conv_id"), F.col("p_size").cast("bigint").alias("turn"), F.expr(CJK_PART).alias("q"))
    )
    r = textops.is_fact_question(F.col("q"), DENY, ALLOW, PRONOUNS)
    return s.select("conv_id", "turn", r.alias("r")).select("conv_id", "turn", "r.fact", "r.note")


@query(
    "chat_label",
    f"""with c as (select u.conv_id, u.turn, u.text as q, a.text as a from conversations u join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1
      where u.role = 'user' and a.role = 'assistant'), k as (select *, {duck_words("q || a")} as w from c)
    select conv_id, turn, case when conv_id % 5 = 0 then 'human' when length(list_intersect(w, ['reth', 'que'])) > 0 then '知道:' || array_to_string(list_sort(list_intersect(w, ['reth', 'que'])), ',')
    when length(list_intersect(w, ['the', 'und', 'que'])) > 0 then '敏感:' || array_to_string(list_sort(list_intersect(w, ['the', 'und', 'que'])), ',') else '' end as label from k""",
)
def _(t):
    from webloom.plans.qa_queries import qa_pairs

    human = F.when(F.col("conv_id") % 5 == 0, "human").otherwise("")
    label = textops.chat_label(F.col("question"), F.col("answers"), [("知道", ["reth", "que"]), ("敏感", ["the", "und", "que"])], human)
    return qa_pairs(t).where("answers is not null").select("conv_id", "turn", label.alias("label"))



@query(
    "learn_lexicon",
    f"""with w as (select unnest({duck_words('p_name')}) as term, p_partkey from part) select term, count(*) as weight from w
    where term not in (select 'red' union select 'ring') group by 1""",
)
def _(t):
    minus = t.part.where("p_name = 'red ring'").select(F.explode(F.split("p_name", " ")).alias("term")).distinct()
    return textops.learn_lexicon(t.part, "p_name", minus)


@query(
    "keyword_bigrams",
    f"""with d as (select doc_id, list_filter({duck_words()}, lambda x: not regexp_matches(x, '^[0-9]+$')) as w from documents),
    u as (select unnest(w) as name, unnest(range(1, length(w) + 1)) as i, doc_id from d), x as (select name || lead(name) over (partition by doc_id order by i) as name from u),
    a as (select name, count(*) as freq from u group by 1 order by freq desc, name limit 100), b as (select name, count(*) as freq from x where name is not null group by 1 order by freq desc, name limit 100)
    select name, cast(sum(freq) as bigint) as freq from (select * from a union all select * from b) group by 1""",
)
def _(t):
    return textops.keyword_bigrams(t.documents, words(F.col("text")), 100, skip="^[0-9]+$")


@query(
    "mention_entities",
    f"""with w as (select doc_id, unnest(list_distinct({duck_words()})) as name from documents),
    d as (select distinct unnest({duck_words('text')}) as name from benchmark union select lower(r_name) from region)
    select doc_id, name from w where name in (select name from d)""",
)
def _(t):
    d = t.benchmark.select(F.explode(words(F.col("text"))).alias("name")).unionByName(t.region.select(F.lower("r_name").alias("name"))).distinct()
    return textops.mention_entities(t.documents, "doc_id", "text", d)


@query(
    "region_dictionary",
    "select r_name as name from region union select n_name from nation union select 'X' || c_mktsegment from customer union select c_name from customer",
)
def _(t):
    n = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    js = F.to_json(F.create_map("r_name", F.create_map("n_name", F.lit("1"))))
    text = F.concat(F.lit("a (X"), "c_mktsegment", F.lit(") b （"), "c_name", F.lit("）"))
    return textops.region_dictionary(n.select(js.alias("js")), "js", t.customer.select(text.alias("s")), "s")


@query(
    "phrase_vocabulary",
    f"""with d as (select doc_id, {duck_words()} as w from documents), u as (select unnest(w) as a, unnest(range(1, length(w) + 1)) as i, doc_id from d),
    x as (select a, lead(a) over (partition by doc_id order by i) as b from u), n as (select a as term, count(*) as n from u group by 1),
    p as (select a, b, count(*) as n from x where b is not null group by all), v as (select (select count(*) from n) + (select count(*) from p) as v),
    s as (select a || '_' || b as term, p.n, (p.n - 5) * (select v from v) / (na.n * nb.n) as score from p join n na on a = na.term join n nb on b = nb.term where p.n > 5)
    select term, n, round(score, 4) as score from s where score > 10 union all
    select term, n, null from n where length(term) > 1 and term not in (select unnest({duck_words('text')}) from benchmark)""",
)
def _(t):
    stop = t.benchmark.select(F.explode(words(F.col("text"))).alias("term")).distinct()
    out = textops.phrase_vocabulary(t.documents, words(F.col("text")), stop)
    return out.select("term", "n", F.round("score", 4).alias("score"))


@query(
    "phrased_tokens",
    f"""with d as (select doc_id, {duck_words()} as w from documents), u as (select unnest(w) as a, unnest(range(1, length(w) + 1)) as i, doc_id from d),
    y as (select *, lead(a) over (partition by doc_id order by i) as b from u), n as (select a as term, count(*) as n from u group by 1),
    p as (select a, b, count(*) as n from y where b is not null group by all), v as (select (select count(*) from n) + (select count(*) from p) as v),
    s as (select p.a, p.b from p join n na on a = na.term join n nb on b = nb.term where p.n > 5 and (p.n - 5) * (select v from v) / (na.n * nb.n) > 10),
    m as (select y.*, s.a is not null as hit from y left join s on y.a = s.a and y.b = s.b),
    r as (select *, i - sum(case when hit then 1 else 0 end) over (partition by doc_id order by i) as run from m),
    q as (select *, hit and row_number() over (partition by doc_id, hit, run order by i) % 2 = 1 as begins from r),
    k as (select *, lag(begins) over (partition by doc_id order by i) as used from q)
    select doc_id, string_agg(case when begins then a || '_' || b else a end, ' ' order by i) as tokens from k where not coalesce(used, false) group by 1""",
)
def _(t):
    stop = t.benchmark.select(F.explode(words(F.col("text"))).alias("term")).distinct()
    phrases = textops.phrase_vocabulary(t.documents, words(F.col("text")), stop).where("score is not null")
    return textops.phrased_tokens(t.documents, "doc_id", words(F.col("text")), phrases).select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query("topic_terms")
def _(t):
    stop = t.benchmark.select(F.explode(words(F.col("text"))).alias("term")).distinct()
    phrases = textops.phrase_vocabulary(t.documents, words(F.col("text")), stop).where("score is not null")
    texts = textops.phrased_tokens(t.documents, "doc_id", words(F.col("text")), phrases)
    return topics.topic_terms(texts, F.col("tokens"), stop=stop)


@query("train_classifier")
def _(t):
    rows = t.labels.join(t.documents, "doc_id").select("text", F.col("quality").alias("target"))
    terms = ["the", "ing", "que", "und", "los", "http", "@", "license", "key", ".", ",", "er", "tion", "ou", "th"]
    return textops.train_classifier(rows, "text", "target", terms)[2]
