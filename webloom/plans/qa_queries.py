"""Question/answer jobs: a user turn is a question, the assistant turn after it its answer."""

from pyspark.sql import functions as F

from webloom.functions import fixed_values as V
from webloom.operators import qa
from webloom.operators.textops import similarity_ratio, word_matcher, word_overlap
from webloom.plans.functions_queries import duck_chain, duck_chat_question, duck_strip
from webloom.plans.registry import query
from webloom.plans.textops_queries import ALLOW, DENY, PRONOUNS, duck_fact_tokens, duck_is_fact, duck_words
from webloom.scale import first_per_key

LATIN = r"\p{L}"
LATIN_FOREIGN = r"[^\p{L}，。？！,\d\w\.!?\-\s]"
SENSITIVE = ["que", "und", "ich"]
GROUPS = [("知道", ["reth", "que"]), ("敏感", ["the", "und"])]


def qa_pairs(t):
    """Joined on (conversation, turn), which is unique: a long conversation is no hot key."""
    c = t.conversations
    answers = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answers"))
    questions = c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    return questions.join(answers, ["conv_id", "turn"], "left")


_PAIRS = """p as (select u.conv_id, u.turn, u.text as question, a.text as answers from conversations u left join conversations a
      on a.conv_id = u.conv_id and a.turn = u.turn + 1 and a.role = 'assistant' where u.role = 'user')"""


def candidates(t):
    """Three spellings of every question of a conversation, against its first question."""
    p = qa_pairs(t)
    first = first_per_key(p.select("conv_id", "turn", F.col("question").alias("query")), ["conv_id"], ["turn"]).drop("turn")
    forms = F.array(F.col("question"), F.translate("question", "aei", "eia"), F.lower("question"))
    rows = p.join(first, "conv_id").select("conv_id", "turn", "query", "answers", F.posexplode(forms).alias("form", "question"))
    at = F.col("conv_id") * 1000 + F.col("turn") * 10 + F.col("form")
    source = F.when(at % 7 == 3, V.SKIPPED_SOURCE).when(at % 11 == 5, V.TRUSTED_SOURCE).otherwise("zhidao")
    return rows.select(
        "conv_id", "query", at.alias("result_index"), "question", "answers", source.alias("source"), (F.length("answers") % 20).alias("cnt_like")
    )


_CAND = f"""{_PAIRS}, f as (select conv_id, arg_min(question, turn) as query from p group by 1),
    c as (select p.conv_id, query, p.conv_id * 1000 + turn * 10 + k as result_index, case k when 0 then question when 1 then translate(question, 'aei', 'eia') else lower(question) end as question, answers
      from p join f using (conv_id), (select unnest([0, 1, 2]) as k))"""


@query(
    "qapair_gates",
    rf"""with {_CAND} select result_index, case when answers is null then '[-]无答案' when length(question) > 200 then '[-]问题长度过长:' || cast(length(question) as varchar)
    when length(answers) > 800 then '[-]答案长度过长:' || cast(length(answers) as varchar) when length(answers) < 2 then '[-]答案长度过短:' || cast(length(answers) as varchar)
    when length({duck_strip(r"regexp_replace(answers, '[^\p{L}]', '', 'g')")}) < 2 then '[-]是闲聊' end as debug_note from c""",
)
def _(t):
    return qa.note_qapairs(candidates(t), 800, 200, 0.0, LATIN, GROUPS).select("result_index", "debug_note")


@query("select_qapair")
def _(t):
    out = qa.select_qapair(candidates(t), answer_max=2000, question_max=2000, letters=LATIN, groups=GROUPS)
    return out.select("query", "result_index", "rank", "match_score", "qa_label")


@query("top_n_chat_two_tier")
def _(t):
    return qa.top_n_chat_two_tier(candidates(t), 3).select("query", "result_index", "rank", "tier", "match_score")


@query("top_n_chat")
def _(t):
    return qa.top_n_chat(candidates(t), answer_max=600, question_max=400, letters=LATIN, groups=GROUPS).select(
        "query", "result_index", "rank", "match_score", "label"
    )


@query("best_qapair")
def _(t):
    m = word_matcher(SENSITIVE)
    return qa.best_qapair(candidates(t), m, m).select("query", "result_index", "source", "match_score")


def duck_overlap(a: str, b: str) -> str:
    x, y = f"list_distinct({duck_words(a)})", f"list_distinct({duck_words(b)})"
    return f"(case when length({x}) + length({y}) = 0 then 1.0 else 2.0 * length(list_intersect({x}, {y}))::double / (length({x}) + length({y})) end)"


_LABELLED = "case " + " ".join(
    f"when length(list_intersect({duck_words('question || answers')}, {w!r})) > 0 then '{name}:' || array_to_string(list_sort(list_intersect({duck_words('question || answers')}, {w!r})), ',')"
    for name, w in GROUPS
) + " else '' end"
_LETTERS = r"regexp_replace(answers, '[^\p{L}]', '', 'g')"
_SOURCE = f"case when result_index % 7 = 3 then '{V.SKIPPED_SOURCE}' when result_index % 11 = 5 then '{V.TRUSTED_SOURCE}' else 'zhidao' end"
_SELECTED = rf"""k as (select *, {duck_overlap('query', 'question')} as match_score, {_LABELLED} as qa_label from c
      where answers is not null and length(question) <= 2000 and length(answers) between 2 and 2000 and length({_LETTERS}) >= 2),
    picked as (select *, row_number() over (partition by query order by match_score desc, result_index) as rank from k where match_score >= 0.3 qualify rank <= 3)"""


@query("select_qapair_overlap", f"with {_CAND}, {_SELECTED} select query, result_index, rank, match_score, {duck_overlap('query', 'answers')} as match_score_answers, qa_label from picked")
def _(t):
    out = qa.select_qapair(candidates(t), answer_max=2000, question_max=2000, letters=LATIN, groups=GROUPS, score=word_overlap)
    return out.select("query", "result_index", "rank", "match_score", "match_score_answers", "qa_label")


@query(
    "top_n_chat_two_tier_overlap",
    f"""with {_CAND}, k as (select *, {duck_overlap('query', 'question')} as match_score, case when regexp_matches(answers, '{V.ANSWER_FILTER}') then 1 else 0 end as tier from c where answers is not null)
    select query, result_index, row_number() over (partition by query order by tier, match_score desc, result_index) as rank, tier, match_score from k where match_score >= 0.6 qualify rank <= 3""",
)
def _(t):
    return qa.top_n_chat_two_tier(candidates(t), 3, score=word_overlap).select("query", "result_index", "rank", "tier", "match_score")


@query(
    "top_n_chat_overlap",
    rf"""with {_CAND}, k as (select *, {duck_overlap('query', 'question')} as match_score, {_LABELLED} as label from c
      where answers is not null and length(question) <= 400 and length(answers) <= 600 and length({_LETTERS}) >= 2)
    select query, result_index, row_number() over (partition by query order by match_score desc, result_index) as rank, match_score, label from k where match_score >= 0.4 qualify rank <= 3""",
)
def _(t):
    return qa.top_n_chat(candidates(t), answer_max=600, question_max=400, letters=LATIN, groups=GROUPS, score=word_overlap).select(
        "query", "result_index", "rank", "match_score", "label"
    )


_S = "[" + ", ".join(f"'{w}'" for w in SENSITIVE) + "]"


@query(
    "best_qapair_overlap",
    f"""with recursive {_CAND}, w as (select *, {_SOURCE} as source, length(answers) % 20 as cnt_like from c),
    skipped as (select query, count(*) as n from w where source = '{V.SKIPPED_SOURCE}' group by 1),
    usable as (select * from w where source <> '{V.SKIPPED_SOURCE}' and len(list_intersect({duck_words('question')}, {_S})) = 0 and len(list_intersect({duck_words('answers')}, {_S})) = 0
      and length(answers) >= 2 and not regexp_matches(answers, '{V.ANSWER_FILTER}')),
    sure as (select query, max(result_index) as result_index from usable where source = '{V.TRUSTED_SOURCE}' group by 1),
    clean as (select *, {duck_chain('lower(query)', V.QUESTION_CLEANUP)} as q1, {duck_chain('lower(question)', V.QUESTION_CLEANUP)} as q2 from usable where source <> '{V.TRUSTED_SOURCE}'),
    s as (select *, row_number() over (partition by query order by result_index) as pos from (select *, {duck_overlap('q1', 'q2')} as match_score from clean) where match_score > 0.57),
    st as (select query, cast(0 as bigint) as pos, 0.6::double as best, cast(-1 as bigint) as lk, cast(null as bigint) as won_at from (select distinct query from s)
      union all select query, pos, case when won then greatest(match_score, best) else best end, case when won then cnt_like else lk end, case when won then result_index else won_at end
      from (select s.query, s.pos, s.match_score, s.cnt_like, s.result_index, st.best, st.lk, st.won_at,
        (s.match_score > st.best and s.cnt_like >= st.lk * 0.2) or (s.match_score > st.best * 0.95 and s.cnt_like > st.lk * 1.5 + 2) as won
        from st join s on s.query = st.query and s.pos = st.pos + 1)),
    fin as (select query, arg_max(coalesce(won_at, -1), pos) as result_index from st group by 1)
    select query, result_index, '{V.TRUSTED_SOURCE}' as source, cast(null as double) as match_score from sure
    union all select s.query, s.result_index, s.source, s.match_score from s join fin using (query, result_index) left join skipped k on k.query = s.query
      where coalesce(k.n, 0) < 4 and s.query not in (select query from sure)""",
)
def _(t):
    m = word_matcher(SENSITIVE)
    return qa.best_qapair(candidates(t), m, m, score=word_overlap).select("query", "result_index", "source", "match_score")


_REWRITTEN = duck_chain("text", V.QUERY_REWRITE)
_FACT, _NOTE = duck_is_fact("q", "k")


@query(
    "query_gate",
    f"""with r as (select conv_id, turn, {_REWRITTEN} as r from conversations where role = 'user'),
    s as (select *, list_sort(list_intersect(list_distinct({duck_words('r')}), {_S})) as h, regexp_replace(r, '？$', '') as q from r),
    g as (select *, {duck_fact_tokens('q')} as k from s)
    select conv_id, turn, q as query_clean, r <> '' and length(h) = 0 and {_FACT} as passed,
    case when r = '' then '[-]问题空' when length(h) > 0 then '[-]问题敏感词:' || array_to_string(h, '/') else {_NOTE} end as reason from g""",
)
def _(t):
    users = t.conversations.where("role = 'user'").select("conv_id", "turn", "text")
    out = qa.query_gate(users, "text", word_matcher(SENSITIVE), DENY, ALLOW, PRONOUNS)
    return out.select("conv_id", "turn", "query_clean", "passed", "reason")


def _typed(t):
    """Pairs in order, every fourth one repeated under another source."""
    p = qa_pairs(t).where("answers is not null").withColumn("seq", F.col("conv_id") * 100 + F.col("turn"))
    base = p.select(F.concat(F.lit("s"), (F.col("seq") % 3).cast("string")).alias("source"), "question", "answers", F.when(F.col("seq") % 5 == 0, 0).otherwise(1).alias("type"), "seq")
    again = base.where("length(question) > 150").select(F.lit("s9").alias("source"), "question", F.when(F.col("seq") % 8 == 0, F.col("answers")).otherwise(F.concat("answers", F.lit(" more"))).alias("answers"),
                                             F.lit(1).alias("type"), (F.col("seq") + 10_000_000).alias("seq"))
    return base.unionByName(again)


_ITEMS = f"""{_PAIRS}, b as (select conv_id * 100 + turn as seq, question, answers from p where answers is not null),
    i as (select 's' || cast(seq % 3 as varchar) as source, question, answers, case when seq % 5 = 0 then 0 else 1 end as type, seq from b
      union all select 's9', question, case when seq % 8 = 0 then answers else answers || ' more' end, 1, seq + 10000000 from b where length(question) > 150)"""

_TYPED = f"""{_ITEMS},
    u as (select *, sha1(question || answers) as id from i where type = 1 qualify row_number() over (partition by sha1(question || answers) order by seq) = 1),
    x0 as (select * exclude (answers, question), {duck_chat_question('question')} as question, {duck_chain('answers', [(V.EMOJI, ''), (V.BRACKET_TAG, ''), (V.FACE_MARKS, ''), (V.ANSWER_TAIL, '')])} as a0 from u),
    x as (select *, case when regexp_matches(a0, '{LATIN_FOREIGN}') then '' else a0 end as a1 from x0),
    ch as (select seq, unnest(string_split(a1, '')) as c, generate_subscripts(string_split(a1, ''), 1) as k from x),
    kk as (select *, lag(c, 1) over w as p1, lag(c, 2) over w as p2 from ch window w as (partition by seq order by k)),
    rr as (select seq, string_agg(c, '' order by k) as answers from kk where c = '.' or not coalesce(c = p1 and c = p2, false) group by 1),
    n as (select x.*, coalesce(rr.answers, '') as answers, list_sort(list_intersect(list_distinct({duck_words("coalesce(rr.answers, '')")}), {_S})) as h from x left join rr using (seq)),
    m as (select *, case when length(answers) < 2 then 'empty_answer' when length(h) > 0 then 'sensitive' end as reason from n)"""


@query(
    "curate_qa",
    f"with {_TYPED} select id, source, question, answers from m where reason is null qualify row_number() over (partition by question order by seq desc) = 1",
)
def _(t):
    best, _ = qa.curate_qa(_typed(t), word_matcher(SENSITIVE), foreign=LATIN_FOREIGN)
    return best.select("id", "source", "question", "answers")


@query(
    "curate_qa_counts",
    f"""with {_TYPED}, k as (select *, row_number() over (partition by question order by seq) as rn from m where reason is null)
    select reason, count(*) as n from m where reason is not null group by 1 union all select 'from_' || source, count(*) from k where rn = 1 group by 1
    union all select 'overwrite_' || source, count(*) filter (rn > 1) from k group by source
    union all select 'items', count(*) from i union all select 'drop', count(*) from i where type <> 1 union all select 'dup', (select count(*) from i where type = 1) - (select count(*) from u)""",
)
def _(t):
    return qa.curate_qa(_typed(t), word_matcher(SENSITIVE), foreign=LATIN_FOREIGN)[1]


@query(
    "curate_qa_labelled",
    f"""with {_TYPED} select id, source, case when length(h) > 0 then '敏感词：' || array_to_string(h, ',') else '' end as label from m
    where length(answers) >= 2 qualify row_number() over (partition by question order by seq desc) = 1""",
)
def _(t):
    best, _ = qa.curate_qa(_typed(t), word_matcher(SENSITIVE), drop_sensitive=False, foreign=LATIN_FOREIGN)
    return best.select("id", "source", "label")


@query(
    "rewrite_answers",
    f"""with m as (select p_name as old_answers, p_name || ' v' || cast(p_size as varchar) as answers from part where p_size > 20 and p_name <> 'red ring'
      qualify row_number() over (partition by p_name order by p_partkey desc) = 1),
    j as (select sha1(p_type || p_brand) as id, p_type || p_brand as question, m.answers, p_partkey as seq from part join m on p_name = old_answers)
    select id, question, answers from j where length(list_intersect({duck_words("question || answers")}, ['gear', 'v9'])) = 0
    qualify row_number() over (partition by id order by seq) = 1""",
)
def _(t):
    mapping = t.part.where("p_size > 20").select(
        F.when(F.col("p_name") == "red ring", "  ").otherwise(F.col("p_name")).alias("old_answers"),
        F.concat("p_name", F.lit(" v"), F.col("p_size").cast("string"), F.lit("  ")).alias("answers"), F.col("p_partkey").alias("seq"),
    )
    items = t.part.select(F.concat("p_type", "p_brand").alias("question"), F.col("p_name").alias("old_answers"), F.col("p_partkey").alias("seq"))
    return qa.rewrite_answers(items, mapping, word_matcher(["gear", "v9"]))


_LINES = rf"""l as (select conv_id, turn, unnest(string_split(text, chr(10))) as l, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from conversations),
    z as (select conv_id, turn, cast(pos as int) as pos, {duck_strip("regexp_replace(l, '[^a-z ]', '', 'g')")} as line from l)"""


@query("dialogue_lines", f"with {_LINES} select conv_id, turn, pos, line from z where length(line) > 1")
def _(t):
    keyed = t.conversations.withColumn("k", F.struct("conv_id", "turn"))
    return qa.dialogue_lines(keyed, "k", "text", "a-z ").select("k.conv_id", "k.turn", "pos", "line")


@query("dialogue_line_set", f"with {_LINES} select distinct line from z where length(line) > 1")
def _(t):
    return qa.dialogue_line_set(t.conversations.withColumn("k", F.struct("conv_id", "turn")), "k", "text", "a-z ")


def _merged(t):
    c = _typed(t).withColumn("category", F.when(F.col("seq") % 6 == 1, "human:x").otherwise(""))
    return qa.merge_qa(c, ["s9", "s0", "s1", "s2"], qa_pairs(t).where("length(question) > 400").select("question"), GROUPS)


_MERGED = f"""{_ITEMS}, sk as (select question from p where length(question) > 400),
    g as (select *, case when seq % 6 = 1 then 'human:x' else '' end as category, sha1(question || answers) as id, case source when 's9' then 0 when 's0' then 1 when 's1' then 2 else 3 end as o,
      list_distinct({duck_words("question || answers")}) as w from i where question not in (select question from sk)
      qualify row_number() over (partition by sha1(question || answers) order by case source when 's9' then 0 when 's0' then 1 when 's1' then 2 else 3 end, seq) = 1),
    mm as (select *, case when category <> '' then category """ + " ".join(
    f"when length(list_intersect(w, {words!r})) > 0 then '{name}:' || array_to_string(list_sort(list_intersect(w, {words!r})), ',')" for name, words in GROUPS
) + " else '' end as label from g)"


@query("merge_qa", f"with {_MERGED} select id, source, label from mm")
def _(t):
    return _merged(t).select("id", "source", "label")


@query(
    "merge_qa_counts",
    f"with {_MERGED} select 'from:' || source as what, count(*) as n from mm group by 1 union all select 'label:' || regexp_replace(label, ':.*$', ''), count(*) from mm group by 1",
)
def _(t):
    return qa.merged_counts(_merged(t))


@query("merge_qa_pages", f"with {_MERGED} select id, row_number() over (order by encode(question), id) - 1 as idx, (row_number() over (order by encode(question), id) - 1) // 50 as page from mm")
def _(t):
    return qa.merged_pages(_merged(t), 50).select("id", "idx", "page")


@query("merge_qa_sample", f"with {_MERGED} select id from mm order by md5(id || ':1'), id limit 40")
def _(t):
    return qa.merged_sample(_merged(t).select("id"), 40)


@query("merge_qa_missing", f"with {_MERGED} select distinct question from p where question not in (select question from mm)")
def _(t):
    return qa.missing_questions(qa_pairs(t).select("question"), _merged(t))


def _search(t, score=similarity_ratio):
    c = candidates(t)
    q = c.select("query").distinct().withColumn("has_data", F.length("query") > 30)
    with_items = c.where("length(query) > 60").drop("conv_id")
    skip = qa_pairs(t).where("length(question) > 350 and turn = 0").select(F.col("question").alias("query"))
    return qa.curate_search_results(
        q, with_items, skip, word_matcher(["und"]), GROUPS, answer_max=2000, question_max=2000, letters=LATIN, score=score
    )


_SEARCHED = rf"""{_CAND}, {_SELECTED}, state as (select query, case when not length(query) > 30 then 'no_data' when not length(query) > 60 then 'no_item'
      when query in (select question from p where length(question) > 350 and turn = 0) then 'skip' when len(list_intersect({duck_words('query')}, ['und'])) > 0 then 'sensitive' end as reason
      from (select distinct query from c)),
    mine as (select * from picked where query in (select query from state where reason is null))"""


@query("curate_search_results")
def _(t):
    return _search(t)[0].select("id", "query", "result_index", "qa_label")


@query(
    "curate_search_results_overlap",
    f"""with {_SEARCHED} select id, query, result_index, qa_label from (select sha1(question || answers) as id, * from mine)
    qualify row_number() over (partition by id order by query, result_index) = 1""",
)
def _(t):
    return _search(t, word_overlap)[0].select("id", "query", "result_index", "qa_label")


@query("curate_search_counts")
def _(t):
    return _search(t)[1]


@query(
    "curate_search_counts_overlap",
    f"""with {_SEARCHED} select coalesce(reason, case when query in (select query from mine) then 'yes' else 'no' end) as reason, count(*) as n from state group by 1""",
)
def _(t):
    return _search(t, word_overlap)[1]
