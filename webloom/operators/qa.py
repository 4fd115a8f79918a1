"""Question/answer selection and curation.

Candidates are rows (query, result_index, question, answers, source, cnt_like, ...).
Gates that need no comparison come first; texts that failed one are not compared.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import fixed_values as V
from webloom.functions import ids
from webloom.functions.text import answer_filter_word, clean_chat_answer, clean_chat_question, extract_zh, rewrite_query
from webloom.operators.stats import label_counts, seeded_order
from webloom.operators.textops import chat_label, is_fact_question, ratio_bound, similarity_ratio
from webloom.operators.urls import missing_items
from webloom.scale import first_per_key, global_index, last_per_key, position_in_group, top_per_group
from webloom.session import cut_lineage

Matcher = Callable[[Column], Column]
Scorer = Callable[..., Column]  # (a, b, when=, cleaned=) -> likeness from 0 to 1


def _near(score: Scorer, a: Column, b: Column, least: float, open_end: bool = False) -> Column:
    """A cheap test that only texts pass which can reach ``least``; lengths bound the block ratio alone."""
    if score is not similarity_ratio:
        return F.lit(True)
    return ratio_bound(a, b) > least if open_end else ratio_bound(a, b) >= least


def is_foreign_answer(answer: Column, letters: str = V.CJK) -> Column:
    """Fewer than two characters of the script."""
    return F.length(extract_zh(answer, letters)) < 2


def _length(c: Column) -> Column:
    return F.length(c).cast("string")


def note_qapairs(
    candidates: DataFrame, answer_max: int = 100, question_max: int = 30, min_ratio: float = 0.3, letters: str = V.CJK,
    groups: Sequence[tuple[str, Sequence[str]]] = (), score: Scorer = similarity_ratio,
) -> DataFrame:
    """Candidates with match_score, qa_label and the reason a row is dropped (``debug_note``, null for a kept row)."""
    q, a = F.col("question"), F.col("answers")
    gate = (
        F.when(a.isNull(), "[-]无答案")
        .when(F.length(q) > question_max, F.concat(F.lit("[-]问题长度过长:"), _length(q)))
        .when(F.length(a) > answer_max, F.concat(F.lit("[-]答案长度过长:"), _length(a)))
        .when(F.length(a) < 2, F.concat(F.lit("[-]答案长度过短:"), _length(a)))
        .when(is_foreign_answer(a, letters), "[-]是闲聊")
    )
    gated = candidates.withColumn("_gate", gate)
    open_row = F.col("_gate").isNull()
    close = open_row & _near(score, F.col("query"), q, min_ratio)
    scored = gated.withColumn("match_score", F.when(open_row, F.coalesce(score(F.col("query"), q, when=close), ratio_bound(F.col("query"), q))))
    low = F.when(F.col("match_score") < min_ratio, F.concat(F.lit("[-]问题匹配度低: "), F.format_number("match_score", 2)))
    label = F.when(open_row, chat_label(q, a, groups))
    return scored.withColumn("qa_label", label).withColumn("debug_note", F.coalesce("_gate", low)).drop("_gate")


def select_qapair(candidates: DataFrame, n: int = 3, score: Scorer = similarity_ratio, **gates) -> DataFrame:
    """The best ``n`` kept candidates of each query by match score, ties in result order, with match_score_answers, which is
    worked out for these alone."""
    kept = note_qapairs(candidates, score=score, **gates).where("debug_note is null").drop("debug_note")
    best = top_per_group(kept, ["query"], [F.desc("match_score"), F.asc("result_index")], n)
    return best.withColumn("match_score_answers", score(F.col("query"), F.col("answers")))


def top_n_chat_two_tier(
    candidates: DataFrame, n: int, min_ratio: float = 0.6, pattern: str = V.ANSWER_FILTER, score: Scorer = similarity_ratio
) -> DataFrame:
    """Candidates at the threshold, those without a filtered word before those with one,
    each by score."""
    close = _near(score, F.col("query"), F.col("question"), min_ratio)
    rows = candidates.where(close & F.col("answers").isNotNull()).withColumn("match_score", score(F.col("query"), F.col("question")))
    rows = rows.where(F.col("match_score") >= min_ratio).withColumn(
        "tier", F.when(answer_filter_word(F.col("answers"), pattern) == "", 0).otherwise(1)
    )
    return top_per_group(rows, ["query"], [F.asc("tier"), F.desc("match_score"), F.asc("result_index")], n)


def top_n_chat(
    candidates: DataFrame, n: int = 3, answer_max: int = 30, question_max: int = 20, min_ratio: float = 0.4, letters: str = V.CJK,
    groups: Sequence[tuple[str, Sequence[str]]] = (), score: Scorer = similarity_ratio,
) -> DataFrame:
    """Short candidates of enough likeness, the best ``n`` per query, with a chat label."""
    q, a = F.col("question"), F.col("answers")
    rows = candidates.where(
        a.isNotNull() & (F.length(a) <= answer_max) & (F.length(q) <= question_max) & ~is_foreign_answer(a, letters)
        & _near(score, F.col("query"), q, min_ratio)
    )
    rows = rows.withColumn("match_score", score(F.col("query"), q)).where(F.col("match_score") >= min_ratio)
    return top_per_group(rows.withColumn("label", chat_label(q, a, groups)), ["query"], [F.desc("match_score"), F.asc("result_index")], n)


# --- the best pair of a query ------------------------------------------------

BEST_START, LIKE_START = 0.6, -1


def _beats(score: Column, like: Column, best: Column, best_like: Column) -> Column:
    return ((score > best) & (like >= best_like * 0.2)) | ((score > best * 0.95) & (like > best_like * 1.5 + 2))


def _winners(rows: DataFrame) -> DataFrame:
    """(query, pos) of the winner among (query, pos, match_score, cnt_like), ``pos`` unique in a query. Each pass finds, for all
    queries at once, the next candidate that beats the standing one; the passes number the changes of
    the leader, not the candidates."""
    state = cut_lineage(
        rows.select("query").distinct().select(
            "query", F.lit(-1).cast("bigint").alias("at"), F.lit(BEST_START).alias("best"), F.lit(LIKE_START).cast("bigint").alias("like"),
            F.lit(True).alias("moved"),
        ),
        "best-state",
    )
    cand = rows.select(F.col("query").alias("_q"), F.col("pos").alias("idx"), "match_score", F.col("cnt_like").cast("bigint").alias("lk"))
    while True:
        live = state.where("moved")
        nxt = (
            cand.join(live, F.col("_q") == F.col("query"))
            .where((F.col("idx") > F.col("at")) & _beats(F.col("match_score"), F.col("lk"), F.col("best"), F.col("like")))
            .groupBy("query").agg(F.min(F.struct("idx", "match_score", "lk")).alias("_n"))
        )
        state = cut_lineage(
            state.join(nxt, "query", "left").select(
                "query", F.coalesce("_n.idx", "at").alias("at"), F.greatest(F.coalesce("_n.match_score", "best"), "best").alias("best"),
                F.coalesce("_n.lk", "like").alias("like"), F.col("_n").isNotNull().alias("moved"),
            ),
            "best-state",
        )
        if state.where("moved").isEmpty():
            return state.where("at >= 0").select("query", F.col("at").alias("pos"))


def best_qapair(
    candidates: DataFrame, sensitive_question: Matcher, sensitive_answer: Matcher, trusted: str = V.TRUSTED_SOURCE,
    skipped: str = V.SKIPPED_SOURCE, pattern: str = V.ANSWER_FILTER, max_skipped: int = 4, score: Scorer = similarity_ratio,
) -> DataFrame:
    """At most one candidate per query, read in result order (equal ones by question, then answer).

    Rows of the skipped source are counted and left out, as are sensitive questions or
    answers, answers shorter than two characters or with a filtered word. The last row of
    the trusted source wins; without one, a row replaces the leader when it is more alike
    and liked enough, or nearly as alike and liked much more. A query with
    ``max_skipped`` skipped rows has no answer except a trusted one.
    """
    q, a = F.col("question"), F.col("answers")
    left_out = candidates.where(F.col("source") == skipped).groupBy("query").agg(F.count(F.lit(1)).alias("_skipped"))
    usable = candidates.where(
        (F.col("source") != skipped) & (F.size(sensitive_question(q)) == 0) & (F.size(sensitive_answer(a)) == 0)
        & (F.length(a) >= 2) & (answer_filter_word(a, pattern) == "")
    )
    is_trusted = F.col("source") == trusted
    # A score at or under 0.95 of the starting best can never win, so it need not be computed.
    near = _near(score, F.col("query"), q, BEST_START * 0.95, open_end=True)
    scored = usable.where(~is_trusted & near).withColumn("match_score", score(F.col("query"), q, cleaned=True))
    scored = cut_lineage(scored.where(F.col("match_score") > BEST_START * 0.95), "best-scored")
    placed = position_in_group(scored, ["query"], ["result_index", "question", "answers"], F.expr("result_index div 100000"))
    scored = cut_lineage(placed, "best-placed")
    winner = _winners(scored).join(left_out, "query", "left").where(F.coalesce("_skipped", F.lit(0)) < max_skipped).drop("_skipped")
    trusted_rows = last_per_key(usable.where(is_trusted), ["query"], ["result_index"])
    other = scored.join(winner, ["query", "pos"], "left_semi").drop("pos").join(trusted_rows.select("query"), "query", "left_anti")
    return trusted_rows.withColumn("match_score", F.lit(None).cast("double")).unionByName(other)


# --- gates and curation ------------------------------------------------------


def query_gate(
    queries: DataFrame, column: str, sensitive: Matcher, deny: Sequence[str], allow: Sequence[str], pronouns: Sequence[str],
    use_pos: bool = True, mark: str = V.TRAILING_QUESTION_MARK,
) -> DataFrame:
    """Add ``query_clean``, ``passed`` and ``reason``: rewritten, not empty, not sensitive,
    trailing question mark removed, and factual."""
    rewritten = rewrite_query(F.col(column))
    hits = sensitive(rewritten)
    fact = is_fact_question(F.regexp_replace(rewritten, mark, ""), deny, allow, pronouns, use_pos)
    rows = queries.withColumn("_r", rewritten).withColumn("_h", hits).withColumn("_f", fact)
    empty = F.coalesce(F.col("_r"), F.lit("")) == ""
    reason = (
        F.when(empty, "[-]问题空").when(F.size("_h") > 0, F.concat(F.lit("[-]问题敏感词:"), F.array_join("_h", "/")))
        .otherwise(F.col("_f.note"))
    )
    passed = ~empty & (F.size("_h") == 0) & F.col("_f.fact")
    return rows.select(
        *queries.columns, F.regexp_replace("_r", mark, "").alias("query_clean"), F.coalesce(passed, F.lit(False)).alias("passed"), reason.alias("reason")
    )


def curate_qa(
    items: DataFrame, sensitive: Matcher, seq: str = "seq", accepted: Sequence[int] = (1,), drop_sensitive: bool = True,
    foreign: str = V.ANSWER_FOREIGN,
) -> tuple[DataFrame, DataFrame]:
    """(curated pairs, counts per reason) of (source, question, answers, type, seq).

    Rejected types are dropped; equal raw pairs count once (the first); answers shorter
    than two characters after cleaning and sensitive answers are dropped (or only
    labelled); of a question's answers the last one wins.
    """
    raw = items.withColumn("id", ids.text_id(F.concat("question", "answers")))
    is_accepted = F.coalesce(F.col("type").isin(*accepted), F.lit(False))
    unique = first_per_key(raw.where(is_accepted), ["id"], [seq])
    clean = (
        unique.withColumn("question", clean_chat_question(F.col("question")))
        .withColumn("answers", clean_chat_answer(F.col("answers"), foreign))
    )
    words = sensitive(F.col("answers"))
    reason = F.when(F.length("answers") < 2, "empty_answer")
    if drop_sensitive:
        reason = reason.when(F.size(words) > 0, "sensitive")
    noted = clean.withColumn("label", F.when(F.size(words) > 0, F.concat(F.lit("敏感词："), F.array_join(words, ","))).otherwise(""))
    noted = cut_lineage(noted.withColumn("_reason", reason), "curated")
    kept = noted.where("_reason is null")
    best = last_per_key(kept.select("id", "source", "question", "answers", "label", seq), ["question"], [seq])
    n = F.count(F.lit(1)).alias("n")
    # From/overwritten counts per source: a question's first row is new, its later rows overwrite.
    firsts = kept.groupBy("question").agg(F.min_by("source", seq).alias("source")).groupBy("source").agg(n)
    per_source = kept.groupBy("source").agg(n)
    overwrites = per_source.join(firsts.select("source", F.col("n").alias("_f")), "source", "left").select(
        F.concat(F.lit("overwrite_"), "source").alias("reason"), (F.col("n") - F.coalesce("_f", F.lit(0))).alias("n")
    )
    tally = items.agg(F.count(F.lit(1)).alias("items"), F.count(F.when(is_accepted, 1)).alias("_a"))
    tally = tally.withColumn("drop", F.col("items") - F.col("_a")).withColumn("dup", F.col("_a") - noted.agg(F.count(F.lit(1))).scalar())
    totals = tally.select(F.explode(F.array(*[F.struct(F.lit(c).alias("reason"), F.col(c).alias("n")) for c in ("items", "drop", "dup")])).alias("r"))
    counts = (
        noted.where("_reason is not null").groupBy(F.col("_reason").alias("reason")).agg(n)
        .unionByName(firsts.select(F.concat(F.lit("from_"), "source").alias("reason"), "n"))
        .unionByName(overwrites).unionByName(totals.select("r.*"))
    )
    return best, counts


def rewrite_answers(items: DataFrame, mapping: DataFrame, sensitive: Matcher, seq: str = "seq") -> DataFrame:
    """(id, question, answers) with old answers replaced by mapped ones: unmapped rows are
    dropped, of a question the first row counts, sensitive pairs are dropped.
    ``mapping``: old_answers, answers, seq (the last one of an old answer counts)."""
    filled = mapping.where((F.trim("old_answers") != "") & (F.trim("answers") != "")).select(
        F.trim("old_answers").alias("old_answers"), F.trim("answers").alias("answers"), seq
    )
    last = last_per_key(filled, ["old_answers"], [seq]).drop(seq)
    mapped = items.join(last, "old_answers").select(
        ids.text_id(F.col("question")).alias("id"), "question", "answers", seq,
        (F.size(sensitive(F.concat("question", "answers"))) > 0).alias("_bad"),
    )
    # A sensitive row does not take the place of a later clean one.
    return first_per_key(mapped.where("not _bad").drop("_bad"), ["id"], [seq]).drop(seq)


def dialogue_lines(df: DataFrame, key: str, text: str, keep: str = V.CJK) -> DataFrame:
    """(key, pos, line): lines reduced to the script, longer than one character, in order."""
    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "_l"))
    return lines.select(key, "pos", extract_zh(F.col("_l"), keep).alias("line")).where(F.length("line") > 1)


def dialogue_line_set(df: DataFrame, key: str, text: str, keep: str = V.CJK) -> DataFrame:
    return dialogue_lines(df, key, text, keep).select("line").distinct()


def merge_qa(
    rows: DataFrame, sources: Sequence[str], skip: DataFrame, groups: Sequence[tuple[str, Sequence[str]]], seq: str = "seq"
) -> DataFrame:
    """Merged rows (id, source, category, question, answers, label) of (source, category, question,
    answers, seq), read once: skipped questions left out, equal pairs once (first source in the order of ``sources``, then
    order), a human category kept as label. Rows of other sources are left out."""
    place = F.array_position(F.array(*[F.lit(s) for s in sources]), F.col("source"))
    ordered = rows.where(F.col("source").isin(*sources)).select("category", "question", "answers", seq, "source", place.alias("_o"))
    kept = ordered.join(skip.select("question").distinct(), "question", "left_anti")
    kept = kept.withColumn("id", ids.text_id(F.concat("question", "answers")))
    one = first_per_key(kept, ["id"], ["_o", seq]).drop("_o")
    return one.withColumn("label", chat_label(F.col("question"), F.col("answers"), groups, F.col("category")))


def merged_counts(merged: DataFrame) -> DataFrame:
    """Rows per source and per label group."""
    by_label = label_counts(merged, "label").select(F.concat(F.lit("label:"), "label").alias("what"), "n")
    by_source = merged.groupBy("source").agg(F.count(F.lit(1)).alias("n")).select(F.concat(F.lit("from:"), "source").alias("what"), "n")
    return by_source.unionByName(by_label)


def merged_pages(merged: DataFrame, page_size: int = 2000) -> DataFrame:
    """Rows sorted by question with their page."""
    return global_index(merged, ["question", "id"]).withColumn("page", F.floor(F.col("idx") / page_size).cast("bigint"))


def merged_sample(merged: DataFrame, n: int = 1000, seed: int = 1) -> DataFrame:
    return merged.orderBy(seeded_order("id", seed), "id").limit(n)


def missing_questions(todo: DataFrame, merged: DataFrame) -> DataFrame:
    return missing_items(todo, merged.select("question").distinct(), todo.where(F.lit(False)), "question")


def curate_search_results(
    queries: DataFrame, candidates: DataFrame, skip: DataFrame, sensitive: Matcher, groups: Sequence[tuple[str, Sequence[str]]] = (),
    **gates,
) -> tuple[DataFrame, DataFrame]:
    """(selected pairs, queries per reason). ``queries``: query, has_data. A query without
    data, without items, skipped or sensitive is only counted; the others select pairs.
    Equal pairs of different queries count once."""
    items = candidates.groupBy("query").agg(F.count(F.lit(1)).alias("_items"))
    skips = skip.select("query").distinct().withColumn("_skip", F.lit(True))
    state = queries.join(items, "query", "left").join(skips, "query", "left")
    reason = (
        F.when(~F.col("has_data"), "no_data").when(F.coalesce("_items", F.lit(0)) == 0, "no_item").when(F.col("_skip"), "skip")
        .when(F.size(sensitive(F.col("query"))) > 0, "sensitive")
    )
    noted = state.select("query", reason.alias("reason"))
    open_queries = noted.where("reason is null").select("query")
    picked = cut_lineage(
        select_qapair(candidates.join(open_queries, "query", "left_semi"), groups=groups, **gates).withColumn(
            "id", ids.text_id(F.concat("question", "answers"))
        ),
        "picked",
    )
    done = picked.select("query").distinct().withColumn("_yes", F.lit(True))
    counts = noted.join(done, "query", "left").select(
        F.coalesce("reason", F.when(F.col("_yes"), "yes").otherwise("no")).alias("reason")
    ).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    unique = first_per_key(picked, ["id"], ["query", "result_index"])
    return unique, counts
