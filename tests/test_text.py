"""Text functions on edge cases: null, empty, ties."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from webloom.functions import fixed_values as V
from webloom.functions import ids, text
from webloom.operators import textops


def values(spark, rows, *cols):
    df = spark.createDataFrame([(r,) for r in rows], "c string")
    return [tuple(r) for r in df.select(*[c.alias(f"x{i}") for i, c in enumerate(cols)]).collect()]


def one(spark, rows, col):
    return [r[0] for r in values(spark, rows, col)]


C = lambda: F.col("c")


def test_clean_answers(spark):
    rows = [None, "", "第一句。第二句", "没有句号...", "甲" * 25 + "....", "word " * 40 + "....", "今天。明天....", ("字母 abc，" * 30) + "尾...."]
    got = one(spark, rows, text.clean_answers(C()))
    assert got[0] is None and got[1] == ""
    assert got[2] == "第一句。"
    assert got[3] == "没有句号"
    assert got[4] == ""
    assert got[5] == ("word " * 40).strip()
    assert got[6] == "今天。"
    assert got[7] == ("字母 abc，" * 30)[:-1].strip()


def test_question_rules(spark):
    assert one(spark, ["你知道为何“天”蓝"], text.clean_question(C())) == ["为什么天蓝"]
    assert one(spark, ["你知道长城在那里", "为啥天蓝"], text.rewrite_query(C())) == ["长城在哪里", "为什么天蓝"]
    assert one(spark, ["好吗？", "好。。", "好"], text.answer_filter_word(C())) == ["？", "。。", ""]


def test_chat_cleanup(spark):
    assert one(spark, ["@bob 你好吗？？～", "嗨😀"], text.clean_chat_question(C())) == ["你好吗", "嗨"]
    assert one(spark, ["[笑]好好好好的。", "日本語の", None, "a...b"], text.clean_chat_answer(C())) == ["好好的", "", "", "a...b"]
    assert one(spark, ["aaab..  ", "啊啊啊啊"], text.collapse_repeats(C())) == ["aab..  ", "啊啊"]


def test_screen_question(spark):
    got = one(spark, ["", "abc!", "观音在哪", "师父好", "天气2度", "今天吃什么", "甲" * 16, "天 地"], text.screen_question(C()))
    assert got == ["", "", "", "", "", "今天吃什么", "", "，"]


def test_names(spark):
    assert one(spark, ["101省道_(浙江)", "长江"], text.drop_disambiguation(C())) == ["101省道", "长江"]
    assert one(spark, ["名（注）", "(只有)", "名"], text.drop_brackets(C())) == ["名", "(只有)", "名"]
    assert one(spark, ["《红楼梦》（小说）", "a_b"], text.entity_filter(C())) == ["红楼梦", None]
    assert one(spark, ["太行山脉", "纺织股份有限公司", "运河市", "无"], text.strip_generic_suffix(C())) == ["太行山", "纺织", "运河", None]


def test_units_and_dates(spark):
    assert values(spark, ["12.5元/千克"], text.number_part(C()), text.unit_part(C())) == [("12.5", "元/千克")]
    assert one(spark, ["12 斤", "x 12", ""], text.leading_number(C())) == ["12", None, None]
    assert one(spark, ["2016年7月1日", "未知", "bad"], ids.cn_release_date(C())) == [1467331200, 0, None]
    assert one(spark, ["42370", None], ids.excel_serial_date(C().cast("int"))) == ["2016-01-01", None]
    assert one(spark, ["http://u:p@Host.com:80/x?y", "bad"], ids.url_domain(C())) == ["Host.com", ""]


def test_alias_text(spark):
    rule = F.array_join(text.clean_alias_text(C()), "|")
    assert one(spark, ["甲（《书》），乙、丙。", "占车[藏名]"], rule) == ["甲|乙|丙", "占车"]


def test_similarity_ratio_matches_difflib(spark):
    pairs = [("abcd", "bcde"), ("", ""), ("天气怎么样", "今天天气"), ("x" * 300, "x" * 299 + "y"), (None, "a")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(textops.similarity_ratio(F.col("a"), F.col("b"))).collect()]
    want = [None if a is None else difflib.SequenceMatcher(None, a, b).ratio() for a, b in pairs]
    assert got == want
    bound = [r[0] for r in df.select(textops.ratio_bound(F.col("a"), F.col("b"))).collect()]
    assert all(g <= b + 1e-12 for g, b in zip(got, bound) if g is not None)
    rng = random.Random(6)
    many = [("".join(rng.choice("abcde\U0001f600\u00e9") for _ in range(rng.randint(0, 30))), "".join(rng.choice("abcdfg\U0001f600") for _ in range(rng.randint(0, 30)))) for _ in range(300)]
    df = spark.createDataFrame(many, "a string, b string")
    bound = [r[0] for r in df.select(textops.ratio_bound(F.col("a"), F.col("b"))).collect()]
    match = [difflib.SequenceMatcher(None, a, b, autojunk=False) for a, b in many]
    assert bound == pytest.approx([m.quick_ratio() for m in match]) and all(m.ratio() <= b + 1e-12 for m, b in zip(match, bound))


def test_tokens_of_every_row(spark):
    lexicon = spark.createDataFrame([(w,) for w in ["是什么", "什么", "天气", "天气预报", "a", "报"]], "term string")
    rows = [(1, "天气预报是什么abc 12天气"), (2, ""), (3, None), (4, "，。天"), (5, "什么什么天气预"), (6, "天气\u3000什么\u00a0a"), (1, "报"), (7, "报"), (7, "报")]
    df = spark.createDataFrame(rows, "k int, s string")
    got = sorted([(r.k, r.tokens) for r in textops.tokenize(df, "k", "s", lexicon).collect()], key=str)
    assert got == sorted([
        (1, ["天气预报", "是什么", "abc", "12", "天气"]), (2, []), (3, None), (4, ["，", "。", "天"]), (5, ["什么", "什么", "天气", "预"]),
        (6, ["天气", "什么", "a"]), (1, ["报"]), (7, ["报"]), (7, ["报"]),
    ], key=str)


def longest_match(run, terms):
    out, at, longest = [], 0, max(map(len, terms), default=1)
    while at < len(run):
        n = next((n for n in range(longest, 1, -1) if run[at : at + n] in terms and at + n <= len(run)), 1)
        out.append(run[at : at + n])
        at += n
    return out


@pytest.mark.parametrize("chunk", [1, 2, 5, 256])
def test_tokens_over_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(textops, "CHUNK", chunk)
    rng = random.Random(chunk)
    terms = {"".join(rng.choice("甲乙丙") for _ in range(rng.randint(1, 7))) for _ in range(25)} | {"甲甲", "丁" * 9, "\U00020000丙"}
    runs = ["".join(rng.choice("甲乙丙丁\U00020000") for _ in range(rng.randint(1, 90))) for _ in range(60)] + ["丁" * 40, "甲" * 41]
    df = spark.createDataFrame(list(enumerate(runs)), "k int, s string")
    lexicon = spark.createDataFrame([(t,) for t in sorted(terms)], "term string")
    got = {r.k: r.tokens for r in textops.tokenize(df, "k", "s", lexicon).collect()}
    assert got == {i: longest_match(r, terms) for i, r in enumerate(runs)}


def test_tokens_of_a_long_run(spark):
    rng = random.Random(1)
    run = "".join(rng.choice("甲乙丙丁戊") for _ in range(300_000))
    terms = {"甲乙", "乙丙丁", "丁丁", "戊甲乙丙丁"}
    lexicon = spark.createDataFrame([(t,) for t in terms], "term string")
    got = textops.tokenize(spark.createDataFrame([(1, run), (2, "戊甲乙")], "k int, s string"), "k", "s", lexicon)
    assert {r.k: r.tokens for r in got.collect()} == {1: longest_match(run, terms), 2: ["戊", "甲乙"]}
    empty = textops.tokenize(spark.createDataFrame([(2, "戊甲乙a")], "k int, s string"), "k", "s", lexicon.where("false"))
    assert empty.first().tokens == ["戊", "甲", "乙", "a"]


def test_strip_takes_every_blank(spark):
    df = spark.createDataFrame([("\u3000 标题\u00a0\n",), ("\u2003a b\t",), (None,), ("\u3000",)], "s string")
    from webloom.functions.text import strip

    assert [r[0] for r in df.select(strip(F.col("s"))).collect()] == ["标题", "a b", None, ""]


def test_fact_question(spark):
    rule = textops.is_fact_question(C(), ["they"], ["what"], ["it"])
    got = one(spark, ["", "你会唱歌吗", "they know", "what now", "is it", "plain words", "w " * 3 + "a b c d e f g h i j"], rule)
    assert [g.fact for g in got] == [False, False, False, True, False, True, False]
    regex = textops.is_fact_question_regex(C())
    assert one(spark, [None, "", "你好", "你知道长城多长", "长城历史", "好"], regex) == [False, False, False, True, True, False]
    assert one(spark, ["我国首都是什么"], regex) == [True]
    assert V.FACT_ALLOW[0].startswith("什么")


def test_keyword_bigrams(spark):
    df = spark.createDataFrame([(["a", "b", "a", "b"],), (["ab", "1"],)], "t array<string>")
    got = {r.name: r.freq for r in textops.keyword_bigrams(df, F.col("t"), skip="^[0-9]$").collect()}
    assert got == {"a": 2, "b": 2, "ab": 1 + 2, "ba": 1}


def test_phrased_tokens_of_many_texts(spark, capsys):
    rng = random.Random(5)
    texts = {i: [rng.choice("abcde") for _ in range(rng.randrange(40))] for i in range(60)}
    pairs = {("a", "b"), ("b", "a"), ("c", "c"), ("d", "e")}
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()] + [(None, "a b"), (99, None)], "k int, t string")
    phrases = spark.createDataFrame([(f"{a}_{b}",) for a, b in pairs] * 2, "term string")
    out = textops.phrased_tokens(df, "k", F.filter(F.split("t", " "), lambda x: x != ""), phrases)
    out.explain()
    assert "arrays_zip" not in capsys.readouterr().out  # only places that begin a phrase leave their text
    got = {r.k: r.tokens for r in out.collect()}
    for i, t in texts.items():
        want, at = [], 0
        while at < len(t):
            two = tuple(t[at:at + 2]) in pairs
            want.append("_".join(t[at:at + 2]) if two else t[at])
            at += 1 + two
        assert got[i] == want
    assert got[None] == ["a", "b"] and got[99] is None


def test_adjacent_counts_are_sent_in_parts(spark, capsys, monkeypatch):
    from collections import Counter

    cut = textops.cut_lineage

    def shown(df, label):
        df.explain()
        return cut(df, label)

    monkeypatch.setattr(textops, "cut_lineage", shown)
    monkeypatch.setattr(textops, "COUNTED", 50)  # several times a task
    rng = random.Random(2)
    texts = [[rng.choice(["a", "b", "", "zß", "長", None]) for _ in range(rng.randrange(12))] for _ in range(300)] + [None, [], ["x"]]
    df = spark.createDataFrame([(t,) for t in texts], "t array<string>").repartition(3)
    out = textops.adjacent_counts(df, F.col("t"))
    assert "hashpartitioning(a" not in capsys.readouterr().out  # no row per pair and task is shuffled
    want = Counter((x, y) for t in texts if t for x, y in zip(t, [*t[1:], None], strict=True))
    assert {(r.a, r.b): r.n for r in out.collect()} == want and out.count() == len(want)
    assert textops.adjacent_counts(df.where("false"), F.col("t")).count() == 0


def test_phrased_tokens_move_texts_as_they_are(spark, capsys, monkeypatch):
    monkeypatch.setattr(textops, "PHRASE_BITS", 64)  # most places may begin a phrase then; the join tells
    df = spark.createDataFrame([(i, "a b a b c " + "d " * (i % 5)) for i in range(40)], "k int, t string")
    phrases = spark.createDataFrame([("a_b",), ("d_d",), ("c_c",)], "term string")
    out = textops.phrased_tokens(df, "k", F.filter(F.split("t", " "), lambda x: x != ""), phrases)
    out.explain()
    assert "Window" not in capsys.readouterr().out  # places are found and written before the texts move
    for r in out.collect():
        n = r.k % 5
        assert r.tokens == ["a_b", "a_b", "c"] + ["d_d"] * (n // 2) + ["d"] * (n % 2)
