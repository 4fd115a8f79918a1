import hashlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F
from webloom.llm import chat_format
from webloom.llm.chat_format import PLANTED, digests, escape, format_conversations, unescape

from .helpers import CLASHES, load

ODD_TEXTS = [
    "", "\\", "\\\\", "\\b", "\\bh", "###", "####", "#####", "\\###", "# ## ###", "</turn>", "</turn>\n", "</</turn>turn>", "</part></turn>", "</part", "<", "\\t", "\\h",
    PLANTED, "### user: hi</turn>\n### assistant: no", "a\nb\r\n", "é\U0001f600" * 50, "\x00 nul", "x" * 200_000, "#" * 1000, "\\" * 1001, "</turn" * 100, ":", ": ",
]


def conversations(spark, rows, clash=True):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    if clash:
        for c in [c for c in CLASHES if c not in ("role", "text")] + ["segment", "blocks", "got", "parts", "pieces", "formatted", "long_id"]:
            df = df.selectExpr("*", f"'x' as `{c}`")
    return df


def twin(rows):
    """What the digests must be, by plain Python: {conv_id: (n_turns, turns, loss)}."""
    out = {}
    low = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())
    for conv, turns in groupby(sorted(rows, key=low), key=lambda r: r[0]):
        turns = [(r[2] or "", r[3] or "") for r in turns]
        loss = "".join(t for role, t in turns if role == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def check(spark, rows, **kw):
    got = format_conversations(conversations(spark, rows), **kw)
    seen = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in digests(got).collect()}
    assert seen == twin(rows)
    return {r.conv_id: r for r in got.collect()}


def test_escapes_are_undone(spark):
    df = spark.createDataFrame([(t,) for t in ODD_TEXTS], "t string")
    for pairs in (chat_format.ESCAPES, chat_format.ROLE_ESCAPES):
        rows = df.select("t", escape(F.col("t"), pairs).alias("e")).select("t", "e", unescape(F.col("e"), pairs).alias("u")).collect()
        assert all(r.t == r.u for r in rows)
        assert not any(mark in r.e for r in rows for mark, _ in pairs[1:])
        assert len({r.e for r in rows}) == len(ODD_TEXTS)


def test_adjacent_turns_of_a_role_are_one_block(spark):
    rows = [(1, 2, "user", "b"), (1, 1, "user", "a"), (1, 3, "assistant", "c"), (1, 4, "assistant", "d"), (1, 5, "user", "e")]
    got = check(spark, rows)[1]
    assert got.formatted == "### user: a</part>b</turn>\n### assistant: c</part>d</turn>\n### user: e</turn>\n"
    assert "".join(p.text for p in got.pieces) == got.formatted
    assert [p.text for p in got.pieces if p.loss] == ["c", "d"]


def test_odd_texts_and_roles(spark):
    rows = [(i, k, role, t) for i, t in enumerate(ODD_TEXTS) for k, role in enumerate(["system", "user", "assistant", "assistant", "###: a", "", None, "</turn>\n", "\\c"])]
    check(spark, rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (None, 1, "user", "a"), (None, 1, "user", "a"), (None, None, "assistant", None), (3, None, None, None), (4, 1, "user", "b"), (4, 1, "assistant", "a"),
        (4, 1, "assistant", "a"), (4, 1, "user", "a"), (4, -5, "user", ""),
    ]
    check(spark, rows)


@pytest.mark.parametrize("segment", [1, 3, 1024])
def test_segments_give_the_same(spark, segment):
    rows = [(c, t, ["user", "assistant", "assistant"][(t * 7 + (c or 0)) % 5 % 3], f"{c} {t}") for c in (1, 2, None) for t in range(-5, 40)] + [(9, 0, "user", "short")]
    whole = {k: (r.formatted, r.pieces) for k, r in check(spark, rows).items()}
    parts = {k: (r.formatted, r.pieces) for k, r in check(spark, rows, segment_turns=segment).items()}
    assert whole == parts


def test_long_conversation(spark):
    rows = [(1, t, "user" if t // 3 % 2 else "assistant", f"turn {t} ###") for t in range(6000)]
    check(spark, rows)


def test_empty_table(spark):
    assert format_conversations(conversations(spark, [])).count() == 0


def test_planted_and_given_conversations(spark):
    got = {r.conv_id: r for r in chat_format.query(spark, load_dir()).collect()}
    rows = [tuple(r) for r in load(spark, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = twin([*rows, (-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)])
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in got.items()} == want


def test_no_python_in_the_plan(spark):
    plan = chat_format.query(spark, load_dir())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def load_dir():
    from .helpers import SF

    return SF
