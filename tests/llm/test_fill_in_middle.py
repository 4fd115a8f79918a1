import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from webloom.llm import fill_in_middle as fim
from webloom.llm.fill_in_middle import WaveletMatrix, blocks, fill_in_middle, restored

from .helpers import ODD, documents, load


def twin(doc_id, text):
    """(n, form, prefix, middle, output) by the units of a regular expression."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(docs, rows):
    got = fill_in_middle(docs).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    seen = sorted((str(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got)
    assert seen == sorted((str(i), *twin(i, t), t or "") for i, t in rows)
    return got


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 1000])
def test_wavelet_ranks(size):
    codes = np.random.default_rng(size).integers(0, 8, size).astype(np.uint8)
    matrix = WaveletMatrix(codes, 3)
    at = np.arange(size + 1)
    for code in range(8):
        assert matrix.rank(code, at).tolist() == np.concatenate(([0], np.cumsum(codes == code))).tolist()


def test_blocks_are_bounded():
    sizes = np.array([5, 5, 0, 30, 1, 9, 0])
    assert list(blocks(sizes, 10)) == [(0, 3), (3, 4), (4, 7)]
    assert list(blocks(np.zeros(0, np.int64), 10)) == []


def test_given_documents(spark):
    docs = load(spark, "documents")
    got = check(docs, [(r.doc_id, r.text) for r in docs.collect()])
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_edges(spark):
    check(documents(spark, ODD), ODD)
    assert fill_in_middle(documents(spark, [])).count() == 0


def test_odd_texts(spark):
    texts = [
        "a", " ", "ab", "a1b2", "\n", "\r\n", "\x00a\x00", "é", "éa", "aé", "ſKK", "漢字 kanji", "\U0001f600x\U0001f600", "<", "<<", "<P", "P>", "<S<S", "a<P>b", "<M>", "<S>",
        "x" * 70_000, "<" * 100, "M>" * 50, " " * 65, "é" * 40, "Ab" * 3 + "é" * 200,
    ]
    rows = [(100 * k + i, t) for k in range(12) for i, t in enumerate(texts)]
    check(documents(spark, rows), rows)


def test_a_run_of_letters_ends_with_its_text(spark, monkeypatch):
    rows = [(i, "abc") for i in range(40)] + [(50 + i, "é") for i in range(5)]
    check(documents(spark, rows).coalesce(1), rows)
    starts = np.array([0, 3, 6])
    kinds = fim.character_classes(np.frombuffer(b"abcabc", np.uint8), starts)
    assert kinds.tolist() == [fim.STARTS, fim.WITHIN, fim.WITHIN] * 2


def test_long_text(spark):
    rows = [(7, "Word, wörd. " * 200_000), (8, "short one"), (9, "x " * 2_500_000)]
    check(documents(spark, rows), rows)
