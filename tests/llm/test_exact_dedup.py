from collections import defaultdict
from hashlib import sha256

import pytest
from webloom.llm.exact_dedup import drop_copies, exact_dedup

from .helpers import ODD, documents


def brute(rows, keep):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    low = [(-1 if i is None else i) for i in ()]
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        order = sorted(ids, key=lambda x: (x is not None, x or 0))
        best = order[-1] if keep == "largest" else order[0]
        out.append((i, best, len(ids), sha256((t or "").encode()).hexdigest()))
    return sorted(out + low, key=str)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_groups(spark, keep):
    rows = ODD + [(i, f"text {i % 7}") for i in range(20, 90)]
    got = exact_dedup(documents(spark, rows).repartition(13), keep=keep).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute(rows, keep)
    per_text = defaultdict(int)
    for r in got:
        per_text[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(per_text.values()) == {1}  # one row, also of rows repeated whole


def test_rounds_of_many_runs(spark):
    rows = [(i, f"text {i % 50}") for i in range(600)]
    got = exact_dedup(documents(spark, rows).repartition(70), keep="largest").where("kept").collect()
    assert sorted(r.doc_id for r in got) == list(range(550, 600))
    assert {r.group_size for r in got} == {12}


def test_rows_that_stay(spark):
    docs = documents(spark, ODD)
    got = drop_copies(docs)
    assert got.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted(
        [(2, ""), (3, " \n\t"), (4, "a"), (None, "a null id"), (5, "é" * 3000), (7, "same text here")], key=str
    )


def test_empty(spark):
    assert exact_dedup(documents(spark, [])).count() == 0
    assert drop_copies(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        exact_dedup(documents(spark, []), keep="first")
