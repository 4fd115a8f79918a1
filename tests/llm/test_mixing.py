from collections import Counter, defaultdict

import pytest
from webloom.llm.mixing import mix, mixed_documents

from .helpers import ODD, documents, load


def test_targets_and_budget(spark):
    got = mix(load(spark, "documents")).toPandas()
    total = got["size"].sum()
    assert got.taken.sum() <= total < got.taken.sum() + got["size"].max()
    assert (got.taken <= 3 * got["size"]).all()
    by = got.assign(s=list(zip(got.source_size, got.target))).groupby("s").agg(taken=("taken", "sum"), most=("size", "max"))
    for (size, target), r in by.iterrows():
        assert target <= 3 * size + 1e-6
        assert abs(r.taken - target) <= r.most + 1


def test_targets_are_shared_again(spark):
    # the small source cannot fill its five parts of eight
    rows = [(i, "w " * 10, "en", "a") for i in range(2)] + [(i, "w " * 10, "en", "b") for i in range(10, 40)] + [(i, "w " * 10, "en", None) for i in range(50, 80)]
    got = mix(documents(spark, rows)).toPandas()
    targets = dict(zip(got.source_size, got.target))
    assert targets[20] == 60
    left = 620 - 60
    assert sorted(got.target.unique()) == pytest.approx(sorted([60, left / 3, left * 2 / 3]))


def test_edges(spark):
    docs = documents(spark, ODD)
    got = mix(docs)
    assert got.count() == len(ODD)
    assert got.where("size = 0 and taken > 0").count() == 0
    assert sorted(map(str, got.collect())) == sorted(map(str, mix(docs.repartition(3)).collect()))  # reruns agree
    assert mix(documents(spark, [])).count() == 0
    assert mix(documents(spark, [(1, None), (2, "")])).agg({"taken": "sum"}).first()[0] == 0


def test_rows_as_often_as_taken(spark):
    rows = [(i, f"w{i} " * 10, "en", "abc"[i % 3]) for i in range(30)] + [(99, "lonely word", "en", "d")]
    docs = documents(spark, rows)
    times = Counter()
    for r in mix(docs).collect():
        times[r.doc_id] += r.times
    got = mixed_documents(docs)
    assert got.columns == docs.columns
    assert Counter(r.doc_id for r in got.collect()) == Counter({k: v for k, v in times.items() if v})
    assert max(times.values()) <= 3


def test_order_of_one_source_is_whole_turns(spark):
    got = mix(documents(spark, [(i, "w " * (1 + i % 5), "en", "s") for i in range(50)])).toPandas()
    assert set(got.times) == {1}  # one source gets exactly its own words
    assert defaultdict(int, got.groupby("source_size").taken.sum().to_dict()) == {int(got["size"].sum()): got["size"].sum()}


def test_repeated_rows_come_as_often_as_the_mix_says(spark):
    other = [(100 + i, f"w{i} " * 10, "en", "abc"[i % 3]) for i in range(40)]
    for repeats in (1, 2, 5, 7):
        rows = [(5, "one text again and again", "en", "b")] * repeats + [(5, "one text again and again", "en", "c"), (None, "no id", "en", None), (None, "no id", "en", None)] + other
        docs = documents(spark, rows).repartition(3)
        want = Counter()
        for r in mix(docs).collect():
            want[(r.doc_id, r.source, r.text_hash)] += r.times
        got = Counter((r.doc_id, r.source, r.h) for r in mixed_documents(docs).selectExpr("*", "xxhash64(text) as h").collect())
        assert got == Counter({k: v for k, v in want.items() if v})
    only = documents(spark, [(1, "a b c", "en", "s")] * 7)
    assert mixed_documents(only).count() == sum(r.times for r in mix(only).collect()) == 7
