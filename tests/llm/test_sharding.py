from zlib import crc32

import pytest
from webloom.llm import sharding
from webloom.llm.sharding import longest_first, shard_by_size

from .helpers import ODD, documents, load


def check(got, docs, shards):
    assert len(got) == len(docs)
    assert sorted(zip(got.doc_id.fillna(-1), got["size"], got.text_crc32)) == sorted(
        (-1 if i is None else i, len((t or "").encode()) + 16, crc32((t or "").encode())) for i, t in docs
    )
    assert got.shard.between(0, shards - 1).all()
    for _, slots in got.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))


def test_sizes_near_equal(spark):
    docs = load(spark, "documents")
    got = shard_by_size(docs, 5).toPandas()
    check(got, [(r.doc_id, r.text) for r in docs.collect()], 5)
    loads = got.groupby("shard")["size"].sum()
    assert loads.max() - loads.min() <= got["size"].max()
    assert got.merge(docs.toPandas(), on="doc_id").groupby("text").shard.nunique().max() == 1


def test_hierarchy_agrees_in_bounds(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_GROUPS", 20)
    monkeypatch.setattr(sharding, "FAN", 4)
    monkeypatch.setattr(sharding, "HEAVY", 2)
    monkeypatch.setattr(sharding, "SLOT_ROWS", 7)
    rows = [(i, "x" * (i * 37 % 101)) for i in range(700)] + [(1000 + i, "big " * 500) for i in range(3)]
    got = shard_by_size(documents(spark, rows), 4).toPandas()
    check(got, rows, 4)
    loads = got.groupby("shard")["size"].sum()
    assert loads.max() - loads.min() <= 3 * 2016


def test_longest_first_is_the_plain_rule():
    loads = [0, 0, 0]
    assert longest_first([3, 9, 7, 5, 5], loads) == [1, 0, 1, 2, 2]
    assert sorted(loads) == [9, 10, 10]


def test_edges(spark):
    check(shard_by_size(documents(spark, ODD), 3).toPandas(), ODD, 3)
    assert shard_by_size(documents(spark, []), 3).count() == 0


@pytest.mark.parametrize("shards", [1, 40])
def test_one_text_in_all_rows(spark, shards):
    got = shard_by_size(documents(spark, [(i, "same") for i in range(50)]), shards).toPandas()
    assert got.shard.nunique() == 1
