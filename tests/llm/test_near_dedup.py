import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from webloom.llm import near_dedup
from webloom.llm.components import components
from webloom.llm.near_dedup import keep_one, near_groups

from .helpers import ODD, documents, load


def brute_groups(docs, idf, similarity=0.8):
    features = {i: near_dedup.features_of(t, idf) for i, t in docs}
    places, parent = defaultdict(list), {i: i for i in features}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sorted(features):
        common = Counter(j for h in features[i][0].tolist() for j in places[h])
        for h in features[i][0].tolist():
            places[h].append(i)
        for j in common:
            if near_dedup.weighted_jaccard(features[i], features[j]) >= similarity:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in features}


def test_groups_match_brute_force(spark):
    docs = load(spark, "documents")
    idf = near_dedup.inverse_frequencies(*near_dedup.document_frequencies(docs))
    got = {r.doc_id: r.group_id for r in near_groups(docs).collect()}
    assert got == brute_groups([(r.doc_id, r.text) for r in docs.collect()], idf)


@pytest.mark.parametrize("part", [4_096, 12])
def test_large_group_and_parts(spark, monkeypatch, part):
    monkeypatch.setattr(near_dedup, "PART", part)
    rng = random.Random(4)
    base = [f"w{rng.randrange(500)}" for _ in range(300)]
    rows = []
    for i in range(120):
        words = list(base)
        words[rng.randrange(300)] = f"edit{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"x{rng.randrange(10**6)}" for _ in range(80))) for i in range(60)]
    got = near_groups(documents(spark, rows)).collect()
    assert {r.doc_id: r.group_id for r in got} == {i: 0 if i < 1000 else i for i, _ in rows}
    assert {r.group_size for r in got} == {120, 1} and sum(r.kept for r in got) == 61


def family(rng, size, pairs, words=400):
    """Texts about 0.75 alike to each other, and pairs of them that are over 0.8 alike, as (id, text)."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]

    def edited(of, edits, mark):
        at = set(rng.sample(range(words), edits))
        return [f"{mark}{k}" if k in at else w for k, w in enumerate(of)]

    rows = [(i, edited(base, 6, f"e{i}x")) for i in range(size)]
    rows += [(size + k, edited(rows[size - pairs + k][1], 6, f"p{k}x")) for k in range(pairs)]
    return [(i, " ".join(w)) for i, w in rows]


@pytest.mark.parametrize("limits", [{}, {"PART": 12, "BLOCK": 40}, {"BLOCK_BYTES": 30_000}])
def test_pairs_in_a_family_that_is_not_linked(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(near_dedup, name, value)
    rows = family(random.Random(8), 160, 30)
    docs = documents(spark, rows)
    want = brute_groups(rows, near_dedup.inverse_frequencies(*near_dedup.document_frequencies(docs)))
    assert 20 <= len(rows) - len(set(want.values())) <= 60  # the planted pairs, and few others
    assert {r.doc_id: r.group_id for r in near_groups(docs).collect()} == want


@pytest.mark.parametrize("part", [4_096, 4])
def test_strangers_of_a_bucket_are_all_compared(spark, monkeypatch, part):
    monkeypatch.setattr(near_dedup, "PART", part)
    rng = np.random.default_rng(2)
    sketch = rng.integers(0, 256, (60, near_dedup.SAMPLES), dtype=np.uint8)
    sketch[1::2, 24:] = sketch[::2, 24:]  # pairs 2k, 2k + 1 agree in 40 of 64 samples
    signed = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sketch)], "id long, sketch binary")
    shared = signed.selectExpr("id", "1L as key")
    groups = spark.createDataFrame([(0, 0), (1, 0)], "id long, component long")
    # pairs 2k, 2k + 1 are alike for even k only, and all others have nothing in common
    texts = [" ".join(f"t{i // 2 if i // 2 % 2 == 0 else i}w{j}" for j in range(60)) + f" last{i}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    monkeypatch.setattr(near_dedup, "BLOCK", part)
    idf = np.ones(near_dedup.BUCKETS, dtype=np.float32)
    got = near_dedup.open_links(shared, signed, groups, docs, idf, 0.8).collect()
    assert sorted((min(r.a, r.b), max(r.a, r.b)) for r in got) == [(i, i + 1) for i in range(4, 60, 4)]


def test_links_of_a_block_are_fewer_than_its_rows(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(300)) + f" own{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "id long, text string")
    signed = docs.selectExpr("id", f"unhex(repeat('00', {near_dedup.SAMPLES})) as sketch")
    shared = docs.selectExpr("id", "explode(array(1L, 2L)) as key")
    none = spark.createDataFrame([], "id long, component long")
    idf = np.ones(near_dedup.BUCKETS, dtype=np.float32)
    got = near_dedup.open_links(shared, signed, none, docs, idf, 0.8)
    assert got.count() == 2 * 199 and components(got).select("component").distinct().count() == 1


def test_words_as_python_sees_them():
    texts = ["One two\tTHREE four  five six", "", " \n ", "é ß ünï", "x" * 5000, "a b"]
    column = pa.array(texts)
    n = 0
    for _, data, ends in near_dedup._chunks(column):
        words, owner = near_dedup.words_of(data, ends)
        n += len(words)
        assert Counter(owner.tolist()) == {i: len(t.encode().split()) for i, t in enumerate(texts) if t.split()}
    assert n == sum(len(t.encode().split()) for t in texts)
    a, b = (near_dedup.features_of(t, np.ones(near_dedup.BUCKETS, dtype=np.float32)) for t in ("a b c d e f g", "A B C D E F h"))
    assert near_dedup.weighted_jaccard(a, b) == pytest.approx(2 / 4)


def test_samples_estimate_the_similarity():
    rng = np.random.default_rng(0)
    hashes = np.sort(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
    weights = rng.uniform(1, 10, 400).astype(np.float32)
    other = weights.copy()
    other[:150] = 0
    both = [near_dedup.Sampler(s).samples(np.concatenate([hashes, hashes[150:]]), np.array([0, 400]), np.concatenate([weights, other[150:]])) for s in range(12)]
    agreed = np.mean([(x[0] == x[1]).mean() for x in both])
    assert agreed == pytest.approx(other.sum() / weights.sum(), abs=0.06)


def test_edges(spark):
    docs = documents(spark, ODD)
    got = near_groups(docs).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert by[None].group_id is None and by[None].kept
    assert [by[i].group_id for i in (1, 2, 3, 4, 5)] == [1, 2, 3, 4, 5]
    assert by[6].group_id == by[7].group_id == 6 and by[7].group_size == 3 and not by[7].kept
    left = keep_one(docs)
    assert left.columns == docs.columns and left.where("doc_id = 7").count() == 0 and left.count() == len(ODD) - 1
    assert near_groups(documents(spark, [])).count() == 0
    assert keep_one(documents(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(50)] + [(500, 500)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {x: x for link in links for x in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(parent[a], parent[b])
            changed |= parent[a] != m or parent[b] != m
            parent[a] = parent[b] = m
    assert got == parent
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
