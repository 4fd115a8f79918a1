import math

import numpy as np
import pytest
from webloom.llm import embedding_dedup
from webloom.llm.embedding_dedup import near_vectors, passes_for

from .helpers import CLASHES


def table(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    return df.selectExpr("*", *[f"'x' as `{c}`" for c in [*CLASHES, "vec", "dim", "copies", "turn"]])


def brute(ids, x, threshold=0.9):
    x = x.astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    comp = np.array(ids)
    while True:
        new = np.minimum(comp, [comp[r].min() if r.any() else c for r, c in zip(near, comp)])
        if (new == comp).all():
            return {i: (int(n), int(c), c == i) for i, n, c in zip(ids, near.sum(axis=1), comp)}
        comp = new


def planted(seed, groups, lone, dim=32):
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=(lone, dim))]
    for n, noise in groups:
        out.append(rng.normal(size=dim) + noise * rng.normal(size=(n, dim)))
    return np.concatenate(out).astype(np.float32)


@pytest.mark.parametrize("block, rows", [(512, 20_000), (16, 300)])
def test_matches_brute_force(spark, monkeypatch, block, rows):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "TASK_ROWS", rows)
    x = planted(1, [(2, 0.1), (40, 0.15), (90, 0.1), (5, 0.02)], 400)
    x[7] = x[3]  # copies
    ids = list(range(len(x)))
    got = near_vectors(table(spark, [(i, x[i].tolist(), 0) for i in ids])).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute(ids, x)


@pytest.mark.parametrize("rows", [20_000, 1_500])
def test_pairs_in_a_dense_clump(spark, monkeypatch, rows):
    monkeypatch.setattr(embedding_dedup, "TASK_ROWS", rows)
    rng = np.random.default_rng(5)

    def around(of, cosine):
        noise = rng.normal(size=of.shape)
        noise -= (noise * of).sum(axis=1, keepdims=True) * of
        return cosine * of + math.sqrt(1 - cosine**2) * noise / np.linalg.norm(noise, axis=1, keepdims=True)

    middle = np.eye(64)[:1]
    clump = around(np.repeat(middle, 2_500, axis=0), math.sqrt(0.7))  # 0.7 to each other
    x = np.concatenate([clump, around(clump[:120], 0.92), rng.normal(size=(1_500, 64))]).astype(np.float32)
    got = near_vectors(table(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute(list(range(len(x))), x)


def test_scaled_double_vectors(spark):
    got = near_vectors(table(spark, [(1, [1.0, 2.0], 0), (2, [10.0, 20.0], 0), (3, [-1.0, -2.0], 0), (4, [1.0, 2.0, 3.0], 0)], "double")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True)]


def test_edges(spark):
    odd = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 1), (None, [1.0, 1.0], 1),
           (8, [1.0, 1.0], None), (9, [1.0, 1.0], 2)]
    got = {r.vec_id: r for r in near_vectors(table(spark, odd)).collect()}
    assert len(got) == len(odd)
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (1, 2, 3, 4, 5, 6))
    assert got[None].kept and got[None].component_id is None
    assert (got[8].n_links, got[9].n_links, got[9].component_id, got[9].kept) == (1, 1, 8, False)
    assert near_vectors(table(spark, [])).count() == 0


def test_passes_follow_the_size():
    assert passes_for(0, 0.9) == passes_for(32, 0.9) == 1
    assert passes_for(1_000, 0.9) < passes_for(100_000, 0.9) < passes_for(100_000_000, 0.9)
