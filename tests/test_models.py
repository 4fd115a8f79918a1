import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from webloom.functions.text import words
from webloom.operators import textops, topics


def test_classifier_separates_clear_classes(spark):
    rows = [("red apple pie " + str(i), 1) for i in range(30)] + [("cold rain day " + str(i), 0) for i in range(30)]
    df = spark.createDataFrame(rows, "text string, y int")
    model, score, report = textops.train_classifier(df, "text", "y", ["apple", "rain", "day"], iters=3, depth=2)
    assert score == 1.0
    assert {(r.label, r.f1) for r in report.collect()} == {(0.0, 1.0), (1.0, 1.0)}


def numpy_topics(texts, k):
    """(singular values, right vectors, terms) of unit TF-IDF rows by numpy."""
    bags = [Counter(w for w in t.split() if len(w) > 1) for t in texts]
    bags = [b for b in bags if b]
    seen = Counter(w for b in bags for w in b)
    names = sorted(w for w in seen if seen[w] < len(bags))
    a = np.array([[b[w] * math.log(len(bags) / seen[w]) for w in names] for b in bags])
    norm = np.linalg.norm(a, axis=1, keepdims=True)
    a = a / np.where(norm > 0, norm, 1)
    _, values, right = np.linalg.svd(a)
    return values[:k], right[:k], names


def zipf_texts(n, vocabulary, seed):
    rng = np.random.default_rng(seed)
    share = 1 / np.arange(1, vocabulary + 1)
    return [" ".join(f"w{i:03d}" for i in rng.choice(vocabulary, rng.integers(1, 40), p=share / share.sum())) for _ in range(n)]


@pytest.mark.parametrize("split", [100_000, 7])
def test_topics_equal_numpy(spark, monkeypatch, split):
    monkeypatch.setattr(topics, "SPLIT", split)
    texts = zipf_texts(150, 90, 3) + ["", "a b c", "w001"]
    values, right, names = numpy_topics(texts, 4)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = topics.topic_weights(df, words(F.col("text")), 4, 12).collect()
    for k in range(4):
        mine = sorted((r for r in got if r.topic == k), key=lambda r: r["rank"])
        assert mine[0].value == pytest.approx(values[k], rel=1e-9)
        order = sorted(range(len(names)), key=lambda i: (-round(abs(right[k][i]), 6), names[i]))[:12]
        assert [r.term for r in mine] == [names[i] for i in order]
        sign = math.copysign(1, mine[0].weight * right[k][order[0]])
        assert [r.weight * sign for r in mine] == pytest.approx([right[k][i] for i in order], abs=1e-6)
    listed = Counter(r.term for r in got)
    want = sorted(listed.items(), key=lambda x: (-x[1], x[0]))[:9]
    assert [(r.term, r.topics) for r in topics.topic_terms(df, words(F.col("text")), 4, 12, 9).collect()] == want


def test_topics_of_low_rank(spark):
    df = spark.createDataFrame([("apple pie sugar",), ("rain cloud storm",)] * 5, "text string")
    got = topics.topic_weights(df, words(F.col("text")), 5, 3).collect()
    assert {r.topic for r in got} == {0, 1} and {r.term for r in got} == {"apple", "pie", "sugar", "rain", "cloud", "storm"}
    stop = spark.createDataFrame([("rain",)], "term string")
    assert "rain" not in {r.term for r in topics.topic_terms(df, words(F.col("text")), 2, 3, 9, stop).collect()}


@pytest.mark.parametrize("texts", [[], [""], ["same words"], ["same words", "same words"]])
def test_topics_without_weight(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert topics.topic_terms(df, words(F.col("text"))).count() == 0


def test_a_product_ships_no_entries_and_no_vectors_of_texts(spark, capsys):
    rows = [(d, t, 1.0 + (d * t) % 5) for d in range(40) for t in range(15) if (d + t) % 3]
    entries = spark.createDataFrame([(d % 4, d, t, w) for d, t, w in rows], "g long, d long, t long, w double")
    block = spark.createDataFrame([(t, [float(t), 1.0 - t]) for t in range(15)], "t long, v array<double>")
    needed = spark.createDataFrame(sorted({(d % 4, t) for d, t, _ in rows}), "g long, t long")
    out = topics._product(entries, needed, block, 2)
    out.explain()
    assert "hashpartitioning(d" not in capsys.readouterr().out
    a, x = np.zeros((40, 15)), np.array([r.v for r in block.orderBy("t").collect()])
    for d, t, w in rows:
        a[d, t] = w
    got = {r.t: r.v for r in out.collect()}
    assert got.keys() == set(range(15)) and np.allclose([got[t] for t in range(15)], a.T @ (a @ x))


def test_topics_keep_vectors_over_the_texts_only(spark, monkeypatch):
    cut, kept = topics.cut_lineage, []

    def seen(df, label):
        out = cut(df, label)
        if label == "block":
            kept.append(out.agg(F.sum(F.size("v"))).first()[0])
        return out

    monkeypatch.setattr(topics, "cut_lineage", seen)
    rows = [(f"rain wind{i % 3} " + " ".join(f"own{i}x{j}" for j in range(40)),) for i in range(12)]
    assert topics.topic_weights(spark.createDataFrame(rows, "text string").repartition(2), words(F.col("text")), 2, 3).count() == 6
    assert kept and max(kept) <= 12 * (2 + topics.SPARE)  # nothing as long as the vocabulary is written in a pass
