"""Building blocks with one key that holds most of the rows."""

import random

from pyspark.sql import functions as F

from webloom import scale


def hot_rows(n=600):
    rng = random.Random(3)
    return [("hot" if rng.random() < 0.7 else f"k{rng.randrange(5)}", i) for i in range(n)]


def test_position_in_group(spark):
    rows = hot_rows() + [(None, 5), (None, 1)]
    df = spark.createDataFrame(rows, "k string, o long")
    got = {(r.k, r.o): r.pos for r in scale.position_in_group(df, ["k"], ["o"], F.expr("o div 50")).collect()}
    want, seen = {}, {}
    for k, o in sorted(rows, key=lambda r: r[1]):
        want[(k, o)] = seen.get(k, 0)
        seen[k] = want[(k, o)] + 1
    assert got == want


def test_global_index_with_equal_sort_keys(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(500)], "s int, i int").repartition(5)
    out = scale.global_index(df, ["s"]).collect()
    assert sorted(r.idx for r in out) == list(range(500))
    by_idx = sorted(out, key=lambda r: r.idx)
    assert [r.s for r in by_idx] == sorted(r.s for r in out)


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None)], "k string, o int, v string")
    assert {tuple(r) for r in scale.first_per_key(df, ["k"], ["o"]).collect()} == {("a", 1, "y"), ("b", 5, None)}
    assert {tuple(r) for r in scale.last_per_key(df, ["k"], ["o"]).collect()} == {("a", 2, "x"), ("b", 5, None)}
