import numpy as np
from pyspark.sql import functions as F
from webloom.llm import language
from webloom.llm.common import held_out

from .helpers import ODD, documents, load


def test_held_out_accuracy(spark):
    docs = load(spark, "documents")
    model = language.fit(docs.where(~held_out(F.col("doc_id"))))
    got = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held_out(F.col("doc_id"))).toPandas()
    assert (got.lang == got.lang_pred).mean() >= 0.95
    assert got.score.between(0, 1).all()


def test_tables_give_what_the_filters_give():
    rng = np.random.default_rng(5)
    windows = rng.integers(0, 128, (70, 256)).astype(np.uint8)
    net = language.train(windows, np.arange(70) % 2, ["x", "y"], epochs=1)
    got = net.probabilities(windows, net.tables())
    x = net.embedding[windows.astype(int)]
    pooled = []
    for w, f in net.filters.items():
        r = np.stack([x[:, i : i + w].reshape(len(x), -1) @ f + net.bias[w] for i in range(256 - w + 1)], axis=1)
        pooled.append(np.maximum(r.max(axis=1), 0))
    want = language.softmax(np.concatenate(pooled, axis=1) @ net.dense + net.dense_bias)
    assert np.allclose(got, want, atol=1e-4)


def test_windows_cover_every_byte():
    net = language.train(np.zeros((2, 256), dtype=np.uint8), np.array([0, 1]), ["x", "y"], epochs=0)
    for n in (0, 1, 4, 255, 256, 257, 5000):
        cut = net.windows(bytes(range(97, 122)) * 200)[0:0] if n == 0 else net.windows((b"abcdefghij" * 500)[:n])
        if n:
            seen = np.zeros(n + 256, dtype=bool)
            for k in range(len(cut)):
                seen[k * net.stride : k * net.stride + 256] = True
            assert seen[:n].all() and (len(cut) - 1) * net.stride < max(n, 1)


def test_edges(spark):
    rows = [(i, t * 3, lang) for i, (t, lang) in enumerate([("der die das und ", "de"), ("the and of to ", "en")] * 10)]
    model = language.fit(documents(spark, rows))
    got = language.identify(documents(spark, ODD + [(8, "123 !?")]), model).collect()
    assert len(got) == len(ODD) + 1
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {1, 2, 3, 8}
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    assert {r.lang_pred for r in got} <= {"und", "de", "en"}
    assert language.identify(documents(spark, []), model).count() == 0
    assert language.fit(documents(spark, ODD)) is None  # no label
    assert {r.lang_pred for r in language.identify(documents(spark, ODD), None).collect()} == {"und"}
