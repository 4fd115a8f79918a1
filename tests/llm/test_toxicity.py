import pytest
from webloom.llm import toxicity
from webloom.llm.toxicity import UNTRAINED, Grammar

from .helpers import ODD, documents


@pytest.fixture(scope="module")
def corpus():
    clean = [(i, f"Report {i} again. You are a reader and so is he.") for i in range(200)]
    toxic = [(1000 + i, f"Report {i} again. You are a {w} and so is he.") for i, w in enumerate(["zorbakk", "zorbilin", "idiot"] * 20)]
    return clean, toxic


def test_marks():
    g = Grammar({"idiot*": 3.0})

    def marks(text):
        return {k for k, v in g.clause(toxicity.WORD.findall(text.lower()))[1].items() if v}

    assert marks("you are an idiot") == {"match", "aimed"}
    assert marks("idiots on the road") == {"match"}
    assert "negated" in marks("you are not an idiot")
    assert "reported" in marks("he said you are an idiot")
    assert {"match", "threat", "aimed"} == marks("i will find you and kill")
    assert marks("calm weather") == set()


@pytest.mark.parametrize("text", [
    "I will kill you", "we will hurt them", "stab him", "we beat all of you", "Ich töte dich", "wir verprügeln euch", "je vais frapper fort, toi", "tue-toi",
    "voy a matar a ellos", "voy a matarte", "te mato",
])
def test_threats_with_the_object_behind(text):
    g = Grammar({"idiot*": 3.0})
    words = toxicity.WORD.findall(text.lower())
    assert g.clause(words) == (1.5, {"match": 1, "threat": 1, "aimed": 1})
    assert any(g.features(text))
    assert toxicity.UNTRAINED.score(g.features(text)) > toxicity.UNTRAINED.score(g.features("calm weather"))


def test_marks_of_a_threat_stay():
    g = Grammar({"idiot*": 3.0})
    assert g.clause("i will never kill you".split())[1] == {"match": 1, "threat": 1, "negated": 1, "aimed": 1}
    assert g.clause("you kill you".split())[0] == 1.5  # aimed once
    assert not any(g.features("kill one two three four five six you"))  # out of reach
    assert not any(g.features("tuer le temps"))


def test_weights_of_paths():
    g = Grammar({"idiot*": 3.0})

    def weight(text):
        return g.clause(text.split())[0]

    assert weight("you idiot") > weight("idiot") > weight("not an idiot") > 0
    assert weight("you idiot") > weight("she said you idiot")
    assert g.features("a threat to kill time") == [0.0] * len(toxicity.FEATURES)  # a threat at nobody


def test_learned_stems_reach_unseen_words(spark, corpus):
    clean, toxic = corpus
    docs = documents(spark, clean + toxic)
    labels = spark.createDataFrame([(i, 0) for i, _ in clean] + [(i, 1) for i, _ in toxic] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert any("zorb".startswith(s.rstrip("*")[:4]) for s in model.weights)
    probe = documents(spark, [(1, "Look, you are a zorbumel."), (2, "Nothing but calm weather."), (3, None), (4, "")])
    got = {r.doc_id: r.score for r in toxicity.score(probe, model).collect()}
    assert got[1] >= 0.7 > 0.3 > got[2] == got[3] == got[4]
    left = toxicity.keep_clean(probe, model)
    assert left.columns == probe.columns and sorted(r.doc_id for r in left.collect()) == [2, 3, 4]


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = documents(spark, ODD)
    assert toxicity.fit(docs, none) is UNTRAINED
    assert toxicity.fit(docs, spark.createDataFrame([(4, 1)], "doc_id long, toxic int")) is UNTRAINED
    got = toxicity.score(docs, UNTRAINED).collect()
    assert len(got) == len(ODD) and all(0 <= r.score < 0.7 for r in got)
    assert toxicity.score(documents(spark, []), UNTRAINED).count() == 0
    assert toxicity.keep_clean(documents(spark, []), UNTRAINED).count() == 0
    long_text = "calm words. " * 30_000 + "You pathetic idiot. " * 40
    assert toxicity.score(documents(spark, [(1, long_text)]), UNTRAINED).first().matched_clauses == 40


def test_every_labelled_row_is_learned_from(spark, monkeypatch):
    import inspect

    assert "sample_rows" not in inspect.signature(toxicity.fit).parameters
    rows = [(i, "the weather was zorblax again" if i % 3 == 0 else f"plain words number {i} about rivers") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    whole = toxicity.fit(docs, labels)
    monkeypatch.setattr(toxicity, "HELD", 0)  # the tasks choose the stems, not the driver
    assert toxicity.fit(docs, labels).weights == whole.weights and any(s.startswith("zor") for s in whole.weights)


def test_a_stem_behind_three_thousand_others_is_learned(spark):
    letters = "bcdfghjklmnpqrst"
    more = " ".join("".join(letters[i >> s & 15] for s in (0, 4, 8)) + "u" * 5 for i in range(700))  # 700 words of 6 stems
    texts = [f"{more} {i}" for i in range(6)] + [f"zorblax {i}" for i in range(4)] + [f"calm weather number {i}" for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 10)) for i in range(30)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert any(s.startswith("zor") for s in model.weights)
    grammar = toxicity.Grammar(model.weights)
    assert model.score(grammar.features("zorblax")) > 0.5 > model.score(grammar.features("calm weather"))


def test_logistic_adds_up_in_the_tasks(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 2))
    y = (x @ [1.0, -2.0] + rng.normal(size=60) > 0).astype(int)
    rows = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y, strict=True)], "f array<double>, toxic int").repartition(5)
    w, b = toxicity.logistic(rows, 2)
    mu = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.allclose(x.T @ (y - mu), w, atol=1e-6) and abs((y - mu).sum() - 1e-3 * b) < 1e-6  # the gradient vanishes
