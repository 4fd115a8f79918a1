"""Each stage on its own input, and the whole run, against what the operators say of the same rows."""

from collections import Counter

import corpus_pipeline
import pytest
from webloom.llm import mixing, near_dedup, toxicity
from webloom.llm.common import held_out
from webloom.session import cut_lineage

from .helpers import SF, documents, load
from .test_near_dedup import brute_groups


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = load(spark, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        left = cut_lineage(stage(spark, docs, SF), "stage")
        out.append((docs, left))
        docs = left
    return out


def test_shape(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "mixing", "packing"]
    assert all(a.columns == b.columns for a, b in stages[:-1])


def test_toxic_rows_go(spark, stages):
    before, after = stages[0]
    labels = load(spark, "labels")
    model = toxicity.fit(before, labels.where(~held_out(labels["doc_id"])))
    want = {r.doc_id for r in before.collect() if model.score(toxicity.Grammar(model.weights).features(r.text or "")) < 0.7}
    assert {r.doc_id for r in after.collect()} == want and 0 < len(want) < before.count()


def test_one_of_each_text_stays(stages):
    before, after = stages[1]
    last = {}
    for r in sorted(before.collect(), key=lambda r: r.doc_id):
        last[r.text] = r.doc_id
    assert sorted(r.doc_id for r in after.collect()) == sorted(last.values())


def test_one_of_each_group_stays(stages):
    before, after = stages[2]
    idf = near_dedup.inverse_frequencies(*near_dedup.document_frequencies(before))
    groups = brute_groups([(r.doc_id, r.text) for r in before.collect()], idf)
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(groups.values()))


def test_mix_repeats_rows(stages):
    before, after = stages[3]
    times = {r.doc_id: r.times for r in mixing.mix(before).collect() if r.times}
    assert Counter(r.doc_id for r in after.collect()) == times


def test_sequences(stages):
    before, after = stages[4]
    got = after.toPandas()
    assert got.groupby("sequence_id").length.sum().max() <= 1024
    assert (got.piece == 0).sum() == before.count()


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert Counter(r.doc_id for r in got.select("doc_id").collect()) == Counter(r.doc_id for r in stages[-1][1].select("doc_id").collect())


def test_empty_documents(spark):
    docs = documents(spark, [], extra=False)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
