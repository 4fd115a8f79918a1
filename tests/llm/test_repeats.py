from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from webloom.llm import repeats
from webloom.llm.repeats import cut_repeats

from .helpers import ODD, documents, load


def brute(docs, length):
    seen = Counter(t[k : k + length] for t in docs.values() for k in range(len(t) - length + 1))
    out = {}
    for i, t in docs.items():
        gone = np.zeros(len(t) + 1, dtype=int)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k] += 1
                gone[k + length] -= 1
        gone = np.cumsum(gone)[: len(t)] > 0
        rest = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes()
        out[i] = (len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), sha256(rest).hexdigest())
    return out


def results(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_transform_matches_brute_force():
    rng = np.random.default_rng(0)
    for trial in range(60):
        length = int(rng.integers(2, 9))
        contexts = [bytes(rng.integers(97, 98 + trial % 4, int(rng.integers(length, 40)), dtype=np.uint8)) for _ in range(int(rng.integers(1, 12)))]
        sizes = np.array([len(c) - length + 1 for c in contexts])
        seen = Counter(c[i : i + length] for c in contexts for i in range(len(c) - length + 1))
        want = [seen[c[i : i + length]] > 1 for c in contexts for i in range(len(c) - length + 1)]
        assert repeats.repeated_starts(contexts, sizes, length).tolist() == want


@pytest.mark.parametrize("limit", [20_000, 2])
def test_documents(spark, limit):
    docs = load(spark, "documents")
    got = results(cut_repeats(docs, limit=limit))
    assert got == brute({r.doc_id: (r.text or "").encode() for r in docs.collect()}, 200)


@pytest.mark.parametrize("batch", [1 << 19, 500])
def test_random_pieces(spark, monkeypatch, batch):
    monkeypatch.setattr(repeats, "BATCH", batch)
    rng = np.random.default_rng(3)
    parts = ["".join(rng.choice(list("abcé "), int(rng.integers(5, 90)))) for _ in range(12)] + ["xy" * 40, "z" * 60]
    rows = [(i, "".join(rng.choice(parts, int(rng.integers(1, 8))))) for i in range(150)]
    got = results(cut_repeats(documents(spark, rows).repartition(5), length=25))
    assert got == brute({i: t.encode() for i, t in rows}, 25)


def test_edges(spark):
    rows = [r for r in ODD if r[0] not in (None, 6)] + [(20, "q" * 300), (21, "copy " * 60), (22, "copy " * 60), (23, "unlike"), (24, "longer than all " + "".join(map(str, range(3000))))]
    assert results(cut_repeats(documents(spark, rows))) == brute({i: (t or "").encode() for i, t in rows}, 200)
    assert cut_repeats(documents(spark, ODD)).count() == len(ODD)
    assert cut_repeats(documents(spark, [])).count() == 0
    kept = cut_repeats(documents(spark, [(1, "head" + "0123456789" * 5 + "tail"), (2, "0123456789" * 5)]), length=50).collect()
    assert {r.doc_id: bytes(r.kept) for r in kept} == {1: b"headtail", 2: b""}
