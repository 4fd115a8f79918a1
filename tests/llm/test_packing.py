import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer
from webloom.llm import packing

from .helpers import ODD, documents, load

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(got, docs, tokenizer, capacity):
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4") for i, t in docs}
    for i, p in got.groupby("doc_id"):
        p = p.sort_values("piece")
        assert list(p.piece) == list(range(len(p)))
        assert list(p.start) == list(p.length.cumsum() - p.length) and p.length.sum() == len(ids[i])
        assert len(p) == 1 or set(p.length[1:]) == {capacity}
        assert [crc32(ids[i][a : a + n].tobytes()) for a, n in zip(p.start, p.length)] == list(p.ids_crc32)
    assert set(got.doc_id) == set(ids)
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert list(s.offset) == list(s.length.cumsum() - s.length) and s.length.sum() <= capacity


def test_round_trip_and_fill(spark, tokenizer):
    docs = load(spark, "documents")
    got = packing.pack_documents(docs, PATH).toPandas()
    check(got, [(r.doc_id, r.text) for r in docs.collect()], tokenizer, 1024)
    assert got.sequence_id.nunique() <= 1.01 * got.length.sum() / 1024 + 1


def test_blocks_and_islands(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 30)
    rows = [(i, "word " * (1 + i * 7 % 40)) for i in range(150)]
    got = packing.pack_documents(documents(spark, rows), PATH, capacity=64).toPandas()
    check(got, rows, tokenizer, 64)


def test_edges(spark, tokenizer):
    rows = [r for r in ODD if r[0] not in (None, 6)] + [(8, "hello <|endoftext|> world"), (9, "<|endoftext|>"), (10, "a<|endoftext|><|endoftext|>b <|endoftext|"), (11, "  <|endoftext|>  x ")]
    check(packing.pack_documents(documents(spark, rows), PATH).toPandas(), rows, tokenizer, 1024)
    assert packing.pack_documents(documents(spark, ODD), PATH).where("doc_id = 6").count() == 2
    assert packing.pack_documents(documents(spark, []), PATH).count() == 0


def test_crossover_keeps_every_piece():
    rng = random.Random(3)
    sizes = [rng.randint(1, 60) for _ in range(200)]
    a = packing.best_fit([], list(range(200)), sizes, 64)
    b = packing.best_fit([], sorted(range(200), key=lambda i: -sizes[i]), sizes, 64)
    child = packing.crossover(a, b, sizes, 64, rng)
    assert sorted(i for bin_ in child for i in bin_) == list(range(200))
    assert all(sum(sizes[i] for i in bin_) <= 64 for bin_ in child)
    best = packing.evolve(sizes, 64, 1, [a], children=10)
    assert packing.fitness(best, sizes, 64) <= packing.fitness(a, sizes, 64)
    assert len(best) <= len(b)
