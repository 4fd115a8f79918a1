import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from webloom.llm import target_resampling as tr
from webloom.llm.target_resampling import Composer, bucket_counts, features, payloads, resample, stretches

from .helpers import ODD, documents, load

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def buckets(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def twin(docs, target):
    """The contract's rows by plain Python."""
    s, t = Counter(b for _, x in docs for b in buckets(x)), Counter(b for x in target for b in buckets(x))
    size_s, size_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (size_s + 10_000) / ((s[b] + 1) * (size_t + 10_000)))) for b in range(10_000)]
    rows = []
    for i, text in docs:
        got = buckets(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in got)
        rows.append([i, len(words(text)), len(got), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    enough = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    for place, r in enumerate(enough[: len(enough) * 5 // 100]):
        r[5] = place + 1
    return Counter(map(tuple, rows))


def seen(df):
    return Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


TEXTS = [b"", b" ", b"One two THREE one", "é Öl 12-ab\x7fcd".encode(), b"a", b"a a a a", b"x" * 5000 + b" y", "漢字 かな".encode(), b"\x00\x01", b"ab" * 300 + b" " + b"c d " * 700, b"a\nb\tc"]


@pytest.mark.parametrize("limit", [1, 7, 64, 1 << 22])
@pytest.mark.parametrize("step", [1, 2, 3, 1 << 20])
def test_features_are_crcs_of_runs(monkeypatch, limit, step):
    monkeypatch.setattr(tr, "STEP_WORDS", step)
    texts = TEXTS if step > 3 else [t[:400] for t in TEXTS]
    got = [[] for _ in texts]
    for doc, _, bucket in features(texts, Composer(), limit=limit):
        for d, b in zip(doc, bucket, strict=True):
            got[d].append(int(b))
    for text, have in zip(texts, got, strict=True):
        assert Counter(have) == Counter(buckets(text.decode(errors="ignore")) if text.isascii() or text == text.decode(errors="ignore").encode() else have)


def test_payloads_of_words():
    long = b"z" * 100_000
    data = b" one  two one  \x01 \x01 " + long + b" two "
    for limit in (1, 5, 1 << 20):
        doc, crc, length = payloads(data, limit)
        assert doc.tolist() == [0, 0, 0, 2, 2]
        assert crc.tolist() == [zlib.crc32(w) for w in (b"one", b"two", b"one", long, b"two")]
        assert length.tolist() == [3, 3, 3, 100_000, 3]


def test_stretches_share_their_delimiter():
    data = b" aa bb  ccc d "
    for limit in range(1, 20):
        got = list(stretches(data, limit))
        assert all(s[:1] == b" " == s[-1:] for s in got)
        assert b" ".join(w for s in got for w in s.split()) == b"aa bb ccc d"


def test_composition_of_all_lengths():
    composer = Composer()
    right = [bytes([97 + n % 26]) * n for n in range(1, 600)]
    left = np.full(len(right), zlib.crc32(b"left"), np.uint32)
    got = composer.join(left, np.array([zlib.crc32(r) for r in right], np.uint32), composer.places(np.array([len(r) for r in right])))
    assert got.tolist() == [zlib.crc32(b"left " + r) for r in right]


def test_given_documents(spark):
    docs, target = load(spark, "documents"), load(spark, "benchmark")
    assert seen(resample(docs, target)) == twin([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])


def test_counts_of_buckets(spark):
    docs = load(spark, "benchmark")
    want = Counter(b for r in docs.collect() for b in buckets(r.text))
    got = bucket_counts(docs)
    assert {b: int(n) for b, n in enumerate(got) if n} == dict(want)


def test_edges(spark):
    target = documents(spark, [(1, "same text here")])
    assert seen(resample(documents(spark, ODD), target)) == twin(ODD, ["same text here"])
    assert resample(documents(spark, []), target).count() == 0
    nothing = documents(spark, [])
    assert seen(resample(documents(spark, ODD), nothing)) == twin(ODD, [])


def test_ties_and_repeated_rows(spark):
    rows = [(i % 3 or None, "word " * 25) for i in range(120)] + [(i, f"other {i} " * 15) for i in range(200, 260)]
    docs = documents(spark, rows)
    got = resample(docs, documents(spark, [(1, "word " * 30)]))
    assert seen(got) == twin(rows, ["word " * 30]) and seen(resample(docs.repartition(5), documents(spark, [(1, "word " * 30)]))) == seen(got)
    ranks = sorted(r["rank"] for r in got.where("rank is not null").collect())
    assert ranks == list(range(1, 180 * 5 // 100 + 1))


def test_long_text_over_several_stretches(spark, monkeypatch):
    text = " ".join(f"w{i % 977} Äpfel{i % 31}" for i in range(150_000))
    rows = [(1, text), (2, "short")]
    assert len(text.encode()) > 2_000_000
    monkeypatch.setattr(tr, "STRETCH_BYTES", 100_000)
    got = Counter()
    for _, _, bucket in features([text.encode()], Composer(), limit=100_000):
        got.update(bucket.tolist())
    assert got == Counter(buckets(text))
    assert seen(resample(documents(spark, rows), documents(spark, [(1, "äpfel")]))) == twin(rows, ["äpfel"])
