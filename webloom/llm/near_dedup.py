"""Near-duplicate documents by improved consistent weighted sampling.

1. Words (runs of anything but ASCII blanks, ASCII case folded) are hashed. Their document frequencies are counted
   over all documents in a table of fixed size (``BUCKETS`` hashed entries), so it can be handed to every task.
2. The features of a document are its shingles of five words; a weight is the shingle's frequency in the document times
   the mean inverse document frequency of its words. A text of fewer words is one shingle.
3. Consistent weighted samples (Ioffe's method) of these weights: two documents agree in a sample with the probability
   of their weighted Jaccard similarity. Samples are banded; documents that agree in a band meet in a bucket.
4. In a bucket, documents gather around leaders by their estimated similarity. A large bucket is dealt into parts first, whose
   leaders then meet in the same way, round by round, so no task holds a whole large bucket and no bucket makes all its pairs.
5. The likest pair of every document is verified by the weighted Jaccard similarity of the whole texts; verified links are unioned to groups.
6. Leaders only find most of the links cheaply. Every bucket that still holds documents of different groups is then compared
   whole, block by block in many tasks: all pairs of different groups with a high enough estimate are verified there, on the
   features of the block, and only links that join two groups leave the task. So no link depends on who leads and no table of pairs is made; the
   work, but not its output, grows with the square of the documents of a bucket that are alike but not linked.

Documents with one and the same sequence of words are one document in steps 3 to 6.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import small_side, table, wrapped
from webloom.llm.components import components
from webloom.session import cut_lineage

WORDS = 5
SIMILARITY = 0.8
BUCKETS = 1 << 18
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
ESTIMATE = 0.6  # samples in common from which a pair is verified: 3.9 standard errors below 0.8
TIES = 4  # leaders a document is tied to in a bucket at first; what they miss is compared whole later
PART = 4_096  # documents of a bucket in one part
BLOCK = 2_048  # documents of a bucket that are compared whole with those of another block
BLOCK_BYTES = 1 << 24  # and about the text of these
CHUNK = 1 << 20  # bytes of text worked on at once

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_BASE = 0x5851F42D4C957F2D
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_LOWER += np.uint64(1)
_PLACES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M1
    return (x ^ (x >> np.uint64(29))) * _M2


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, CHUNK + 1)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                out, step = np.ones(1, dtype=np.uint64), base
                while len(out) < size:
                    out = np.concatenate([out, out * np.uint64(step)])
                    step = step * step % (1 << 64)
                setattr(cls, name, out)
        return cls.up, cls.down


def words_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in concatenated UTF-8 texts and the text of each; ``ends`` are the texts' ends."""
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    blank = _BLANK[data]
    opens = ~blank
    closes = ~blank
    inner = ends[(ends > 0) & (ends < len(data))]
    first = np.ones(len(data), dtype=bool)
    first[1:] = blank[:-1]
    first[inner] = True
    last = np.ones(len(data), dtype=bool)
    last[:-1] = blank[1:]
    last[inner - 1] = True
    starts, stops = np.flatnonzero(opens & first), np.flatnonzero(closes & last) + 1
    up, down = _Powers.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_LOWER[data] * up[: len(data)], out=sums[1:])
    return _mix((sums[stops] - sums[starts]) * down[starts]), np.searchsorted(ends, starts, side="right")


def shingles_of(words: np.ndarray, docs: np.ndarray, idf: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, mean idf) of the shingles, in text order."""
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32)
    weight = idf[(words >> np.uint64(46)).astype(np.intp)] if idf is not None else np.ones(n, dtype=np.float32)
    counts = np.bincount(docs)
    wide = np.concatenate([words, np.zeros(WORDS - 1, dtype=np.uint64)])
    owner = np.concatenate([docs, np.full(WORDS - 1, -1)])
    w = np.concatenate([weight, np.zeros(WORDS - 1, dtype=np.float32)])
    total, mean, size = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.float32), np.zeros(n, dtype=np.float32)
    for k in range(WORDS):
        mine = owner[k : k + n] == docs
        total += np.where(mine, wide[k : k + n] * _PLACES[k], 0)
        mean += np.where(mine, w[k : k + n], 0)
        size += mine
    first = np.ones(n, dtype=bool)
    first[1:] = docs[1:] != docs[:-1]
    use = (owner[WORDS - 1 : WORDS - 1 + n] == docs) | (first & (counts[docs] < WORDS))
    return _mix(total[use]), docs[use], mean[use] / size[use]


def weighted(hashes: np.ndarray, docs: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct features in text order: (hash, text, weight = frequency x idf)."""
    _, at, n = np.unique(hashes + docs.astype(np.uint64) * _M2, return_index=True, return_counts=True)
    order = np.argsort(at)
    at = at[order]
    return hashes[at], docs[at], idf[at] * n[order].astype(np.float32)


class Sampler:
    """Random variables of the samples, from tables of gamma and uniform variates picked by the feature's hash."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.r = rng.gamma(2.0, 1.0, 1 << 16).astype(np.float32)
        self.inverse = (1 / self.r).astype(np.float32)
        self.beta = rng.random(1 << 16, dtype=np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, 1 << 16)).astype(np.float32)
        self.odd = rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def samples(self, hashes: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Sample identities, (texts, SAMPLES) uint64, for features sorted by text with the texts' first places."""
        log_w = np.log(weights.astype(np.float64)).astype(np.float32)
        sizes = np.diff(np.append(starts, len(hashes)))
        out = np.empty((len(starts), SAMPLES), dtype=np.uint64)
        for k in range(SAMPLES):
            z = (hashes * self.odd[k]).view(np.uint16).reshape(-1, 4)
            i = z[:, 3].astype(np.intp)
            beta, r = self.beta.take(i), self.r.take(i)
            t = np.floor(log_w * self.inverse.take(i) + beta)
            score = self.log_c.take(z[:, 2].astype(np.intp)) - r * (t - beta + np.float32(1))
            least = np.minimum.reduceat(score, starts)
            hit = np.flatnonzero(score == np.repeat(least, sizes))
            first = hit[np.searchsorted(hit, starts)]
            out[:, k] = _mix(hashes[first] + t[first].astype(np.int64).astype(np.uint64) * _M1 + np.uint64(k))
        return out


def _chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, ends) of runs of rows with about CHUNK bytes, without copying the texts."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
        yield at, data[offsets[at] : offsets[to]], offsets[at + 1 : to + 1] - offsets[at]
        at = to


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """(counts per word bucket, documents), over all documents; BUCKETS numbers whatever the size of the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for _, data, ends in _chunks(batch.column("text")):
                words, owner = words_of(data, ends)
                keys = np.unique(owner.astype(np.int64) * BUCKETS + (words >> np.uint64(46)).astype(np.int64))
                counts += np.bincount(keys % BUCKETS, minlength=BUCKETS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["bucket", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    got = rows.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS, dtype=np.int64)
    counts[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return counts, docs.count()


def inverse_frequencies(counts: np.ndarray, n: int) -> np.ndarray:
    """Damped inverse document frequencies: with the root, one rare word in a shingle does not outweigh the others, and
    the weighted similarity stays near that of plain shingles."""
    return np.sqrt(1 + np.log((1 + n) / (1 + np.minimum(counts, n)))).astype(np.float32)


def signatures(docs: DataFrame, idf: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(id, words, bands, sketch): hash of the word sequence, band keys, one byte of each sample. Texts without a word are left out."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)  # BUCKETS numbers
    id_type = docs.schema[id_col].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in batches:
            for at, data, ends in _chunks(batch.column("text")):
                words, owner = words_of(data, ends)
                if not len(words):
                    continue
                rank = np.arange(len(words)) - np.searchsorted(owner, owner)
                hashes, of, mean = shingles_of(words, owner, shared.value)
                hashes, of, weights = weighted(hashes, of, mean)
                docs_here, starts = np.unique(of, return_index=True)
                ids = sampler.samples(hashes, starts, weights)
                bands = ids.reshape(-1, BANDS, ROWS)
                keys = bands[:, :, 0].copy()
                for k in range(1, ROWS):
                    keys = _mix(keys + bands[:, :, k] * _PLACES[k])
                keys = _mix(keys + np.arange(BANDS, dtype=np.uint64) * _M1).view(np.int64)
                places = np.concatenate([_mix(words + rank.astype(np.uint64) * _M1)[:, None], _mix(words * _M2 + rank.astype(np.uint64))[:, None]], axis=1)
                word_starts = np.searchsorted(owner, docs_here)
                whole = np.add.reduceat(places, word_starts, axis=0)
                sketch = (ids >> np.uint64(56)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(docs_here + at)),
                        pa.array([w.tobytes() for w in whole], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel())),
                        pa.array([s.tobytes() for s in sketch], pa.binary()),
                    ],
                    names=["id", "words", "bands", "sketch"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(sign, f"id {id_type}, words binary, bands array<bigint>, sketch binary")


def _gather(rows: DataFrame) -> DataFrame:
    """One round of the buckets: (key, salt, id, sketch) -> (key, id, sketch, leader, leads, alike).

    Rows come sorted by (key, salt), so a part is worked through as a stream; only its leaders are held. A document is tied to the
    TIES leaders it is estimated to be likest to, and leads itself while there are fewer and none is nearly the same. The order
    within a part differs from bucket to bucket, so a group has other leaders in every band.
    """

    def part(sketches: np.ndarray, ids: list) -> tuple[list, list[bool]]:
        ties, leads = [], [False] * len(ids)
        lead_at: list[int] = []
        lead_sketch = np.empty((16, SAMPLES), dtype=np.uint8)
        for i in range(len(ids)):
            n = len(lead_at)
            if n:
                alike = (lead_sketch[:n] == sketches[i]).mean(axis=1)
                near = np.flatnonzero(alike >= ESTIMATE)
                if len(near):
                    for j in near[np.argsort(-alike[near], kind="stable")][:TIES]:
                        ties.append((i, lead_at[j], float(alike[j])))
                    if len(near) >= TIES or alike[near].max() >= 0.9:  # its leaders stand for it
                        continue
            leads[i] = True
            if n == len(lead_sketch):
                lead_sketch = np.concatenate([lead_sketch, np.empty_like(lead_sketch)])
            lead_sketch[n] = sketches[i]
            lead_at.append(i)
        return ties, leads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def work(whole: pa.Table) -> pa.RecordBatch:
            keys, salts = whole.column("key").to_numpy(), whole.column("salt").to_numpy()
            bounds = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (salts[1:] != salts[:-1])))
            bounds = np.append(bounds, len(keys))
            wide = bounds[:-1][np.diff(bounds) > 1]
            ends = bounds[1:][np.diff(bounds) > 1]
            sketch = np.frombuffer(b"".join(whole.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, SAMPLES)
            left, right, alike = [], [], []
            lead = np.ones(len(keys), dtype=bool)
            for a, b in zip(wide.tolist(), ends.tolist(), strict=True):
                ties, leads = part(sketch[a:b], range(a, b))
                lead[a:b] = leads
                for i, j, s in ties:
                    left.append(a + i)
                    right.append(a + j)
                    alike.append(s)
            leaders = np.flatnonzero(lead)
            ids = whole.column("id").combine_chunks()
            n, m = len(left), len(leaders)
            first = pa.array(np.concatenate([np.array(left, dtype=np.int64), leaders]))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[np.concatenate([np.array(left, dtype=np.int64), leaders])]), ids.take(first),
                    pa.concat_arrays([pa.nulls(n, pa.binary()), whole.column("sketch").combine_chunks().take(pa.array(leaders)).cast(pa.binary())]),
                    pa.concat_arrays([ids.take(pa.array(right, pa.int64())), pa.nulls(m, ids.type)]),
                    pa.array(alike + [0.0] * m, pa.float64()),
                ],
                names=["key", "id", "sketch", "leader", "alike"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            whole = pa.concat_tables(held)
            keys, salts = whole.column("key").to_numpy(), whole.column("salt").to_numpy()
            open_ = np.flatnonzero((keys != keys[-1]) | (salts != salts[-1]))
            cut = int(open_[-1]) + 1 if len(open_) else 0
            if cut:
                yield work(whole.slice(0, cut))
            held = [whole.slice(cut)]
        if held and held[0].num_rows:
            yield work(pa.concat_tables(held))

    id_type = rows.schema["id"].dataType.simpleString()
    laid = rows.repartition("key", "salt").sortWithinPartitions("key", "salt", F.xxhash64("id", "key"), "id")
    return laid.select("key", "salt", "id", "sketch").mapInArrow(run, f"key long, id {id_type}, sketch binary, leader {id_type}, alike double")


def shared_buckets(signed: DataFrame) -> DataFrame:
    """(id, key) of the buckets with several documents."""
    members = signed.select("id", F.explode("bands").alias("key"))
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return members.join(sizes.select("key"), "key").select("id", "key")


def candidate_pairs(signed: DataFrame, shared: DataFrame) -> DataFrame:
    """(a, b, alike), a < b: what the buckets' rounds tie together; ``shared`` are the shared buckets."""
    triples = SAMPLES // 3
    members = shared.select("id", F.lit(0).alias("from"), "key")
    sketches = signed.select("id", "sketch")
    found = None
    while True:
        sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("from").alias("from")).where("n > 1")
        split = F.ceil(F.col("n") / F.lit(PART)).cast("int")
        # only what shares a bucket takes its sketch along
        dealt = members.drop("from").join(sizes, "key").withColumn("salt", F.when(split > 1, F.pmod(F.xxhash64("id", "key"), split)).otherwise(0).cast("int"))
        round_ = cut_lineage(_gather(dealt.select("key", "salt", "id").join(sketches, "id")), "buckets")
        pairs = round_.where("leader is not null").select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b"), "alike")
        found = pairs if found is None else found.unionByName(pairs)
        # only the leaders of buckets in several parts meet again
        large = cut_lineage(sizes.where(F.col("n") > PART), "large")
        if large.isEmpty():
            break
        again = round_.where("leader is null").join(large, "key")
        # parts that hold mostly strangers are dealt by further samples, each time later ones, so this ends; open_links compares what is left
        left = again.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
        marked = again.join(left, "key").withColumn("strange", F.col("m") > F.col("n") * 0.9)
        further = F.when(
            F.col("from") < triples,
            F.transform(F.sequence(F.col("from"), F.lit(triples - 1)), lambda j: F.struct(
                (j + 1).cast("int").alias("from"), F.xxhash64("key", j, F.substring("sketch", j * 3 + 1, 3)).alias("key")
            )),
        )
        members = marked.where("not strange").select("id", "from", "key").unionByName(
            marked.where("strange").select("id", F.explode(further).alias("next")).select("id", "next.from", "next.key")
        )
    return found.groupBy("a", "b").agg(F.max("alike").alias("alike"))


def _block_features(texts: pa.ChunkedArray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(first places, feature numbers, weights, total weights, number of features) of the texts of a block, features numbered across them."""
    owners, hashes, weights = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.float32)]
    rows = 0
    for part in texts.chunks:
        for at, data, ends in _chunks(part):
            words, owner = words_of(data, ends)
            h, of, mean = shingles_of(words, owner, idf)
            h, of, w = weighted(h, of, mean)
            owners.append(of + rows + at)
            hashes.append(h)
            weights.append(w)
        rows += len(part)
    owner, weight = np.concatenate(owners), np.concatenate(weights)
    names, number = np.unique(np.concatenate(hashes), return_inverse=True)
    starts = np.searchsorted(owner, np.arange(rows + 1))
    total = np.bincount(owner, weight, minlength=rows)
    return starts, number, weight, total, len(names)


def _joining(rows: pa.Table, idf: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links of a block that join what is still apart: candidates by their sketches, verified by the weighted Jaccard similarity
    of the whole texts. One union of the block's groups tells what is apart, so there are fewer links than rows."""
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, SAMPLES)
    root = rows.column("own").combine_chunks().dictionary_encode().indices.to_numpy().copy()
    block, within = rows.column("block").to_numpy(), rows.column("x")[0].as_py() == rows.column("y")[0].as_py()
    features, links = None, []
    for i in range(len(root) - 1):
        # in a block all that follow, else those of the other block
        open_ = root[i + 1 :] != root[i]
        if not within:
            open_ &= block[i + 1 :] != block[i]
        near = np.flatnonzero(open_) + i + 1
        if len(near):
            near = near[(sketch[near] == sketch[i]).sum(axis=1) >= ESTIMATE * SAMPLES]
        if not len(near):
            continue
        if features is None:
            features = _block_features(rows.column("text"), idf)
            starts, number, weight, total, size = features
            mine = np.zeros(size, dtype=np.float32)
        own = slice(starts[i], starts[i + 1])
        # the lighter text holds at most its whole weight in common
        near = near[np.minimum(total[near], total[i]) >= similarity * np.maximum(total[near], total[i]) * (1 - 1e-6)]
        if not len(near) or not total[i]:
            continue
        mine[number[own]] = weight[own]
        sizes = starts[near + 1] - starts[near]
        first = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) + np.repeat(starts[near] - first, sizes)
        low = np.add.reduceat(np.minimum(mine[number[at]], weight[at]), first, dtype=np.float64)
        mine[number[own]] = 0
        for j in near[low / (total[i] + total[near] - low) >= similarity]:
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                links.append((i, int(j)))
    return links


def open_links(shared: DataFrame, sketches: DataFrame, groups: DataFrame, docs: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """(a, b): links between different ``groups`` among all documents that share a bucket, such that groups and links have
    the components that all links would have.

    Buckets that hold several groups are dealt into blocks of at most BLOCK documents and about BLOCK_BYTES of text, and every two
    blocks meet in a task of their own; none is cut. Pairs are compared inside the task, and what leaves it is less than a row per document.
    """
    named = shared.join(groups, "id", "left").select("id", "key", F.coalesce("component", "id").alias("own"))
    mixed = named.groupBy("key").agg(F.min("own").alias("_low"), F.max("own").alias("_high")).where("_low <> _high").select("key")
    open_ = cut_lineage(named.join(mixed, "key"), "open")
    wanted = small_side(cut_lineage(open_.select("id").distinct(), "wanted"))
    texts = cut_lineage(docs.join(wanted, "id", "left_semi").dropDuplicates(["id"]).join(sketches, "id").select("id", "sketch", "text"), "texts")
    lengths = texts.select("id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"))
    sizes = open_.join(lengths, "id").groupBy("key").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    dealt = open_.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "id", "own", "block", "key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")
    ).join(texts, "id")
    id_type = shared.schema["id"].dataType.simpleString()
    known = shared.sparkSession.sparkContext.broadcast(idf)  # BUCKETS numbers

    def compare(rows: pa.Table) -> pa.RecordBatch:
        links = _joining(rows, known.value, similarity)
        ids = rows.column("id").combine_chunks()
        return pa.RecordBatch.from_arrays([ids.take(pa.array([p[k] for p in links], pa.int64())) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in chain(batches, [None]):
            if batch is not None and not batch.num_rows:
                continue
            if batch is not None:
                held.append(batch)
            if not held:
                continue
            whole = pa.Table.from_batches(held)
            names = [whole.column(c).to_numpy() for c in ("key", "x", "y")]
            new = np.flatnonzero(np.any([v[1:] != v[:-1] for v in names], axis=0)) + 1
            bounds = [0, *new.tolist(), *([whole.num_rows] if batch is None else [])]
            for a, b in zip(bounds, bounds[1:], strict=False):
                if b - a > 1:
                    yield compare(whole.slice(a, b - a))
            held = whole.slice(bounds[-1]).to_batches()

    laid = met.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return laid.select("key", "x", "y", "id", "own", "block", "sketch", "text").mapInArrow(run, f"a {id_type}, b {id_type}")


def features_of(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted feature hashes of a text and their weights."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8)
    words, owner = words_of(data, np.array([len(data)]))
    hashes, of, mean = shingles_of(words, owner, idf)
    hashes, _, weights = weighted(hashes, of, mean)
    order = np.argsort(hashes)
    return hashes[order], weights[order]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][at] == a[0]
    low = np.minimum(a[1][same], b[1][at[same]]).sum(dtype=np.float64)
    return float(low / (a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64) - low))


def verified(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """(a, b, similarity) of the pairs that are alike enough; ``texts`` is (id, text)."""
    shared = pairs.sparkSession.sparkContext.broadcast(idf)
    id_type = pairs.schema["a"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, left = None, None
            values = []
            for b, x, y in zip(batch.column("b"), batch.column("text_a"), batch.column("text_b"), strict=True):
                if last is None or b.as_py() != last:
                    last, left = b.as_py(), features_of(y.as_py(), shared.value)
                values.append(weighted_jaccard(features_of(x.as_py(), shared.value), left))
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(values, pa.float64())], names=["a", "b", "similarity"])
            yield out.filter(pa.array([v >= similarity for v in values], pa.bool_()))

    with_a = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(compare, f"a {id_type}, b {id_type}, similarity double")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: (doc_id, group_id, group_size, kept).

    Documents are linked when their weighted Jaccard similarity is at least ``similarity``; a group is what links
    reach, named by its least id, whose row is kept. Texts with the same words in the same order are always in one group. A null or empty
    text, or one of blanks, is alone. A row with a null id is alone too, with a null group_id, and kept. Rows
    repeated with one id are one document (all of them are kept or not). An empty table gives an empty result. Other columns are not read.
    """
    counts, n = document_frequencies(docs, text_col)
    idf = inverse_frequencies(counts, n)
    known = docs.where(F.col(id_col).isNotNull())
    signed = cut_lineage(signatures(known, idf, id_col, text_col), "signatures")
    first = signed.groupBy("words").agg(F.min("id").alias("id"), F.min_by("bands", "id").alias("bands"), F.min_by("sketch", "id").alias("sketch"))
    first = cut_lineage(first, "distinct")
    same = signed.select("words", F.col("id").alias("copy")).join(first.select("words", "id"), "words").select(F.col("id").alias("a"), F.col("copy").alias("b"))
    shared = cut_lineage(shared_buckets(first), "shared")
    pairs = candidate_pairs(first, shared)

    # first the likest partner of every document, then all that share a bucket and are still apart, whoever led it
    best = cut_lineage(pairs.groupBy("b").agg(F.max_by("a", F.struct("alike", -F.col("a"))).alias("a")).select("a", "b"), "best")
    plain = known.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    wanted = small_side(cut_lineage(best.select(F.col("a").alias("id")).unionByName(best.select(F.col("b").alias("id"))).distinct(), "wanted"))
    texts = cut_lineage(plain.join(wanted, "id", "left_semi").dropDuplicates(["id"]), "texts")
    links = cut_lineage(verified(best, texts, idf, similarity).select("a", "b"), "verified")
    groups = cut_lineage(components(links.unionByName(same)), "groups")
    more = cut_lineage(open_links(shared, first.select("id", "sketch"), groups, plain, idf, similarity), "joining")
    if not more.isEmpty():
        groups = cut_lineage(components(links.unionByName(same).unionByName(more)), "groups")
    sizes = signed.select("id").join(groups, "id").groupBy("component").agg(F.count(F.lit(1)).alias("group_size"))
    named = groups.join(sizes, "component").withColumnRenamed("id", "_id")
    out = docs.select(F.col(id_col).alias("doc_id")).join(named, F.col("doc_id") == F.col("_id"), "left")
    return out.select(
        "doc_id", F.coalesce("component", "doc_id").alias("group_id"), F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("doc_id").isNull() | (F.coalesce("component", "doc_id") == F.col("doc_id"))).alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that are the first of their group, all their columns unchanged.

    Rows with a null id, and those with a null, empty or blank text, stay. Rows repeated with one id stay or go together. An empty table
    gives an empty result; columns of any name may be there.
    """
    gone = small_side(cut_lineage(near_groups(docs, id_col, text_col, similarity).where("not kept").select("doc_id").distinct(), "gone"))
    return wrapped(docs, id=F.col(id_col)).join(gone, F.col("id") == F.col("doc_id"), "left_anti").select("whole.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))
