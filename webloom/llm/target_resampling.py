"""Importance resampling towards a target distribution, with an Aho-Corasick dictionary.

Features are runs of one to three words, counted in buckets of their CRC-32. No feature is ever put
together as a string: the distinct words of a stretch of text, each between two delimiters, are the
patterns of an automaton and carry their CRC and length as payload. One scan of the stretch emits the payloads of its words
in order, and the CRC of a run follows from those of neighbours, since appending n bytes to a text
maps its CRC linearly. Buckets are counted over documents and target first; with the
gains that follow, a second scan gives each document its weight.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import table
from webloom.scale import global_index
from webloom.session import cut_lineage

BUCKETS = 10_000
LONGEST = 3
STRETCH_BYTES = 1 << 22
STEP_WORDS = 1 << 20

#: Bytes of words stay (A to Z in lower case), all others are the delimiter. Bytes of non-ASCII characters belong to words.
_WORD_BYTES = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))
#: Between two texts of a block; no word has this byte.
_NEXT = b"\x01"
LONG_WORD = 64
_LONG = re.compile(rb"[^ ]{%d,}" % (LONG_WORD + 1))


def _crc_table() -> np.ndarray:
    """The CRC of one byte after a state of 8 bits, by the polynomial of CRC-32."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_TABLE = _crc_table()
_POWERS: list[np.ndarray] = []


def _advance(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """CRCs after the zero bytes that ``tables`` (4 x 256: one per byte of the CRC) stand for."""
    return tables[0][crc & 255] ^ tables[1][(crc >> 8) & 255] ^ tables[2][(crc >> 16) & 255] ^ tables[3][crc >> 24]


def zero_tables(length: int) -> np.ndarray:
    """Tables of the linear map that appending ``length`` zero bytes is, from those of powers of two."""
    unit = (np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)).astype(np.uint32)
    got = unit
    for bit in range(length.bit_length()):
        if len(_POWERS) <= bit:
            _POWERS.append(_TABLE[unit & 255] ^ (unit >> 8) if not bit else _advance(_POWERS[-1], _POWERS[-1]))
        if length >> bit & 1:
            got = _advance(_POWERS[bit], got)
    return got


def append_space(crc: np.ndarray) -> np.ndarray:
    state = ~crc
    return ~(_TABLE[(state ^ 32) & 255] ^ (state >> 8))


class Composer:
    """CRCs of neighbouring words joined by a space. Words of one length share a map."""

    def __init__(self) -> None:
        self._place: dict[int, int] = {}
        self._tables = np.zeros((0, 4, 256), np.uint32)

    def places(self, lengths: np.ndarray) -> np.ndarray:
        """The number of each length's map; maps of new lengths are made."""
        distinct, where = np.unique(lengths, return_inverse=True)
        if len(self._place) > 4096:
            self.__init__()
        new = [int(n) for n in distinct if int(n) not in self._place]
        if new:
            self._tables = np.concatenate((self._tables, np.stack([zero_tables(n) for n in new])))
            self._place.update({n: len(self._place) + i for i, n in enumerate(new)})
        return np.array([self._place[int(n)] for n in distinct], np.int64)[where]

    def join(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        crc, t = append_space(left), self._tables
        return t[place, 0, crc & 255] ^ t[place, 1, (crc >> 8) & 255] ^ t[place, 2, (crc >> 16) & 255] ^ t[place, 3, crc >> 24] ^ right


def stretches(data: bytes, limit: int = STRETCH_BYTES) -> Iterator[bytes]:
    """Parts of ``data``, which begins and ends with a delimiter, cut at delimiters; each begins and ends with one, and neighbours share it."""
    at = 0
    while at + 1 < len(data):
        end = len(data) - 1 if at + limit >= len(data) - 1 else data.find(b" ", at + limit)
        yield data[at : end + 1]
        at = end


def payloads(data: bytes, limit: int = STRETCH_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, crc, length) of the words of ``data`` in order, by an automaton of the distinct words of each stretch.

    The mark between two texts is a pattern of its own. A word of over ``LONG_WORD`` bytes stands in the scanned stretch by a
    short name, so the automaton grows with the number of distinct words and not with their length.
    """
    doc, crcs, lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    texts = 0
    for stretch in stretches(data, limit):
        words = sorted(set(stretch.split()) - {_NEXT})
        names = {w: b"\x02%d" % i for i, w in enumerate(words) if len(w) > LONG_WORD}
        if names:
            stretch = _LONG.sub(lambda m: names[m[0]], stretch)
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, word in enumerate([*words, _NEXT]):
            automaton.add_word(f" {names.get(word, word).decode('latin-1')} ", i)
        automaton.make_automaton()
        hits = np.fromiter(map(itemgetter(1), automaton.iter(stretch.decode("latin-1"))), np.int64)
        mark = hits == len(words)
        at = texts + np.cumsum(mark)
        texts += int(mark.sum())
        hits = hits[~mark]
        doc.append(at[~mark])
        crcs.append(np.fromiter((zlib.crc32(w) for w in words), np.uint32, len(words))[hits])
        lengths.append(np.fromiter(map(len, words), np.int64, len(words))[hits])
    return np.concatenate(doc), np.concatenate(crcs), np.concatenate(lengths)


def features(texts: list[bytes], composer: Composer, n_buckets: int = BUCKETS, limit: int = STRETCH_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, length of the run in words, bucket) of all features, in several arrays; no run crosses texts."""
    data = b" " + (b" " + _NEXT + b" ").join(t.translate(_WORD_BYTES) for t in texts) + b" "
    doc, crc, length = payloads(data, limit)
    for low in range(0, len(doc), STEP_WORDS):
        back = min(low, LONGEST - 1)
        d, c, n = (x[low - back : low + STEP_WORDS] for x in (doc, crc, length))
        place = composer.places(n)
        run = c
        yield d[back:], np.ones(len(d) - back, np.int64), (run[back:] % n_buckets).astype(np.int64)
        for words in range(2, LONGEST + 1):
            # ``run`` holds the CRCs of runs one word shorter, by their last word
            run = np.concatenate((run[:1], composer.join(run[:-1], c[1:], place[1:])))
            at = np.arange(max(back, words - 1), len(d))
            at = at[d[at] == d[at - words + 1]]
            yield d[at], np.full(len(at), words, np.int64), (run[at] % n_buckets).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], limit: int = STRETCH_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of batches of about ``limit`` bytes with their texts; a longer text is a slice of its own."""
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        low, size, got = 0, 0, []
        for i in range(len(texts)):
            value = texts[i].as_py() or b""
            if got and size + len(value) > limit:
                yield batch.slice(low, i - low), got
                low, size, got = i, 0, []
            got.append(value)
            size += len(value)
        if got:
            yield batch.slice(low), got


def bucket_counts(docs: DataFrame, text_col: str = "text", n_buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts each bucket holds. A task sends one row per bucket, and so does the result."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, composer = np.zeros(n_buckets, np.int64), Composer()
        for _, texts in _blocks(batches):
            for _, _, bucket in features(texts, composer, n_buckets):
                total += np.bincount(bucket, minlength=n_buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "bucket int, n bigint")
    counts = np.zeros(n_buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target share over source share of each bucket, one added to every count."""
    size = len(source)
    of_source, of_target = float(source.sum() + size), float(target.sum() + size)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * of_source / ((s + 1.0) * of_target))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64
    )


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight), one row per input row: weight is the sum of the gains of all features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        composer = Composer()
        for batch, texts in _blocks(batches):
            words, found, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
            for doc, size, bucket in features(texts, composer, len(gain)):
                found += np.bincount(doc, minlength=len(texts))
                if len(size) and size[0] == 1:
                    words += np.bincount(doc, minlength=len(texts))
                # doubles hold these sums exactly: a bucket's gain is below 2**16
                weight += np.bincount(doc, gain[bucket], minlength=len(texts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *map(pa.array, (words, found, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate drawn from the digest of ``seed:doc_id``."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
    target_text_col: str = "text", n_buckets: int = BUCKETS,
) -> DataFrame:
    """One row per input row: (doc_id, n_words, n_features, weight, score, rank).

    Of the documents with at least ``least_words`` words, ``percent`` of a hundred (rounded down) are drawn: those of highest
    score, ties to the smaller id, a null id before all. Their ``rank`` counts from 1; it is null for the others. Scores are the weight
    plus noise from the id, so reruns agree and the draw is one without replacement. A null or empty text has no word and weight 0, as have
    all texts when the target has none of their features' difference. Repeated rows are drawn each for itself. An empty table gives
    an empty result; an empty target is a flat one. No other column is read. Order and ranks come from a distributed index.
    """
    gain = gains(bucket_counts(docs, text_col, n_buckets), bucket_counts(target, target_text_col, n_buckets))
    rows = weigh(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    rows = cut_lineage(rows, "weighed")
    enough = F.col("n_words") >= least_words
    drawn = rows.where(enough).count() * percent // 100
    indexed = global_index(rows.where(enough), [F.col("score").desc(), F.col("doc_id").asc()], "at")
    rank = F.when(F.col("at") < drawn, F.col("at") + 1)
    return indexed.withColumn("rank", rank).drop("at").unionByName(rows.where(~enough).withColumn("rank", F.lit(None).cast("bigint")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 byte by byte, once for each distinct feature.
SQL = r"""
with recursive bits as (select range as byte, range as state, 0 as step from range(256) union all
  select byte, case when state & 1 = 1 then xor(state >> 1, 3988292384) else state >> 1 end, step + 1 from bits where step < 8),
crc as materialized (select list(state order by byte) as t from bits where step = 8),
texts as (select 'd' as side, doc_id as id, text from documents union all select 'b', item_id, text from benchmark),
words as materialized (select side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts),
features as (select side, id, unnest(w) as f from words
  union all select side, id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from words
  union all select side, id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) from words),
counted as materialized (select side, id, f, count(*) as n from features group by all),
named as materialized (select f, hex(encode(f)) as h from (select distinct f from counted)),
hashed as materialized (select f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(h), 2), lambda i: ('0x' || substr(h, i, 2))::bigint)),
  lambda state, b: xor(state >> 8, t[xor(state, b) % 256 + 1])), 4294967295) % 10000 as bucket from named, crc),
filled as materialized (select side, bucket, sum(n) as n from counted join hashed using (f) group by all),
total as (select coalesce(sum(n) filter (side = 'd'), 0) as s, coalesce(sum(n) filter (side = 'b'), 0) as t from filled),
gain as (select range as bucket, floor(1000 * ln((coalesce(b.n, 0) + 1.0)::double * (total.s + 10000)::double / ((coalesce(d.n, 0) + 1)::double * (total.t + 10000)::double))) as g
  from range(10000) left join filled d on d.side = 'd' and d.bucket = range left join filled b on b.side = 'b' and b.bucket = range, total),
summed as (select id, sum(n) as n_features, sum(n * g) as weight from counted join hashed using (f) join gain using (bucket) where side = 'd' group by id),
scored as (select doc_id, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight, len(w) as n_words,
  coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::bigint + 0.5)::double / 4294967296)))::bigint as score
  from documents left join summed on doc_id = summed.id join words on side = 'd' and words.id = doc_id),
ranked as (select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from scored where n_words >= 20)
select doc_id, n_features, weight, score, case when place <= 5 * n // 100 then place end as rank from scored left join ranked using (doc_id)
"""
