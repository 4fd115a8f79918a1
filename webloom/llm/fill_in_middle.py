"""Fill-in-middle transformation over a wavelet matrix of character classes.

The bytes of a block of documents are one sequence of four classes: a byte that continues a UTF-8
character, a letter within a run of letters, a letter that starts a run, and any other character. A
wavelet matrix answers how many bytes of a class stand before a place. Two such ranks add up to the
number of units that begin before it (runs of letters and single other characters), a third gives the
number of characters. The cut after ``p`` units is the last place with at most ``p`` units begun before it,
found by bisection on the ranks, for all documents of a block at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CONTINUED, WITHIN, STARTS, OTHER = range(4)
BLOCK_BYTES = 1 << 22


class WaveletMatrix:
    """Rank queries over a sequence of codes below ``2 ** bits``: a bit plane per level, highest first, each with counts per 64 bits."""

    def __init__(self, codes: np.ndarray, bits: int = 2):
        self.planes, self.counts, self.zeros = [], [], []
        for level in range(bits - 1, -1, -1):
            bit = (codes >> level) & 1
            room = np.zeros(-(-(len(bit) + 1) // 64) * 8, np.uint8)
            packed = np.packbits(bit, bitorder="little")
            room[: len(packed)] = packed
            words = room.view("<u8")
            ones = np.bitwise_count(words).astype(np.int64)
            self.planes.append(words)
            self.counts.append(np.concatenate(([0], np.cumsum(ones)[:-1])))
            self.zeros.append(len(bit) - int(ones.sum()))
            codes = np.concatenate((codes[bit == 0], codes[bit == 1]))

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of a level before each place."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][word] + np.bitwise_count(self.planes[level][word] & below)

    def rank(self, code: int, at: np.ndarray) -> np.ndarray:
        """How often ``code`` occurs before each place."""
        first, last = np.zeros(1, np.int64), np.asarray(at, np.int64)
        for level in range(len(self.planes)):
            if code >> (len(self.planes) - 1 - level) & 1:
                first, last = self.zeros[level] + self._ones(level, first), self.zeros[level] + self._ones(level, last)
            else:
                first, last = first - self._ones(level, first), last - self._ones(level, last)
        return last - first


_KIND = np.full(256, OTHER, np.uint8)
_KIND[0x80:0xC0] = CONTINUED
_KIND[ord("A") : ord("Z") + 1] = _KIND[ord("a") : ord("z") + 1] = WITHIN


def character_classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of each byte of texts that stand one after the other and begin at ``starts``."""
    kinds = _KIND[data]
    letter = kinds == WITHIN
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    here = starts[starts < len(data)]
    begins[here] = letter[here]
    kinds[begins] = STARTS
    return kinds


class Units:
    """Counts and cuts of a block of texts."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.first, self.last = bounds[:-1].astype(np.int64), bounds[1:].astype(np.int64)
        self._matrix = WaveletMatrix(character_classes(data, self.first))

    def begun(self, at: np.ndarray) -> np.ndarray:
        return self._matrix.rank(STARTS, at) + self._matrix.rank(OTHER, at)

    def number(self) -> np.ndarray:
        return self.begun(self.last) - self.begun(self.first)

    def chars(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (high - low) - (self._matrix.rank(CONTINUED, high) - self._matrix.rank(CONTINUED, low))

    def after(self, units: np.ndarray) -> np.ndarray:
        """The place after so many units of each text."""
        most = self.begun(self.first) + units
        low, high = self.first.copy(), self.last.copy()
        while (low < high).any():
            mid = (low + high + 1) >> 1
            fits = self.begun(mid) <= most
            low, high = np.where(fits, mid, low), np.where(fits, high, mid - 1)
        return low


def blocks(sizes: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``limit`` bytes; a longer row is a run of its own."""
    at = 0
    ends = np.cumsum(sizes)
    while at < len(sizes):
        before = ends[at] - sizes[at]
        until = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield at, until
        at = until


def _transform(batch: pa.RecordBatch, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    texts = batch.column("text").cast(pa.large_binary())
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    sizes = np.array([len(x.as_buffer()) for x in texts], np.int64)
    h1, h2, plain, spm = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "plain", "spm"))
    for low, high in blocks(sizes):
        raw = [texts[i].as_py() for i in range(low, high)]
        bounds = np.concatenate(([0], np.cumsum(sizes[low:high])))
        units = Units(np.frombuffer(b"".join(raw), np.uint8), bounds)
        n = units.number()
        a, b = h1[low:high] % (n + 1), h2[low:high] % (n + 1)
        first, second = units.after(np.minimum(a, b)), units.after(np.maximum(a, b))
        prefix_chars, middle_chars = units.chars(units.first, first), units.chars(first, second)
        forms, out = [], []
        for i, text in enumerate(raw):
            if plain[low + i] or not text or any(m in text for m in marks):
                forms.append("plain")
                out.append(text)
                continue
            p, m = int(first[i] - bounds[i]), int(second[i] - bounds[i])
            forms.append("spm" if spm[low + i] else "psm")
            parts = (marks[1], text[m:], marks[0], text[:p]) if spm[low + i] else (marks[0], text[:p], marks[1], text[m:])
            out.append(b"".join((*parts, marks[2], text[p:m])))
        cut = np.array([f == "plain" for f in forms], bool)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id").slice(low, high - low).cast(id_type), pa.array(n), pa.array(forms, pa.string()), pa.array(prefix_chars, mask=cut),
                pa.array(middle_chars, mask=cut), pa.array(out, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )


def _share(digest: Column, group: int) -> Column:
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("bigint")


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, rate: int = 90, spm_rate: int = 20
) -> DataFrame:
    """One row per input row: (doc_id, n, form, prefix_chars, middle_chars, output).

    A text is cut into ``n`` units, runs of the letters A to Z and a to z and single other characters. Two cuts and the form are drawn
    from the digest of ``seed:doc_id``, so reruns and repeated ids agree: ``rate`` percent are rearranged, of these
    ``spm_rate`` percent as suffix, prefix, middle and the others as prefix, suffix, middle. A null text is the empty text; empty texts
    and those that hold a mark stay plain, with null counts. A null id is drawn as an empty one. Ties cannot arise. An
    empty table gives an empty result. No other column is read. A text is held whole in its task, with about four times its bytes.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), digest.alias("digest")
    ).select(
        "id", "text", _share(F.col("digest"), 0).alias("h1"), _share(F.col("digest"), 1).alias("h2"),
        (_share(F.col("digest"), 2) % 100 >= rate).alias("plain"), (_share(F.col("digest"), 3) % 100 < spm_rate).alias("spm"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _transform(batch, batch.schema.field("id").type)

    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. No part holds a mark, so each mark is where it first occurs."""
    before = lambda text, mark: F.substring_index(text, mark, 1)
    after = lambda text, mark: F.substr(text, F.locate(mark, text) + len(mark))
    middle = after(output, MIDDLE)
    psm = F.concat(before(after(output, PREFIX), SUFFIX), middle, before(after(output, SUFFIX), MIDDLE))
    spm = F.concat(before(after(output, PREFIX), MIDDLE), middle, before(after(output, SUFFIX), PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = fill_in_middle(table(spark, sf_dir, "documents"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return got.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


SQL = r"""
with d as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units, sha256('1:' || doc_id) as x from documents),
h as (select *, len(units) as n, ('0x' || substr(x, 1, 8))::bigint as h1, ('0x' || substr(x, 9, 8))::bigint as h2,
  ('0x' || substr(x, 17, 8))::bigint as h3, ('0x' || substr(x, 25, 8))::bigint as h4 from d),
c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
  case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from h),
p as (select *, array_to_string(units[1:a], '') as pre, array_to_string(units[a + 1:b], '') as mid, array_to_string(units[b + 1:], '') as suf from c)
select doc_id, cast(n as bigint) as n, form, cast(case when form <> 'plain' then length(pre) end as bigint) as prefix_chars,
  cast(case when form <> 'plain' then length(mid) end as bigint) as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(text) as restored_sha256
from p
"""
