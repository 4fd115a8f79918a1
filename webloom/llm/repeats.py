"""Removal of repeated passages: interval expansion on a Burrows-Wheeler transform, bounded by the least length.

A byte goes when a string of ``length`` bytes that covers it starts at another place too.

1. Every string of ``length`` bytes is named by its smallest hashed substring of ``anchor`` bytes, so equal strings have one
   name. Starts next to each other with one name are a run; the bytes its strings cover are its context.
   Runs whose name occurs once cannot be repeated. Runs with equal contexts are merged into one with a count, as all their
   starts are repeated.
2. What is left, different contexts under one name, is concatenated name by name, and a task builds the suffix array and
   from it the Burrows-Wheeler transform of about half a megabyte at once. From the interval of the empty string, intervals are
   extended backwards by one byte breadth first; an interval that ends at a place whose common prefix is still open settles it
   with the value of the level and goes on (Beller, Gog, Ohlebusch and Schnattinger, 2013). The expansion stops at ``length``: what is
   open then is a common prefix of at least that many bytes, so both suffixes beside it are repeated.
3. The repeated starts of a text are unioned to spans, which are cut out.

A name with over ``LIMIT`` different contexts (one passage at the rim of very many documents) is not brought
together: its starts are compared by a 128-bit hash of their ``length`` bytes instead, spread over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import table
from webloom.llm.near_dedup import _chunks, _mix, _Powers
from webloom.session import cut_lineage

LENGTH = 200
LIMIT = 20_000
BATCH = 1 << 19  # bytes of contexts in one transform, about
_TOP = np.iinfo(np.uint64).max


def anchor_of(length: int) -> int:
    return max(1, length * 8 // 25)


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums whose differences, moved by the second array, are hashes of substrings."""
    up, down = _Powers.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums, down


def runs_of(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(name, context hash, start, starts) of all runs in concatenated texts with the given ends."""
    n, k = len(data), anchor_of(length)
    if n < length:
        return tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    sums, down = prefix_hashes(data)
    wide, m = length - k + 1, n - k + 1
    # least (hash, place) in a sliding window, from the running minima of blocks to both sides; of equal hashes the
    # first place counts, so a passage that repeats itself makes many runs of one name
    blocks, bits = -(-m // wide), np.uint64(max(24, m.bit_length()))
    whole = _mix((sums[k:] - sums[:m]) * down[:m])
    h = np.full(blocks * wide, _TOP, dtype=np.uint64)
    h[:m] = (whole >> bits << bits) | np.arange(m, dtype=np.uint64)
    h = h.reshape(blocks, wide)
    count = n - length + 1
    least = np.minimum(
        np.minimum.accumulate(h[:, ::-1], axis=1)[:, ::-1].ravel()[:count], np.minimum.accumulate(h, axis=1).ravel()[wide - 1 : wide - 1 + count]
    )
    place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    long_ = ends - begins >= length
    inside = np.zeros(count + 1, dtype=np.int32)
    inside[begins[long_]] = 1
    np.subtract.at(inside, ends[long_] - length + 1, 1)
    inside = np.cumsum(inside)[:count] > 0
    first = np.ones(count, dtype=bool)
    first[1:] = place[1:] != place[:-1]
    first[begins[long_]] = True
    first &= inside
    breaks = np.flatnonzero(first | ~inside)
    start = np.flatnonzero(first)
    size = np.append(breaks, count)[np.searchsorted(breaks, start) + 1] - start
    end = start + size + length - 1
    return whole[place[start]], _mix((sums[end] - sums[start]) * down[start] + size.astype(np.uint64)), start, size


# ---- the transform --------------------------------------------------------------------------


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Order of the rotations of ``text`` by at least their first ``depth`` symbols, by prefix doubling."""
    n = len(text)
    key = np.zeros(n, dtype=np.uint64)
    wide = np.concatenate([text, text[: min(8, n)]]) if n >= 8 else np.tile(text, 9)
    for j in range(8):
        key = key << np.uint64(8) | wide[j : j + n].astype(np.uint64)
    reach = 8
    order = np.argsort(key)
    while True:
        ranked = key[order]
        new = np.ones(n, dtype=bool)
        new[1:] = ranked[1:] != ranked[:-1]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(new) - 1
        if reach >= depth or new.all():
            return order
        key = rank * n + np.roll(rank, -reach)
        order = np.argsort(key)
        reach *= 2


def open_prefixes(order: np.ndarray, transform: np.ndarray, length: int) -> np.ndarray:
    """For each place of the suffix order, whether its common prefix with the place before has at least ``length`` symbols.

    Breadth-first backward extension: level by level the queue holds intervals of strings of that length.
    """
    n = len(transform)
    by_symbol = np.argsort(transform, kind="stable")
    step = np.empty(n, dtype=np.int64)  # the place an extension by its own symbol leads to
    step[by_symbol] = np.arange(n)
    following = np.full(n, n, dtype=np.int64)  # next place with the same symbol
    same = transform[by_symbol[1:]] == transform[by_symbol[:-1]]
    following[by_symbol[:-1][same]] = by_symbol[1:][same]
    sorted_keys = transform[by_symbol].astype(np.int64) * n + by_symbol
    is_open = np.ones(n + 1, dtype=bool)
    is_open[0] = is_open[n] = False
    low, high = np.array([0]), np.array([n - 1])
    for _ in range(length):
        size = high - low + 1
        one = size == 1
        # intervals of one place have one extension
        to_one = step[low[one]]
        fresh_one = to_one[is_open[to_one + 1]]
        lo, hi, size = low[~one], high[~one], size[~one]
        total = int(size.sum())
        if total:
            owner = np.repeat(np.arange(len(lo)), size)
            place = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + lo[owner]
            last = following[place] > hi[owner]  # the last of its symbol in the interval
            place, owner = place[last], owner[last]
            to = step[place]
            fresh = is_open[to + 1]
            place, owner, to = place[fresh], owner[fresh], to[fresh]
            begin = np.searchsorted(sorted_keys, transform[place].astype(np.int64) * n + lo[owner])
        else:
            to = begin = np.zeros(0, dtype=np.int64)
        low, high = np.concatenate([fresh_one, begin]), np.concatenate([fresh_one, to])
        is_open[high + 1] = False
        if not len(low):
            break
    return is_open[:n]


def repeated_starts(contexts: list[bytes], sizes: np.ndarray, length: int) -> np.ndarray:
    """Whether each start of each context (its first ``size`` places) is repeated in any of the contexts, one after another."""
    ends = np.cumsum([len(c) + 1 for c in contexts])
    joined = np.frombuffer(b"\0".join(contexts) + b"\0", dtype=np.uint8)
    order = suffix_array(joined, length)
    opened = open_prefixes(order, joined[order - 1], length)
    beside = opened.copy()
    beside[:-1] |= opened[1:]
    repeated = np.zeros(len(joined), dtype=bool)
    repeated[order] = beside
    begins = np.concatenate([[0], ends[:-1]])
    at = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    return repeated[at]


# ---- on tables ------------------------------------------------------------------------------


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("key"), text, F.octet_length(text)).alias("k2")]


def _runs(texts: DataFrame, length: int) -> DataFrame:
    """(name, context, k1, k2, start, size, times): runs of all texts; equal contexts that meet in a batch are known to be repeated.

    Of these, one row with ``times`` 2 stands for the context, the others are rows with ``times`` 0 under names that spread.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            parts = []
            for at, data, ends in _chunks(batch.column("text")):
                name, context, start, size = runs_of(data, ends, length)
                if len(name):
                    row = np.searchsorted(ends, start, side="right")
                    begins = np.concatenate([[0], ends[:-1]])
                    parts.append((name, context, row + at, start - begins[row], size))
            if not parts:
                continue
            name, context, row, start, size = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((name, context))
            twin = np.zeros(len(name), dtype=bool)
            twin[1:] = (context[order[1:]] == context[order[:-1]]) & (name[order[1:]] == name[order[:-1]])
            times = np.ones(len(name), dtype=np.int8)
            times[order[np.flatnonzero(twin)]] = 0
            lead = order[np.flatnonzero(~twin & np.append(twin[1:], False))]
            times[lead] = 2
            spread = times == 0
            name[spread] = _mix(k1[row[spread]].view(np.uint64) + start[spread].astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(name.view(np.int64)), pa.array(context.view(np.int64)), pa.array(k1[row]), pa.array(k2[row]),
                 pa.array(start << 24 | size), pa.array(times)],
                names=["name", "context", "k1", "k2", "run", "times"],
            )

    return texts.select("k1", "k2", "text").mapInArrow(find, "name long, context long, k1 long, k2 long, run long, times tinyint")


def _met(runs: DataFrame) -> DataFrame:
    """Runs sorted by name: ``repeated`` ones, whose context occurs again, and one row per context of names with several."""

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        before: int | None = None

        def emit(t: pa.Table, before: int | None, after: int | None) -> pa.RecordBatch:
            """``t`` holds whole contexts; ``before`` and ``after`` are the names around it."""
            name, context, times = (t.column(c).to_numpy() for c in ("name", "context", "times"))
            known = times == 0
            new = np.ones(len(name), dtype=bool)
            new[1:] = (name[1:] != name[:-1]) | (context[1:] != context[:-1]) | known[1:] | known[:-1]
            begin = np.flatnonzero(new)
            count = np.add.reduceat(times.astype(np.int64), begin)
            group = np.cumsum(new) - 1
            repeated = known | (count[group] >= 2)
            names = name[begin]
            several = np.zeros(len(begin), dtype=bool)
            several[1:] |= names[1:] == names[:-1]
            several[:-1] |= names[1:] == names[:-1]
            several[0] |= names[0] == before
            several[-1] |= names[-1] == after
            several &= ~known[begin]
            take = np.concatenate([np.flatnonzero(repeated), begin[several]])
            flag = np.concatenate([np.zeros(int(repeated.sum()), dtype=np.int8), np.minimum(count[several], 2).astype(np.int8)])
            picked = t.take(pa.array(take)).combine_chunks()
            return pa.RecordBatch.from_arrays(
                [*[picked.column(c).combine_chunks() for c in ("name", "context", "k1", "k2", "run")], pa.array(flag)],
                names=["name", "context", "k1", "k2", "run", "kind"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            name, context = whole.column("name").to_numpy(), whole.column("context").to_numpy()
            other = np.flatnonzero((name != name[-1]) | (context != context[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield emit(whole.slice(0, cut), before, int(name[-1]))
                before = int(name[cut - 1])
            held = whole.slice(cut)
        if held is not None:
            yield emit(held, before, None)

    laid = runs.repartition("name").sortWithinPartitions("name", "context")
    return laid.mapInArrow(sift, "name long, context long, k1 long, k2 long, run long, kind tinyint")


def _spans(flags: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, first, number) of the runs of True in flags that are laid out context by context."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inner = np.arange(len(flags)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    opens = flags.copy()
    opens[1:] &= ~flags[:-1] | (owner[1:] != owner[:-1])
    closes = flags.copy()
    closes[:-1] &= ~flags[1:] | (owner[1:] != owner[:-1])
    a, b = np.flatnonzero(opens), np.flatnonzero(closes)
    return owner[a], inner[a], b - a + 1


def _expanded(contexts: DataFrame, length: int) -> DataFrame:
    """(k1, k2, run) of repeated starts in (name, k1, k2, run, kind, bytes)."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def work(t: pa.Table) -> pa.RecordBatch:
            kind, run = t.column("kind").to_numpy(), t.column("run").to_numpy()
            start, sizes = run >> 24, run & 0xFFFFFF
            flags = repeated_starts(t.column("bytes").to_pylist(), sizes, length)
            owner, first, number = _spans(flags, sizes)
            keep = kind[owner] == 1  # starts of contexts that occur again are known already
            owner, first, number = owner[keep], first[keep], number[keep]
            at = pa.array(owner)
            return pa.RecordBatch.from_arrays(
                [t.column("k1").take(at).combine_chunks(), t.column("k2").take(at).combine_chunks(), pa.array((start[owner] + first) << 24 | number)], names=["k1", "k2", "run"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.column("bytes").nbytes
            if size < BATCH:
                continue
            whole = pa.Table.from_batches(held)
            name = whole.column("name").to_numpy()
            weight = np.cumsum([len(b) for b in whole.column("bytes").to_pylist()])
            bounds = np.append(np.flatnonzero(np.append(False, name[1:] != name[:-1])), len(name))
            done = 0
            while True:  # whole names of about BATCH bytes; the last name may go on
                limit = (weight[done - 1] if done else 0) + BATCH
                ready = bounds[(bounds > done) & (bounds < len(name))]
                full = ready[weight[ready - 1] >= limit] if len(ready) else ready
                if not len(full):
                    break
                yield work(whole.slice(done, int(full[0]) - done))
                done = int(full[0])
            rest = whole.slice(done)
            held = rest.to_batches()
            size = int(weight[-1] - (weight[done - 1] if done else 0)) if rest.num_rows else 0
        if held:
            yield work(pa.Table.from_batches(held))

    laid = contexts.repartition("name").sortWithinPartitions("name")
    return laid.select("name", "k1", "k2", "run", "kind", "bytes").mapInArrow(expand, "k1 long, k2 long, run long")


def _hashed(contexts: DataFrame, length: int) -> DataFrame:
    """The same for names with very many contexts: starts whose ``length`` bytes have a hash that occurs again."""

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (raw, run) in enumerate(zip(batch.column("bytes").to_pylist(), batch.column("run").to_pylist(), strict=True)):
                size = run & 0xFFFFFF
                names = [hashlib.blake2b(raw[j : j + length], digest_size=16).digest() for j in range(size)]
                one = batch.slice(i, 1)
                at = pa.array([0] * size, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [one.column("k1").take(at), one.column("k2").take(at), pa.array([(run >> 24) + j << 24 | 1 for j in range(size)], pa.int64()), pa.array(names, pa.binary()),
                     one.column("kind").take(at)],
                    names=["k1", "k2", "run", "hash", "kind"],
                )

    each = contexts.select("k1", "k2", "run", "kind", "bytes").mapInArrow(starts, "k1 long, k2 long, run long, hash binary, kind tinyint")
    many = each.groupBy("hash").agg(F.sum("kind").alias("n")).where("n > 1").select("hash")
    return each.join(many, "hash", "left_semi").select("k1", "k2", "run")


def repeated_runs(texts: DataFrame, length: int, limit: int = LIMIT) -> DataFrame:
    """(k1, k2, run): all repeated starts of ``texts`` (k1, k2, text), a run being start << 24 | number of starts."""
    met = cut_lineage(_met(_runs(texts, length)), "runs")
    known = met.where("kind = 0").select("k1", "k2", "run").distinct()
    several = met.where("kind > 0")
    # a name needs a context that is not known to be repeated, and another beside it
    names = several.groupBy("name").agg(F.min("kind").alias("least"), F.count(F.lit(1)).alias("n")).where("least = 1 and n > 1")
    wanted = several.join(names, "name").select("name", "n", "k1", "k2", F.struct("run", "kind").alias("r"))
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("name", "n", "r")).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
            out: list[list] = [[] for _ in range(7)]
            for i, (text, runs) in enumerate(zip(batch.column("text"), batch.column("runs"), strict=True)):
                raw = text.as_py().encode("utf-8")
                for x in runs.as_py():
                    run = x["r"]["run"]
                    start, size = run >> 24, run & 0xFFFFFF
                    for column, value in zip(out, (x["name"], x["n"], k1[i], k2[i], run, x["r"]["kind"], raw[start : start + size + length - 1]), strict=True):
                        column.append(value)
            kinds = [pa.int64()] * 5 + [pa.int8(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["name", "n", "k1", "k2", "run", "kind", "bytes"])

    one_each = texts.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    contexts = cut_lineage(
        one_each.join(lists, ["k1", "k2"]).mapInArrow(cut, "name long, n long, k1 long, k2 long, run long, kind tinyint, bytes binary"), "contexts"
    )
    found = _expanded(contexts.where(F.col("n") <= limit), length)
    if not contexts.where(F.col("n") > limit).isEmpty():
        found = found.unionByName(_hashed(contexts.where(F.col("n") > limit), length))
    return known.unionByName(found)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, limit: int = LIMIT) -> DataFrame:
    """One row per input row: (doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256).

    Texts are UTF-8 bytes, null is empty; matches never cross texts, and strings are judged on the input. ``kept`` is the binary
    rest (a cut may fall inside a character). Texts shorter than ``length`` stay whole. Whole copies of a text
    that is long enough go all, as their strings start elsewhere too. Ids may be null or repeated, and rows repeated whole are
    copies. An empty table gives an empty result. Other columns are not read.
    """
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), body.alias("text")).select("doc_id", "text", *_text_key(F.col("text")))
    found = cut_lineage(repeated_runs(rows.select("k1", "k2", "text"), length, limit), "repeated")
    lists = found.groupBy("k1", "k2").agg(F.collect_list("run").alias("runs"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for text, runs in zip(batch.column("text"), batch.column("runs"), strict=True):
                raw = text.as_py().encode("utf-8")
                spans: list[list[int]] = []
                for run in sorted(runs.as_py() or []):
                    a = run >> 24
                    b = a + (run & 0xFFFFFF) - 1 + length
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(b, spans[-1][1])
                    else:
                        spans.append([a, b])
                kept, at = [], 0
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                rest = b"".join([*kept, raw[at:]]) if spans else raw
                for column, value in zip(out, (len(raw), len(raw) - len(rest), len(spans), rest, hashlib.sha256(rest).hexdigest()), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()), strict=True)]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.join(lists, ["k1", "k2"], "left").select("doc_id", "text", "runs").mapInArrow(
        apply, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir, "documents")).drop("kept")
