"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Documents become token ids; one of over ``capacity`` ids is cut into full pieces and a
first piece that may be shorter. Full pieces are sequences of their own; the others are
dealt by a hash into blocks, and each block is packed by a grouping genetic algorithm:

* an individual is a packing: a list of bins, each a list of pieces;
* crossover takes whole bins of one parent, the best filled first, injects them into the other, drops
  the other's bins that hold a piece again, and best-fits the displaced pieces;
* islands of a block evolve apart in separate tasks; between rounds each island's elite
  goes to the next island of the ring.

The result is the island elite with the fewest bins, then the best filled ones. A block with its bound of
pieces is the largest unit any task holds.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import table
from webloom.session import cut_lineage

BLOCK = 4_096  # pieces of a block, about
ISLANDS = 2
ROUNDS = 2
POPULATION = 4
CHILDREN = 4  # per island and round
INJECT = 0.5  # share of the donor's bins


# ---- tokens ---------------------------------------------------------------------------------

_ENCODER: dict[str, object] = {}


def encoder(vocabulary: str):
    """The byte-level BPE of a tokenizer file as a callable text -> ids, loaded once in a process.

    The vocabulary and merges are those of the ``tokenizers`` JSON file; its ranks are handed to the tiktoken
    engine, which gives the same ids several times faster. An added token of the file that stands in a text gets its own id, as there.
    """
    if vocabulary not in _ENCODER:
        import json

        import public_tokenizers
        import tiktoken

        with open(vocabulary, encoding="utf-8") as f:
            made = json.load(f)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        special = {x["content"]: x["id"] for x in made.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in word): i for word, i in made["model"]["vocab"].items() if word not in special}
        engine = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        _ENCODER[vocabulary] = engine.encode_to_numpy
    return _ENCODER[vocabulary]


def _encode(encode, text: str) -> np.ndarray:
    try:
        return encode(text, allowed_special="all")
    except UnicodeEncodeError:  # a lone surrogate cannot come from Parquet; kept for other callers
        return encode(text.encode("utf-16", "surrogatepass").decode("utf-16", "replace"), allowed_special="all")


def pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, doc_row) of every document."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            at, out = [], [[], [], [], []]
            for i, text in enumerate(batch.column("text")):
                ids = np.append(_encode(encode, text.as_py() or ""), end_id).astype("<u4")
                start = 0
                end = len(ids) % capacity or min(capacity, len(ids))
                while start < len(ids):
                    for column, value in zip(out, (len(at) and start and out[0][-1] + 1, start, end - start, zlib.crc32(ids[start:end].tobytes())), strict=True):
                        column.append(value)
                    at.append(i)
                    start, end = end, end + capacity
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(at, pa.int64())), batch.column("row").take(pa.array(at, pa.int64())),
                 pa.array(out[0], pa.int32()), *[pa.array(c, pa.int64()) for c in out[1:]]],
                names=["doc_id", "doc_row", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(cut, f"doc_id {id_type}, doc_row long, piece int, start long, length long, ids_crc32 long")


# ---- the genetic algorithm ------------------------------------------------------------------


def best_fit(bins: list[list[int]], order: list[int], sizes: list[int], capacity: int) -> list[list[int]]:
    """Put pieces, in ``order``, each into the fullest bin it fits; open a new bin when there is none."""
    free = sorted((capacity - sum(sizes[i] for i in b), k) for k, b in enumerate(bins))
    for i in order:
        at = bisect_left(free, (sizes[i], -1))
        if at == len(free):
            bins.append([i])
            room, k = capacity, len(bins) - 1
        else:
            room, k = free.pop(at)
            bins[k].append(i)
        if room > sizes[i]:
            insort(free, (room - sizes[i], k))
    return bins


def fitness(bins: list[list[int]], sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first; then bins as unequally filled as can be, as that leaves usable room."""
    return len(bins), -sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(taker: list[list[int]], giver: list[list[int]], sizes: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """Inject well-filled whole bins of ``giver`` into ``taker`` and best-fit what they displace."""
    ranked = sorted(giver, key=lambda b: (-sum(sizes[i] for i in b), rng.random()))
    injected = [list(b) for b in ranked[: max(1, int(len(ranked) * INJECT * rng.uniform(0.6, 1.0)))]]
    there = {i for b in injected for i in b}
    kept, displaced = injected, []
    for b in taker:
        if there.isdisjoint(b):
            kept.append(list(b))
        else:
            displaced.extend(i for i in b if i not in there)
    displaced.sort(key=lambda i: -sizes[i])
    return best_fit(kept, displaced, sizes, capacity)


def evolve(sizes: list[int], capacity: int, seed: int, guests: list[list[list[int]]], children: int = CHILDREN) -> list[list[int]]:
    """The elite of one island after a round; ``guests`` are packings that join its population."""
    rng = random.Random(seed)
    everyone = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    least = -(-sum(sizes) // capacity)
    people = [[list(b) for b in g] for g in guests]
    while len(people) < POPULATION:
        noise = 0 if not people else capacity * 0.05 * len(people)
        order = everyone if not noise else sorted(everyone, key=lambda i: -(sizes[i] + rng.uniform(0, noise)))
        people.append(best_fit([], order, sizes, capacity))
        if len(people[-1]) == least:
            return people[-1]  # no packing has fewer bins
    people.sort(key=lambda p: fitness(p, sizes, capacity))
    for _ in range(children):
        a, b = rng.sample(range(len(people)), 2)
        child = crossover(people[a], people[b], sizes, capacity, rng)
        people.append(child)
        people.sort(key=lambda p: fitness(p, sizes, capacity))
        people.pop()
        if len(people[0]) == least:
            break
    return people[0]


def pack(short: DataFrame, capacity: int, seed: int = 7) -> DataFrame:
    """(item, bin, offset, block) of (item long, length long): the islands and their migration."""
    count = short.count()
    blocks = max(1, round(count / BLOCK))
    dealt = short.select("item", "length", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block"))
    settled = dealt.select("*", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"), F.lit(None).cast("int").alias("own"), F.lit(None).cast("int").alias("guest"))
    schema = "item long, length long, block int, island int, own int, guest int"

    def evolving(turn: int):
        def island(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("item", kind="stable").reset_index(drop=True)
            guests = []
            for column in ("own", "guest"):
                if part[column].notna().all():
                    bins: dict[int, list[int]] = {}
                    for i, b in enumerate(part[column].tolist()):
                        bins.setdefault(int(b), []).append(i)
                    guests.append(list(bins.values()))
            mark = f"{seed} {turn} {part['block'].iloc[0]} {part['island'].iloc[0]}"
            best = evolve(part["length"].tolist(), capacity, zlib.crc32(mark.encode()), guests)
            own = np.zeros(len(part), dtype="int32")
            for k, b in enumerate(best):
                own[b] = k
            part["own"] = own
            part["guest"] = None
            return part

        return island

    for turn in range(ROUNDS):
        settled = cut_lineage(settled.groupBy("block", "island").applyInPandas(evolving(turn), schema), "islands")
        if turn + 1 < ROUNDS:  # the elite goes on to the next island of the ring
            moved = settled.select("item", "block", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("own").alias("_guest"))
            settled = settled.join(moved, ["item", "block", "island"]).select("item", "length", "block", "island", "own", F.col("_guest").alias("guest"))
    fills = settled.groupBy("block", "island", "own").agg(F.sum("length").alias("fill"))
    score = fills.groupBy("block", "island").agg(F.count(F.lit(1)).alias("bins"), F.sum(-F.col("fill") * F.col("fill")).alias("rest"))
    best = score.groupBy("block").agg(F.min(F.struct("bins", "rest", "island"))["island"].alias("island"))
    from pyspark.sql import Window

    inside = Window.partitionBy("block", "own").orderBy(F.col("length").desc(), "item").rowsBetween(Window.unboundedPreceding, -1)
    return settled.join(best, ["block", "island"]).select(
        "item", "block", F.col("own").alias("bin"), F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset")
    )


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    ``vocabulary`` is the path of a byte-level BPE JSON file, at the same place on every machine.
    A null text is the empty text and is packed as its end id alone. A null id is carried along, and rows repeated
    whole are packed as often as they occur. Texts of any length are cut, none is shortened. An empty table
    gives an empty result. Sequence numbers are unique and reproducible, not dense. Other columns are not read.
    """
    made = pieces(docs, vocabulary, capacity, end_id, id_col, text_col)
    made = cut_lineage(made.withColumn("item", F.monotonically_increasing_id()), "pieces")
    placed = pack(made.where(F.col("length") < capacity), capacity)
    numbered = placed.select("item", (F.shiftleft(F.col("block").cast("bigint"), 20) + F.col("bin")).alias("_short"), "offset")
    return made.join(numbered, "item", "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        # short sequences are even, full pieces odd numbers
        F.coalesce(F.col("_short") * 2, F.col("item") * 2 + 1).alias("sequence_id"),
        F.coalesce(F.col("offset"), F.lit(0)).cast("bigint").alias("offset"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
