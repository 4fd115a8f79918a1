"""Near-duplicate vectors by sorted projection passes.

1. Vectors that are bit for bit the same are one vector with a count.
2. In every pass a vector gets a key of the signs of some random projections, and all vectors are sorted by the key, spread
   over many tasks. All vectors with one key are compared with each other, however many they are; a key that goes
   over the end of a task's rows is compared in a second step, every two tasks' rows of it in a task of their own.
3. Verified links of all passes are unioned to components. Only links that join something go on, as the others
   cannot change a component.
4. Inside a component all vectors are compared, block by block in many tasks, to count each one's links: the count
   does not depend on which passes found which link.

The number of passes follows from the number of signs in a key, so that a pair right at the threshold is missed with a
probability below ``MISS``: it has one key in a pass with the probability (1 - angle / pi) for each sign, whatever the other vectors are. The
number of signs follows from the density measured on a sample: more signs part dense clumps, fewer need fewer passes. It only
changes the cost. Inside a clump that no sign parts the work grows with the square of its vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import table
from webloom.llm.components import components
from webloom.session import cut_lineage

NEIGHBOURS = 32
MISS = 1e-3
TASK_ROWS = 20_000
SAMPLE = 2_000  # vectors on which the density is measured
ROW_COST = 500  # of projecting and sorting a vector in a pass, in comparisons
MOST_SIGNS = 40
BLOCK = 512


def passes_for(n: int, threshold: float, signs: float | None = None) -> int:
    """Passes with keys of ``signs`` signs; by default as many as narrow ``n`` evenly spread rows to NEIGHBOURS."""
    signs = max(0.0, math.log2(max(n, 1) / NEIGHBOURS)) if signs is None else signs
    together = (1 - math.acos(threshold) / math.pi) ** signs
    return 1 if together >= 1 else math.ceil(math.log(MISS) / math.log(1 - together))


def signs_for(n: int, threshold: float, sample: list[np.ndarray]) -> int:
    """The number of signs with the least cost, by how often pairs of the ``sample`` (unit vectors by dimension) agree in a sign."""
    agree = [1 - np.arccos(np.clip(x @ x.T, -1, 1))[np.triu_indices(len(x), 1)] / math.pi for x in sample]
    pairs = np.concatenate(agree) if agree else np.zeros(0)
    most = math.ceil(max(0.0, math.log2(max(n, 1) / NEIGHBOURS)))
    if not len(pairs):
        return most
    costs = [passes_for(n, threshold, k) * (ROW_COST + n / 2 * float((pairs**k).mean())) for k in range(min(MOST_SIGNS, 2 * most) + 1)]
    return int(np.argmin(costs))


def planes(turn: int, dimension: int) -> np.ndarray:
    return np.random.default_rng([turn, dimension]).normal(size=(dimension, 64))


def unit(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def key_links(x: np.ndarray, keys: np.ndarray, threshold: float, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join something between rows with one key, which stand together; with ``sides`` only between two sides."""
    n, step, out = len(x), 256, []
    label = np.arange(n)
    for a in range(0, n, step):
        last = keys[min(n, a + step) - 1]
        for b in range(a, n, step):
            if b > a and keys[b] != last:
                break
            p, q = slice(a, a + step), slice(b, b + step)
            hit = (x[p] @ x[q].T >= threshold) & (keys[p][:, None] == keys[q][None, :])
            if sides is not None:
                hit &= sides[p][:, None] != sides[q][None, :]
            while True:
                left = hit & (label[p][:, None] != label[q][None, :])
                rows = np.flatnonzero(left.any(axis=1))
                if not len(rows):
                    break
                for i, j in zip((rows + a).tolist(), (left[rows].argmax(axis=1) + b).tolist(), strict=True):
                    if label[i] != label[j]:
                        label[label == label[j]] = label[i]
                        out.append((i, j))
    return out


def _vectors(table_: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, str]:
    """(id, vec, dim) of the usable rows, and the numpy type of the bytes in ``vec``."""
    kind = "<f4" if table_.schema[vector_col].dataType.elementType.simpleString() == "float" else "<f8"
    id_type = table_.schema[id_col].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, vecs = [], []
            for i, v in enumerate(batch.column("v")):
                if v.is_valid and len(v.values) and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False).astype(kind)
                    norm = np.linalg.norm(x.astype(np.float64))
                    if np.isfinite(norm) and norm > 0:
                        at.append(i)
                        vecs.append(x.tobytes())
            size = np.dtype(kind).itemsize
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(at, pa.int64())), pa.array(vecs, pa.binary()), pa.array([len(v) // size for v in vecs], pa.int32())],
                names=["id", "vec", "dim"],
            )

    rows = table_.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    return rows.mapInArrow(pack, f"id {id_type}, vec binary, dim int"), kind


def linked(vectors: DataFrame, kind: str, threshold: float) -> DataFrame:
    """(a, b): verified links found by the passes, enough of them to hold every component together."""
    spark, n = vectors.sparkSession, vectors.count()
    # at most SAMPLE vectors, the lowest in a hash of the id
    some = vectors.orderBy(F.xxhash64("id", F.lit("density"))).limit(SAMPLE).select("vec", "dim").toPandas()
    signs = signs_for(n, threshold, [unit(g["vec"].tolist(), kind) for _, g in some.groupby("dim")])
    turns = passes_for(n, threshold, signs)
    parts = max(1, n * turns // TASK_ROWS)
    id_type = vectors.schema["id"].dataType.simpleString()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                mine = batch.filter(pa.array(dims == dim))
                x = unit(mine.column("vec").to_pylist(), kind)
                for turn in range(turns):
                    bits = (x @ planes(turn, int(dim))[:, :signs] > 0).astype(np.uint64)
                    key = (bits * weights[:signs]).sum(axis=1, dtype=np.uint64).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), turn, dtype=np.int32)), pa.array(key), *[mine.column(c) for c in ("id", "vec", "dim")]],
                        names=["turn", "key", "id", "vec", "dim"],
                    )

    laid = vectors.mapInArrow(project, f"turn int, key long, id {id_type}, vec binary, dim int").repartitionByRange(parts, "turn", "dim", "key", "id").sortWithinPartitions(
        "turn", "dim", "key", "id"
    )
    schema = f"part int, a {id_type}, b {id_type}, turn int, dim int, key long, vec binary"

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []
        first = True

        def edge(t: pa.Table) -> pa.RecordBatch:
            m = t.num_rows
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * m, pa.int32()), t.column("id").combine_chunks(), pa.nulls(m, t.schema.field("id").type), *[t.column(c).combine_chunks() for c in ("turn", "dim", "key", "vec")]],
                names=["part", "a", "b", "turn", "dim", "key", "vec"],
            )

        for batch in chain(batches, [None]):
            if batch is not None:
                if not batch.num_rows:
                    continue
                held.append(batch)
            if not held:
                continue
            whole = pa.Table.from_batches(held)
            names = [whole.column(c).to_numpy() for c in ("turn", "dim", "key")]
            new = np.flatnonzero(np.any([v[1:] != v[:-1] for v in names], axis=0)) + 1
            end = whole.num_rows if batch is None else int(new[-1]) if len(new) else 0
            held = whole.slice(end).to_batches()
            if not end:
                continue
            start_of_last = int(new[-1]) if len(new) else 0
            if first:
                to = int(new[0]) if len(new) else end
                yield edge(whole.slice(0, to))
                if batch is None and to < end:
                    yield edge(whole.slice(start_of_last))
            elif batch is None:
                yield edge(whole.slice(start_of_last))
            first = False
            keys = np.zeros(whole.num_rows, dtype=np.int64)
            keys[new] = 1
            keys, ids = np.cumsum(keys)[:end], whole.column("id").combine_chunks()
            for dim in np.unique(names[1][:end]):
                at = np.flatnonzero(names[1][:end] == dim)
                links = key_links(unit(whole.column("vec").take(pa.array(at)).to_pylist(), kind), keys[at], threshold)
                if links:
                    i, j = (pa.array(at[list(side)]) for side in zip(*links, strict=True))
                    m, none = len(links), pa.int32()
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(m, none), ids.take(i), ids.take(j), pa.nulls(m, none), pa.nulls(m, none), pa.nulls(m, pa.int64()), pa.nulls(m, whole.schema.field("vec").type)],
                        names=["part", "a", "b", "turn", "dim", "key", "vec"],
                    )

    swept = cut_lineage(laid.mapInArrow(sweep, schema), "swept")
    inside = swept.where("part is null").select("a", "b")
    # keys in several tasks: every two tasks' rows of a key meet
    edge = swept.where("part is not null").select("part", F.col("a").alias("id"), "turn", "dim", "key", "vec")
    spread = edge.groupBy("turn", "dim", "key").agg(F.array_sort(F.collect_set("part")).alias("all")).where(F.size("all") > 1)
    met = edge.join(spread, ["turn", "dim", "key"]).withColumn("other", F.explode("all")).where("other <> part").select(
        "turn", "dim", "key", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "part", "id", "vec"
    )

    def join_seam(rows: pd.DataFrame) -> pd.DataFrame:
        ids, same = rows["id"].tolist(), np.zeros(len(rows), dtype=np.int64)
        links = key_links(unit(rows["vec"].tolist(), kind), same, threshold, rows["part"].to_numpy())
        return pd.DataFrame([(ids[i], ids[j]) for i, j in links], columns=["a", "b"])

    across = met.groupBy("turn", "dim", "key", "x", "y").applyInPandas(join_seam, f"a {id_type}, b {id_type}")
    return inside.unionByName(across).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def count_links(members: DataFrame, kind: str, threshold: float) -> DataFrame:
    """(id, n) of (component, id, vec, copies): copies of other vectors of the component that a vector is linked to."""
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    dealt = members.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = dealt.select("component", "id", "vec", "copies", "own", other.alias("other")).select(
        "component", "id", "vec", "copies", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")
    )
    many = max(1, met.count() // 4_000)
    id_type = members.schema["id"].dataType.simpleString()

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        out_ids, out_n = [], []
        for (_, x, y), block in rows.groupby(["component", "x", "y"], sort=False):
            vecs, copies, own, ids = unit(block["vec"].tolist(), kind), block["copies"].to_numpy(), block["own"].to_numpy(), block["id"].to_numpy()
            if x == y:
                hit = vecs @ vecs.T >= threshold
                np.fill_diagonal(hit, False)
                out_ids.append(ids)
                out_n.append(hit @ copies)
            else:
                p, q = own == x, own == y
                hit = vecs[p] @ vecs[q].T >= threshold
                out_ids += [ids[p], ids[q]]
                out_n += [hit @ copies[q], hit.T @ copies[p]]
        return pd.DataFrame({"id": np.concatenate(out_ids), "n": np.concatenate(out_n).astype(np.int64)})

    counted = met.withColumn("_task", F.pmod(F.xxhash64("component", "x", "y"), F.lit(many))).groupBy("_task").applyInPandas(
        lambda rows: count(rows), f"id {id_type}, n long"
    )
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """One row per input row: (vec_id, n_links, component_id, kept).

    Two rows are linked when the cosine of their vectors, in double precision, is at least ``threshold``. ``n_links`` counts the other
    rows a row is linked to, ``component_id`` is the least id that links reach, and the row with that id is kept. A vector that is null, empty
    or zero or has null or non-finite parts links with nothing, nor do vectors of different length; a row with a null id stands alone with a null component
    and is kept. Rows repeated with one id and vector count as linked copies. An empty table gives an empty result. Other columns are not read.
    """
    usable, kind = _vectors(vectors, id_col, vector_col)
    packed = cut_lineage(usable, "vectors")
    same = packed.groupBy("vec").agg(F.min("id").alias("id"), F.first("dim").alias("dim"), F.count(F.lit(1)).alias("copies"))
    single = cut_lineage(same, "distinct")
    links = linked(single.select("id", "vec", "dim"), kind, threshold)
    groups = cut_lineage(components(links), "groups")
    inside = single.join(groups, "id")
    counted = count_links(inside.select("component", "id", "vec", "copies"), kind, threshold)
    facts = single.join(groups, "id", "left").join(counted, "id", "left").select(
        "vec", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")
    )
    known = packed.select("id", "vec").join(facts, "vec").groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component").alias("component"))
    out = vectors.select(F.col(id_col).alias("vec_id")).join(known, F.col("vec_id") == F.col("id"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        (F.col("vec_id").isNull() | (component == F.col("vec_id"))).alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
