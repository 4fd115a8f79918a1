"""Latent semantic topics: a truncated singular value decomposition of TF-IDF rows, as tables throughout.

Neither the vocabulary nor a vector over it is ever on the driver, and vectors over the vocabulary, of which a term takes one number
a vector, are never kept: those of a pass are over the texts. The entries are written once, packed in groups of texts as the tasks
read them. A product adds up a group's texts by term, sends one vector for every term that other groups have too, gets the sums
back and adds them up by text. What the driver sees are the inner products of a few vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.scale import global_index, top_per_group
from webloom.session import cut_bucketed, cut_lineage, discard, free_shuffles

#: Vectors beyond the wanted ones in a block, and products per pass: both only decide how fast the passes converge.
SPARE, DEPTH = 6, 6
#: Words of a group of texts, about: what one task multiplies at once.
SPLIT = 8_000_000


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, width)


def _vectors(row: pa.ListScalar, width: int) -> np.ndarray:
    return row.values.to_numpy().reshape(-1, width)


def _product(entries: DataFrame, needed: DataFrame, block: DataFrame, width: int) -> DataFrame:
    """The block (t, v) over the terms times the matrix and then its transpose; ``entries``: g, d, t, w; ``needed``: the t of each g.

    For callers that hold a block over the terms; the passes of ``singular_vectors`` hold theirs over the texts (``_multiplied``)."""

    def multiply(part: pa.Table, vectors: pa.Table) -> pa.Table:
        if not part.num_rows or not vectors.num_rows:
            return pa.table({"t": pa.array([], pa.int64()), "v": pa.array([], pa.list_(pa.float64()))})
        x = _matrix(vectors.column("v").combine_chunks(), width)
        terms = vectors.column("t").to_numpy()
        order = np.argsort(terms)
        at = order[np.searchsorted(terms[order], part.column("t").to_numpy())]
        _, text = np.unique(part.column("d").to_numpy(), return_inverse=True)
        w, out = part.column("w").to_numpy(), np.empty_like(x)
        for i in range(width):
            y = np.bincount(text, weights=w * x[at, i])
            out[:, i] = np.bincount(at, weights=w * y[text], minlength=len(x))
        offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * width)
        return pa.table({"t": pa.array(terms), "v": pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))})

    shipped = needed.join(block, "t").select("g", "t", "v")
    got = entries.groupBy("g").cogroup(shipped.groupBy("g")).applyInArrow(multiply, "t bigint, v array<double>")
    return got.groupBy("t").agg(F.array(*[F.sum(F.col("v")[i]) for i in range(width)]).alias("v"))


def _pack(**lists: pa.Array) -> bytes:
    row = pa.RecordBatch.from_arrays([pa.LargeListArray.from_arrays(pa.array([0, len(x)], pa.int64()), x) for x in lists.values()], names=list(lists))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(row)
    return sink.getvalue().to_pybytes()


def _unpack(packed: bytes) -> dict[str, pa.Array]:
    row = pa.ipc.open_stream(packed).read_all().to_batches()[0]
    return {name: row.column(name).flatten() for name in row.schema.names}


def _bags(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """(g, packed): groups of texts with about ``most`` words: their distinct words, and text, word and count of every entry."""

    def bag(number: int, texts: list[pa.Array]) -> pa.RecordBatch:
        coded = pa.concat_arrays([t.flatten().cast(pa.large_string()) for t in texts]).dictionary_encode()
        sizes = np.concatenate([t.value_lengths().fill_null(0).to_numpy() for t in texts])
        keys = np.repeat(np.arange(len(sizes)), sizes) * len(coded.dictionary) + coded.indices.to_numpy()
        keys, n = np.unique(keys, return_counts=True)
        d, t = np.divmod(keys, len(coded.dictionary))
        columns = {"d": np.unique(d, return_inverse=True)[1].astype(np.int32), "t": t.astype(np.int32), "n": n.astype(np.int32)}
        packed = _pack(words=coded.dictionary, **{k: pa.array(x) for k, x in columns.items()})
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([packed], pa.binary())], names=["g", "packed"])

    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            held.append(batch.column(0).slice(at, 256))
            size += len(held[-1].flatten())
            if size >= most:
                yield bag(number, held)
                number, held, size = number + 1, [], 0
    if size:
        yield bag(number, held)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, at, term, df) of (g, packed): the texts of the group with each of its words."""
    for batch in batches:
        for g, packed in zip(batch.column("g").to_pylist(), batch.column("packed"), strict=True):
            x = _unpack(packed.as_py())
            df = np.bincount(x["t"].to_numpy(), minlength=len(x["words"]))
            for a in range(0, len(df), 100_000):
                at = np.arange(a, min(a + 100_000, len(df)))
                columns = [pa.array(np.full(len(at), g)), pa.array(at.astype(np.int32)), x["words"][a : a + len(at)].cast(pa.string()), pa.array(df[at])]
                yield pa.RecordBatch.from_arrays(columns, names=["g", "at", "term", "df"])


def _lay(bag: pa.Table, found: pa.Table) -> pa.Table:
    """(g, texts, packed) of a group: only kept terms, by their number, with all their texts and whether other groups have them too."""
    if not bag.num_rows or not found.num_rows:
        return pa.table({"g": pa.array([], pa.int64()), "texts": pa.array([], pa.int64()), "packed": pa.array([], pa.binary())})
    x = _unpack(bag.column("packed")[0].as_py())
    place = np.full(len(x["words"]), -1)
    place[found.column("at").to_numpy()] = np.arange(found.num_rows)
    t = place[x["t"].to_numpy()]
    kept = t >= 0
    texts, d = np.unique(x["d"].to_numpy()[kept], return_inverse=True)
    columns = {"d": pa.array(d.astype(np.int32)), "t": pa.array(t[kept].astype(np.int32)), "n": x["n"].filter(pa.array(kept))}
    named = {c: found.column(c).combine_chunks() for c in ("term", "df", "shared")}
    return pa.table({"g": bag.column("g"), "texts": [len(texts)], "packed": pa.array([_pack(**columns, **named)], pa.binary())})


def tfidf(df: DataFrame, tokens: Column, stop: DataFrame | None = None) -> tuple[DataFrame, DataFrame, int]:
    """(terms: t, term, df; groups of texts: g, texts, packed; number of texts) of the tokens longer than one character and outside ``stop``.

    The weight of an entry is the count of the term in the text times the logarithm of texts over texts with the term; the weights of
    a text have unit length. Texts without a kept term count nowhere; a term of all texts has no weight. A text stays in the
    group of the task that read it, so entries are never shuffled one by one.
    """
    spark = df.sparkSession
    most = SPLIT
    bags = cut_lineage(df.select(F.filter(tokens, lambda x: F.length(x) > 1).alias("bag")).mapInArrow(lambda b: _bags(b, most), "g bigint, packed binary"), "bags")
    free_shuffles(spark)
    found = bags.mapInArrow(_words, "g bigint, at int, term string, df bigint")
    known = found.groupBy("term").agg(F.sum("df").alias("df"), (F.count(F.lit(1)) > 1).alias("shared"))
    if stop is not None:
        known = known.join(stop.select("term").distinct(), "term", "left_anti")
    terms = cut_lineage(global_index(known, ["term"], "t"), "terms")
    placed = found.select("g", "at", "term").join(terms, "term").select("g", "at", F.col("t").alias("term"), "df", "shared")
    laid = bags.groupBy("g").cogroup(placed.groupBy("g")).applyInArrow(_lay, "g bigint, texts bigint, packed binary")
    groups = cut_bucketed(laid, "groups", int(spark.conf.get("spark.sql.shuffle.partitions")), ["g"])
    discard(bags)
    free_shuffles(spark)
    return terms, groups, groups.agg(F.sum("texts")).first()[0] or 0


def _entries(packed: bytes, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """(text, place of the term, weight) of a group's entries, and its terms' numbers and whether they are shared."""
    x = {k: v.to_numpy(zero_copy_only=False) for k, v in _unpack(packed).items()}
    w = x["n"] * np.log(texts / x["df"])[x["t"]]
    norm = np.sqrt(np.bincount(x["d"], weights=w * w))
    return x["d"], x["t"], w / np.where(norm > 0, norm, 1)[x["d"]], {k: x[k] for k in ("term", "shared", "df")}


def _sums(by: np.ndarray, size: int, w: np.ndarray, at: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = np.empty((size, x.shape[1]))
    for i in range(x.shape[1]):
        out[:, i] = np.bincount(by, weights=w * x[at, i], minlength=size)
    return out


def _row(**values: object) -> pa.RecordBatch:
    lists = {k: pa.ListArray.from_arrays(pa.array([0, v.size], pa.int32()), pa.array(v.ravel())) if isinstance(v, np.ndarray) else pa.array([v]) for k, v in values.items()}
    return pa.RecordBatch.from_arrays(list(lists.values()), names=list(lists))


def _multiplied(groups: DataFrame, block: DataFrame, width: int, texts: int, buckets: int) -> DataFrame:
    """The block (g, v) over the texts times the transpose of the matrix and then the matrix.

    Sums over the texts are finished in the group for the terms that no other group has; of the others each group sends one vector
    to the term's bucket and gets one back.
    """
    both = groups.select("g", "packed").join(block, "g")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, packed, v in zip(batch.column("g").to_pylist(), batch.column("packed"), batch.column("v"), strict=True):
                d, t, w, terms = _entries(packed.as_py(), texts)
                z = _sums(t, len(terms["term"]), w, d, _vectors(v, width))
                bucket = np.where(terms["shared"], terms["term"] % buckets, -1)
                for q in np.unique(bucket[bucket >= 0]).tolist():
                    yield _row(q=q, g=g, t=terms["term"][bucket == q], v=z[bucket == q])

    def add(rows: pa.Table) -> pa.Table:
        ts = [x.values.to_numpy() for x in rows.column("t")]
        names, at = np.unique(np.concatenate(ts), return_inverse=True)
        z = _sums(at, len(names), np.ones(len(at)), np.arange(len(at)), np.concatenate([_vectors(x, width) for x in rows.column("v")]))
        ends = np.cumsum([len(t) for t in ts])
        return pa.Table.from_batches([_row(g=g, t=t, v=z[at[e - len(t) : e]]) for g, t, e in zip(rows.column("g").to_pylist(), ts, ends, strict=True)])

    def take(own: pa.Table, got: pa.Table) -> pa.Table:
        d, t, w, terms = _entries(own.column("packed")[0].as_py(), texts)
        z = _sums(t, len(terms["term"]), w, d, _vectors(own.column("v")[0], width))
        if got.num_rows:
            order = np.argsort(terms["term"])
            for ts, v in zip(got.column("t"), got.column("v"), strict=True):
                z[order[np.searchsorted(terms["term"][order], ts.values.to_numpy())]] = _vectors(v, width)
        y = _sums(d, len(own.column("v")[0]) // width, w, t, z)
        return pa.Table.from_batches([_row(g=own.column("g")[0].as_py(), v=y)])

    summed = both.mapInArrow(send, "q bigint, g bigint, t array<bigint>, v array<double>").groupBy("q").applyInArrow(add, "g bigint, t array<bigint>, v array<double>")
    return both.groupBy("g").cogroup(summed.groupBy("g")).applyInArrow(take, "g bigint, v array<double>")


def singular_vectors(groups: DataFrame, texts: int, k: int, tol: float = 1e-6, passes: int = 200) -> tuple[list[float], DataFrame]:
    """The largest ``k`` singular values of the groups' weights, fewer if the rank is lower, and their right vectors as (t, v array).

    Block Krylov passes with Rayleigh-Ritz projection over the texts, which are fewer than the terms: each multiplies a block ``DEPTH``
    times by the matrix's transpose and the matrix and starts the next from the best combinations of all its products. It ends when
    every wanted pair satisfies the equation up to ``tol`` times the largest eigenvalue, and is an error if it never does.
    """
    spark = groups.sparkSession
    buckets = groups.count()
    width = k + SPARE

    def begin(batches: Iterator[pa.RecordBatch], width: int = width) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, n in zip(batch.column("g").to_pylist(), batch.column("texts").to_pylist(), strict=True):
                yield _row(g=g, v=np.random.default_rng(g).uniform(-1, 1, (n, width)))

    block = cut_lineage(groups.select("g", "texts").mapInArrow(begin, "g bigint, v array<double>"), "block")
    for _ in range(passes):
        powers = [block]
        for _ in range(DEPTH):
            powers.append(cut_lineage(_multiplied(groups, powers[-1], width, texts, buckets), "block"))
            free_shuffles(spark)
        rows = None
        for i, p in enumerate(powers):
            rows = p.select("g", F.lit(i).alias("i"), "v") if rows is None else rows.unionByName(p.select("g", F.lit(i).alias("i"), "v"))
        size = width * len(powers)

        def basis(part: pa.Table) -> np.ndarray:
            place = part.column("i").to_pylist()
            return np.hstack([_vectors(part.column("v")[place.index(i)], width) for i in range(len(place))])

        def products(part: pa.Table) -> pa.Table:
            x = basis(part)
            return pa.Table.from_batches([_row(x=x.T @ x)])

        inner = np.zeros(size * size)
        flat = rows.groupBy("g").applyInArrow(products, "x array<double>").select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"))
        for r in flat.collect():
            inner[r["at"]] = r["x"]
        inner = inner.reshape(size, size)
        # the products of all but the last power with the matrix are the powers one further
        scale = 1 / np.sqrt(np.maximum(np.diag(inner), 1e-300))
        low, high = np.arange(width * DEPTH), np.arange(width, width * (DEPTH + 1))
        values, vectors = np.linalg.eigh(inner[np.ix_(low, low)] * np.outer(scale[low], scale[low]))
        kept = values > 1e-10 * values[-1]
        white = scale[low, None] * vectors[:, kept] / np.sqrt(values[kept])
        ritz, turn = np.linalg.eigh(white.T @ ((inner[np.ix_(low, high)] + inner[np.ix_(high, low)]) / 2) @ white)
        order = np.argsort(ritz)[::-1]
        order = order[ritz[order] > 1e-10 * ritz[order[0]]][:width]
        ritz, chosen = ritz[order], white @ turn[:, order]
        rest = np.zeros((len(inner), len(order)))
        rest[high] += chosen
        rest[low] -= chosen * ritz
        miss = np.sqrt(np.maximum(np.einsum("ij,ij->j", rest, inner @ rest), 0))[:k]

        def combine(part: pa.Table) -> pa.Table:
            return pa.Table.from_batches([_row(g=part.column("g")[0].as_py(), v=basis(part)[:, : len(chosen)] @ chosen)])

        block, width = cut_lineage(rows.groupBy("g").applyInArrow(combine, "g bigint, v array<double>"), "block"), len(order)
        for p in powers:
            discard(p)
        free_shuffles(spark)
        if (miss <= tol * ritz[0]).all():
            values = np.sqrt(ritz[:k])
            return values.tolist(), _right_vectors(groups, block, width, values, texts)
    raise RuntimeError(f"singular vectors did not converge in {passes} passes")


def _right_vectors(groups: DataFrame, left: DataFrame, width: int, values: np.ndarray, texts: int) -> DataFrame:
    """(t, v) of the first left vectors (g, v) with their singular values; terms without weight are left out."""

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, u in zip(batch.column("packed"), batch.column("v"), strict=True):
                d, t, w, terms = _entries(packed.as_py(), texts)
                z = _sums(t, len(terms["term"]), w, d, _vectors(u, width)[:, : len(values)] / values)
                z, names = z[terms["df"] < texts], terms["term"][terms["df"] < texts]
                for at in range(0, len(z), 50_000):
                    x = z[at : at + 50_000]
                    offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(values))
                    yield pa.RecordBatch.from_arrays([pa.array(names[at : at + 50_000]), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], names=["t", "v"])

    parts = groups.select("g", "packed").join(left, "g").mapInArrow(right, "t bigint, v array<double>")
    return cut_lineage(parts.groupBy("t").agg(F.array(*[F.sum(F.col("v")[i]) for i in range(len(values))]).alias("v")), "vectors")


def topic_weights(df: DataFrame, tokens: Column, topics: int = 10, per_topic: int = 50, stop: DataFrame | None = None) -> DataFrame:
    """(topic from 0, value, rank from 1, term, weight): of each topic the terms of greatest weight, its sign aside, equal
    weights (to six places) by term. ``value`` is the topic's singular value. Without any weight the result is empty."""
    terms, groups, texts = tfidf(df, tokens, stop)
    terms = terms.where(F.col("df") < texts)
    if terms.isEmpty():
        return df.sparkSession.createDataFrame([], "topic int, value double, rank int, term string, weight double")
    values, vectors = singular_vectors(groups, texts, topics)
    listed = vectors.select("t", F.posexplode("v").alias("topic", "weight")).join(terms.select("t", "term"), "t")
    order = [F.round(F.abs("weight"), 6).desc(), F.col("term").asc()]
    best = top_per_group(listed, ["topic"], order, per_topic)
    return best.select("topic", F.get(F.array(*map(F.lit, values)), F.col("topic")).alias("value"), "rank", "term", "weight")


def topic_terms(df: DataFrame, tokens: Column, topics: int = 10, per_topic: int = 50, top: int = 100, stop: DataFrame | None = None) -> DataFrame:
    """(term, topics): terms by the number of topics that list them among their ``per_topic`` best."""
    counted = topic_weights(df, tokens, topics, per_topic, stop).groupBy("term").agg(F.count(F.lit(1)).cast("int").alias("topics"))
    return counted.orderBy(F.desc("topics"), F.asc("term")).limit(top)
