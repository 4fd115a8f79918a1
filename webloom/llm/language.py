"""Language identification by a byte convolutional network.

Bytes are folded into 128 classes (case folded for ASCII) and embedded; filters of several widths slide over
a window of fixed length; each filter's largest response in the window goes to a softmax layer over the
languages. The network is trained in numpy on a bounded sample of labelled windows. A text is
the mean of its windows' probabilities; windows overlap by the widest filter less one, so
every run of bytes of the text is seen whole.

As the filters are linear in the embedding, a trained network is applied through tables of
the response of every pair of byte classes: the same numbers, without the matrix products.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webloom.llm.common import held_out, table

CLASSES = 128
PAD = 127
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


def byte_classes() -> np.ndarray:
    """Class of each byte: blanks, letters without case, digits, signs, and the parts of UTF-8 sequences."""
    out = np.full(256, 28, dtype=np.uint8)
    out[[9, 10, 11, 12, 13, 32]] = 0
    for i in range(26):
        out[ord("a") + i] = out[ord("A") + i] = 1 + i
    out[ord("0") : ord("9") + 1] = 27
    out[0x80:0xC0] = 29 + np.arange(64)
    out[0xC0:0xE0] = 93 + np.arange(32)
    out[0xE0:0xF0], out[0xF0:] = 125, 126
    return out


FOLD = byte_classes()


@dataclass
class ByteNetwork:
    languages: list[str]
    embedding: np.ndarray  # (CLASSES, d)
    filters: dict[int, np.ndarray]  # width -> (width * d, n)
    bias: dict[int, np.ndarray]
    dense: np.ndarray  # (features, languages)
    dense_bias: np.ndarray
    window: int = 256

    @property
    def stride(self) -> int:
        return self.window - max(self.filters) + 1

    def windows(self, text: bytes) -> np.ndarray:
        """All windows of a text, (n, window); the last is padded."""
        n = max(1, -(-(len(text) - max(self.filters) + 1) // self.stride))
        padded = np.full((n - 1) * self.stride + self.window, PAD, dtype=np.uint8)
        padded[: len(text)] = FOLD[np.frombuffer(text, dtype=np.uint8)]
        return np.lib.stride_tricks.as_strided(padded, (n, self.window), (self.stride, 1))

    def tables(self) -> dict[int, list[np.ndarray]]:
        """For each width, the responses of its bytes two by two, as (CLASSES ** 2, n) and for an odd last byte (CLASSES, n)."""
        out, d = {}, self.embedding.shape[1]
        for w, weights in self.filters.items():
            one = [self.embedding @ weights[k * d : (k + 1) * d] for k in range(w)]
            one[0] = one[0] + self.bias[w]
            parts = [(one[k][:, None, :] + one[k + 1][None, :, :]).reshape(CLASSES * CLASSES, -1) for k in range(0, w - 1, 2)]
            if w % 2:
                parts.append(one[-1])
            out[w] = [np.ascontiguousarray(p, dtype=np.float32) for p in parts]
        return out

    def probabilities(self, windows: np.ndarray, tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        """Softmax over the languages for each window."""
        out = np.empty((len(windows), len(self.languages)))
        for at in range(0, len(windows), 64):
            c = windows[at : at + 64].astype(np.intp)
            pair = c[:, :-1] * CLASSES + c[:, 1:]
            pooled = []
            for w, parts in tables.items():
                n = self.window - w + 1
                r = parts[0].take(pair[:, :n], axis=0)
                for k, part in enumerate(parts[1:], 1):
                    r += part.take((pair if len(part) > CLASSES else c)[:, 2 * k : 2 * k + n], axis=0)
                pooled.append(np.maximum(r.max(axis=1), 0))
            out[at : at + 64] = softmax(np.concatenate(pooled, axis=1) @ self.dense + self.dense_bias)
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(
    windows: np.ndarray, labels: np.ndarray, languages: list[str], widths: tuple[int, ...] = (2, 3, 4), width_filters: int = 16,
    dimension: int = 8, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 1,
) -> ByteNetwork:
    """Fit a network on (n, window) byte classes by Adam on the cross entropy."""
    rng = np.random.default_rng(seed)
    length = windows.shape[1]
    net = ByteNetwork(
        languages, rng.normal(0, 0.5, (CLASSES, dimension)),
        {w: rng.normal(0, (w * dimension) ** -0.5, (w * dimension, width_filters)) for w in widths},
        {w: np.zeros(width_filters) for w in widths},
        rng.normal(0, 0.1, (len(widths) * width_filters, len(languages))), np.zeros(len(languages)), length,
    )
    params = [net.embedding, *net.filters.values(), *net.bias.values(), net.dense, net.dense_bias]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // batch)):
            c, y = windows[rows].astype(np.intp), labels[rows]
            x = net.embedding[c]  # (b, length, d)
            pooled, kept = [], []
            for w in widths:
                view = np.lib.stride_tricks.sliding_window_view(x, w, axis=1).swapaxes(2, 3).reshape(len(rows), length - w + 1, w * dimension)
                r = view @ net.filters[w] + net.bias[w]
                top = r.argmax(axis=1)  # (b, n)
                best = np.take_along_axis(r, top[:, None, :], axis=1)[:, 0, :]
                pooled.append(np.maximum(best, 0))
                kept.append((top, best > 0, view))
            h = np.concatenate(pooled, axis=1)
            p = softmax(h @ net.dense + net.dense_bias)
            p[np.arange(len(rows)), y] -= 1
            p /= len(rows)
            grads = {"dense": h.T @ p, "dense_bias": p.sum(axis=0)}
            back = (p @ net.dense.T).reshape(len(rows), len(widths), width_filters)
            g_embedding, g_filters, g_bias = np.zeros_like(net.embedding), [], []
            for k, w in enumerate(widths):
                top, alive, view = kept[k]
                g = back[:, k, :] * alive  # (b, n)
                picked = view[np.arange(len(rows))[:, None], top]  # (b, n, w * d)
                g_filters.append(np.einsum("bnf,bn->fn", picked, g))
                g_bias.append(g.sum(axis=0))
                spread = (g[:, :, None] * net.filters[w].T[None]).reshape(len(rows), width_filters, w, dimension)
                for j in range(w):
                    np.add.at(g_embedding, c[np.arange(len(rows))[:, None], top + j], spread[:, :, j])
            all_grads = [g_embedding, *g_filters, *g_bias, grads["dense"], grads["dense_bias"]]
            step += 1
            for q, g, m, v in zip(params, all_grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_language: int = 400,
    windows_each: int = 4, window: int = 256,
) -> ByteNetwork | None:
    """A network from a bounded sample: of each language the ``per_language`` rows lowest in a hash
    of the id, and ``windows_each`` windows spread over the whole of each text. None without a labelled text that has a letter."""
    labelled = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(label_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.lit("language")).alias("at")
    )
    # twice the wanted share goes to the ranking, so a frequent language sends few rows; one number per language, as in the model
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not sizes:
        return None
    size_of = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(r["n"]))])
    share = labelled.where((F.col("at").cast("double") / float(1 << 64) + 0.5) * size_of[F.col("lang")] <= 2.0 * per_language)
    ranked = share.where(F.col("text").rlike(r"\p{L}")).select("lang", "text", "at")
    order = Window.partitionBy("lang").orderBy("at")
    sample = ranked.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_language)
    shape = ByteNetwork([], np.zeros((0, 0)), {4: np.zeros(0)}, {}, np.zeros(0), np.zeros(0), window)

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = []
            for lang, text in zip(frame["lang"], frame["text"], strict=True):
                cut = shape.windows(text.encode("utf-8", "replace"))
                for k in np.unique(np.linspace(0, len(cut) - 1, windows_each).astype(int)):
                    got.append((lang, cut[k].tobytes()))
                    # a shortened copy, so that short texts are no stranger to the network
                    short = cut[k].copy()
                    short[16 + zlib.crc32(cut[k].tobytes()) % 112 :] = PAD
                    got.append((lang, short.tobytes()))
            yield pd.DataFrame(got, columns=["lang", "bytes"])

    rows = sample.select("lang", "text").mapInPandas(spread, "lang string, bytes binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], bytes(r["bytes"])))
    languages = sorted({r["lang"] for r in rows})
    data = np.stack([np.frombuffer(r["bytes"], dtype=np.uint8) for r in rows])
    return train(data, np.array([languages.index(r["lang"]) for r in rows]), languages)


def identify(docs: DataFrame, model: ByteNetwork | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, lang_pred, score).

    ``score`` is the mean probability of the language over all windows of the whole text. A text
    that is null, empty or without a letter is "und" with score 0, as is any text when nothing could be learned. Ids may
    be null or repeated; no other column is read. An empty table gives an empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.tables() if model else {}
        for batch in batches:
            names, scores = [], []
            pending: list[np.ndarray] = []
            places: list[int] = []
            waiting = 0

            def flush() -> None:
                nonlocal waiting
                if pending:
                    p = model.probabilities(np.concatenate(pending), tables)
                    at = 0
                    for place, cut in zip(places, pending, strict=True):
                        mean = p[at : at + len(cut)].mean(axis=0)
                        at += len(cut)
                        names[place], scores[place] = model.languages[int(mean.argmax())], float(mean.max())
                    pending.clear()
                    places.clear()
                    waiting = 0

            for i, value in enumerate(batch.column("text")):
                text = value.as_py()
                names.append(UNKNOWN)
                scores.append(0.0)
                if model and text and LETTER.search(text):
                    pending.append(model.windows(text.encode("utf-8", "replace")))
                    places.append(i)
                    waiting += len(pending[-1])
                    if waiting >= 2048:
                        flush()
            flush()
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(predict, f"doc_id {id_type}, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
