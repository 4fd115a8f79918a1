"""Toxicity by a weighted finite-state pattern grammar over clauses.

Transducers read the words of a clause and are composed into one machine:

* words -> symbols: insult, threat, target (pronouns, no names), negation, report, other;
* report: what follows a verb of saying is marked as reported;
* negation: an insult or threat shortly after a negation is marked as negated;
* target: an insult or threat shortly after a target is marked as aimed, and so is a threat shortly before one: the
  machine of targets also reads the clause from its end.

The weight of a clause's path is the sum of its arcs' weights: what was matched, and how it was marked. A text is
scored by its matched clauses (strongest, sum, number, share, and how many were aimed,
negated, reported or threats) in a logistic model.

The insult words are a short list and those learned: word stems that stand in toxic texts and hardly in
others, chosen greedily by the toxic texts that no chosen stem covers yet.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import held_out, small_side, table
from webloom.session import cut_lineage

# Seed words of the grammar (en, de, fr, es).
INSULTS = "idiot moron scum pathetic worthless loser clown trash disgusting stupid dumb imbecile fool".split()
THREATS = "kill hurt destroy beat shoot stab burn töten töte umbringen verprügeln verprügle tuer tue frapper frappe détruire matar mato matarte golpear golpearte destruir destruirte".split()
TARGETS = "you your yours he she they him her them du dich dir ihr euch ihn ihnen tu te toi vous eux ils elles tú usted ustedes ellos ellas".split()
CLITICS = frozenset("matarte golpearte destruirte".split())  # threats with their target in one word
NEGATIONS = "not no never neither nor nicht kein keine nie pas jamais aucun aucune nunca ni tampoco".split()
REPORTS = "said says say told quoted wrote claimed sagte sagt schrieb dit écrit affirmé dijo dice escribió".split()

WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[.!?;:\n]+")
#: Distinct sets of stems of uncovered texts from which the driver goes on alone.
HELD = 20_000
FEATURES = ("strongest", "sum", "clauses", "share", "aimed", "negated", "reported", "threats")


@dataclass
class Transducer:
    """Arcs (state, input) -> (state, output, weight); "*" stands for any other input, which is copied when the output is "*"."""

    arcs: dict[tuple[int, str], tuple[int, str, float]]
    start: int = 0

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        state, out, weight = self.arcs.get((state, symbol)) or self.arcs.get((state, "*")) or (state, "*", 0.0)
        return state, symbol if out == "*" else out, weight


@dataclass
class Composed:
    """The composition of transducers: the output of one is the input of the next; states are tuples, weights add up."""

    parts: list[Transducer]
    seen: dict = field(default_factory=dict)

    @property
    def start(self) -> tuple[int, ...]:
        return tuple(p.start for p in self.parts)

    def step(self, state: tuple[int, ...], symbol: str) -> tuple[tuple[int, ...], str, float]:
        got = self.seen.get((state, symbol))
        if got is None:  # arcs are made when first needed
            out, states, total = symbol, [], 0.0
            for part, s in zip(self.parts, state, strict=True):
                s, out, weight = part.step(s, out)
                states.append(s)
                total += weight
            got = self.seen[state, symbol] = (tuple(states), out, total)
        return got


def report_marks() -> Transducer:
    arcs: dict = {(0, "report"): (1, "report", 0.0)}
    for s in ("insult", "threat"):
        arcs[1, s] = (1, f"{s}+reported", -0.5)
    return Transducer(arcs)


def negation_marks(reach: int = 3) -> Transducer:
    """State k > 0: a negation stands k - 1 words before."""
    arcs: dict = {}
    for state in range(reach + 1):
        arcs[state, "negation"] = (1, "negation", 0.0)
        if state:
            after = state + 1 if state < reach else 0
            arcs[state, "*"] = (after, "*", 0.0)
            for s in ("insult", "threat", "insult+reported", "threat+reported"):
                arcs[state, s] = (after, f"{s}+negated", -0.5)
    return Transducer(arcs)


def target_marks(reach: int = 6) -> Transducer:
    arcs: dict = {}
    for state in range(reach + 1):
        arcs[state, "target"] = (1, "target", 0.0)
        if state:
            after = state + 1 if state < reach else 0
            arcs[state, "*"] = (after, "*", 0.0)
            for base in ("insult", "threat"):
                for mark in ("", "+reported", "+negated", "+reported+negated"):
                    arcs[state, base + mark] = (after, f"{base}{mark}+aimed", 0.5)
    return Transducer(arcs)


class Grammar:
    """The composed machine with its lexicon: stems ("abc*") and words with their weights."""

    def __init__(self, weights: dict[str, float]):
        self.weights = dict(weights)
        self.lexicon = {w: s for s, words in (("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS)) for w in words}
        self.threats = set(THREATS)
        self.stem_lengths = sorted({len(w) - 1 for w in weights if w.endswith("*")})
        self.machine = Composed([report_marks(), negation_marks(), target_marks()])
        self.behind = target_marks()  # reads from the end of a clause: what has a target behind it
        parts = sorted({w.rstrip("*") for w in [*weights, *THREATS]}, key=lambda w: (-len(w), w))
        self.trigger = re.compile("|".join(map(re.escape, parts))) if parts else None

    def symbol(self, word: str) -> tuple[str, float]:
        if word in self.weights:
            return "insult", self.weights[word]
        for n in self.stem_lengths:
            if n <= len(word) and (w := self.weights.get(word[:n] + "*")) is not None:
                return "insult", w
        if word in self.threats:
            return "threat", 1.0
        return self.lexicon.get(word, "other"), 0.0

    def clause(self, words: list[str]) -> tuple[float, Counter]:
        """Weight of the path of a clause, and how often each mark was put."""
        symbols = [self.symbol(word) for word in words]
        after, state = [0.0] * len(words), self.behind.start
        for i in range(len(words) - 1, -1, -1):
            state, _, weight = self.behind.step(state, symbols[i][0])
            if symbols[i][0] == "threat":
                # a clitic is a target in the word itself
                after[i] = 0.5 if words[i] in CLITICS else weight
        state, total, marks = self.machine.start, 0.0, Counter()
        for (symbol, own), aim in zip(symbols, after, strict=True):
            state, out, weight = self.machine.step(state, symbol)
            if symbol in ("insult", "threat"):
                if aim and "+aimed" not in out:
                    out, weight = f"{out}+aimed", weight + aim
                total += own * (1 + weight)
                marks["match"] += 1
                marks["threat"] += symbol == "threat"
                marks.update(out.split("+")[1:])
        return total, marks

    def features(self, text: str) -> list[float]:
        """The values of ``FEATURES`` for a whole text."""
        low = text.lower()
        if self.trigger is None or not self.trigger.search(low):
            return [0.0] * len(FEATURES)
        clauses = [c for c in CLAUSE.split(low) if c and not c.isspace()]
        best, total, matched, marks = 0.0, 0.0, 0, Counter()
        for clause in clauses:
            if self.trigger.search(clause):
                weight, found = self.clause(WORD.findall(clause))
                if found["match"]:
                    # a threat counts only when it is aimed
                    if found["threat"] == found["match"] and not found["aimed"]:
                        continue
                    best, total, matched = max(best, weight), total + weight, matched + 1
                    marks.update(found)
        return [
            best, math.log1p(max(total, 0.0)), math.log1p(matched), math.sqrt(matched / max(len(clauses), 1)), math.log1p(marks["aimed"]),
            math.log1p(marks["negated"]), math.log1p(marks["reported"]), math.log1p(marks["threat"]),
        ]


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    coefficients: list[float]
    bias: float

    def score(self, features: Iterable[float]) -> float:
        z = self.bias + sum(c * f for c, f in zip(self.coefficients, features, strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


#: Used when there is no label to learn from.
UNTRAINED = ToxicityModel({w: 3.0 for w in INSULTS}, [0.5, 0.5, 0.5, 1.0, 0.5, -0.5, -0.5, 0.5], -3.0)


def stems(text: str) -> set[str]:
    """Words of a text and their beginnings of 3 to 7 letters as "abc*"."""
    out: set[str] = set()
    for w in set(WORD.findall(text.lower())):
        out.add(w)
        out.update(w[:n] + "*" for n in range(3, min(8, len(w) + 1)))
    return out


def _counts(sample: DataFrame, wanted: set[str] | None) -> DataFrame:
    """(stem, n): texts of the sample with each stem."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            c: Counter = Counter()
            for text in frame["text"]:
                found = stems(text)
                c.update(found if wanted is None else found & wanted)
            yield pd.DataFrame({"stem": list(c), "n": list(c.values())}).astype({"stem": "object", "n": "int64"})

    return sample.select("text").mapInPandas(count, "stem string, n long").groupBy("stem").agg(F.sum("n").alias("n"))


def logistic(rows: DataFrame, n: int, penalty: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Penalised logistic regression of ``toxic`` on the ``n`` numbers of ``f`` by Newton steps; the bias is not penalised. Every step
    adds up the rows' gradients and second derivatives in the tasks."""
    k = n + 1
    w, p = np.zeros(k), np.eye(k) * penalty
    p[-1, -1] = 1e-3
    for _ in range(rounds):

        def sums(batches: Iterator[pa.RecordBatch], w: np.ndarray = w) -> Iterator[pa.RecordBatch]:
            total = np.zeros((k + 1, k))
            for batch in batches:
                x = np.asarray(batch.column("f").flatten(), dtype=np.float64).reshape(-1, n)
                a = np.hstack([x, np.ones((len(x), 1))])
                mu = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
                total[:k] += a.T @ (a * (mu * (1 - mu))[:, None])
                total[k] += a.T @ (np.asarray(batch.column("toxic"), dtype=np.float64) - mu)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "x"])

        got = np.zeros((k + 1) * k)
        for r in rows.mapInArrow(sums, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).collect():
            got[r["at"]] = r["x"]
        got = got.reshape(k + 1, k)
        step = np.linalg.solve(got[:k] + p, got[k] - p @ w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> ToxicityModel:
    """Learn the stems and the model from all labelled rows and from every stem that is telling enough. The driver sees counts of
    stems (as a stem stands in a 300th of the toxic texts at least, these do not grow with the rows), sums over the rows and, once
    they are few enough, the toxic texts that no chosen stem covers yet.

    A doc labelled more than once is toxic if any label says so. Null labels, ids and texts are left out. Without a
    toxic and a clean text among the sample the untrained grammar is returned.
    """
    known = cut_lineage(
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
        .agg(F.max(label_col).cast("int").alias("toxic")), "labelled"
    )
    if known.isEmpty():
        return UNTRAINED
    sample = cut_lineage(
        docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(small_side(known), "id").select("text", "toxic"),
        "sample",
    )
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return UNTRAINED

    toxic = sample.where("toxic = 1")
    least = max(3, n_toxic // 300)
    often = {r["stem"]: r["n"] for r in _counts(toxic, None).where(F.col("n") >= least).collect()}
    clean = {r["stem"]: r["n"] for r in _counts(sample.where("toxic = 0"), set(often)).collect()}

    def odds(s: str) -> float:
        return math.log((often[s] + 0.5) / (n_toxic + 1)) - math.log((clean.get(s, 0) + 0.5) / (n_clean + 1))

    def gain(s: str) -> float:
        return often[s] * odds(s)

    strong = sorted((s for s in often if odds(s) >= 2), key=lambda s: (-gain(s), -len(s), s))
    place = {s: i for i, s in enumerate(strong)}

    def held(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"found": [sorted(place[s] for s in stems(t) if s in place) for t in frame["text"]]})

    # texts of the same stems are one entry with a count
    open_texts = cut_lineage(toxic.select("text").mapInPandas(held, "found array<int>").groupBy("found").agg(F.count(F.lit(1)).alias("n")), "covers")
    chosen: list[str] = []

    def choose(cover: Mapping[int, int]) -> int | None:
        best = max(cover, key=lambda i: (cover[i] * odds(strong[i]), len(strong[i]), -i), default=None)
        if best is None or cover[best] < least:
            return None
        chosen.append(strong[best])
        return best

    best: int | None = -1
    while best is not None and open_texts.count() > HELD:
        counted = open_texts.select(F.explode("found").alias("i"), "n").groupBy("i").agg(F.sum("n").alias("n")).collect()
        best = choose({r["i"]: r["n"] for r in counted})
        if best is not None:
            open_texts = open_texts.where(~F.array_contains("found", best))
    entries = [(set(r["found"]), r["n"]) for r in open_texts.collect()] if best is not None else []
    while entries:
        cover: Counter = Counter()
        for found, n in entries:
            cover.update(dict.fromkeys(found, n))
        best = choose(cover)
        if best is None:
            break
        entries = [e for e in entries if best not in e[0]]
    # further stems that are as telling as the chosen ones, of texts that are covered already; the longest of a nest
    nested: list[str] = []
    for s in strong:
        if clean.get(s, 0) * 20 * n_toxic <= often[s] * n_clean and often[s] >= max(least, n_toxic // 25):
            if not any(s.startswith(c.rstrip("*")) or c.startswith(s.rstrip("*")) for c in [*chosen, *nested]):
                nested.append(s)
    weights = {s: min(odds(s), 8.0) for s in [*chosen, *nested]}
    for s in INSULTS:
        weights.setdefault(s, 2.0)

    grammar = Grammar(weights)

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"f": [grammar.features(t) for t in frame["text"]], "toxic": frame["toxic"]})

    measured = cut_lineage(sample.mapInPandas(measure, "f array<double>, toxic int"), "measured")
    w, b = logistic(measured, len(FEATURES))
    return ToxicityModel(weights, w.tolist(), b)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, score, matched_clauses).

    Whole texts are read; a null or empty text matches nothing and gets the score of that. Ids may be
    null or repeated; other columns are not read. An empty table gives an empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(model.weights)
        for batch in batches:
            found = [grammar.features(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([model.score(f) for f in found], pa.float64()), pa.array([round(math.expm1(f[2])) for f in found], pa.int64())],
                names=["doc_id", "score", "matched_clauses"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, score double, matched_clauses long")


def keep_clean(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, all their columns unchanged."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(model.weights)
        for batch in batches:
            clean = [model.score(grammar.features(t.as_py() or "")) < threshold for t in batch.column(text_col)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    mine = labels.where(~held_out(F.col("doc_id")))
    got = score(docs, fit(docs, mine))
    return got.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "matched_clauses"
    )
