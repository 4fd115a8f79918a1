"""Tokens, lexicons, word groups, question classes and text models."""

from __future__ import annotations

import difflib
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.functions import fixed_values as V
from webloom.functions.text import clean_question, words
from webloom.operators.stats import classification_report
from webloom.session import cut_lineage, free_shuffles

PIECES = r"(?U)([A-Za-z0-9]+|[^\sA-Za-z0-9]+)"  # Unicode white space separates


# --- tokens ------------------------------------------------------------------


CHUNK = 256


def _cut_runs(runs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(id, tokens) of distinct runs (id, run): cut by the longest term from left to right.

    A run is cut into chunks, each with as much of the next as the longest term can reach. For a chunk, where a walk
    leaves it depends only on where it comes in, fewer characters from its beginning than the longest term has: a small table
    per chunk. These tables, taken one after the other, tell where each chunk is entered, and then all chunks are walked at
    once. Rows are positions times lengths of terms at most, and nothing but the tables of a run meets in one place.
    """
    terms = lexicon.select("term").where(F.length("term") > 1).distinct()
    sizes = terms.agg(F.sort_array(F.collect_set(F.length("term")))).scalar()
    longest = F.coalesce(F.array_max("sizes"), F.lit(1))
    run, size = F.col("run"), F.length("run")
    cut = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / CHUNK).cast("int")), lambda i: F.substr(run, i * CHUNK + 1, longest + (CHUNK - 1)))
    chunks = runs.withColumn("sizes", sizes).select("id", "sizes", size.alias("size"), F.posexplode(cut).alias("chunk", "part"))
    chunks = chunks.withColumn("own", F.least(F.lit(CHUNK), F.col("size") - F.col("chunk") * CHUNK))
    chunks = cut_lineage(chunks, "chunks")

    part = F.col("part")
    found = lambda at: F.transform(
        F.filter("sizes", lambda n: at + n - 1 <= F.length(part)), lambda n: F.struct(at.alias("at"), n.alias("n"), F.substr(part, at, n).alias("term"))
    )
    spots = chunks.select("id", "chunk", F.explode(F.flatten(F.transform(F.sequence(F.lit(1), F.col("own")), found))).alias("x"))
    hits = spots.select("id", "chunk", "x.at", "x.n", "x.term").join(terms, "term", "left_semi")
    hits = hits.groupBy("id", "chunk", "at").agg(F.max("n").alias("n"))
    hits = hits.groupBy("id", "chunk").agg(F.map_from_entries(F.collect_list(F.struct("at", "n"))).alias("hits"))  # at most CHUNK
    steps = F.transform(F.sequence(F.lit(1), F.col("own")), lambda at: F.coalesce(F.try_element_at("hits", at), F.lit(1)))
    stepped = chunks.join(hits, ["id", "chunk"], "left").select("id", "chunk", "size", "own", "part", longest.alias("longest"), steps.alias("steps"))
    stepped = cut_lineage(stepped, "steps")

    places = F.sequence(F.lit(0), F.col("own") - 1)
    leave = lambda entry: F.aggregate(places, entry, lambda at, i: F.when(i < at, at).otherwise(at + F.get("steps", i))) - F.col("own")
    tables = stepped.where(F.col("size") > CHUNK).select("id", "chunk", F.transform(F.sequence(F.lit(0), F.col("longest") - 1), leave).alias("exits"))
    in_turn = tables.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("chunk", "exits"))).alias("t"))
    entries = F.aggregate("t", F.array(F.lit(0)), lambda seen, x: F.array_append(seen, F.get(x["exits"], F.element_at(seen, -1))))
    entered = in_turn.select("id", F.posexplode(entries).alias("chunk", "entry"))

    def walk(state: Column, i: Column) -> Column:
        step = F.get("steps", i)
        return F.when(i < state["next"], state).otherwise(
            F.struct((i + step).alias("next"), F.array_append(state["out"], F.substr(part, i + 1, step)).alias("out"))
        )

    start = F.struct(F.coalesce("entry", F.lit(0)).alias("next"), F.array().cast("array<string>").alias("out"))
    tokens = F.aggregate(places, start, walk)["out"]
    walked = stepped.join(entered, ["id", "chunk"], "left").select("id", F.struct("chunk", tokens.alias("tokens")).alias("x"))
    return walked.groupBy("id").agg(F.flatten(F.sort_array(F.collect_list("x"))["tokens"]).alias("tokens"))


def tokenize(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """(key, tokens), one row per input row: runs of Latin letters and digits are tokens; other runs are
    cut by the longest lexicon term from left to right, one character where none fits. A null text has null tokens.

    The lexicon stays a table of any size: substrings of the lengths that occur in it are
    joined with it. Equal texts and equal runs are cut once; both go by their digest.
    """
    own = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.md5(F.col(text).cast("binary")).alias("digest"))
    spread = own.where("text is not null").select("digest", F.posexplode(F.regexp_extract_all("text", F.lit(PIECES), 1)).alias("piece", "run"))
    pieces = spread.groupBy("digest", "piece").agg(F.any_value("run").alias("run"))
    latin = F.rlike("run", F.lit("^[A-Za-z0-9]"))
    pieces = pieces.withColumn("id", F.when(~latin, F.md5(F.col("run").cast("binary"))))
    runs = spread.where(~latin).groupBy(F.md5(F.col("run").cast("binary")).alias("id")).agg(F.any_value("run").alias("run"))
    cut = _cut_runs(runs, lexicon).withColumnRenamed("tokens", "cut")
    per = pieces.join(cut, "id", "left").select("digest", F.struct("piece", F.coalesce("cut", F.array("run")).alias("k")).alias("x"))
    tokens = per.groupBy("digest").agg(F.flatten(F.sort_array(F.collect_list("x"))["k"]).alias("tokens"))
    out = own.select("key", "digest").join(tokens, "digest", "left")
    none = F.when(F.col("digest").isNotNull(), F.array().cast("array<string>"))
    return out.select(F.col("key").alias(key), F.coalesce("tokens", none).alias("tokens"))


def word_matcher(listed: Sequence[str], tokens: Callable[[Column], Column] = words) -> Callable[[Column], Column]:
    """Column function giving the listed words of a text, the fixed phrase before all.
    For short lists; long ones go through ``detect_groups``."""

    def match(text: Column) -> Column:
        phrase = F.contains(text, F.lit(V.FIXED_SKIP_PHRASE))
        hits = F.array_sort(F.array_intersect(tokens(text), F.array(*[F.lit(w) for w in listed]).cast("array<string>")))
        return F.coalesce(F.when(phrase, F.array(F.lit(V.FIXED_SKIP_PHRASE))).otherwise(hits), F.array().cast("array<string>"))

    return match


def detect_groups(
    df: DataFrame, key: str, text: str, groups: DataFrame, user_words: DataFrame | None = None,
    tokens: Callable[[Column], Column] = words,
) -> DataFrame:
    """(key, grp, matched) of texts with a listed word: the fixed phrase first, else the user
    words when given, else the first group in ``rank`` that has a token of the text.
    ``groups``: word, grp, rank; ``user_words``: word."""
    phrase = F.contains(text, F.lit(V.FIXED_SKIP_PHRASE))
    fixed = df.where(phrase).select(
        key, F.lit("skip_phrase").alias("grp"), F.array(F.lit(V.FIXED_SKIP_PHRASE)).alias("matched")
    )
    listed = groups
    if user_words is not None:
        listed = user_words.select("word", F.lit("skip_words_user").alias("grp"), F.lit(0).alias("rank"))
    toks = df.where(~phrase).select(key, F.explode(F.array_distinct(tokens(F.col(text)))).alias("word"))
    hits = toks.join(listed.select("word", "grp", "rank").distinct(), "word")
    per = hits.groupBy(key, "rank", "grp").agg(F.sort_array(F.collect_set("word")).alias("matched"))
    first = per.groupBy(key).agg(F.min(F.struct("rank", "grp", "matched")).alias("_m"))
    return fixed.unionByName(first.select(key, "_m.grp", "_m.matched"))


# --- question classes --------------------------------------------------------


def is_fact_question_regex(
    q: Column, variant: str = "clean", exempt: str = V.FACT_EXEMPT, deny: str = V.FACT_DENY, allow: Sequence[str] = V.FACT_ALLOW
) -> Column:
    """Factual by pattern. ``clean`` tests the deny list after removing exempt phrases;
    ``rewritten`` after the question rewriting; ``exempt`` accepts a denied question that
    holds an exempt phrase."""
    hit = lambda c, p: F.rlike(c, F.lit(p))
    allowed = hit(q, allow[0])
    for p in allow[1:]:
        allowed = allowed | hit(q, p)
    if variant == "exempt":
        rule = F.when(hit(q, deny), hit(q, exempt)).otherwise(allowed)
    else:
        base = clean_question(q) if variant == "rewritten" else q
        cleaned = F.regexp_replace(base, V.HOMELAND_PHRASES if variant == "rewritten" else exempt, "")
        rule = F.when(hit(cleaned, deny), False).otherwise(allowed)
    return F.when(F.coalesce(q, F.lit("")) == "", False).otherwise(rule)


def fact_tokens(q: Column, tokens: Callable[[Column], Column] = words) -> Column:
    cleaned = F.regexp_replace(clean_question(q), V.HOMELAND_PHRASES, "")
    return F.array_distinct(tokens(F.regexp_replace(cleaned, V.KEYWORD_SPACING, " $1 ")))


def is_fact_question(
    q: Column, deny: Sequence[str], allow: Sequence[str], pronouns: Sequence[str], use_pos: bool = True,
    small_talk: str = V.SMALL_TALK, tokens: Callable[[Column], Column] = words,
) -> Column:
    """Struct (fact, note). Small talk and deny words refuse, allow words accept; with
    ``use_pos`` a question of fewer than ten tokens without a pronoun is accepted too."""
    lit_list = lambda items: F.array(*[F.lit(x) for x in items]).cast("array<string>")
    toks = fact_tokens(q, tokens)
    black, white = F.array_intersect(toks, lit_list(deny)), F.array_intersect(toks, lit_list(allow))
    named = F.array_intersect(toks, lit_list(pronouns))
    talk = F.regexp_extract(q, small_talk, 0)

    def out(fact: bool, note: Column) -> Column:
        return F.struct(F.lit(fact).alias("fact"), note.alias("note"))

    listed = lambda head, arr: F.concat(F.lit(head), F.array_join(F.array_sort(arr), "/"))
    rule = (
        F.when(F.coalesce(q, F.lit("")) == "", out(False, F.lit("[-]问题空")))
        .when(talk != "", out(False, F.concat(F.lit("[-]闲聊:"), talk)))
        .when(F.size(black) > 0, out(False, listed("[-]黑名单:", black)))
        .when(F.size(white) > 0, out(True, listed("[+]白名单:", white)))
    )
    if use_pos:
        short = (F.size(toks) < 10) & (F.size(toks) > 0)
        rule = rule.when(short & (F.size(named) > 0), out(False, listed("[-]词性指代:", named)))
        rule = rule.when(short, out(True, F.lit("[+]词性名词")))
    return rule.otherwise(out(False, F.lit("[-]其他")))


def chat_label(
    question: Column, answer: Column, groups: Sequence[tuple[str, Sequence[str]]], human: Column | None = None,
    tokens: Callable[[Column], Column] = words,
) -> Column:
    """``group:words`` label over question and answer, groups in order; '' without a match.
    A non-empty human label is kept."""
    both = F.concat(question, answer)
    phrase = F.contains(both, F.lit(V.FIXED_SKIP_PHRASE))
    label = F.when(phrase, F.lit(f"词组:{V.FIXED_SKIP_PHRASE}"))
    toks = tokens(both)
    for name, listed in groups:
        hits = F.array_sort(F.array_intersect(toks, F.array(*[F.lit(w) for w in listed]).cast("array<string>")))
        label = label.when(F.size(hits) > 0, F.concat(F.lit(f"{name}:"), F.array_join(hits, ",")))
    label = label.otherwise("")
    return label if human is None else F.coalesce(F.nullif(human, F.lit("")), label)


# --- similarity --------------------------------------------------------------


@F.pandas_udf(T.DoubleType())
def _ratio(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in pairs:
        yield pd.Series(
            [
                None if a is None or b is None else difflib.SequenceMatcher(None, a, b).ratio()
                for a, b in zip(left, right)
            ],
            dtype="float64",
        )


def similarity_ratio(a: Column, b: Column, cleaned: bool = False, when: Column | None = None) -> Column:
    """Matching-block ratio of two texts. Rows where ``when`` is false get null without
    being compared."""
    if cleaned:
        a, b = clean_question(a), clean_question(b)
    if when is not None:
        a, b = F.when(when, a), F.when(when, b)
    return _ratio(a, b)


def ratio_bound(a: Column, b: Column) -> Column:
    """Upper bound of the ratio, without Python: blocks in common can hold no character more often than both texts do."""
    total = F.length(a) + F.length(b)
    times = lambda text, c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
    letters = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(a)), lambda i: F.substr(a, i, F.lit(1))))
    in_common = F.aggregate(letters, F.lit(0), lambda n, c: n + F.least(times(a, c), times(b, c)))
    return F.when(total == 0, 1.0).otherwise(2.0 * in_common / total)


def word_overlap(a: Column, b: Column, when: Column | None = None, cleaned: bool = False) -> Column:
    """Shared distinct words of two texts over the mean of their numbers (1 for two texts without words): a native
    measure that can stand in for ``similarity_ratio``."""
    if cleaned:
        a, b = clean_question(a), clean_question(b)
    x, y = F.array_distinct(words(a)), F.array_distinct(words(b))
    total = F.size(x) + F.size(y)
    value = F.when(total == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(x, y)) / total)
    return value if when is None else F.when(when, value)


# --- lexicon and vocabulary learning -----------------------------------------


def learn_lexicon(phrases: DataFrame, phrase: str, minus: DataFrame, tokens: Callable[[Column], Column] = words) -> DataFrame:
    """(term, weight) of the tokens of the phrases, weighted by phrase count, without the
    terms of ``minus``, sorted."""
    counted = phrases.groupBy(phrase).agg(F.count(F.lit(1)).alias("_n"))
    toks = counted.select(F.explode(tokens(F.col(phrase))).alias("term"), "_n")
    return toks.groupBy("term").agg(F.sum("_n").alias("weight")).join(minus, "term", "left_anti").orderBy("term")


#: Tokens of a task counted at once.
COUNTED = 6_000_000
#: Bytes of input for which the pairs are dealt into one more part.
DEALT_BYTES = 8 << 20


def _counted_pairs(batches: Iterator[pa.RecordBatch], parts: int, most: int) -> Iterator[pa.RecordBatch]:
    """(part, counted): the pairs of about ``most`` tokens at a time with their counts; ``counted`` holds those of a part as a
    compressed Arrow row of lists: each word once, the places of both words of a pair, and how often it occurs."""

    def counted(texts: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        values = pa.concat_arrays([pa.array([None], pa.large_string()), *[t.flatten().cast(pa.large_string()) for t in texts]])
        coded = values.dictionary_encode("encode")  # null is number 0
        names, follow = coded.dictionary, coded.indices.to_numpy()[1:].astype(np.int64)
        keys = follow * len(names)
        keys[:-1] += follow[1:]
        ends = np.cumsum(np.concatenate([t.value_lengths().to_numpy() for t in texts])) - 1
        keys[ends] = follow[ends] * len(names)  # null at the end of a text
        keys, n = np.unique(keys, return_counts=True)
        a, b = np.divmod(keys, len(names))
        hashed = pd.util.hash_array(np.asarray(names.to_pandas(), dtype=object), categorize=False)
        mixed = hashed[a] * np.uint64(0x9E3779B97F4A7C15) + hashed[b] * np.uint64(0xBF58476D1CE4E5B9)
        part = ((mixed ^ (mixed >> np.uint64(31))) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            used, place = np.unique(np.concatenate([a[rows], b[rows]]), return_inverse=True)
            place = place.astype(np.int32)
            lists = [names.take(pa.array(used)), *map(pa.array, (place[: len(rows)], place[len(rows) :], n[rows]))]
            row = pa.RecordBatch.from_arrays([pa.LargeListArray.from_arrays(pa.array([0, len(x)], pa.int64()), x) for x in lists], names=["words", "a", "b", "n"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(row)
            yield pa.RecordBatch.from_arrays([pa.array(part[rows[:1]]), pa.array([sink.getvalue().to_pybytes()])], names=["part", "counted"])

    held, size = [], 0
    for batch in batches:
        held.append(batch.column(0))
        size += len(held[-1].flatten())
        if size >= most:
            yield from counted(held)
            held, size = [], 0
    if size:
        yield from counted(held)


def _summed_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, n), in order within a part, of rows (part, counted) that come part after part."""

    def summed(rows: list[bytes]) -> Iterator[pa.RecordBatch]:
        read = [pa.ipc.open_stream(r).read_all().to_batches()[0] for r in rows]
        words = [r.column("words").flatten() for r in read]
        coded = pa.concat_arrays(words).dictionary_encode("encode")
        order = pc.sort_indices(coded.dictionary)
        names, rank = coded.dictionary.take(order), np.empty(len(order), dtype=np.int64)
        rank[order.to_numpy()] = np.arange(len(order))
        code = rank[coded.indices.to_numpy()]
        first = np.cumsum([0, *map(len, words)])
        a, b = (np.concatenate([code[r.column(c).flatten().to_numpy() + at] for r, at in zip(read, first, strict=False)]) for c in "ab")
        keys, n = a * len(names) + b, np.concatenate([r.column("n").flatten().to_numpy() for r in read])
        by_key = np.argsort(keys, kind="stable")
        keys = keys[by_key]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        n = np.add.reduceat(n[by_key], starts)
        a, b = np.divmod(keys[starts], len(names))
        for at in range(0, len(n), 100_000):
            now = slice(at, at + 100_000)
            pair = [names.take(pa.array(x[now])).cast(pa.string()) for x in (a, b)]
            yield pa.RecordBatch.from_arrays([*pair, pa.array(n[now])], names=["a", "b", "n"])

    part, held = None, []
    for batch in batches:
        for p, row in zip(batch.column("part").to_pylist(), batch.column("counted").to_pylist(), strict=True):
            if held and p != part:
                yield from summed(held)
                held = []
            part = p
            held.append(row)
    if held:
        yield from summed(held)


def adjacent_counts(df: DataFrame, tokens: Column) -> DataFrame:
    """(a, b, n): how often token ``a`` is followed by ``b``, null at the end of a text. The
    texts are read once; a token's own count is the sum over ``b``.

    A task counts its pairs before it sends them, and sends them dealt by a hash of both words into parts, each word of a part once:
    as a row per pair they would take several times the room of the texts. A part of more input is no larger, there are more of them.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    planned = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())  # of the files; out of all bounds if it is not known
    if planned < 1 << 50:
        parts = max(parts, math.ceil(planned / DEALT_BYTES))
    texts = df.select(tokens.cast("array<string>").alias("_t")).where(F.size("_t") > 0)
    sent = texts.mapInArrow(lambda batches: _counted_pairs(batches, parts, COUNTED), "part int, counted binary").repartition(parts, "part")
    out = cut_lineage(sent.sortWithinPartitions("part").mapInArrow(_summed_pairs, "a string, b string, n bigint"), "adjacent")
    free_shuffles(spark)
    return out


def keyword_bigrams(df: DataFrame, tokens: Column, limit: int = 100, skip: str | None = None, glue: str = "") -> DataFrame:
    """(name, freq): the most frequent terms and adjacent pairs, ``limit`` of each, summed
    where a pair equals a term."""
    toks = F.transform(tokens, lambda x: F.trim(x))
    if skip:
        toks = F.filter(toks, lambda x: ~F.rlike(x, F.lit(skip)))
    counts = adjacent_counts(df, toks)
    terms = counts.where("a <> ''").groupBy(F.col("a").alias("name")).agg(F.sum("n").alias("freq"))
    pair = F.trim(F.concat_ws(glue, "a", "b")).alias("name")
    pairs = counts.where("b is not null").groupBy(pair).agg(F.sum("n").alias("freq"))
    top = lambda c: c.orderBy(F.desc("freq"), "name").limit(limit)
    return top(terms).unionByName(top(pairs)).groupBy("name").agg(F.sum("freq").alias("freq"))


def mention_entities(docs: DataFrame, key: str, text: str, dictionary: DataFrame, tokens: Callable[[Column], Column] = words) -> DataFrame:
    """(key, name), distinct: dictionary names among the tokens of each text."""
    toks = docs.select(key, F.explode(F.array_distinct(tokens(F.col(text)))).alias("name"))
    return toks.join(dictionary.select("name").distinct(), "name", "left_semi").select(key, "name").distinct()


def region_dictionary(provinces: DataFrame, column: str, countries: DataFrame, text: str) -> DataFrame:
    """Names of nested province -> city JSON and the bracketed names of a country text."""
    outer = provinces.select(F.explode(F.from_json(column, "map<string,map<string,string>>")).alias("name", "_c"))
    inner = outer.select(F.explode(F.map_keys("_c")).alias("name"))
    bracketed = countries.select(F.explode(F.regexp_extract_all(text, F.lit(r"[(（]([^()（）]+)[)）]"), 1)).alias("name"))
    return outer.select("name").unionByName(inner).unionByName(bracketed).distinct()


def phrase_vocabulary(
    df: DataFrame, tokens: Column, stop: DataFrame, min_count: int = 5, threshold: float = 10.0, glue: str = "_"
) -> DataFrame:
    """(term, n, score): words longer than one character outside the stop list (score null)
    and adjacent pairs with (n_ab - min_count) * vocabulary / (n_a * n_b) over the threshold."""
    counts = adjacent_counts(df, tokens)
    uni = counts.groupBy(F.col("a").alias("term")).agg(F.sum("n").alias("n"))
    bi = counts.where("b is not null")
    vocabulary = uni.select(F.lit(1)).unionByName(bi.select(F.lit(1))).agg(F.count(F.lit(1))).scalar()
    frequent = bi.where(F.col("n") > min_count)
    scored = (
        frequent.join(uni.select(F.col("term").alias("a"), F.col("n").alias("na")), "a")
        .join(uni.select(F.col("term").alias("b"), F.col("n").alias("nb")), "b")
        .withColumn("score", (F.col("n") - min_count) * vocabulary / (F.col("na") * F.col("nb")))
        .where(F.col("score") > threshold)
        .select(F.concat_ws(glue, "a", "b").alias("term"), "n", "score")
    )
    kept = uni.where(F.length("term") > 1).join(stop.select("term"), "term", "left_anti")
    return kept.withColumn("score", F.lit(None).cast("double")).unionByName(scored)


#: Bits of the table of phrase hashes that every task holds, whatever the number of phrases.
PHRASE_BITS = 1 << 24


def _may_hold(terms: DataFrame) -> np.ndarray:
    """PHRASE_BITS bits, as bytes: set at the hash of each of the terms."""
    place = F.pmod(F.xxhash64("term"), F.lit(PHRASE_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))
    words = terms.select(F.shiftright(place, 6).alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("w")).toArrow()
    bits = np.zeros(PHRASE_BITS // 64, dtype=np.int64)
    bits[words.column("at").to_numpy()] = words.column("w").to_numpy()
    return np.unpackbits(bits.view(np.uint8), bitorder="little").view(bool)


def phrased_tokens(df: DataFrame, key: str, tokens: Column, phrases: DataFrame, glue: str = "_") -> DataFrame:
    """(key, tokens) with adjacent tokens that form a phrase joined, from left to right, none used twice.

    ``phrases``: term, the joined form (the scored terms of ``phrase_vocabulary``). ``key`` is unique; rows that share one are worked
    on as one text, in which the words of a place follow each other. The phrases are joined as a table of any size, and only
    places that may begin one, as a small table of hashes says, leave the text; it is put together again from the pieces between them.
    """
    spark = df.sparkSession
    known = cut_lineage(phrases.select("term").where("term is not null").distinct(), "phrases")
    free_shuffles(spark)
    repeated = cut_lineage(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key), "repeated")
    single = df
    if not repeated.isEmpty():
        single = df.join(repeated, key, "left_anti")
    ends = F.zip_with(F.slice("_t", F.lit(1), F.size("_t") - 1), F.slice("_t", F.lit(2), F.size("_t")), lambda a, b: F.concat(a, F.lit(glue), b))
    bits = spark.sparkContext.broadcast(np.packbits(_may_hold(known)))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(bits.value).view(bool)
        for batch in batches:
            terms, sizes = batch.column("ends").flatten(), batch.column("ends").value_lengths().to_numpy()
            at = np.flatnonzero(held[batch.column("places").flatten().to_numpy()])
            row = np.repeat(np.arange(len(sizes)), sizes)[at]
            pos = at - (np.cumsum(sizes) - sizes)[row]
            columns = [batch.column("key").take(pa.array(row)), pa.array(pos.astype(np.int32)), terms.take(pa.array(at))]
            yield pa.RecordBatch.from_arrays(columns, names=["_key", "pos", "term"])

    spread = single.select(F.col(key).alias("key"), tokens.alias("_t")).where((F.size("_t") > 1) & F.col("key").isNotNull()).select("key", ends.alias("ends"))
    hashed = F.transform("ends", lambda x: F.pmod(F.xxhash64(x), F.lit(PHRASE_BITS)).cast("int"))
    key_type = df.schema[key].dataType.simpleString()
    places = spread.select("key", "ends", hashed.alias("places")).mapInArrow(candidates, f"_key {key_type}, pos int, term string")
    hits = places.join(known, "term").select("_key", "pos")
    # in a row of places that could each begin a phrase, every second one does
    run = F.col("pos") - F.row_number().over(Window.partitionBy("_key").orderBy("pos"))
    nth = F.row_number().over(Window.partitionBy("_key", "_run").orderBy("pos"))
    begun = hits.withColumn("_run", run).withColumn("_nth", nth).where("_nth % 2 = 1").groupBy("_key").agg(F.sort_array(F.collect_list("pos")).alias("_b"))
    begun = cut_lineage(begun, "begun")
    free_shuffles(spark)
    word = lambda at: F.get("_t", at)
    later = F.concat(F.slice("_b", F.lit(2), F.size("_b")), F.array(F.size("_t")))
    piece = lambda x, y: F.concat(F.array(F.concat(word(x), F.lit(glue), word(x + 1))), F.slice("_t", x + 3, y - x - 2))
    whole = F.concat(F.slice("_t", F.lit(1), F.get("_b", F.lit(0))), F.flatten(F.zip_with("_b", later, piece)))
    # the rows meet their places as they are and are cut into words after that, since words take several times the room
    joined = single.join(begun, F.col(key) == F.col("_key"), "left").select(key, "_b", tokens.alias("_t"))
    out = joined.select(key, F.when(F.col("_b").isNull(), F.col("_t")).otherwise(whole).alias("tokens"))
    if repeated.isEmpty():
        return out
    return out.unionByName(_phrased_together(df.join(repeated, key, "left_semi").select(key, tokens.alias("_t")), key, known, glue))


def _phrased_together(t: DataFrame, key: str, known: DataFrame, glue: str) -> DataFrame:
    """(key, tokens) of rows (key, _t) that share keys: a word at a time, those of a key in one order of places."""
    spread = t.where(F.size("_t") > 0).select(
        key, F.posexplode(F.arrays_zip(F.col("_t").alias("a"), F.slice("_t", F.lit(2), F.size("_t")).alias("b"))).alias("pos", "p")
    ).select(key, "pos", "p.a", F.concat(F.col("p.a"), F.lit(glue), F.col("p.b")).alias("term"))
    marked = spread.join(known.withColumn("hit", F.lit(True)), "term", "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    w = Window.partitionBy(key).orderBy("pos")
    row = F.when(F.col("hit"), F.col("pos") - F.sum(F.col("hit").cast("int")).over(w))
    nth = F.row_number().over(Window.partitionBy(key, "_row").orderBy("pos"))
    begun = marked.withColumn("_row", row).withColumn("begins", F.col("hit") & (nth % 2 == 1))
    kept = begun.withColumn("used", F.coalesce(F.lag("begins").over(w), F.lit(False))).where("not used")
    joined = kept.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", F.when(F.col("begins"), F.col("term")).otherwise(F.col("a")).alias("w")))).alias("_l"))
    out = t.join(joined.withColumnRenamed(key, "_key"), F.col(key) == F.col("_key"), "left")
    return out.select(key, F.coalesce(F.transform("_l", lambda x: x["w"]), F.col("_t")).alias("tokens"))


def term_features(df: DataFrame, text: str, terms: Sequence[str]) -> DataFrame:
    """Add ``features``: 1 for each term the text contains, else 0."""
    from pyspark.ml.functions import array_to_vector

    flags = F.array(*[F.contains(F.lower(text), F.lit(t)).cast("double") for t in terms])
    return df.withColumn("features", array_to_vector(flags))


def train_classifier(
    df: DataFrame, text: str, target: str, terms: Sequence[str], folds: int = 3, iters: int = 10, depth: int = 3, seed: int = 7
):
    """(model, mean fold score, report) of gradient-boosted trees over contains-term
    features; ``target`` is numeric from 0. More than two classes are trained one against
    the rest. Folds and model see four fifths of the rows; the report is on the last fifth."""
    from pyspark.ml.classification import GBTClassifier, OneVsRest
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    data = term_features(df, text, terms).select("features", F.col(target).cast("double").alias("label"))
    data = cut_lineage(data, "features")  # the folds read the flags, not the texts
    classes = data.agg(F.max("label")).first()[0]
    gbt = GBTClassifier(maxIter=iters, maxDepth=depth, seed=seed)
    learner = gbt if classes <= 1 else OneVsRest(classifier=gbt)
    check = MulticlassClassificationEvaluator(metricName="accuracy")
    cv = CrossValidator(estimator=learner, estimatorParamMaps=ParamGridBuilder().build(), evaluator=check, numFolds=folds, seed=seed)
    seen, held = data.randomSplit([0.8, 0.2], seed)
    model = cv.fit(seen)
    report = classification_report(model.transform(held), "label", "prediction")
    return model.bestModel, model.avgMetrics[0], report
