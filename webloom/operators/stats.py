"""Counters and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def _n() -> Column:
    return F.count(F.lit(1)).alias("n")


def _n_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per label group, the part of the label before ``:``."""
    return df.groupBy(F.regexp_replace(label, ":.*$", "").alias("label")).agg(_n())


def domain_stats(records: DataFrame) -> DataFrame:
    """Records, distinct series, distinct products and news per domain; the null domain
    is the grand total. Input: domain, series, product, is_news."""
    return records.rollup("domain").agg(
        _n_if(~F.col("is_news")).alias("records"),
        F.count_distinct("series").alias("series"),
        F.count_distinct("product").alias("products"),
        _n_if(F.col("is_news")).alias("news"),
    )


def snapshot_delta(df: DataFrame, key: str, value: str, taken: str, start: Column, end: Column) -> DataFrame:
    """Per key: newest minus oldest value among snapshots in [start, end)."""
    return (
        df.where((F.col(taken) >= start) & (F.col(taken) < end))
        .groupBy(key)
        .agg(F.min_by(value, taken).alias("oldest"), F.max_by(value, taken).alias("newest"))
        .withColumn("delta", F.col("newest") - F.col("oldest"))
    )


def attribute_frequency(pairs: DataFrame, attribute: str = "attribute") -> DataFrame:
    """Attribute names by descending frequency."""
    return pairs.groupBy(attribute).agg(_n()).orderBy(F.desc("n"), attribute)


def class_tables(tags: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entity, tag) without repeats, and (attribute -> count)."""
    return tags.where("tag is not null").select("entity", "tag").distinct(), attribute_frequency(pairs)


def existence_ratio(df: DataFrame, section: str) -> DataFrame:
    return df.agg(F.avg(F.col(section).isNotNull().cast("double")).alias("ratio"), _n())


def lacking(df: DataFrame, section: str, key: str) -> DataFrame:
    return df.where(F.col(section).isNull()).select(key)


def coverage(tests: DataFrame, entities: DataFrame, key: str) -> DataFrame:
    """Share of the distinct, non-blank test values that are entities."""
    t = tests.select(key).where(F.trim(F.col(key).cast("string")) != "").distinct()
    hits = t.join(entities.select(key).distinct().withColumn("_hit", F.lit(1)), key, "left")
    return hits.agg((F.count("_hit") / F.count(F.lit(1))).alias("coverage"), F.count(F.lit(1)).alias("tests"))


# Fixed value: characters of symbol-only terms
SYMBOLS = (
    "A-Za-z0-9"
    r"!@#$%^&*()\-_+={}\[\]|\;:<>,./?~`，。、！？（）‘’《》｛｝＊…～★【】“” ｜”『』"
)


def length_histogram(terms: DataFrame, term: str, split_at: int = 7) -> DataFrame:
    """Terms per length with the short/long side of the split."""
    n = F.length(term)
    return terms.groupBy(n.alias("length"), (n > split_at).alias("is_long")).agg(_n())


def length_buckets(terms: DataFrame, term: str) -> DataFrame:
    """Terms with bucket 1, 2, 3 or 4 (4 and more); symbol-only terms that are not
    plainly alphanumeric are dropped."""
    only_symbols = F.rlike(term, F.lit(f"^[{SYMBOLS}]*$")) & ~F.rlike(term, F.lit("^[A-Za-z0-9]+$"))
    n = F.length(term)
    bucket = F.when(n.isin(1, 2, 3), n).otherwise(4)
    return terms.where(~only_symbols).withColumn("bucket", bucket)


def suffix_counts(names: DataFrame, name: str, top: int = 1000) -> DataFrame:
    """The most frequent endings of one, two and three characters, counted together.
    A name shorter than an ending counts as a whole."""
    c = F.col(name)
    ends = names.select(F.explode(F.array(*[F.right(c, F.lit(k)) for k in (1, 2, 3)])).alias("suffix"))
    return ends.groupBy("suffix").agg(_n()).orderBy(F.desc("n"), "suffix").limit(top)


def host_group_sum(df: DataFrame, group: Column, num: str) -> DataFrame:
    """Sum of ``num`` per group, with the grand total under a null group."""
    return df.withColumn("grp", group).rollup("grp").agg(F.sum(num).alias("total"))


def hit_rates(rows: DataFrame, known: DataFrame, excluded_host: str) -> DataFrame:
    """Percentage of rows with an answer from another host, and of those also known by id.
    Input: answer, url, item_id; ``known``: item_id."""
    hit = (F.coalesce(F.col("answer"), F.lit("")) != "") & ~F.contains("url", F.lit(excluded_host))
    ids = known.select("item_id").distinct().withColumn("_k", F.lit(1))
    return rows.join(ids, "item_id", "left").agg(
        (100 * _n_if(hit) / F.count(F.lit(1))).alias("hit_pct"),
        (100 * _n_if(hit & F.col("_k").isNotNull()) / F.count(F.lit(1))).alias("known_pct"),
    )


def duplicate_report(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """(what, key, n): repeated artist ids, repeated whole song rows, songs per artist
    including zero, and their total. Input: songs(song_id, artist_id, ...), artists(artist_id)."""

    def tag(df: DataFrame, what: str, key: Column) -> DataFrame:
        return df.select(F.lit(what).alias("what"), key.cast("string").alias("key"), F.col("n"))

    artist_n = artists.groupBy("artist_id").agg(_n())
    song_n = songs.groupBy(*songs.columns).agg(_n())
    per_artist = artists.select("artist_id").distinct().join(
        songs.groupBy("artist_id").agg(_n()), "artist_id", "left"
    ).select("artist_id", F.coalesce("n", F.lit(0)).alias("n"))
    return (
        tag(artist_n.where("n > 1"), "duplicate_artist", F.col("artist_id"))
        .unionByName(tag(song_n.where("n > 1"), "duplicate_song", F.concat_ws("__", F.col("song_id").cast("string"), F.col("artist_id").cast("string"))))
        .unionByName(tag(per_artist, "songs_of_artist", F.col("artist_id")))
        .unionByName(tag(per_artist.agg(F.sum("n").alias("n")), "total", F.lit("total")))
    )


def search_completeness(expected: DataFrame, items: DataFrame) -> DataFrame:
    """Per keyword: expected total over indexes, collected items, distinct names and
    whether they disagree. Input: expected(keyword, idx, total), items(keyword, idx, name)."""
    exp = expected.groupBy("keyword").agg(F.sum("total").alias("expected"))
    got = items.groupBy("keyword").agg(F.count(F.lit(1)).alias("collected"), F.count_distinct("name").alias("actual"))
    zero = F.lit(0).cast("bigint")
    return exp.join(got, "keyword", "left").select(
        "keyword", "expected", F.coalesce("collected", zero).alias("collected"), F.coalesce("actual", zero).alias("actual"),
        (F.col("expected") != F.coalesce("actual", zero)).alias("mismatch"),
    )


def confusion_matrix(df: DataFrame, target: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(target).alias("target"), F.col(predicted).alias("predicted")).agg(_n())


def classification_report(df: DataFrame, target: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts alone."""
    m = confusion_matrix(df, target, predicted)
    sides = m.select(
        F.explode(
            F.array(
                F.struct(F.col("target").alias("label"), F.col("n").alias("as_target"), F.lit(0).cast("bigint").alias("as_pred"),
                         F.when(F.col("target") == F.col("predicted"), F.col("n")).otherwise(0).alias("tp")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("as_target"), F.col("n").alias("as_pred"),
                         F.lit(0).cast("bigint").alias("tp")),
            )
        ).alias("s")
    ).select("s.*")
    per = sides.groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("as_pred").alias("as_pred"), F.sum("as_target").alias("support"))
    zero = F.lit(0.0)
    precision = F.when(F.col("as_pred") > 0, F.col("tp") / F.col("as_pred")).otherwise(zero)
    recall = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(zero)
    f1 = F.when(F.col("tp") > 0, 2 * F.col("tp") / (F.col("as_pred") + F.col("support"))).otherwise(zero)
    return per.select("label", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support")


def evaluate(tests: Sequence[DataFrame], predict: Column, item: str, expect: str) -> DataFrame:
    """Report of a prediction column over test sets; of a repeated item the earlier set counts."""
    ranked = None
    for i, t in enumerate(tests):
        part = t.select(item, expect).withColumn("_o", F.lit(i))
        ranked = part if ranked is None else ranked.unionByName(part)
    one = ranked.groupBy(item).agg(F.min_by(expect, "_o").alias(expect)).withColumn("_p", predict)
    return classification_report(one, expect, "_p")


def seeded_order(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def error_lists(
    df: DataFrame, key: str, expect: str, actual: str, sample: int = 1500, seed: int = 1, matched: Column | None = None
) -> DataFrame:
    """Rows tagged false_positive, false_negative or true_negative; of the last kind a
    seeded sample of ``sample`` rows. ``matched``, the listed words a text holds, is put beside each row
    as ``matched``, with commas between."""
    e, a = F.col(expect), F.col(actual)
    if matched is not None:
        df = df.withColumn("matched", F.array_join(matched, ","))
    wrong = df.where(e != a).withColumn("kind", F.when(a == 1, "false_positive").otherwise("false_negative"))
    right = df.where((e == 0) & (a == 0)).withColumn("kind", F.lit("true_negative"))
    return wrong.unionByName(right.orderBy(seeded_order(key, seed), key).limit(sample))


def record_dictionary(df: DataFrame, domain: Column, entity: Column, name: Column) -> DataFrame:
    return df.select(domain.alias("domain"), entity.alias("entity"), name.alias("name")).distinct()


def checksum_diff(a: DataFrame, b: DataFrame, key: str, content: str) -> DataFrame:
    """Keys whose copies differ or that one side lacks."""
    left = a.select(key, F.md5(content).alias("_a"))
    right = b.select(key, F.md5(content).alias("_b"))
    state = (
        F.when(F.col("_a").isNull(), "missing_left").when(F.col("_b").isNull(), "missing_right").otherwise("mismatch")
    )
    both = left.join(right, key, "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b")))
    return both.select(key, state.alias("state"))
