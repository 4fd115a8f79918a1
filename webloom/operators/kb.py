"""Knowledge-base jobs: entity extraction, fragment merge, attribute documents, aliases."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import fixed_values as V
from webloom.functions import ids, text
from webloom.operators.joins import map_name
from webloom.operators.pages import clean_headword, dump_entries
from webloom.scale import last_per_key, position_in_group

FRAGMENT_DDL = "map<string, struct<Tags:array<string>, Information:string, `av pair`:array<array<string>>>>"


def extract_entities(df: DataFrame, kind: str, column: str, aliases: str | None = None) -> DataFrame:
    """Distinct ``name`` values of one source. Kinds: ``font`` (titles with font tags),
    ``dump`` (headwords and links of dump records), ``labels`` (labels without
    disambiguation, plus ``aliases``), ``resource`` (labels without disambiguation),
    ``titles`` (the same, unreadable ones dropped), ``brackets`` (names without brackets)."""
    c = F.col(column)
    if kind == "font":
        names = df.select(text.strip(clean_headword(text.drop_label_tags(c) if aliases else c)).alias("name"))
    elif kind == "dump":
        entries = dump_entries(df, column)
        names = entries.select(F.explode(F.array("headword", "alias")).alias("name"))
    elif kind == "labels":
        own = F.array(text.strip(text.drop_disambiguation(c)))
        more = F.transform(F.coalesce(F.col(aliases), F.array().cast("array<string>")), text.strip) if aliases else None
        names = df.select(F.explode(F.concat(own, more) if more is not None else own).alias("name"))
    elif kind == "resource":
        names = df.select(text.drop_disambiguation(text.strip(c)).alias("name"))
    elif kind == "titles":
        names = df.select(text.strip(text.drop_disambiguation(text.strip(c))).alias("name"))
        names = names.where(~F.rlike("name", F.lit(V.HEADWORD["unreadable"])))
    elif kind == "brackets":
        names = df.select(text.drop_brackets(c).alias("name"))
    else:
        raise ValueError(f"unknown entity source kind: {kind}")
    return names.where("name is not null and name <> ''").distinct()


def fragments(lines: DataFrame, column: str, seq: str) -> DataFrame:
    """(entity, seq, tags, information, pairs) of JSON fragments keyed by entity name."""
    parsed = lines.select(F.col(seq).alias("seq"), F.explode(F.from_json(column, FRAGMENT_DDL)).alias("entity", "_v"))
    return parsed.select(
        "entity", "seq", F.col("_v.Tags").alias("tags"), F.col("_v.Information").alias("information"), F.col("_v.`av pair`").alias("pairs")
    )


def merge_fragments(frags: DataFrame) -> DataFrame:
    """One row per entity: of each kind the first non-empty fragment."""

    def first(name: str, filled: Column) -> Column:
        return F.min_by(F.when(filled, F.col(name)), F.when(filled, F.col("seq"))).alias(name)

    return frags.groupBy("entity").agg(
        first("tags", F.size("tags") > 0), first("information", F.length("information") > 0), first("pairs", F.size("pairs") > 0)
    )


def fragment_counts(merged: DataFrame) -> DataFrame:
    """Merged entities per kind and in all."""
    counts = merged.agg(*[F.count(c).alias(c) for c in ("tags", "information", "pairs")])
    kinds = [F.struct(F.lit(c).alias("kind"), F.col(c).alias("n")) for c in ("tags", "information", "pairs")]
    total = F.struct(F.lit("count").alias("kind"), (F.col("tags") + F.col("information") + F.col("pairs")).alias("n"))
    return counts.select(F.explode(F.array(*kinds, total)).alias("r")).select("r.*")


def entity_dictionary(df: DataFrame, column: str, without_brackets: bool = False) -> DataFrame:
    c = text.strip(F.col(column))
    name = text.drop_brackets(c) if without_brackets else c
    return df.select(name.alias("name")).where("name <> ''").distinct()


def exploded_pairs(merged: DataFrame) -> DataFrame:
    """(entity, ord, attribute, value) of merged entities."""
    p = merged.select("entity", F.posexplode("pairs").alias("ord", "_p"))
    return p.select("entity", "ord", F.get("_p", F.lit(0)).alias("attribute"), F.get("_p", F.lit(1)).alias("value"))


def eav_rows(pairs: DataFrame, skip: str = V.CHINESE_NAME_ATTRIBUTE, aliases: Sequence[str] = V.ALIAS_ATTRIBUTES) -> DataFrame:
    """(entity, attribute, pos, value): one row per value, numbered from 0 in order. The Chinese
    name and alias attributes are left out; the latter are in ``alias_map``."""
    kept = pairs.where(~F.col("attribute").isin(skip, *aliases))
    placed = position_in_group(kept, ["entity", "attribute"], ["ord"], F.expr("ord div 100000"))
    return placed.select("entity", "attribute", "pos", "value")


def alias_map(pairs: DataFrame, labels: Sequence[str] = V.ALIAS_LABELS) -> DataFrame:
    """(entity, pos, alias): one row per alias value, numbered from 0 in order."""
    kept = pairs.where(F.col("attribute").isin(*labels))
    return position_in_group(kept, ["entity"], ["ord"], F.expr("ord div 100000")).select("entity", "pos", F.col("value").alias("alias"))


def tag_map(frags: DataFrame) -> DataFrame:
    """Tags per entity; the last fragment with tags counts."""
    return last_per_key(frags.where(F.col("tags").isNotNull()).select("entity", "seq", "tags"), ["entity"], ["seq"]).drop("seq")


def attribute_mapping(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add ``attribute_name``: the mapped expression of an attribute, or itself.
    ``mapping``: raw, mapped."""
    return map_name(rows, "attribute", mapping, "attribute_name")


def definition_values(c: Column, multi: bool = False, stop: str = "。") -> Column:
    """Definition texts: the non-empty parts between the breaks of a multi-source text, else
    the first sentence and the whole (one value when they are equal)."""
    t = text.strip(c)
    if multi:
        return F.filter(F.split(t, r"\|\|\|"), lambda x: x != "")
    short = text.first_sentence(t, stop)
    return F.when(short == t, F.array(t)).otherwise(F.array(short, t))


def eav_document(values: DataFrame, kind: str) -> DataFrame:
    """Served documents, one per (entity, attribute), of the first values among (entity, attribute, attribute_name, pos, value,
    category, searchscore); ``kind`` is the tag of the attribute class. All values stay in the table of ``values``,
    all tags are in ``document_tags``."""
    e = F.col("entity")
    return values.where("pos = 0").select(
        ids.attribute_id(e, F.col("attribute")).alias("id"), "entity", text.drop_brackets(e).alias("entity_name"), "attribute", "attribute_name",
        F.coalesce("value", F.lit("")).alias("value"), F.lit(kind).alias("kind"), "category", "searchscore",
    )


def document_tags(documents: DataFrame, aliases: DataFrame) -> DataFrame:
    """(id, tag), distinct: the words a document is found by. ``aliases``: entity, alias."""
    e = F.col("entity")
    none = F.array().cast("array<string>")
    own = F.concat(
        F.array(e, F.lower(e), F.upper(e), F.col("kind")),
        F.when(F.rlike(e, F.lit(V.BRACKETED_NAME)), F.array(F.lower("entity_name"), F.upper("entity_name"))).otherwise(none),
    )
    # dealt before the tags are spread: a task holds its share of the documents only, and the tags need no further shuffle
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    other = documents.select("id", "entity").join(aliases.select("entity", "alias"), "entity").select("id", F.array("alias").alias("_own"))
    dealt = documents.select("id", F.array_distinct(own).alias("_own")).unionByName(other).repartition(parts, "id")
    return dealt.select("id", F.explode("_own").alias("tag")).where("tag is not null").distinct()


def merge_aliases(sources: Sequence[DataFrame], entities: DataFrame, special: tuple[str, str] = V.RANGE_SUFFIX,
                  pattern: str = V.PURE_CHINESE) -> DataFrame:
    """(entity, alias), distinct: aliases of the listed entities from (entity, aliases)
    sources of comma-separated text, plus the short form of a name with the special
    ending; one-character and non-Chinese aliases are dropped."""
    ending, tail = special
    texts = reduce(DataFrame.unionByName, [s.select("entity", "aliases") for s in sources])
    known = texts.join(entities.select("entity").distinct(), "entity", "left_semi")
    listed = known.select("entity", F.explode(F.split("aliases", ",")).alias("alias"))
    e = F.col("entity")
    short = entities.where(F.endswith(e, F.lit(ending))).select(
        "entity", F.substring(e, F.lit(1), F.length(e) - len(tail)).alias("alias")
    )
    return listed.unionByName(short).where((F.length("alias") > 1) & F.rlike("alias", F.lit(pattern))).distinct()
