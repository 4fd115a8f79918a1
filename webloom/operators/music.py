"""Music-catalogue cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import fixed_values as V
from webloom.functions.text import strip
from webloom.scale import last_per_key


def drop_dots(c: Column) -> Column:
    return F.translate(c, "".join(V.NAME_DOTS), "")


def hot_score(fans: Column, shares: Column, comments: Column) -> Column:
    w = V.HOT_WEIGHTS
    return fans * w["fans"] + shares * w["shares"] + comments * w["comments"]


def pay_flag(flags: Column) -> Column:
    """0 when any entry allows free listening, else 1."""
    free = F.exists(flags, lambda f: (f["action"] == "LISTEN") & (f["opt"] == "FREE"))
    return F.when(free, 0).otherwise(1)


def version_texts(name: Column) -> Column:
    return F.regexp_extract_all(name, F.lit(V.VERSION), 1)


def versions(songs: DataFrame, name: str) -> DataFrame:
    """Distinct bracketed version texts of lower-cased names."""
    return songs.select(F.explode(version_texts(F.lower(name))).alias("version")).distinct()


def clean_song(songs: DataFrame) -> DataFrame:
    """Cleaned songs: names, artist aliases, prefixed tags, pay flag and score.

    The first alias is the artist; the artist is split at `` x `` or ``;``, the alias text
    at ``/``. The song's own name, album and artist are no tags.
    """
    none = F.array().cast("array<string>")
    artist = F.when(F.coalesce(F.col("artist"), F.lit("")) == "", F.col("raw_api_json.artist_name")).otherwise(F.col("artist"))
    name = F.lower("name")
    plain = drop_dots(strip(F.regexp_replace(name, V.VERSION, "")))
    base = songs.select(
        *[F.col(c) for c in songs.columns if c not in ("artist", "name", "songName", "tags", "artist_alias", "fans", "raw_api_json")],
        artist.alias("artist"), plain.alias("name"), version_texts(name).alias("_versions"),
        F.array_distinct(F.flatten(F.transform("tags", lambda x: F.split(x, " ")))).alias("_tags"),
        strip(drop_dots(F.col("artist_alias"))).alias("_alias_text"), F.col("fans").alias("artist_fans"),
        pay_flag(F.col("raw_api_json.purview_flag")).alias("pay"),
    )
    parts = F.when(F.rlike("artist", F.lit(V.ARTIST_SPLIT)), F.split("artist", V.ARTIST_SPLIT)).otherwise(none)
    texts = F.when(F.col("_alias_text") != "", F.split("_alias_text", "/")).otherwise(none)
    base = base.withColumn("artist_alias", F.transform(F.concat(F.array("artist"), parts, texts), lambda a: strip(drop_dots(a))))
    prefixed = lambda prefix, items: F.transform(items, lambda x: F.concat(F.lit(prefix), x))
    own = F.array_except(F.col("_tags"), F.array("name", "album", "artist"))
    tags = F.concat(
        own, prefixed("AN:", F.col("artist_alias")), prefixed("VN:", F.col("_versions")),
        F.array(F.concat(F.lit("BN:"), strip(F.col("album"))), F.concat(F.lit("MN:"), F.col("name"))),
    )
    return (
        base.withColumn("songName", F.col("name")).withColumn("tags", tags)
        .withColumn("hot_score", hot_score(F.col("artist_fans"), F.col("song_share"), F.col("comment_cnt")))
        .drop("_versions", "_tags", "_alias_text")
    )


def tag_counts(songs: DataFrame) -> DataFrame:
    """Tag frequency without the prefixed tags."""
    t = songs.select(F.explode("tags").alias("tag"))
    return t.where(~F.substring("tag", 1, 3).isin(*V.TAG_PREFIXES)).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def song_dictionary(songs: DataFrame) -> DataFrame:
    return songs.select("songName", "artist", F.col("plays").cast("string").alias("plays"), F.col("id").cast("string").alias("id"))


def write_song_dictionary(songs: DataFrame, path: str) -> None:
    song_dictionary(songs).write.csv(path, sep="\t")


def refresh_chart(songs: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of the replaced chart: one per song id, the last one in ``order``."""
    return last_per_key(songs, [key], [order])


def write_chart(songs: DataFrame, key: str, order: str, path: str) -> None:
    refresh_chart(songs, key, order).write.mode("overwrite").parquet(path)


def album_songs(songs: DataFrame, artists: DataFrame, albums: DataFrame) -> DataFrame:
    """Songs with artist and album attributes; a song without either is skipped."""
    usable = songs.where("artist_id is not null and album_id is not null")
    return usable.join(artists, "artist_id").join(albums, "album_id")
