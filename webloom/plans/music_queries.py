"""Music jobs over the driver tables: parts are songs, suppliers artists."""

from pyspark.sql import functions as F

from webloom.functions import fixed_values as V
from webloom.operators import music
from webloom.plans.registry import query

_NAME = "upper(p_name) || case p_partkey % 4 when 0 then ' (Live)' when 1 then '（remix·2）' else '' end"
_ARTIST = "case p_partkey % 5 when 0 then '' when 1 then p_type || ' x ' || p_brand when 2 then p_type || ';' || p_brand else p_type end"
_TAGS = "p_type || ' ' || p_name"
_ALIAS = "case p_size % 3 when 0 then '' when 1 then ' a-b/c·d ' else 'z' end"


def songs(t):
    flags = F.array(
        F.struct(F.lit("LISTEN").alias("action"), F.when(F.col("p_size") % 4 == 0, "FREE").otherwise("PAY").alias("opt")),
        F.struct(F.lit("DOWN").alias("action"), F.lit("FREE").alias("opt")),
    )
    return t.part.select(
        F.col("p_partkey").alias("id"), F.expr(_NAME).alias("name"), F.expr(_NAME).alias("songName"), F.expr(_ARTIST).alias("artist"),
        F.col("p_brand").alias("artistid"), F.expr(_ALIAS).alias("artist_alias"), F.col("p_brand").alias("album"), F.col("p_size").alias("fans"),
        (F.col("p_size") * 2).alias("song_share"), (F.col("p_size") + 7).alias("comment_cnt"), (F.col("p_partkey") % 100).alias("plays"),
        F.array(F.expr(_TAGS), F.col("p_brand"), F.col("p_type")).alias("tags"),
        F.struct(F.lit("api artist").alias("artist_name"), flags.alias("purview_flag")).alias("raw_api_json"),
    )


_SONG = rf"""b as (select p_partkey as id, lower({_NAME}) as lname, case when ({_ARTIST}) = '' then 'api artist' else {_ARTIST} end as artist, p_brand as album, p_size,
      list_distinct(string_split({_TAGS}, ' ') || [p_brand, p_type]) as tg, trim(translate({_ALIAS}, '·-‧()•・', '')) as atx from part),
    c as (select *, translate(trim(regexp_replace(lname, '{V.VERSION}', '', 'g')), '·-‧()•・', '') as name, regexp_extract_all(lname, '{V.VERSION}', 1) as vs,
      list_transform([artist] || case when regexp_matches(artist, ' x |;') then regexp_split_to_array(artist, ' x |;') else [] end
        || case when atx <> '' then string_split(atx, '/') else [] end, lambda a: trim(translate(a, '·-‧()•・', ''))) as al from b),
    s as (select id, name, artist, album, p_size, al, list_filter(tg, lambda x: x <> name and x <> album and x <> artist) as own,
      list_filter(tg, lambda x: x <> name and x <> album and x <> artist) || list_transform(al, lambda a: 'AN:' || a) || list_transform(vs, lambda a: 'VN:' || a)
        || ['BN:' || album, 'MN:' || name] as tags from c)"""


@query(
    "clean_song",
    f"""with {_SONG} select id, name, artist, array_to_string(al, '|') as alias, array_to_string(list_sort(tags), '|') as tags,
    cast(case when p_size % 4 = 0 then 0 else 1 end as int) as pay, round(cast(p_size * 0.001 + p_size * 2 * 0.599 + (p_size + 7) * 0.4 as double), 6) as hot_score from s""",
)
def _(t):
    return music.clean_song(songs(t)).select(
        "id", "name", "artist", F.array_join("artist_alias", "|").alias("alias"), F.array_join(F.array_sort("tags"), "|").alias("tags"), "pay",
        F.round("hot_score", 6).alias("hot_score"),
    )


@query("hot_score", "select p_partkey, round(p_size * 0.001 + p_retailprice * 0.599 + (p_size + 7) * 0.4, 4) as score from part")
def _(t):
    return t.part.select("p_partkey", F.round(music.hot_score(F.col("p_size"), F.col("p_retailprice"), F.col("p_size") + 7), 4).alias("score"))


@query("pay_flag", "select event_id, cast(case when event_type = 'view' then 0 else 1 end as int) as pay from events")
def _(t):
    flag = F.struct(F.when(F.col("event_type") == "view", "LISTEN").otherwise("DOWN").alias("action"), F.lit("FREE").alias("opt"))
    return t.events.select("event_id", music.pay_flag(F.array(flag)).alias("pay"))


@query(
    "versions",
    rf"""select distinct unnest(regexp_extract_all(lower(replace(replace(text, ', ', ' ('), '. ', ') ')), '{V.VERSION}', 1)) as version from documents""",
)
def _(t):
    d = t.documents.select(F.replace(F.replace("text", F.lit(", "), F.lit(" (")), F.lit(". "), F.lit(") ")).alias("name"))
    return music.versions(d, "name")


@query("tag_counts", f"with {_SONG} select tag, count(*) as n from (select unnest(own) as tag from s) group by 1")
def _(t):
    return music.tag_counts(music.clean_song(songs(t)))


@query("song_dictionary", f'with {_SONG} select name as "songName", artist, cast(id % 100 as varchar) as plays, cast(id as varchar) as id from s')
def _(t):
    return music.song_dictionary(music.clean_song(songs(t)))


@query("refresh_chart", "select arg_max(p_partkey, p_partkey) as id, p_name as song, arg_max(p_size, p_partkey) as score from part group by p_name")
def _(t):
    chart = t.part.select(F.col("p_name").alias("song"), F.col("p_partkey").alias("id"), F.col("p_size").alias("score"))
    return music.refresh_chart(chart, "song", "id")


@query(
    "album_songs",
    """select l_orderkey, l_linenumber, s_name as artist_name, p_name as album_name from lineitem join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey
    where l_quantity >= 5""",
)
def _(t):
    s = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_quantity") >= 5, F.col("l_suppkey")).alias("artist_id"), F.col("l_partkey").alias("album_id")
    )
    artists = t.supplier.select(F.col("s_suppkey").alias("artist_id"), F.col("s_name").alias("artist_name"))
    albums = t.part.select(F.col("p_partkey").alias("album_id"), F.col("p_name").alias("album_name"))
    return music.album_songs(s, artists, albums).select("l_orderkey", "l_linenumber", "artist_name", "album_name")
