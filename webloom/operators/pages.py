"""Pages to typed rows, with native expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import fixed_values as V
from webloom.functions.text import strip, strip_tags


# --- native extraction -------------------------------------------------------


def _found(c: Column, pattern: str) -> Column:
    """First group of the first match, null without one."""
    return F.when(F.rlike(c, F.lit(pattern)), F.regexp_extract(c, pattern, 1))


def page_title(html: Column, suffix: str = V.TITLE_SUFFIX, notice: str = V.TITLE_NOTICE) -> Column:
    """Title without the site suffix; '0' for the notice page and '-1' for any other."""
    title = F.regexp_extract(html, "<title>(.*)</title>", 1)
    return (
        F.when(F.contains(title, F.lit(suffix)), F.replace(title, F.lit(suffix), F.lit("")))
        .when(title == notice, "0")
        .otherwise("-1")
    )


def question_page(
    pages: DataFrame, qid: str, html: str, patterns: dict[str, str] = V.QUESTION_PAGE,
    suffix: str = V.TITLE_SUFFIX, notice: str = V.TITLE_NOTICE, marker: str = V.GLYPH_MARKER,
) -> DataFrame:
    """Question rows; notice pages and pages with replaced glyphs are dropped."""
    h = F.col(html)
    body = strip(F.regexp_replace(_found(h, patterns["content"]), "<.*?>", "\n"))
    content = F.concat(F.coalesce(body, F.lit("")), F.coalesce(_found(h, patterns["supplement"]), F.lit("")))
    rows = pages.select(
        F.col(qid).alias("id"), page_title(h, suffix, notice).alias("question"), content.alias("question_content"),
        _found(h, patterns["time"]).alias("question_time"), _found(h, patterns["asker"]).alias("asker_username"),
        F.regexp_extract_all(h, F.lit(patterns["answer_id"]), 1).alias("answer_ids"),
    )
    return rows.where((F.col("question") != "0") & ~F.contains("question_content", F.lit(marker)))


def answer_json(df: DataFrame, column: str, keep: list[str], fields: dict = V.ANSWER_FIELDS) -> DataFrame:
    """Typed answer columns of the answer API's JSON text."""
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in dict(fields.values()).items())
    parsed = df.select(*keep, F.from_json(column, ddl).alias("_r"))
    return parsed.select(*keep, *[F.col(f"_r.{name}").alias(out) for out, (name, _) in fields.items()])


def normalise_headers(rows: DataFrame, key: str, column: str, mapping: DataFrame) -> DataFrame:
    """Rename map keys through ``mapping`` (raw, canonical); unknown keys stay. When two
    headers meet in one field, the first filled one is kept. A null map stays null, an empty one empty;
    rows with equal keys stay apart as long as their maps differ.
    """
    one = mapping.groupBy("raw").agg(F.max("canonical").alias("canonical"))
    entries = F.map_entries(column)
    numbered = rows.select(key, column, F.to_json(entries).alias("_row"))
    items = numbered.select(key, "_row", F.posexplode(entries).alias("_pos", "_e"))
    items = items.select(key, "_row", "_pos", F.col("_e.key").alias("raw"), F.col("_e.value").alias("_v")).distinct()
    named = items.join(one, "raw", "left").withColumn("_k", F.coalesce("canonical", "raw"))
    rank = F.struct((F.coalesce(F.col("_v"), F.lit("")) == "").alias("blank"), F.col("_pos"))
    fields = named.groupBy(key, "_row", "_k").agg(F.min(F.struct(rank.alias("rank"), "_v")).alias("_b"))
    # one row's own fields: the list is as long as the row's map, never longer
    done = fields.groupBy(key, "_row").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_k", "_b._v")))).alias("_named"))
    back = done.withColumnsRenamed({key: "_key", "_row": "_from"})
    joined = numbered.join(back, F.col(key).eqNullSafe(F.col("_key")) & F.col("_row").eqNullSafe(F.col("_from")), "left")
    return joined.select(key, F.coalesce("_named", column).alias(column))


def labelled_sections(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, book, ordinal, label, value) of ``【label】value`` paragraphs; following
    paragraphs without a label continue the value. Books are the parts between rules,
    without the first and last; a page with a single rule has one book before it."""
    text = F.regexp_replace(F.col(html), "</?(strong|sub)>", "")
    parts = F.split(text, V.BOOK_BREAK)
    books = F.when(F.size(parts) == 2, F.slice(parts, 1, 1)).otherwise(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0)))
    )
    book = pages.select(key, F.posexplode(books).alias("book", "_b"))
    inner = F.regexp_extract_all("_b", F.lit(r"(?s)<p(?: [^>]*)?>(.*?)</p>"), 1)
    lines = F.array_join(F.transform(inner, lambda p: F.regexp_replace(p, "<[^>]*>", "\n")), "\n")
    sections = book.select(key, "book", F.posexplode(F.split(lines, rf"\n(?={V.SECTION_LABEL})")).alias("ordinal", "_s"))
    first = F.regexp_extract("_s", r"^([^\n]*)", 1)
    rest = F.substring(F.col("_s"), F.length(first) + 1, F.length("_s"))
    return sections.where(F.rlike("_s", F.lit(f"^{V.SECTION_LABEL}"))).select(
        key, "book", "ordinal", F.regexp_extract("_s", "^【(.+?)】", 1).alias("label"),
        F.concat(F.regexp_replace(first, V.SECTION_LABEL, ""), rest).alias("value"),
    )


def notice_page(html: Column, box: tuple[str, str] = V.NOTICE_BOX, fields: dict[str, str] = V.NOTICE_FIELDS) -> dict[str, Column]:
    """Title, date and body columns of a notice, null when absent, within the main box."""
    begin = F.locate(box[0], html)
    tail = F.substring(html, F.greatest(begin, F.lit(1)), F.length(html))
    end = F.locate(box[1], tail)
    main = F.when(end > 0, F.substring(tail, F.lit(1), end - 1)).otherwise(tail)
    return {name: _found(main, pattern) for name, pattern in fields.items()}


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute URL of a link on the page ``base``."""
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*:)", 1)
    clean = F.regexp_replace(base, r"[?#].*$", "")
    path = F.regexp_replace(clean, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/]*", "")
    folder = F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "[^/]*$", "")).otherwise("/")
    target = F.regexp_extract(href, r"^([^?#]*)", 1)
    query = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    full = F.when(F.startswith(target, F.lit("/")), target).otherwise(F.concat(folder, target))
    steps = F.split(full, "/")

    def step(done: Column, s: Column) -> Column:
        up = F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)
        return F.when(s == "..", up).when(s == ".", done).otherwise(F.array_append(done, s))

    walked = F.aggregate(steps, F.array().cast("array<string>"), step)
    ends_open = F.rlike(full, F.lit(r"(^|/)\.{1,2}$"))
    resolved = F.concat(F.array_join(walked, "/"), F.when(ends_open, "/").otherwise(""))
    plain = F.when(F.rlike(full, F.lit(r"(^|/)\.{1,2}(/|$)")), resolved).otherwise(full)
    return (
        F.when(F.rlike(href, F.lit(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:")), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, href))
        .when(href == "", base)
        .when(F.startswith(href, F.lit("#")), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .when(F.startswith(href, F.lit("?")), F.concat(clean, href))
        .otherwise(F.concat(root, plain, query))
    )


def page_links(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """Distinct resolved links of each page."""
    found = pages.select(key, url, F.explode(F.array_distinct(F.regexp_extract_all(html, F.lit('href="([^"]*)"'), 1))).alias("_h"))
    return found.select(key, resolve_url(F.col(url), F.col("_h")).alias("link")).distinct()


def dump_entries(records: DataFrame, column: str) -> DataFrame:
    """(headword, alias) of a dump split at its delimiter: the first line of a record is a
    headword, an ``@@@LINK=`` line names its alias (null when there is none)."""
    lines = F.filter(F.transform(F.split(column, "\n"), strip), lambda x: x != "")
    rec = records.select(lines.alias("_l")).where(F.size("_l") > 0)
    links = F.transform(
        F.filter(F.slice("_l", 2, 1 << 30), lambda x: F.startswith(x, F.lit(V.DUMP_LINK))),
        lambda x: F.substring(x, len(V.DUMP_LINK) + 1, 1 << 30),
    )
    return rec.select(F.get("_l", F.lit(0)).alias("headword"), F.explode_outer(links).alias("alias"))


def read_dump(spark, path: str) -> DataFrame:
    """Records of a delimiter dump file."""
    return dump_entries(spark.read.text(path, lineSep=V.DUMP_BREAK), "value")


ERROR_CHECKS: dict[str, Callable[[Column], Column]] = {
    "default": lambda body: F.lit(False),
}


def page_error(fetches: DataFrame, min_length: int = 100, check: str | Callable[[Column], Column] = "default") -> DataFrame:
    """Reject reason per fetch (url, final_url, status, body); null for a good page.
    ``check`` is a named or given predicate on the body, chosen per batch."""
    bad_body = ERROR_CHECKS[check] if isinstance(check, str) else check
    reason = (
        F.when(F.col("status") != 200, "status").when(F.col("final_url") != F.col("url"), "redirect")
        .when(F.length("body") < min_length, "short").when(bad_body(F.col("body")), "error")
    )
    return fetches.withColumn("reason", reason)


def clean_headword(c: Column) -> Column:
    """Headword of a dump: font tags removed, null when unreadable."""
    font = V.HEADWORD
    mark = F.locate(font["font_mark"], c)
    plain = F.replace(F.substring(c, mark + len(font["font_mark"]), F.length(c)), F.lit("</font>"), F.lit(""))
    return F.when(F.startswith(c, F.lit(font["font"])), plain).when(~F.rlike(c, F.lit(font["unreadable"])), c)


def dump_definitions(pages: DataFrame, html: str, entry: str = V.HEADWORD["entry"], cut: str = "</span>") -> DataFrame:
    """(headword, definition) of an HTML dump: the block is cut at its last ``cut`` tag."""
    hit = pages.select(
        F.explode(F.arrays_zip(
            F.regexp_extract_all(html, F.lit(entry), 1).alias("word"), F.regexp_extract_all(html, F.lit(entry), 2).alias("info")
        )).alias("_e")
    )
    info = F.regexp_replace("_e.info", f"(?s){cut}(?!.*{cut}).*$", "")
    out = hit.select(strip(clean_headword(F.col("_e.word"))).alias("headword"), strip_tags(info).alias("definition"))
    return out.where("headword is not null")
