"""Main text of web pages by consensus paths of their hosts.

1. Every page is read into blocks of text under containers. Menus, forms, adverts, comments
   and the like are left out by tag, role, class and id. Each container is scored by the text of its blocks
   that is not link text, half of which counts for its parent container too.
2. A container's place is generalised to a path of tags with their classes, digits taken out. Each page votes
   for its best paths but not for what is around the best of them; votes are summed per (host, path) in Spark, and the best
   supported paths of a host win: the first, and those that are the best of two pages at least (further templates).
3. Every page is read again by its own best path if that has won, else by its host's first winning path that holds at least half as much
   of the page, else by its own best container (a template of its own). If the path occurs several times on the page, the container common to all is read, and
   if it lies in an article or main, the whole of that.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webloom.llm.common import table
from webloom.session import cut_lineage

VOTES = 3  # paths a page votes for
WINNERS = 5  # paths kept per host
BROADCAST_BYTES = 32 << 20
SALTS = 64

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>?|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)", re.S
)
# The rest of an ordinary tag: it ends at the next "<" at the latest, matching or not.
PLAIN_END = re.compile(r"(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+>")
END_OR_QUOTE = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "textarea", "noscript", "template", "iframe", "xmp", "title")}
SPACE = re.compile(r"\s+")
DIGITS = re.compile(r"\d+")
NAME = re.compile(r"[^\W_]+")

CONTAINERS = frozenset("html body main article section div center table tbody tr td form fieldset".split())
BREAKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd pre blockquote figure figcaption hr th thead tfoot caption address details summary "
    "header footer nav aside menu dialog hgroup option select button".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED_TAGS = frozenset("nav footer aside form menu dialog button select svg canvas object audio video head math".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Names in a class or id that mark what is not the article: alone, or joined only with each other and with words that say where or how.
SKIPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promos banner cookie cookies consent gdpr "
    "notice notices notification notifications alert alerts disclaimer sidebar sidebars aside menu menus nav navbar navigation navi breadcrumb breadcrumbs "
    "pagination pager footer masthead topbar toolbar comment comments commentlist reply replies respond disqus discussion share sharing social related recommended recommendations "
    "teaser teasers newsletter subscribe subscription signup login popup modal overlay paywall widget widgets skip copyright hidden".split()
)
#: Of these, what holds readers' comments, however long they are.
COMMENT_NAMES = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
JOINED_NAMES = frozenset(
    "site page main top bottom left right upper lower first second third primary secondary sub global mobile desktop fixed sticky floating outer inner wide small large big "
    "box wrapper wrap container holder block area bar list item items section region panel pane column col row slot unit zone strip links link buttons button icons "
    "form field posts post articles stories thread user reader notice message text js the and".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS_SAME = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}


def marks_skipped(names: str) -> bool:
    """Whether a class or id holds a name that is not the article's: ``sidebar``, ``site-footer``, but not ``has-sidebar`` or ``share-price``."""
    for name in names.split():
        parts = NAME.findall(name)
        if not SKIPPED_NAMES.isdisjoint(parts) and all(p in SKIPPED_NAMES or p in JOINED_NAMES or p.isdigit() for p in parts):
            return True
    return False


class Page:
    """Blocks of a page, each with its container; containers with parent and generalised path.

    A container that is left out for its class or id, but holds more than half of the page's text that is not link text, is
    no menu or notice whatever its name (but for readers' comments): the page is then read again with it.
    """

    def __init__(self, source: str):
        spared: set[int] = set()
        while True:
            self.paths, self.parents, self.tags = [""], [-1], [""]
            self.blocks: list[tuple[int, str, int]] = []  # (container, text, characters in links)
            left_out = self._read(source, spared)
            kept = sum(max(0, len(t) - n) for _, t, n in self.blocks)
            large = {at for at, n in left_out.items() if n > kept + sum(left_out.values()) - n}
            if not large:
                break
            spared |= large

    def _read(self, source: str, spared: set[int]) -> dict[int, int]:
        """Read the page. Returns, for each place where a container was left out for its name, its characters outside links."""
        left_out: dict[int, int] = {}
        by_name = -1  # where the container left out for its name began
        last_end, strict = source.rfind(">"), True
        stack: list[tuple[str, int, bool, bool, int]] = []  # (tag, container, skipped, in a header, left out for its name)
        text: list[str] = []
        linked, in_link, at = 0, False, 0
        node, skipped, heading_only = 0, False, False

        def flush() -> None:
            nonlocal linked
            if text:
                whole = SPACE.sub(" ", html.unescape("".join(text))).strip()
                if whole and not (heading_only and not any(t in HEADINGS for t, *_ in stack)):
                    self.blocks.append((node, whole, min(linked, len(whole))))
                text.clear()
            linked = 0

        def restore() -> None:
            nonlocal node, skipped, heading_only, by_name
            node, skipped, heading_only, by_name = stack[-1][1:] if stack else (0, False, False, -1)

        while True:
            found = TOKEN.search(source, at)
            piece = source[at : found.start()] if found else source[at:]
            if piece and not skipped:
                text.append(piece)
                linked += len(piece) * in_link
            elif piece and by_name >= 0 and not in_link:
                left_out[by_name] += len(piece.strip())
            if not found:
                break
            at = found.end()
            tag = found["tag"]
            if tag is not None:
                # the end of the tag; once the quotes of a page do not pair up, the next ">" ends any tag
                plain = PLAIN_END.match(source, at) if last_end >= at else None
                end = plain.end() if plain else at if last_end >= at else 0
                while end and not plain:
                    stop = END_OR_QUOTE.search(source, end) if strict else None
                    close = source.find(stop[0], stop.end()) if stop and stop[0] != ">" else -1
                    if close >= 0:
                        end = close + 1
                        continue
                    strict = strict and stop is not None and stop[0] == ">"
                    end = stop.end() if strict else source.find(">", at) + 1
                    break
                if not end:  # no tag
                    if not skipped:
                        text.append("<")
                    at = found.start() + 1
                    continue
                attrs, at = source[at : end - 1], end
            if tag is None:
                if found["cdata"] and not skipped:
                    text.append(html.escape(found["cdata"]))
                continue
            tag = tag.lower()
            if found["close"]:
                if tag == "a":
                    in_link = False
                elif tag in ("p", "br"):
                    flush()
                depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
                if depth is not None:
                    flush()
                    del stack[depth:]
                    restore()
                continue
            if tag in RAW:
                end = RAW[tag].search(source, at)
                at = end.end() if end else len(source)
                continue
            if tag == "a":
                in_link = True
            if tag == "br":
                if not skipped:
                    text.append(" ")
                continue
            bad, classes, named = tag in SKIPPED_TAGS, (), False
            if attrs and not attrs.isspace():
                given = {m[0].lower(): m[1] or m[2] or m[3] for m in ATTRIBUTE.findall(attrs)}
                classes = sorted(set(DIGITS.sub("", html.unescape(given.get("class", "")).lower()).split()))
                if tag not in ("html", "body", "article", "main"):
                    style = given.get("style", "").replace(" ", "").lower()
                    bad = (
                        bad or given.get("role", "").lower() in SKIPPED_ROLES
                        or "hidden" in given or given.get("aria-hidden", "").lower() == "true" or "display:none" in style
                    )
                if tag not in ("html", "body", "main") and not bad:
                    names = f"{given.get('class', '')} {given.get('id', '')}".lower()
                    bad = found.start() not in spared and marks_skipped(names)
                    named = bad and COMMENT_NAMES.isdisjoint(NAME.findall(names))
            if tag in VOID or attrs.endswith("/") and tag not in BREAKS:
                if tag in BREAKS:
                    flush()
                continue
            if tag not in BREAKS and not bad:
                continue  # inline
            if tag in BREAKS:
                flush()
                in_link = in_link and tag not in CONTAINERS
                while stack and stack[-1][0] == "p":
                    stack.pop()
                if tag in HEADINGS and stack and stack[-1][0] in HEADINGS:
                    stack.pop()
                if tag in ENDS_SAME:
                    same = {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {tag}
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k][0] in ENDS_SAME[tag]:
                            break
                        if stack[k][0] in same:
                            del stack[k:]
                            break
                restore()
            if tag in CONTAINERS and not (bad or skipped):
                name = ".".join([tag, *classes])
                self.parents.append(node)
                self.paths.append(f"{self.paths[node]}/{name}")
                self.tags.append(tag)
                node = len(self.paths) - 1
            if bad and not skipped:
                by_name = found.start() if named else -1
                if named:
                    left_out[by_name] = 0
            skipped = skipped or bad
            heading_only = heading_only or tag == "header"
            stack.append((tag, node, skipped, heading_only, by_name))
        flush()
        return left_out

    def scores(self) -> dict[int, float]:
        """Score per container with text."""
        out: dict[int, float] = {}
        for node, text, linked in self.blocks:
            worth = max(0.0, len(text) - 1.5 * linked)
            while node >= 0 and worth >= 1:
                bonus = 1.5 if self.tags[node] in ("article", "main") else 1.0
                out[node] = out.get(node, 0.0) + worth * bonus
                node, worth = self.parents[node], worth / 2
        return out

    def _by_path(self) -> dict[str, float]:
        out: dict[str, float] = {}
        for node, value in self.scores().items():
            out[self.paths[node]] = out.get(self.paths[node], 0.0) + value
        return out

    def best(self) -> list[tuple[str, float]]:
        """Paths of the page, best first, with their share of the page's score."""
        by_path = self._by_path()
        total = sum(by_path.values())
        ranked = sorted(by_path.items(), key=lambda x: (-x[1], x[0]))
        # what is around the best path would gather the votes of all templates
        return [(p, v / total) for p, v in ranked if p == ranked[0][0] or not ranked[0][0].startswith(f"{p}/")][:VOTES]

    def _top(self, nodes: list[int]) -> int:
        """The container common to ``nodes``, or the article or main that it lies in."""
        def line(node: int) -> list[int]:
            out = []
            while node >= 0:
                out.append(node)
                node = self.parents[node]
            return out[::-1]

        common = line(nodes[0])
        for node in nodes[1:]:
            common = [a for a, b in zip(common, line(node), strict=False) if a == b]
        return next((n for tag in ("article", "main") for n in reversed(common) if self.tags[n] == tag), common[-1])

    def text(self, paths: list[str]) -> str:
        """Text below the page's own best path if it is one of ``paths``, else the first of them that scores at least half as much on
        this page and does not lie around the own best path, else the own best."""
        by_path = self._by_path()
        own = [p for p, _ in self.best()[:1]]
        fit = [p for p in paths if by_path.get(p, 0.0) * 2 >= by_path[own[0]] and not own[0].startswith(f"{p}/")] if own else []
        for path in [*[p for p in own if p in paths], *fit, *own]:
            holds = [False] * len(self.paths)
            for node, *_ in self.blocks:
                while node >= 0 and not holds[node]:
                    holds[node] = True
                    node = self.parents[node]
            nodes = [n for n, p in enumerate(self.paths) if p == path and holds[n]]
            if nodes:
                top, inside = self._top(nodes), [False] * len(self.paths)
                for n in range(top, len(self.paths)):
                    inside[n] = n == top or self.parents[n] >= 0 and inside[self.parents[n]]
                return "\n\n".join(t for node, t, _ in self.blocks if inside[node])
        return ""


def host_of(url: Column) -> Column:
    """Host of an address in small letters, without user, port and "www."; "" if there is none."""
    host = F.regexp_extract(F.lower(F.coalesce(url.cast("string"), F.lit(""))), r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(host, r"^www\.", "")


def vote(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, paths): the winning paths of each host, best first."""

    def ballots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, paths, shares, firsts = [], [], [], []
            for i, source in enumerate(batch.column("html")):
                for nth, (path, share) in enumerate(Page(source.as_py() or "").best()):
                    at.append(i)
                    paths.append(path)
                    shares.append(share)
                    firsts.append(nth == 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("host").take(pa.array(at, pa.int64())), pa.array(paths, pa.string()), pa.array(shares, pa.float64()), pa.array(firsts, pa.bool_())],
                names=["host", "path", "share", "first"],
            )

    cast = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html")).mapInArrow(
        ballots, "host string, path string, share double, first boolean"
    )
    # sums of decimals do not depend on the order of the rows
    votes = cast.groupBy("host", "path").agg(F.sum(F.col("share").cast("decimal(18,9)")).alias("votes"), F.sum(F.col("first").cast("long")).alias("firsts"))
    order = Window.partitionBy("host").orderBy(F.desc("votes"), "path")
    ranked = votes.withColumn("rank", F.row_number().over(order)).where((F.col("rank") <= WINNERS) & ((F.col("rank") == 1) | (F.col("firsts") > 1)))
    return ranked.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("rank", "path"))).alias("_l")).select(
        "host", F.transform("_l", lambda x: x["path"]).alias("paths")
    )


def _with_paths(rows: DataFrame, winners: DataFrame) -> DataFrame:
    """``rows`` with the ``paths`` of their host.

    Winners of up to BROADCAST_BYTES are sent to the pages, which then need no shuffle. Beyond that both sides are dealt by (host,
    salt), each host's winners once per salt, so a host with very many pages is spread over SALTS tasks at least.
    """
    weight = F.sum(F.octet_length("host") + F.octet_length(F.array_join("paths", "")) + 64)
    if (winners.agg(weight).first()[0] or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(winners), "host", "left")
    spread = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("html", "url"), F.lit(SALTS)).cast("int")).join(spread, ["host", "salt"], "left")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: (page_id, url, text, n_chars).

    Blocks stand in page order with two line feeds between them. A null, empty or unreadable source has the empty text; a null or
    unparsable url belongs to the host "" and votes there. Ids may be null or repeated. No page is cut at any length. An empty
    table gives an empty result. Other columns are not read.
    """
    id_type = pages.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                Page(source.as_py() or "").text(paths.as_py() or [])
                for source, paths in zip(batch.column("html"), batch.column("paths"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"),
        host_of(F.col(url_col)).alias("host"),
    )
    return _with_paths(rows, cut_lineage(vote(pages, url_col, html_col), "paths")).select("id", "url", "html", "paths").mapInArrow(
        read, f"page_id {id_type}, url string, text string, n_chars long"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
