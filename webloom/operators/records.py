"""Price, news, entity and company records as nested claim rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import fixed_values as V
from webloom.functions import ids, text
from webloom.operators.joins import link_entity, map_name
from webloom.operators.ranking import page


def copy_fields(
    to: DataFrame, source: DataFrame, keys: Sequence[str], fields: Sequence[str], incremental: bool = False
) -> DataFrame:
    """Copy non-empty ``fields`` from ``source``; ``incremental`` fills empty ones only."""

    def filled(c: Column) -> Column:
        return F.when(c.cast("string") != "", c)

    joined = to.alias("t").join(source.select(*keys, *fields).alias("s"), list(keys), "left")
    out = []
    for c in to.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in fields:
            new, old = filled(F.col(f"s.{c}")), filled(F.col(f"t.{c}"))
            first, second = (old, new) if incremental else (new, old)
            out.append(F.coalesce(first, second, F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return joined.select(*out)


CLAIM = "struct<p:string,o:string,rid:string>"
CLAIMS = f"array<{CLAIM}>"


def claim(p: str | Column, o: Column | None = None, rid: Column | None = None) -> Column:
    null = F.lit(None).cast("string")
    name = F.lit(p) if isinstance(p, str) else p
    return F.struct(
        name.alias("p"), (null if o is None else o.cast("string")).alias("o"), (null if rid is None else rid).alias("rid")
    )


def claims_text(c: Column | str) -> Column:
    """Readable form of a claim list, used by exports and checks."""
    none = F.lit("")
    return F.array_join(
        F.transform(c, lambda x: F.concat(x["p"], F.lit("="), F.coalesce(x["o"], none), F.coalesce(x["rid"], none))), ";"
    )


def _source(url: Column, time: Column, confidence: str, domain: Column | None = None) -> Column:
    return F.struct(
        url.alias("url"), (ids.url_domain(url) if domain is None else domain).alias("domain"), ids.tracking_id(url, time).alias("trackingId"),
        F.lit(confidence).alias("confidence"),
    )


def with_places(df: DataFrame, place: str, mapping: DataFrame, out: str = "mapped") -> DataFrame:
    """Add the mapped list of a place of origin (mapping: place, mapped); empty when unknown."""
    one = mapping.groupBy("place").agg(F.max("mapped").alias("_m"))
    joined = df.join(one.withColumnRenamed("place", "_place"), F.col(place) == F.col("_place"), "left")
    return joined.withColumn(out, F.coalesce("_m", F.array().cast("array<string>"))).drop("_m", "_place")


def place_tags(tags: Column, mapped: Column) -> Column:
    """Tags form of a place mapping: the mapped words follow the tags."""
    return F.concat(tags, mapped)


def place_fields(spec: Column, mapped: Column, places: Sequence[str] = V.PLACE_WORDS) -> tuple[Column, Column]:
    """Record form: (country, spec). Place words set the country, others extend the spec."""
    is_place = lambda x: x.isin(*places)
    return F.try_element_at(F.filter(mapped, is_place), F.lit(-1)), F.concat(spec, F.filter(mapped, lambda x: ~is_place(x)))


def _price_record(
    df: DataFrame, *, url: Column, time: Column, name: Column, price_type: Column, origin: Column, market: Column,
    grade: Column, date: Column, record_date: Column, confidence: str, claims: Column, mapping: DataFrame | None = None,
) -> DataFrame:
    empty = F.lit("")
    five = F.array(*[F.coalesce(c, empty) for c in (name, price_type, origin, market, grade)])
    # Values used several times are computed in their own projection, once per row.
    rows = df.select(
        five.alias("_five"), F.coalesce(origin, empty).alias("_origin"), claims.alias("claims"), ids.url_domain(url).alias("_domain"),
        url.alias("_url"), time.alias("_time"), date.alias("_date"), record_date.alias("recordDate"),
    )
    if mapping is not None:
        rows = with_places(rows, "_origin", mapping, "_mapped")
        tags = place_tags(F.col("_five"), F.col("_mapped"))
    else:
        tags = F.col("_five")
    rows = rows.withColumn("_series", F.array_join("_five", "_"))
    series, domain = F.col("_series"), F.col("_domain")
    rows = rows.withColumn("_rid", ids.record_id(series, F.col("_date"), domain))
    return rows.select(
        F.col("_rid").alias("rid"), F.col("_rid").alias("gid"), series.alias("series"), F.concat_ws("_", series, domain).alias("seriesid"),
        F.array_remove(tags, "").alias("tags"), "claims", "recordDate", F.current_timestamp().alias("createdTime"),
        F.current_timestamp().alias("updatedTime"), _source(F.col("_url"), F.col("_time"), confidence, domain).alias("source"),
    )


def _price_claims(name: Column, date: Column, price: Column, origin: Column, market: Column | None, grade: Column, unit: str) -> Column:
    labels = dict(zip(("name", "date", "price", "unit", "origin", "market", "grade", "currency"), V.PRICE_CLAIMS))
    values = {
        "name": name, "date": date, "price": price, "unit": F.lit(unit), "origin": origin, "market": market, "grade": grade,
        "currency": F.lit(V.CURRENCY),
    }
    return F.array(*[claim(labels[k], v) for k, v in values.items() if v is not None])


def price_records_rows(df: DataFrame, mapping: DataFrame | None = None, unit: str = V.PRICE_UNIT) -> DataFrame:
    """One record per quoted row of (source, rows[])."""
    rows = df.select("source", F.explode("rows").alias("r"))
    market = text.normalise_market(F.col("r.site"))
    name, origin, grade, date = (F.col(f"r.{c}") for c in ("drug_name", "origin", "standards", "price_date"))
    return _price_record(
        rows, url=F.col("source"), time=F.col("r.access_time"), name=name, price_type=F.lit(""), origin=origin, market=market,
        grade=grade, date=date, record_date=date, confidence="0.6", mapping=mapping,
        claims=_price_claims(name, date, F.col("r.price"), origin, market, grade, unit),
    )


def price_records_pairs(df: DataFrame, unit: str = V.PRICE_UNIT) -> DataFrame:
    """Records of (source, name, specs, access_time, data[] of (month, price))."""
    rows = df.select("source", "name", "specs", "access_time", F.explode("data").alias("d"))
    grade, origin = text.split_spec(F.col("specs"))
    name, month = F.col("name"), F.col("d.month")
    return _price_record(
        rows, url=F.col("source"), time=F.col("access_time"), name=name, price_type=F.lit(""), origin=origin, market=F.lit(""),
        grade=grade, date=month, record_date=F.concat(month, F.lit("-01")), confidence="0.6",
        claims=_price_claims(name, month, F.col("d.price"), origin, None, grade, unit),
    )


def price_records_map(df: DataFrame, mapping: DataFrame | None = None, unit: str = V.PRICE_UNIT) -> DataFrame:
    """Records of (source, name, productPlaceOfOrigin, sellerMarket, productGrade,
    access_time, price_history map of date to price)."""
    rows = df.select(*[c for c in df.columns if c != "price_history"], F.explode("price_history").alias("_date", "_price"))
    name, origin, market, grade = (F.col(c) for c in ("name", "productPlaceOfOrigin", "sellerMarket", "productGrade"))
    return _price_record(
        rows, url=F.col("source"), time=F.col("access_time"), name=name, price_type=F.lit(""), origin=origin, market=market,
        grade=grade, date=F.col("_date"), record_date=F.col("_date"), confidence="0.7", mapping=mapping,
        claims=_price_claims(name, F.col("_date"), F.col("_price"), origin, text.normalise_market(market), grade, unit),
    )


def price_records_list(df: DataFrame, mapping: DataFrame | None = None, unit: str = V.PRICE_UNIT,
                       synonyms: Sequence[tuple[str, str]] = (("药市", "市场"),)) -> DataFrame:
    """Records of (source, name, productPlaceOfOrigin, productGrade, price_data[])."""
    rows = df.select("source", "name", "productPlaceOfOrigin", "productGrade", F.explode("price_data").alias("d"))
    market = F.col("d.sellerMarket")
    for old, new in synonyms:
        market = F.replace(market, F.lit(old), F.lit(new))
    name, origin, grade, date = F.col("name"), F.col("productPlaceOfOrigin"), F.col("productGrade"), F.col("d.validDate")
    return _price_record(
        rows, url=F.col("source"), time=F.col("d.access_time"), name=name, price_type=F.lit(""), origin=origin, market=market,
        grade=grade, date=date, record_date=date, confidence="0.7", mapping=mapping,
        claims=_price_claims(name, date, F.col("d.price"), origin, market, grade, unit),
    )


def wide_price_rows(df: DataFrame, values: dict[str, Column], mapper: DataFrame | None = None) -> DataFrame:
    """The null-filled wide price schema with mapped entity, domain, name and tags."""
    array_cols = {"tags"}
    base = df.select(
        "*",
        *[
            (values[c] if c in values else F.lit(None)).cast("array<string>" if c in array_cols else "string").alias(f"_w_{c}")
            for c in V.WIDE_PRICE_COLUMNS
        ],
    )
    if mapper is not None:
        base = map_name(base, "_w_mainEntityOfPage_raw", mapper, "_w_mainEntityOfPage")
    else:
        base = base.withColumn("_w_mainEntityOfPage", F.col("_w_mainEntityOfPage_raw"))
    domain = F.regexp_extract("_w_source", "http://(.*?)/", 1)
    date = F.col("_w_validDate")
    computed = {
        "tags": F.array(domain, F.col("_w_mainEntityOfPage")),
        "validMonth": F.when(ids.valid_month(date), date).otherwise(F.col("_w_validMonth")),
    }
    extras = [c for c in values if c not in V.WIDE_PRICE_COLUMNS]
    name = F.concat_ws("_", *[F.coalesce(F.col(f"_w_{c}"), F.lit("")) for c in ("mainEntityOfPage_raw", "priceType", "sellerMarket", "productGrade")])
    return base.select(
        *[(computed[c] if c in computed else F.col(f"_w_{c}")).alias(c) for c in V.WIDE_PRICE_COLUMNS],
        *[values[c].alias(c) for c in extras], domain.alias("sourceDomainName"), name.alias("name"),
    )


def price_records_nested(df: DataFrame, mapper: DataFrame | None = None) -> DataFrame:
    """Wide rows of (source, market, product_list[]): one per product and date, one
    undated row for a product without history."""
    products = df.select("source", "market", F.explode("product_list").alias("p"))
    dated = products.select("source", "market", "p", F.explode_outer("p.price_history").alias("_date", "_price"))
    out = wide_price_rows(
        dated,
        {
            "productGrade": F.col("p.level"), "priceCurrency": F.lit(V.CURRENCY), "confidence": F.lit("0.7"),
            "productPlaceOfOrigin": F.col("p.produce_area"), "source": F.col("source"), "productionYear": F.col("p.produce_year"),
            "unitText": F.lit(V.QUOTE_UNITS["grain"]), "mainEntityOfPage_raw": F.col("p.variety"), "sellerMarket": F.col("market"),
            "priceType": F.col("p.price_type"), "validDate": F.col("_date"), "price": F.col("_price"),
        },
        mapper,
    )
    return out.withColumn("id", F.concat_ws("_", "name", F.coalesce("validDate", F.lit(""))))


def price_records_quote(df: DataFrame) -> DataFrame:
    """Records of single quotes (source, access_time, name, quote, price_type, place,
    agency, published, detail map); detail entries follow as extra claims."""
    detail = F.map_entries("detail")
    grades = F.filter(detail, lambda e: F.contains(e["key"], F.lit(V.GRADE_KEY)))
    grade = F.coalesce(F.try_element_at(grades, F.lit(-1))["value"], F.lit(""))
    name, date, place = F.col("name"), F.col("published"), F.coalesce(F.col("place"), F.lit(""))
    labels = V.QUOTE_CLAIMS
    price_labels = dict(zip(("name", "date", "price", "unit", "origin", "market", "grade", "currency"), V.PRICE_CLAIMS))
    fixed = F.array(
        claim(price_labels["name"], name), claim(price_labels["price"], text.number_part(F.col("quote"))),
        claim(price_labels["unit"], text.unit_part(F.col("quote"))), claim(price_labels["currency"], F.lit(V.CURRENCY)),
        claim(price_labels["date"], date), claim(labels["type"], F.col("price_type")), claim(labels["agency"], F.col("agency")),
    )
    none = F.array().cast(CLAIMS)
    extra = F.transform(F.filter(detail, lambda e: F.coalesce(e["value"], F.lit("")) != ""), lambda e: claim(e["key"], e["value"]))
    claims = F.concat(
        fixed.cast(CLAIMS),
        F.when(place != "", F.array(claim(labels["place"], place)).cast(CLAIMS)).otherwise(none),
        F.when(grade != "", F.array(claim(labels["grade"], grade)).cast(CLAIMS)).otherwise(none),
        extra.cast(CLAIMS),
    )
    return _price_record(
        df, url=F.col("source"), time=F.col("access_time"), name=name, price_type=F.col("price_type"), origin=place,
        market=F.col("agency"), grade=grade, date=date, record_date=date, confidence="0.9", claims=claims,
    )


def contract_filter(df: DataFrame, contract: str, price: str, code: str = V.CONTRACT_CODE) -> DataFrame:
    """Contracts that contain the code and have a non-blank price."""
    return df.where(F.contains(contract, F.lit(code)) & F.rlike(price, F.lit(r"\S")))


def series_meta(records: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """One row per seriesid with the five named attributes (null when empty), the spec as
    a list extended by the place mapping, and the country. Of equal seriesids the first
    series in order is kept."""
    one = records.groupBy("seriesid").agg(F.min("series").alias("series"))
    parts = F.split("series", "_")
    attrs = {a: F.nullif(F.get(parts, F.lit(i)), F.lit("")) for i, a in enumerate(V.SERIES_ATTRIBUTES)}
    name, kind, origin, market, spec = V.SERIES_ATTRIBUTES
    rows = one.select("seriesid", "series", *[c.alias(a) for a, c in attrs.items()])
    rows = rows.withColumn(spec, F.filter(F.array(spec), lambda x: x.isNotNull()))
    if mapping is not None:
        rows = with_places(rows, origin, mapping, "_mapped")
    else:
        rows = rows.withColumn("_mapped", F.array().cast("array<string>"))
    country, specs = place_fields(F.col(spec), F.col("_mapped"))
    return rows.select(
        "seriesid", "series", F.element_at(F.split("seriesid", "_"), -1).alias("source_domain"), name, kind, origin, market,
        specs.alias(spec), country.alias(V.COUNTRY_FIELD),
    )


def market_history_flatten(df: DataFrame, key: str, chart: str, skip: str = V.OVERALL_TREND) -> DataFrame:
    """(key, sellerMarket, validDate, price) of chart JSON ``[{name, data: [[...]]}]``: the
    second-to-last cell is the date, the second cell the price; the trend line is skipped."""
    lines = df.select(key, F.explode(F.from_json(chart, "array<struct<name:string,data:array<array<string>>>>")).alias("c"))
    cells = lines.where(F.col("c.name") != skip).select(key, F.col("c.name").alias("sellerMarket"), F.explode("c.data").alias("d"))
    return cells.select(
        key, "sellerMarket", F.try_element_at("d", F.lit(-2)).alias("validDate"), F.get("d", F.lit(1)).cast("double").alias("price")
    )


def zip_history(dates: Column, prices: Column) -> Column:
    """Date to price map of two parallel lists, cut at the shorter; a repeated date keeps its last price."""
    n = F.least(F.size(dates), F.size(prices))
    pairs = F.arrays_zip(F.slice(dates, F.lit(1), n).alias("d"), F.slice(prices, F.lit(1), n).alias("p"))
    last = F.filter(pairs, lambda e, i: ~F.array_contains(F.slice(F.slice(dates, F.lit(1), n), i + 2, n), e["d"]))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["d"], e["p"])))


def material_records(
    df: DataFrame, entities: DataFrame, mapper: DataFrame, properties: Sequence[str] = V.MATERIAL_PROPERTIES
) -> DataFrame:
    """Materials of (source, name, usage, upstream[], downstream[], info map): linked entity,
    mapped name, non-empty lists and the filled chosen properties."""
    rows = map_name(link_entity(df, "name", entities), "name", mapper, "mainEntityOfPage")
    listed = lambda c: F.when(F.size(c) > 0, F.col(c))
    chosen = F.map_filter("info", lambda k, v: k.isin(*properties) & (F.coalesce(v, F.lit("")) != ""))
    return rows.select(
        "name", "nid", "mainEntityOfPage", F.nullif(F.col("usage"), F.lit("")).alias("description"), F.lit("0.7").alias("confidence"),
        listed("upstream").alias("upstream_material"), listed("downstream").alias("downstream_material"),
        "source", ids.url_domain(F.col("source")).alias("site"), F.when(F.size(chosen) > 0, chosen).alias("properties"),
    )


def updown_lookup(materials: DataFrame, name: str) -> DataFrame:
    return materials.where(F.col("name") == name).select("name", "upstream_material", "downstream_material")


def news_records(
    df: DataFrame, *, url: Column, title: Column, summary: Column, origin: Column, date: Column, content: Column | None,
    tags: Column, time: Column, confidence: str = "0.7",
) -> DataFrame:
    """News claim records; rows without URL or title are dropped."""
    labels = V.NEWS_CLAIMS
    values = [title, summary, origin, F.substring(date, 1, 10), url] + ([content] if content is not None else [])
    claims = F.array(*[claim(p, o) for p, o in zip(labels, values)])
    rid = ids.joined_sha1(title, date, ids.url_domain(url))
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    return df.where(filled(url) & filled(title)).select(
        rid.alias("rid"), rid.alias("gid"), F.filter(tags, lambda x: F.coalesce(x, F.lit("")) != "").alias("tags"),
        claims.cast(CLAIMS).alias("claims"), F.current_timestamp().alias("createdTime"), F.current_timestamp().alias("updatedTime"),
        _source(url, time, confidence).alias("source"),
    )


def entity_records(df: DataFrame, preferred: str = V.PREFERRED_BOOK) -> DataFrame:
    """Records of (source, name, access_time, books[] of (book, fields[] of (k, v))): the
    preferred book or else the first; its source text becomes the leading definition
    claim (a later one goes before an earlier one), alias text is cleaned and appended."""
    first = F.filter("books", lambda b: b["book"] == preferred)
    book = F.when(F.size(first) > 0, F.get(first, F.lit(0))).otherwise(F.get("books", F.lit(0)))
    rows = df.withColumn("_f", F.filter(book["fields"], lambda f: F.coalesce(f["v"], F.lit("")) != ""))
    definitions = F.reverse(F.filter("_f", lambda f: f["k"] == V.SOURCE_FIELD))
    others = F.filter("_f", lambda f: ~f["k"].isin(V.SOURCE_FIELD, V.ALIAS_FIELD))
    alias_fields = F.filter("_f", lambda f: f["k"] == V.ALIAS_FIELD)
    claims = F.concat(
        F.transform(definitions, lambda f: claim(V.DEFINITION_CLAIM, text.strip(f["v"]))).cast(CLAIMS),
        F.transform(others, lambda f: claim(f["k"], text.strip(f["v"]))).cast(CLAIMS),
    )
    nid = ids.entity_id(F.col("name"), ids.url_domain(F.col("source")))
    return rows.select(
        nid.alias("nid"), nid.alias("gid"),
        F.concat(F.array("name"), F.flatten(F.transform(alias_fields, lambda f: text.clean_alias_text(f["v"])))).alias("alias"),
        claims.alias("claims"), F.current_timestamp().alias("createdTime"), F.current_timestamp().alias("updatedTime"),
        _source(F.col("source"), F.col("access_time"), "0.8").alias("source"),
    )


def company_records(df: DataFrame, url_template: str) -> DataFrame:
    """Company claim records of (name, source, access_time, info[] of (k, v), shareholders[],
    changes[], executives[]). Groups are numbered ``_11, _22, ...`` over the three lists.
    ``url_template`` has ``{key_num}`` and ``{name}``."""
    encoded = F.url_encode("name")
    url = F.replace(F.col("source"), F.col("name"), encoded)
    zero = F.lit(0)
    holders, changes = F.coalesce(F.size("shareholders"), zero), F.coalesce(F.size("changes"), zero)

    def rid(i: Column, offset: Column) -> Column:
        return F.concat(F.lit("_"), ((i + offset + 1) * 11).cast("string"))

    def link(h: Column) -> Column:
        key = F.get(F.split(h["link"], "_"), F.lit(1))
        return F.replace(F.replace(F.lit(url_template), F.lit("{key_num}"), key), F.lit("{name}"), F.url_encode(h["name"]))

    head, name_p, role_p, url_p = V.HOLDER_CLAIMS

    def holder(h: Column, i: Column) -> Column:
        r = rid(i, zero)
        all_claims = F.array(claim(head, None, r), claim(name_p, h["name"], r), claim(role_p, h["role"], r), claim(url_p, link(h), r))
        return F.when(h["link"].isNotNull(), all_claims).otherwise(F.slice(all_claims, 1, 3))

    def change(c: Column, i: Column) -> Column:
        r = rid(i, holders)
        fields = [None, "project", "change_time", "before_change", "after_change"]
        return F.array(*[claim(p, c[f] if f else None, r) for p, f in zip(V.CHANGE_CLAIMS, fields)])

    def executive(e: Column, i: Column) -> Column:
        r = rid(i, holders + changes)
        fields = [None, "position", "name"]
        return F.array(*[claim(p, e[f] if f else None, r) for p, f in zip(V.EXECUTIVE_CLAIMS, fields)])

    info = F.transform(F.filter("info", lambda x: x["v"].isNotNull()), lambda x: claim(x["k"], x["v"]))
    claims = F.concat(
        info.cast(CLAIMS), F.flatten(F.transform("shareholders", holder)).cast(CLAIMS),
        F.flatten(F.transform("changes", change)).cast(CLAIMS), F.flatten(F.transform("executives", executive)).cast(CLAIMS),
    )
    nid = ids.entity_id(F.col("name"), ids.url_domain(url))
    return df.select(
        nid.alias("nid"), nid.alias("gid"), F.array("name").alias("alias"), claims.alias("claims"),
        F.current_timestamp().alias("createdTime"), F.current_timestamp().alias("updatedTime"),
        _source(url, F.col("access_time"), "0.9").alias("source"),
    )


def record_search(
    df: DataFrame, *, all_of: Sequence[str] = (), any_of: Sequence[str] = (), equals: dict[str, object] | None = None,
    dates: Column | None = None, order: Sequence[str], offset: int = 0, limit: int = 20, hide: Sequence[str] = ("rid", "gid", "nid"),
) -> DataFrame:
    """Search of stored records: not soft-deleted, tags hold all of / any of the given ones,
    fields equal, dates in range; page in ``order`` (see ``page``) with the total of all matches, ids nulled."""
    keep = F.lit(True)
    if "deletedTime" in df.columns:
        keep = keep & F.col("deletedTime").isNull()
    if all_of:
        keep = keep & (F.size(F.array_except(F.array(*[F.lit(x) for x in all_of]), F.col("tags"))) == 0)
    if any_of:
        keep = keep & F.arrays_overlap(F.col("tags"), F.array(*[F.lit(x) for x in any_of]))
    for name, value in (equals or {}).items():
        keep = keep & (F.col(name) == F.lit(value))
    if dates is not None:
        keep = keep & dates
    found = page(df.where(keep), order, offset, limit)
    shown = [F.lit(None).cast(df.schema[c].dataType).alias(c) if c in hide else F.col(c) for c in df.columns]
    total_claim = [F.coalesce(F.size("claims"), F.lit(0)).alias("totalClaim")] if "claims" in df.columns else []
    return found.select(*shown, *total_claim, "total")


def table_audit(expected: DataFrame, tables: dict[str, tuple[DataFrame, str]], now: Column, max_age_days: int = 3) -> DataFrame:
    """Per table name: rows, newest update, and a state: missing, unexpected, stale or ok."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.col(ts).cast("timestamp")).alias("newest")).withColumn("name", F.lit(name))
        for name, (df, ts) in tables.items()
    ]
    actual = reduce(DataFrame.unionByName, parts)
    both = expected.select("name").distinct().withColumn("_e", F.lit(True)).join(actual, "name", "full_outer")
    state = (
        F.when(F.col("n_rows").isNull(), "missing").when(F.col("_e").isNull(), "unexpected")
        .when(F.datediff(now, "newest") > max_age_days, "stale").otherwise("ok")
    )
    return both.select("name", "n_rows", "newest", state.alias("state"))


# Loader per batch name: the first entry whose name starts the batch id is used.
LOADERS = {
    "rows": price_records_rows, "pairs": price_records_pairs, "map": price_records_map, "list": price_records_list,
    "nested": price_records_nested, "quote": price_records_quote, "entity": entity_records,
}


def load_batch(batch_id: str, df: DataFrame, loaders: dict[str, str], default: str = "rows") -> DataFrame:
    """Records of a batch by the loader its name selects. ``loaders`` maps batch-name
    prefixes to loader names; an unknown batch uses the default."""
    kind = next((k for prefix, k in loaders.items() if batch_id.startswith(prefix)), default)
    return LOADERS[kind](df)
