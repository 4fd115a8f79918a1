"""Stable ids and date columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_sha1(*parts: Column, sep: str = "_") -> Column:
    """sha1 of the parts joined by ``sep``; a null part counts as empty."""
    return F.sha1(F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def record_id(series: Column, date: Column, domain: Column) -> Column:
    return joined_sha1(series, date, domain)


def entity_id(name: Column, domain: Column) -> Column:
    return joined_sha1(name, domain)


def tracking_id(url: Column, time: Column) -> Column:
    return joined_sha1(url, time)


def attribute_id(entity: Column, attribute: Column) -> Column:
    return joined_sha1(entity, attribute, sep="__")


def text_id(text: Column) -> Column:
    return F.sha1(text)


def text_md5(text: Column) -> Column:
    return F.md5(text)


def url_domain(url: Column) -> Column:
    """Network location without user and port; case is kept."""
    netloc = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1)
    return F.regexp_replace(F.regexp_replace(netloc, "^.+@", ""), ":.+$", "")


def url_key(url: Column) -> Column:
    return F.sha1(url)


def excel_serial_date(n: Column) -> Column:
    """Day number of a spreadsheet (1900 system) as yyyy-MM-dd; null passes through."""
    return F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), (n - 2).cast("int")), "yyyy-MM-dd")


def epoch_to_month(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM")


def valid_month(c: Column) -> Column:
    return F.length(c) == 7


def month_to_date(c: Column) -> Column:
    """First day of a yyyy-MM month; anything else is returned unchanged."""
    return F.when(valid_month(c), F.concat(c, F.lit("-01"))).otherwise(c)


def cn_release_date(c: Column, unknown: str = "未知") -> Column:
    """Epoch seconds of a ``Y年M月D日`` date, 0 when unknown."""
    digits = F.regexp_replace(F.regexp_replace(c, "[年月]", "-"), "日", "")
    parsed = F.unix_timestamp(F.try_to_timestamp(digits, F.lit("yyyy-M-d")))
    return F.when(c == unknown, F.lit(0).cast("bigint")).otherwise(parsed)
