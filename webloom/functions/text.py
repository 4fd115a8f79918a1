"""Text cleaning as column expressions. Every function takes and returns a Column."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from webloom.functions import fixed_values as V


def replace_all(c: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Apply (pattern, replacement) rules in order."""
    for pattern, repl in rules:
        c = F.regexp_replace(c, pattern, repl)
    return c


def strip(c: Column) -> Column:
    """Remove white space at both ends, all of Unicode's (line ends, U+3000, U+00A0; unlike ``trim``)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def extract_zh(c: Column, keep: str = V.CJK) -> Column:
    """Keep only characters of the class ``keep``."""
    return strip(F.regexp_replace(c, f"[^{keep}]", ""))


def only_word_space(c: Column, keep: str = V.CJK) -> Column:
    """True when nothing but ``keep``, word characters and spaces occurs."""
    return ~F.rlike(c, F.lit(rf"[^{keep}\w\s]"))


def clean_answers(c: Column, marks: str = V.SENTENCE_MARKS, commas: str = V.COMMAS, letters: str = V.CJK) -> Column:
    """Shorten a search-result answer to whole sentences (see the length rules inline)."""
    t = F.regexp_replace(c, r"\.{3,10}$", "")
    whole = F.regexp_replace(t, f"([{marks}])[^{marks}]*$", "$1")
    space = F.locate(" ", t, 81)  # 1-based; the first blank at or after index 80
    return strip(
        F.when((t == c) | F.rlike(t, F.lit(f"[{marks}]")), whole)
        .when(F.rlike(t, F.lit(f"^[{letters}]{{20,1000}}$")), F.lit(""))
        .when(
            (F.length(t) > 80) & ~F.rlike(t, F.lit("[a-zA-Z]{2,100}")),
            F.when(space > 81, F.substring(t, F.lit(1), space - 1)).otherwise(t),
        )
        .when(F.length(t) > 120, F.regexp_replace(t, f"[{commas}][^{commas}]*$", ""))
        .otherwise(t)
    )


def clean_question(c: Column, rules: Sequence[tuple[str, str]] = V.QUESTION_CLEANUP) -> Column:
    return replace_all(F.lower(c), rules)


def rewrite_query(c: Column, rules: Sequence[tuple[str, str]] = V.QUERY_REWRITE) -> Column:
    return replace_all(c, rules)


def answer_filter_word(c: Column, pattern: str = V.ANSWER_FILTER) -> Column:
    """The first filtered mark or phrase of an answer, '' when there is none."""
    return F.regexp_extract(c, pattern, 0)


def strip_emoji(c: Column) -> Column:
    return F.regexp_replace(c, V.EMOJI, "")


def clean_chat_question(c: Column) -> Column:
    t = strip_emoji(F.concat(c, F.lit(" ")))
    return F.regexp_replace(strip(F.regexp_replace(t, V.MENTION, "")), V.QUESTION_TAIL, "")


def collapse_repeats(c: Column, keep: int = 2) -> Column:
    """Runs of one character are cut to ``keep``; dots are left alone."""
    return F.regexp_replace(c, rf"([^.])\1{{{keep},}}", "$1" * keep)


def clean_chat_answer(c: Column, foreign: str = V.ANSWER_FOREIGN) -> Column:
    t = F.regexp_replace(strip_emoji(c), V.BRACKET_TAG, "")
    t = F.regexp_replace(F.regexp_replace(t, V.FACE_MARKS, ""), V.ANSWER_TAIL, "")
    return F.coalesce(collapse_repeats(F.when(F.rlike(t, F.lit(foreign)), F.lit("")).otherwise(t)), F.lit(""))


def screen_question(
    c: Column,
    reject: Sequence[str] = V.SCREEN_REJECT,
    clean: Sequence[tuple[str, str]] = V.SCREEN_CLEAN,
    max_length: int = 15,
) -> Column:
    """'' for a rejected or too long question, else the cleaned question."""
    q = strip(c)
    out = strip(replace_all(q, clean))
    out = F.regexp_replace(out, V.SCREEN_SPACED, "，")
    refused = F.length(q) == 0
    for pattern in reject:
        refused = refused | F.rlike(q, F.lit(pattern))
    return F.when(refused | (F.length(out) > max_length), F.lit("")).otherwise(strip(out))


def first_sentence(c: Column, stop: str = "。") -> Column:
    """Up to and including the first full stop, unless the text starts with it."""
    at = F.locate(stop, c)
    return F.when(at > 1, F.substring(c, F.lit(1), at)).otherwise(c)


def _group_or_self(c: Column, pattern: str) -> Column:
    return F.when(F.rlike(c, F.lit(pattern)), F.regexp_extract(c, pattern, 1)).otherwise(c)


def drop_disambiguation(c: Column) -> Column:
    return _group_or_self(c, V.DISAMBIGUATION)


def drop_brackets(c: Column) -> Column:
    return _group_or_self(c, V.BRACKETED_NAME)


def drop_label_tags(c: Column) -> Column:
    return F.regexp_replace(c, V.LABEL_TAG, "")


def entity_filter(c: Column) -> Column:
    """The searchable name inside a well-formed entity title, else null."""
    return F.when(F.rlike(c, F.lit(V.ENTITY_NAME)), F.regexp_extract(c, V.ENTITY_NAME, 1))


def is_chinese(c: Column, pattern: str = V.PURE_CHINESE) -> Column:
    return F.rlike(c, F.lit(pattern))


def is_long_pure(c: Column, pattern: str = V.PURE_CHINESE) -> Column:
    """Purely of the script and longer than one character."""
    return F.rlike(c, F.lit(pattern)) & (F.length(c) > 1)


def strip_generic_suffix(
    c: Column, suffixes: Sequence[str] = V.GENERIC_SUFFIXES, special: tuple[str, str] = V.RANGE_SUFFIX
) -> Column:
    """Remove the first listed suffix that ends the name; null when none does."""
    ending, tail = special

    def cut(word: str) -> Column:
        n = len(tail) if word == ending else len(word)
        return F.when(F.endswith(c, F.lit(word)), F.substring(c, F.lit(1), F.length(c) - n))

    return F.coalesce(*[cut(w) for w in suffixes])


def number_part(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9.]", "")


def unit_part(c: Column) -> Column:
    return F.regexp_replace(c, r"[0-9.]", "")


def leading_number(c: Column) -> Column:
    """The first blank-separated token when it is all digits, else null."""
    token = F.split(c, " ", 2)[0]
    return F.when(F.rlike(token, F.lit("^[0-9]+$")), token)


def normalise_market(c: Column, suffix: str = V.MARKET_SUFFIX, synonyms: Sequence[tuple[str, str]] = ()) -> Column:
    for old, new in synonyms:
        c = F.replace(c, F.lit(old), F.lit(new))
    return F.when(F.endswith(c, F.lit(suffix)), c).otherwise(F.concat(c, F.lit(suffix)))


def split_spec(c: Column) -> tuple[Column, Column]:
    """(grade, origin) of ``grade/origin``."""
    parts = F.split(c, "/")
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def clean_alias_text(c: Column, rules: Sequence[tuple[str, str]] = V.ALIAS_CLEANUP) -> Column:
    """Array of aliases after bracketed remarks are removed and separators unified."""
    return F.split(replace_all(c, rules), "-")


def keyword_tags(c: Column, pattern: str = "[ 、]") -> Column:
    return F.array_remove(F.split(c, pattern), "")


def title_tags(c: Column, words: Sequence[str] = V.NEWS_MARKETS, suffix: str = V.MARKET_SUFFIX) -> Column:
    """A tag per listed word that the title contains, in list order."""
    hits = F.array(*[F.when(F.contains(c, F.lit(w)), F.lit(w + suffix)) for w in words])
    return F.filter(hits, lambda x: x.isNotNull())


def normalise_region(c: Column, level: str = "province") -> tuple[Column, Column]:
    """(normalised, compact) names of a province, city or district."""
    removed, suffix = V.REGION_RULES[level]
    long_names = "(" + "?|".join(p for p in V.PEOPLES if len(p) > 2) + ")"
    norm = F.regexp_replace(F.regexp_replace(c, long_names, ""), "(" + "|".join(V.PEOPLES) + ")", "")
    norm = F.regexp_replace(norm, removed, "")
    compact = F.when(F.length(norm) > 2, F.regexp_replace(norm, suffix, "")).otherwise(norm)
    return norm, compact


def keyword_score(c: Column, weights: dict[str, int]) -> Column:
    """Sum of the weights of the contained keywords; 0 for a null text."""
    total = F.lit(0)
    for word, weight in weights.items():
        total = total + F.when(F.contains(c, F.lit(word)), F.lit(weight)).otherwise(F.lit(0))
    return F.coalesce(total, F.lit(0))


def words(c: Column) -> Column:
    """Tokens of a spaced script: runs of letters and digits, lower case."""
    return F.array_remove(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), "")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"<[^>]*>", "")
