"""Token estimates that need no tokenizer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import BLANK, BLANKS, NOT_BLANKS, is_blank
from quern.session import let

#: Characters a token by kind of content.
CHARS_PER_TOKEN = {"code": 3.2, "dialogue": 3.8, "technical": 4.5, "literature": 4.2, "news": 3.9, "social": 3.5}


def smart_estimate(text: Column, chars_per_token: float = 4.0) -> Column:
    """Tokens by length, corrected for word length, variety of characters, punctuation, numbers and white space.

    0 for null or blank texts, else 1 at least. Sums are taken in doubles in a fixed order.
    """
    def estimated(words: Column) -> Column:
        n = F.size(words)
        mean = F.when(n > 0, F.length(F.array_join(words, "")).cast("double") / n).otherwise(5.0)
        long_words = F.lit(1.0) + F.greatest(F.lit(0.0), mean - 5.0) * 0.02
        variety = F.least(F.lit(1.2), F.lit(0.8) + F.size(F.array_distinct(F.split(F.lower(text), ""))).cast("double") / 100.0)
        punctuation = F.regexp_count(text, F.lit("[.!?;:,]")).cast("double") * 0.5
        numbers = F.size(F.filter(words, lambda w: w.rlike(r"^\p{Nd}+$"))).cast("double") * 0.3
        gaps = F.greatest(F.lit(0), F.regexp_count(text, F.lit(BLANKS)) - F.regexp_count(text, F.lit(NOT_BLANKS))).cast("double") * 0.1
        value = F.length(text).cast("double") / chars_per_token * long_words * variety + punctuation + numbers - gaps
        return F.greatest(F.lit(1), F.floor(value)).cast("bigint")

    found = F.regexp_extract_all(text, F.lit(r"((?:[A-Za-z0-9_]++|[\p{L}\p{N}_])+)"), F.lit(1))
    return F.when(is_blank(text), F.lit(0).cast("bigint")).otherwise(let(found, estimated))


def char_estimate(text: Column, chars_per_token: float | Column = 4.0) -> Column:
    """``floor(characters / chars_per_token)``, 1 at least, 0 for null or blank texts."""
    return F.when(is_blank(text), 0).otherwise(F.greatest(F.lit(1), F.floor(F.length(text).cast("double") / chars_per_token))).cast("bigint")


def content_estimate(content_type: Column, otherwise: float = 4.0) -> Column:
    """Characters a token for a kind of content."""
    found = F.lit(None).cast("double")
    for kind, value in CHARS_PER_TOKEN.items():
        found = F.when(content_type == kind, value).otherwise(found)
    return F.coalesce(found, F.lit(otherwise))


def content_sums(text: Column) -> dict[str, Column]:
    """Sums over texts from which ``content_profile`` is made."""
    count = lambda p: F.coalesce(F.sum(F.regexp_count(text, F.lit(p))), F.lit(0)).cast("double")
    return {
        "chars": F.coalesce(F.sum(F.length(text)), F.lit(0)).cast("double"),
        "words": count(NOT_BLANKS),
        "punctuation": count("[.,!?;:]"),
        "digits": count(r"\p{Nd}"),
        "blanks": count(BLANK),
        "breaks": count("\n"),
    }


def content_profile(chars: Column, words: Column, punctuation: Column, digits: Column, blanks: Column, breaks: Column) -> dict[str, Column]:
    """Mean word length and densities; null for no characters."""
    of = F.nullif(chars, F.lit(0.0))
    return {
        "avg_word_length": (chars - blanks) / F.greatest(F.lit(1.0), words),
        "punctuation_density": punctuation / of,
        "digit_density": digits / of,
        "whitespace_ratio": blanks / of,
        "line_break_density": breaks / of,
    }


def calibrated_chars_per_token(p: dict[str, Column]) -> Column:
    """4 characters a token, adjusted by the content's profile, between 2 and 8."""
    a = lambda c, v: F.when(c, v).otherwise(0.0)
    total = (
        a(p["avg_word_length"] > 6, 0.3) + a(p["avg_word_length"] < 4, -0.2) + a(p["punctuation_density"] > 0.1, -0.1) + a(p["punctuation_density"] < 0.03, 0.1)
        + a(p["digit_density"] > 0.05, 0.1) + a(p["whitespace_ratio"] > 0.25, -0.1) + a(p["line_break_density"] > 0.05, -0.1)
    )
    return F.greatest(F.lit(2.0), F.least(F.lit(8.0), F.lit(4.0) + total))
