"""Text projections and cleaning as Spark expressions. Null in, null out, unless said otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.session import let

#: The cleaning patterns, in the order in which they are applied.
URL = r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\(\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
FENCED_CODE = r"```[\s\S]*?```"
INLINE_CODE = r"`[^`]*`"
CONTROL = r"[\x00-\x08\x0b-\x0c\x0e-\x1f\x7f-\x9f]"

#: White space as Unicode has it; Java's ``\s`` and ``trim`` know ASCII only.
BLANK = r"[\s\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
BLANKS = BLANK + "+"
NOT_BLANK = BLANK.replace("[", "[^", 1)
#: Runs of anything else; ASCII is tried first, as a negated class of this length is slow on every character.
NOT_BLANKS = rf"(?:[!-~]++|{NOT_BLANK})+"


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, rf"\A{BLANKS}|{BLANKS}\z", "")


def is_blank(text: Column) -> Column:
    """Null, empty or nothing but white space."""
    return F.coalesce(~text.rlike(NOT_BLANK), F.lit(True))


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, "")


def strip_code(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, FENCED_CODE, ""), INLINE_CODE, "")


def strip_control(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, "")


def collapse_blanks(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def repair(text: Column) -> Column:
    """Encoding repair where the optional ``ftfy`` is installed on the driver, else the text itself."""
    try:
        import ftfy  # noqa: F401
    except ImportError:
        return text
    import pandas as pd

    @F.pandas_udf("string")
    def fixed(s: pd.Series) -> pd.Series:
        import ftfy

        return s.map(ftfy.fix_text, na_action="ignore")

    return fixed(text)


def clean_text(text: Column) -> Column:
    """Repaired; URLs, code and control characters removed; runs of white space one space; trimmed."""
    return collapse_blanks(strip_control(strip_code(strip_urls(repair(text)))))


def joined_fields(fields: Sequence[Column | str]) -> Column:
    """The fields that aren't null, cast to strings, with a space between; null if all are."""
    cols = [F.col(f) if isinstance(f, str) else f for f in fields]
    return F.when(F.coalesce(*[c.cast("string") for c in cols]).isNotNull(), F.concat_ws(" ", *[c.cast("string") for c in cols]))


def dotted_path(column: Column, path: str, of_json: bool = False) -> Column:
    """``a.0.b`` of a struct, array or map column, or of a JSON string; a number is an index into a list.

    The value is cast to a string and stripped; whatever is missing on the way gives null.
    """
    steps = path.split(".")
    if of_json:
        found = F.get_json_object(column, "$" + "".join(f"[{s}]" if s.isdigit() else f".{s}" for s in steps))
    else:
        found = column
        for s in steps:
            found = F.get(found, F.lit(int(s))) if s.isdigit() else found[s]
    return strip(found.cast("string"))


#: Names under which a response may come, in the order of preference.
RESPONSE_NAMES = ("response", "answer", "completion", "output", "assistant")


def response_alias(names: Sequence[str]) -> Column:
    """The first of the usual response columns that ``names`` has and that isn't null."""
    there = [n for n in RESPONSE_NAMES if n in names]
    return F.coalesce(*there) if there else F.lit(None).cast("string")


def fingerprint(text: Column) -> Column:
    return F.sha2(text, 256)


def blank_words(text: Column) -> Column:
    """The lower-cased pieces between white space."""
    return F.filter(F.split(F.lower(text), BLANKS), lambda w: w != "")


def char_shingles(text: Column, k: int = 3) -> Column:
    """The distinct runs of ``k`` characters of the lower-cased text without spaces; empty if it is shorter.

    One pass of a look-ahead finds the overlapping runs (none from within a surrogate pair); a lambda over positions would evaluate the text for each.
    """
    t = F.replace(F.lower(text), F.lit(" "), F.lit(""))
    return F.array_distinct(F.regexp_extract_all(t, F.lit(f"(?s)(?!\\p{{Cs}})(?=(.{{{k}}}))"), F.lit(1)))


def word_shingles(words: Column, k: int) -> Column:
    """The distinct runs of ``k`` words (without blanks in them), joined by spaces."""
    run = r"(?<![^ ])(?=([^ ]+(?: [^ ]+){%d})(?: |\z))" % (k - 1)
    return F.array_distinct(F.regexp_extract_all(F.array_join(words, " "), F.lit(run), F.lit(1)))


def sentences(text: Column, shortest: int = 5, longest: int = 2048) -> Column:
    """Sentences of 5 to 2048 characters: split after ``.!?`` before a capital or an opening mark, and at line ends."""
    parts = F.split(text, rf"(?<=[.!?]){BLANKS}(?=[A-Z\"'(\[])")
    lines = F.flatten(F.transform(parts, lambda p: F.split(p, "\n")))
    return F.filter(F.transform(lines, strip), lambda s: F.length(s).between(shortest, longest))


def training_sentences(text: Column, shortest: int = 5, longest: int = 2048) -> Column:
    """Sentences for tokenizer training: those shorter than ``shortest`` left out, those longer than ``longest`` cut to it."""
    return F.transform(sentences(text, shortest, 1 << 30), lambda s: F.substring(s, 1, longest))


#: Words of the English word test.
ENGLISH = (
    "the be to of and a in that have i it for not on with he as you do at this but his by from they we say her she or an will my "
    "one all would there their what up out if about who get which go me when make can like time no just him know take people into year your "
    "good some could them see other than then now look only come its over think also back after use two how our work first well way even new"
).split()


def english_share(text: Column) -> Column:
    """The share of English function words among the words between white space; null without words."""
    return let(blank_words(text), lambda w: F.size(F.filter(w, lambda x: x.isin(ENGLISH))).cast("double") / F.nullif(F.size(w), F.lit(0)))


def is_english(text: Column, language: Column | None = None, threshold: float = 0.7) -> Column:
    """20 characters or more, and English by the language column if there is one, else by the share of function words."""
    by = F.lower(F.trim(language)) == "en" if language is not None else english_share(text) >= threshold
    return F.coalesce((F.length(text) >= 20) & by, F.lit(False))
