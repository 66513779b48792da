"""Words and tokens as Spark expressions.

A *word* is a longest run of letters and digits of the lower-cased text, a *token* a piece of GPT-2's
public split pattern. All patterns name Unicode classes, as Java's ``\\w`` and ``\\s`` know ASCII only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode classes that stand for a letter or digit and for white space.
WORD = r"[\p{L}\p{N}]+"
SPACE = r"[\s\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Fixed value: GPT-2's split pattern.
GPT2 = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?(?:(?!{SPACE})[^\p{{L}}\p{{N}}])+|{SPACE}+(?={SPACE}|\z)|{SPACE}"


def words(text: Column) -> Column:
    """The words of ``text`` in order; null for null."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def gpt2_token_count(text: Column) -> Column:
    """The number of GPT-2 split pieces of ``text`` as BIGINT; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(GPT2)), F.lit(0)).cast("bigint")
