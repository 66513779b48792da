"""Row filters with reason codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import URL, is_blank
from quern.operators.order import running_sum


def length_between(text: Column, least: int = 50, most: int = 10_000) -> Column:
    """Whether a text has ``least`` to ``most`` characters; a null text hasn't."""
    return F.coalesce(F.length(text).between(least, most), F.lit(False))


def pair_quality(prompt: Column, response: Column, min_prompt: int | None = None, max_prompt: int | None = None, min_response: int | None = None, max_response: int | None = None, no_urls: bool = False, no_code: bool = False, ascii_only: bool = False) -> Column:
    """The first reason why a pair is left out, or null. Only limits that are given are applied; nulls are of length 0."""
    p, r = F.coalesce(prompt, F.lit("")), F.coalesce(response, F.lit(""))
    either = lambda pattern: p.rlike(pattern) | r.rlike(pattern)
    rules = [
        (min_prompt is not None, lambda: F.length(p) < min_prompt, "short_prompt"), (max_prompt is not None, lambda: F.length(p) > max_prompt, "long_prompt"),
        (min_response is not None, lambda: F.length(r) < min_response, "short_response"), (max_response is not None, lambda: F.length(r) > max_response, "long_response"),
        (no_urls, lambda: either(URL), "url"), (no_code, lambda: either("```"), "code"), (ascii_only, lambda: either(r"[^\x00-\x7F]"), "not_ascii"),
    ]
    reason = F.lit(None).cast("string")
    for on, test, name in reversed(rules):
        if on:
            reason = F.when(test(), name).otherwise(reason)
    return reason


def preference_fault(prompt: Column, chosen: Column, rejected: Column) -> Column:
    """Why a preference triplet is invalid, or null."""
    fields = (("prompt", prompt), ("chosen", chosen), ("rejected", rejected))
    reason = F.when(chosen == rejected, "same")
    for name, c in reversed(fields):
        reason = F.when(is_blank(c), f"empty_{name}").otherwise(reason)
    for name, c in reversed(fields):
        reason = F.when(c.isNull(), f"missing_{name}").otherwise(reason)
    return reason


def preference_quality(tokens: dict[str, Column], least: dict[str, int], most: dict[str, int], min_margin: int = 0, same: Column | None = None) -> Column:
    """Whether all three fields' token counts are in range and chosen and rejected differ enough in length."""
    ok = F.abs(tokens["chosen"] - tokens["rejected"]) >= min_margin
    for k, c in tokens.items():
        ok = ok & c.between(least.get(k, 0), most.get(k, 10_000))
    return F.coalesce(ok if same is None else ok & ~same, F.lit(False))


def first_sentences(df: DataFrame, order: str, sentences: Column, most: int) -> DataFrame:
    """``(order, pos, sentence)``: the first ``most`` sentences of a corpus in ``order``, which must be unique, and by their place in the text.

    Sentences are counted in order as numbers a document; only documents that reach the limit are then looked at, and the last one is cut.
    """
    counted = df.select(F.col(order).alias("__o"), F.coalesce(F.size(sentences), F.lit(0)).alias("__n"))
    before = running_sum(counted, [], "__o", F.col("__n"), "__before").where(F.col("__before") < most).drop("__n")
    taken = df.join(before, F.col(order) == F.col("__o"))
    return taken.select(order, F.posexplode(F.slice(sentences, F.lit(1), (F.lit(most) - F.col("__before")).cast("int"))).alias("pos", "sentence"))


def reason_counts(df: DataFrame, reason: str) -> DataFrame:
    """``(reason, n)``; rows that pass are ``kept``."""
    return df.groupBy(F.coalesce(F.col(reason), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))
