"""Whole preparations: a pretraining corpus, a fine-tuning corpus and a preference corpus, from sources to shards."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import estimate, templates, text
from quern.operators import budget, dedup, filters, order
from quern.session import checkpointed
from quern.sources import readers, writers


@dataclass(frozen=True)
class Source:
    name: str
    kind: str
    path: str
    order: str
    text_keys: tuple[str, ...] = ("text",)
    token_budget: int | None = None
    language: str | None = None
    min_length: int = 50
    max_length: int = 10_000
    require_english: bool = False
    options: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Pretraining:
    """``near``: ``characters``, ``words`` or None; documents of earlier sources win over those of later ones."""

    sources: tuple[Source, ...]
    near: str | None = "words"
    threshold: float = 0.85
    permutations: int = 128
    docs_per_shard: int = 10_000

    def check(self) -> None:
        if not self.sources or len({s.name for s in self.sources}) < len(self.sources):
            raise ValueError("sources must be named, each once")
        if self.near not in (None, "characters", "words"):
            raise ValueError(f"no deduplication by {self.near!r}")


def _source(spark: SparkSession, s: Source, rank: int) -> DataFrame:
    d = readers.load(spark, s.kind, s.path, **s.options)
    t = text.clean_text(text.joined_fields([c for c in s.text_keys if c in d.columns]))
    lang = F.col(s.language) if s.language else None
    ok = filters.length_between(F.col("text"), s.min_length, s.max_length) & (text.is_english(F.col("text"), F.col("lang") if lang is not None else None) if s.require_english else F.lit(True))
    cols = [F.lit(s.name).alias("source"), F.col(s.order).cast("bigint").alias("row"), t.alias("text"), *([lang.alias("lang")] if lang is not None else [])]
    kept = d.select(*cols).where(ok).select("source", "row", "text")
    return kept.withColumn("ord", F.struct(F.lit(rank).alias("source_rank"), F.col("row").alias("row"))).withColumn("tokens", estimate.smart_estimate(F.col("text")))


def pretraining_sources(spark: SparkSession, c: Pretraining) -> list[tuple[str, int, DataFrame]]:
    """``(name, documents, admitted)`` of each source: how many passed its filters, and ``(source, row, text, tokens, ord)`` of those that were admitted.

    Sources are taken in turn, as a document that an earlier source's budget shut out doesn't shut out a later copy. Each is cleaned once and checkpointed.
    """
    c.check()
    memory = dedup.Admission(c.near, c.threshold, c.permutations)
    parts = []
    for rank, s in enumerate(c.sources):
        clean = checkpointed(_source(spark, s, rank))
        within = (lambda d: d) if s.token_budget is None else (lambda d, n=s.token_budget: budget.within_budget(d, ["source"], "row", "tokens", F.lit(n)))
        parts.append((s.name, clean.count(), memory.admit(clean, "text", "row", within)))
    return parts


def pretraining_corpus(spark: SparkSession, c: Pretraining) -> DataFrame:
    """``(source, row, text, tokens, ord)``: every source cleaned, filtered, free of copies of what was admitted before, and within its budget."""
    return _joined([d for _, _, d in pretraining_sources(spark, c)])


def _joined(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for d in parts[1:]:
        whole = whole.unionByName(d)
    return whole.select("source", "row", "text", "tokens", "ord")


def prepare_pretraining(spark: SparkSession, c: Pretraining, directory: str, force: bool = False) -> dict:
    """The corpus as gzipped shards with a manifest that holds its statistics; nothing is done if one is there, unless ``force``.

    Of each source: the documents that passed its filters, those admitted, those that copies or the budget shut out, and the tokens.
    """
    if not force and writers.exists(spark, f"{directory}/manifest.json"):
        return readers.manifest(spark, directory)
    parts = pretraining_sources(spark, c)
    d = _joined([p for _, _, p in parts])
    sums = {r["source"]: r for r in d.groupBy("source").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens")).collect()}  # one row a source
    stats = {}
    for name, processed, _ in parts:
        docs, tokens = (sums[name]["docs"], sums[name]["tokens"]) if name in sums else (0, 0)
        stats[name] = {"processed": processed, "documents": docs, "shut_out": processed - docs, "tokens": tokens}
    rows = d.select("text", "source", F.col("tokens").alias("exact_tokens"), F.length("text").alias("character_count"), "ord")
    return writers.write_shards(rows, directory, "ord", c.docs_per_shard, "exact_tokens", asdict(c), {"statistics": stats}, force=True)


@dataclass(frozen=True)
class Finetuning:
    template: str = "chatml"
    limits: dict[str, Any] = field(default_factory=dict)
    near: bool = True
    train_share: float = 0.9
    rows_per_shard: int = 10_000
    seed: int = 42
    #: How many conversations of each dataset are taken (``budget.SAMPLING_MODES``), None for all; and the total that two of the modes need.
    sampling: str | None = None
    sampling_total: float | None = None

    def check(self) -> None:
        if self.sampling is not None and self.sampling not in budget.SAMPLING_MODES:
            raise ValueError(f"no sampling mode {self.sampling!r}")
        if self.sampling in ("target_tokens", "target_conversations") and self.sampling_total is None:
            raise ValueError(f"{self.sampling} needs a total")
        if self.template not in templates.SPECIAL_TOKENS:
            raise ValueError(f"no template {self.template!r}")
        if not 0 < self.train_share <= 1:
            raise ValueError("the training share must be in (0, 1]")


def finetuning_corpus(pairs: DataFrame, identity: str, c: Finetuning, datasets: DataFrame | None = None) -> DataFrame:
    """``(identity, text, prompt, response, split)`` of pairs with ``prompt`` and ``response``: filtered, formatted, deduplicated, sampled, shuffled and split.

    Sampling needs a column ``dataset`` of ``pairs`` and ``datasets`` with ``(dataset, weight)``, and ``max_samples`` for that mode.
    """
    c.check()
    named = ["dataset"] if c.sampling else []
    p = pairs.select(identity, *named, text.strip(F.col("prompt")).alias("prompt"), text.strip(F.col("response")).alias("response")).dropDuplicates([identity])
    p = p.where(templates.is_valid_pair(F.col("prompt"), F.col("response")) & filters.pair_quality(F.col("prompt"), F.col("response"), **c.limits).isNull())
    f = p.withColumn("text", templates.format_conversation(c.template, F.col("prompt"), F.col("response")))
    kept = dedup.near_first_words(f, "text", identity) if c.near else f
    if c.sampling:
        kept = checkpointed(kept)
        n = estimate.smart_estimate(F.col("text"))
        sizes = kept.groupBy("dataset").agg(F.count("*").alias("n"), F.avg(n).alias("avg_tokens"), F.stddev_pop(n).alias("std_tokens"))
        kept = budget.planned_sample(kept, budget.sampling_plan(sizes.join(datasets, "dataset"), [], c.sampling, c.sampling_total), "dataset", [identity], c.seed).drop("dataset")
    return order.ratio_split(kept.withColumn("__u", order.shuffle_number(c.seed, identity)), [], "__u", F.lit(c.train_share)).drop("__u")


def prepare_finetuning(pairs: DataFrame, identity: str, c: Finetuning, directory: str, datasets: DataFrame | None = None) -> dict:
    return writers.write_split_shards(checkpointed(finetuning_corpus(pairs, identity, c, datasets)), directory, "split", identity, c.rows_per_shard, config=asdict(c))


def prepare_preferences(triplets: DataFrame, identity: str, directory: str, rows_per_shard: int = 10_000) -> dict:
    """Valid triplets as shards, the funnel of the others in the manifest."""
    t = triplets.select(identity, *[text.strip(F.col(c)).alias(c) for c in ("prompt", "chosen", "rejected")]).dropDuplicates([identity])
    t = checkpointed(t.withColumn("fault", filters.preference_fault(F.col("prompt"), F.col("chosen"), F.col("rejected"))))
    funnel = {r["reason"]: r["n"] for r in filters.reason_counts(t, "fault").collect()}  # one row a reason
    good = t.where("fault is null").drop("fault")
    fields = ("prompt", "chosen", "rejected")
    sums = good.agg(*[g(estimate.char_estimate(F.col(c))).alias(f"{c}_{n}") for c in fields for n, g in (("mean", F.avg), ("median", F.median))]).first()
    lengths = {c: {n: sums[f"{c}_{n}"] or 0.0 for n in ("mean", "median")} for c in fields}
    return writers.write_shards(good, directory, identity, rows_per_shard, extra={"funnel": funnel, "lengths": lengths}, force=True)
