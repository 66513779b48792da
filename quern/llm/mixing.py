"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. *Plan*: a source's share of the mix is its weight over the mix's weights; its target is that share of the
   mix's size, its capacity its own size times ``max_repeats``.
2. *Blocks*: a source's documents, once for each copy, fall by a hash into blocks of about ``block_tokens``. Whole
   copies are taken while they fit; of the last one blocks are taken in the order of a random permutation, and of
   the last block documents, until the target is reached (so a share is exact to a document). Only blocks, never
   documents, are ordered across a source.
3. *Splitting tree*: the numbers of blocks taken of each source are split among the output shards: each inner node
   draws from the multivariate hypergeometric distribution how many of its blocks of each source go left. All
   shards get equal numbers of blocks (to one), and every assignment is as likely as in one large shuffle. A
   node's draw depends on the seed and the node only, so every shard finds its quotas by itself on the way from the
   root to its leaf, in a task.
4. *Draw*: the blocks of a source, permuted, are handed out in the shards' order of quotas, and each shard is
   shuffled by itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.words import gpt2_token_count
from quern.operators.order import position, running_sum
from quern.session import broadcast_if_small, checkpointed


def source_name(c: Column) -> Column:
    """A source's name as it is compared: trimmed and in lower case."""
    return F.lower(F.trim(c))


def sized_documents(documents: DataFrame, document: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(doc, source, tokens)`` of every document with a source; a null text has 0 tokens."""
    return documents.select(F.col(document).alias("doc"), source_name(F.col(source)).alias("source"), gpt2_token_count(F.col(text)).alias("tokens")).where("source is not null")


def plan(mixes: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(mix_name, source, weight, max_repeats, source_tokens, target_tokens, capacity_tokens)``.

    ``sizes`` has ``(source, source_tokens)``. A source without documents has size 0; null weights and repeats
    count as 0. Sources named twice in a mix (after trimming) count once, with the larger weight and repeats.
    """
    p = mixes.select("mix_name", source_name(F.col("source")).alias("source"), F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("max_repeats", F.lit(0)).alias("max_repeats"))
    p = p.where("mix_name is not null and source is not null").groupBy("mix_name", "source").agg(F.max("weight").alias("weight"), F.max("max_repeats").alias("max_repeats"))
    p = p.join(sizes, "source", "left").withColumn("source_tokens", F.coalesce("source_tokens", F.lit(0)).cast("bigint"))
    of_mix = Window.partitionBy("mix_name")
    target = F.col("weight") / F.sum("weight").over(of_mix) * F.sum("source_tokens").over(of_mix)
    return p.select("mix_name", "source", "weight", "max_repeats", "source_tokens", F.coalesce(target, F.lit(0.0)).alias("target_tokens"), (F.col("source_tokens") * F.col("max_repeats")).alias("capacity_tokens"))


def _unit(*parts: Column | str) -> Column:
    """A hash of the parts as a number in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def draw(docs: DataFrame, planned: DataFrame, block_tokens: int, seed: int) -> DataFrame:
    """``(mix_name, source, doc, copy, block, tokens)`` of every copy of a document that the mixes take.

    ``docs`` is ``sized_documents``, ``planned`` is ``plan``; both should be cheap to read again.
    """
    # copies taken whole, and what is wanted of the next one
    p = planned.where("source_tokens > 0 and target_tokens > 0 and max_repeats > 0")
    p = p.withColumn("full", F.least(F.floor(F.col("target_tokens") / F.col("source_tokens")), F.col("max_repeats").cast("bigint")))
    p = p.withColumn("rest", F.when(F.col("full") >= F.col("max_repeats"), 0.0).otherwise(F.col("target_tokens") - F.col("full") * F.col("source_tokens")))
    p = p.withColumn("blocks", F.ceil(F.col("source_tokens") / F.lit(block_tokens)).cast("bigint"))
    p = p.select("mix_name", "source", "full", "rest", "blocks")
    placed = docs.join(broadcast_if_small(p, 10_000), "source").withColumn("block", F.floor(_unit(F.lit(seed), "mix_name", "doc") * F.col("blocks")))
    whole = placed.where("full > 0").select("mix_name", "source", "doc", F.explode(F.sequence(F.lit(0), F.col("full").cast("int") - 1)).alias("copy"), "block", "tokens")
    part = placed.where("rest > 0")
    # blocks of the last copy, in a random order, until the rest is reached; one row a block
    sums = part.groupBy("mix_name", "source", "block").agg(F.sum("tokens").alias("block_sum"), F.first("rest").alias("rest"))
    before = running_sum(sums.withColumn("at", F.xxhash64(F.lit(seed + 1), "mix_name", "source", "block")), ["mix_name", "source"], "at", F.col("block_sum"), "before")
    taken = before.where("before < rest").select("mix_name", "source", "block", (F.col("before") + F.col("block_sum") <= F.col("rest")).alias("all"), (F.col("rest") - F.col("before")).alias("left"))
    last = part.join(taken, ["mix_name", "source", "block"]).select("mix_name", "source", "doc", "block", "tokens", "all", "left")
    inside = Window.partitionBy("mix_name", "source", "block").orderBy(F.xxhash64(F.lit(seed + 2), "doc"), "doc").rowsBetween(Window.unboundedPreceding, -1)
    cut = last.where("not all").withColumn("sum", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).where("sum < left").drop("sum")
    rest = last.where("all").unionByName(cut).join(broadcast_if_small(p.select("mix_name", "source", F.col("full").cast("int").alias("copy")), 10_000), ["mix_name", "source"])
    return whole.unionByName(rest.select("mix_name", "source", "doc", "copy", "block", "tokens"))


def leaf_quotas(counts: np.ndarray, shards: int, leaf: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The blocks of each source for one shard, and those of all shards before it.

    The tree halves the shards; a node's draw is seeded by the node, so that all leaves agree on it.
    """
    low, high = 0, shards
    here, before = counts.astype(np.int64), np.zeros(len(counts), np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        total = int(here.sum())
        # equal numbers of blocks: shard i of n gets those from floor(total i / n) on, over the whole tree
        goes_left = total * (middle - low) // (high - low)
        left = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(here, goes_left, method="marginals") if goes_left else np.zeros_like(here)
        if leaf < middle:
            here, high = left, middle
        else:
            before, here, low = before + left, here - left, middle
    return here, before


def shard_quotas(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """``(mix_name, source, shard, first, n)``: shard gets the ``n`` blocks of the source from the ``first`` on, of ``(mix_name, source, n_blocks)``."""
    spark = blocks.sparkSession
    # one row a source of a mix: as many as the plan has, gathered for each mix and sent to the shards, which are made in the tasks
    mixes = blocks.groupBy("mix_name").agg(F.sort_array(F.collect_list(F.struct("source", "n_blocks"))).alias("of"))
    work = spark.range(shards).select(F.col("id").cast("int").alias("shard")).crossJoin(broadcast_if_small(mixes, 10_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for mix, of, shard in zip(*(b.column(c).to_pylist() for c in ("mix_name", "of", "shard")), strict=True):
                here, before = leaf_quotas(np.array([x["n_blocks"] for x in of], np.int64), shards, shard, seed)
                out += [(mix, x["source"], shard, int(f), int(n)) for x, f, n in zip(of, before, here, strict=True) if n]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["mix_name", "source", "shard", "first", "n"])

    return work.mapInArrow(run, "mix_name string, source string, shard int, first bigint, n bigint")


def shard_count(planned: DataFrame, tokens_per_shard: int) -> int:
    """Shards that hold about ``tokens_per_shard`` tokens of the largest mix each."""
    size = F.sum(F.least(F.col("target_tokens"), F.col("capacity_tokens").cast("double")))
    largest = planned.groupBy("mix_name").agg(size.alias("n")).agg(F.max("n")).first()[0]
    return max(4, math.ceil((largest or 0) / tokens_per_shard))


def mix(docs: DataFrame, planned: DataFrame, shards: int | None = None, block_tokens: int = 20_000, tokens_per_shard: int = 20_000_000, seed: int = 42) -> DataFrame:
    """``(mix_name, shard, position, doc, source, copy, tokens)``: every mix, shuffled and cut into shards.

    A source that can't reach its target gives all it may (``max_repeats`` copies). Every copy of a document is in
    one place only. The same input and seed give the same mix. Without ``shards`` their number follows from
    ``tokens_per_shard``, so that shards don't grow with the mix. Empty documents or plans give an empty mix.
    """
    shards = shards or shard_count(planned, tokens_per_shard)
    drawn = checkpointed(draw(docs, planned, block_tokens, seed))
    taken = drawn.groupBy("mix_name", "source", "copy", "block").agg(F.xxhash64(F.lit(seed + 3), "mix_name", "source", "copy", "block").alias("at"))
    ranked = position(taken, ["mix_name", "source"], "at", "rank")  # read twice, from what its ranges wrote
    quotas = shard_quotas(ranked.groupBy("mix_name", "source").agg(F.count("*").alias("n_blocks")), shards, seed)
    # the stretches of ranks that the shards get, rank by rank: one row a block
    by_rank = quotas.select("mix_name", "source", "shard", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("rank"))
    placed = ranked.join(by_rank, ["mix_name", "source", "rank"]).select("mix_name", "source", "copy", "block", "shard")
    local = Window.partitionBy("mix_name", "shard").orderBy(F.xxhash64(F.lit(seed + 4), "doc", "copy"), "doc", "copy")
    joined = drawn.join(placed, ["mix_name", "source", "copy", "block"])
    return joined.select("mix_name", "shard", (F.row_number().over(local) - 1).alias("position"), "doc", "source", "copy", "tokens")


def shares(drawn: DataFrame, planned: DataFrame) -> DataFrame:
    """What each source gives: ``plan``'s columns, ``taken_tokens, taken_docs, most_copies, target_share, share`` (of what the mix took) and ``short``.

    A source is short if all it may give is less than its target.
    """
    got = drawn.groupBy("mix_name", "source").agg(F.sum("tokens").alias("taken_tokens"), F.count("*").alias("taken_docs"), (F.max("copy") + 1).alias("most_copies"))
    j = planned.join(got, ["mix_name", "source"], "left").fillna(0, ["taken_tokens", "taken_docs", "most_copies"])
    w = Window.partitionBy("mix_name")
    return j.select(
        *planned.columns, "taken_tokens", "taken_docs", F.col("most_copies").cast("int").alias("most_copies"),
        (F.col("weight") / F.nullif(F.sum("weight").over(w), F.lit(0.0))).alias("target_share"),
        (F.col("taken_tokens") / F.nullif(F.sum("taken_tokens").over(w), F.lit(0))).alias("share"),
        (F.col("taken_tokens") < F.col("target_tokens")).alias("short"),
    )
