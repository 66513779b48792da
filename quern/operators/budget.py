"""Token budgets, sampling plans, and weighted draws."""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.order import hashed_rank, position, running_sum, shuffle_number
from quern.session import broadcast_if_small


def within_budget(df: DataFrame, keys: Sequence[str], order: str, tokens: str, budget: Column) -> DataFrame:
    """The rows admitted before the budget is used up: a row is kept if the tokens of those before it are fewer than ``budget``.

    So the last row may exceed the budget, and a budget of 0 admits nothing. Null tokens count as 0. Rows of the same key and order are admitted together.
    Only keys, order and tokens are summed in order; other columns are joined to what was admitted.
    """
    slim = df.groupBy(*keys, order).agg(F.sum(F.coalesce(F.col(tokens), F.lit(0))).cast("bigint").alias("__n"))
    names = {c: f"__k{i}" for i, c in enumerate([*keys, order])}
    admitted = running_sum(slim, keys, order, F.col("__n"), "__before").where(F.col("__before") < budget).select(*[F.col(c).alias(n) for c, n in names.items()])
    same = F.lit(True)
    for c, n in names.items():
        same = same & F.col(c).eqNullSafe(F.col(n))
    return df.join(admitted, same, "left_semi")


def weighted_budgets(weights: DataFrame, keys: Sequence[str], weight: str, total: Column | float) -> DataFrame:
    """``budget``: the whole part of each row's share, by weight among its ``keys``, of ``total``."""
    whole = F.sum(weight).over(Window.partitionBy(*keys))
    return weights.withColumn("budget", F.floor(total * F.col(weight) / whole).cast("bigint"))


def samples_needed(budget: Column, mean: Column, deviation: Column, margin: float = 0.1) -> Column:
    """Samples that make up a token budget, counted with half a standard deviation more each and a margin."""
    return F.ceil(budget / (mean + deviation * 0.5) * (1.0 + margin)).cast("bigint")


#: The ways to plan how many rows of each source are taken.
SAMPLING_MODES = ("target_tokens", "target_conversations", "max_samples")


def sampling_plan(sources: DataFrame, keys: Sequence[str], mode: str, total: float | None = None, margin: float = 0.02) -> DataFrame:
    """``sources`` (a row a source, with ``weight``) with ``planned``: how many rows of each are wanted.

    ``target_tokens``: as many as make up the source's share by weight, among its ``keys``, of ``total`` tokens, from ``avg_tokens`` and ``std_tokens``.
    ``target_conversations``: the share of ``total`` rows. ``max_samples``: ``max_samples`` of a source that has more (``n``), else the share ``weight`` of it; without
    a maximum the share. Null weights count as 1.
    """
    if mode not in SAMPLING_MODES:
        raise ValueError(f"no sampling mode {mode!r}; there are {', '.join(SAMPLING_MODES)}")
    if mode == "max_samples":
        share = F.floor(F.col("n") * F.coalesce("weight", F.lit(1.0)))
        return sources.withColumn("planned", F.when((F.col("max_samples") > 0) & (F.col("n") > F.col("max_samples")), F.col("max_samples")).otherwise(share).cast("bigint"))
    if total is None:
        raise ValueError(f"{mode} needs a total")
    s = weighted_budgets(sources.withColumn("__w", F.coalesce("weight", F.lit(1.0))), keys, "__w", F.lit(float(total))).drop("__w")
    if mode == "target_conversations":
        return s.withColumnRenamed("budget", "planned")
    return s.withColumn("planned", samples_needed(F.col("budget"), F.col("avg_tokens"), F.col("std_tokens"), margin)).drop("budget")


def planned_sample(df: DataFrame, plan: DataFrame, key: str, identity: Sequence[str], seed: int = 42) -> DataFrame:
    """``df``'s rows of the planned keys: all, or ``planned`` of them by a seeded draw without replacement. ``plan`` has ``(key, planned)``."""
    p = plan.select(F.col(key).alias("__key"), F.col("planned").alias("__planned"))
    j = df.join(broadcast_if_small(p, 100_000), F.col(key) == F.col("__key")).drop("__key")
    return seeded_sample(j, [key], identity, F.col("__planned"), seed).drop("__planned")


def adaptive_quotas(counts: DataFrame, shard: str, n: str, total: int) -> DataFrame:
    """``counts`` (a row a shard) with ``quota``: what each shard gives to ``total`` rows, in order.

    A shard is asked for an even part of what is still wanted of the shards left; what a small one lacks falls to those after it. The fold is over one row a
    shard, in one task.
    """
    rows = counts.select(shard, F.col(n).cast("bigint").alias("__n")).repartition(1).sortWithinPartitions(shard)
    shards = counts.agg(F.count("*")).first()[0]
    kind = counts.schema[shard].dataType.simpleString()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, left = total, shards
        for b in batches:
            out = []
            for c in b.column("__n").to_pylist():
                out.append(min(c or 0, wanted // left))
                wanted, left = wanted - out[-1], left - 1
            yield pa.RecordBatch.from_arrays([b.column(shard), pa.array(out, pa.int64())], names=["__shard", "quota"])

    q = rows.mapInArrow(fold, f"__shard {kind}, quota bigint")
    return counts.join(q, F.col(shard) == F.col("__shard")).drop("__shard")


def token_estimates(df: DataFrame, keys: Sequence[str], tokens: str) -> DataFrame:
    """Mean, population deviation, median, 90th percentile (interpolated) and number of samples."""
    return df.groupBy(*keys).agg(
        F.avg(tokens).alias("avg_tokens"), F.stddev_pop(tokens).alias("std_tokens"), F.median(tokens).alias("p50_tokens"), F.percentile(tokens, 0.9).alias("p90_tokens"), F.count(tokens).alias("n_samples")
    )


class RunningMedian:
    """The median of the values added so far, from a histogram of them: its size is the number of different values."""

    def __init__(self) -> None:
        self.values: list[float] = []
        self.counts: dict[float, int] = {}
        #: How many were added, where in ``values`` the lower median is, and how many are below it.
        self.n = self.at = self.below = 0

    def add(self, v: float) -> None:
        if v in self.counts:
            self.counts[v] += 1
            self.below += v < self.values[self.at]
        else:
            i = bisect.bisect_left(self.values, v)
            self.values.insert(i, v)
            self.counts[v] = 1
            if self.n and i <= self.at:
                self.at, self.below = self.at + 1, self.below + 1
        self.n += 1
        middle = (self.n - 1) // 2
        while self.below > middle:
            self.at -= 1
            self.below -= self.counts[self.values[self.at]]
        while self.below + self.counts[self.values[self.at]] <= middle:
            self.below += self.counts[self.values[self.at]]
            self.at += 1

    def value(self) -> float:
        """0 if nothing was added."""
        if not self.n:
            return 0.0
        low = self.values[self.at]
        high = low if self.n % 2 or self.below + self.counts[low] > self.n // 2 else self.values[self.at + 1]
        return (low + high) / 2


def without_outliers(df: DataFrame, key: str, order: str, tokens: str, after: int = 10, factor: float = 10.0) -> DataFrame:
    """The rows of each key that aren't longer than ``factor`` times the median of those kept before, once more than ``after`` are kept.

    The median of what was kept so far depends on every decision before, so each key is folded whole and in order, in one pass over key, order and
    tokens only; what is held is a histogram of the key's token counts. Keys run in parallel, and null is a key too. Rows of null tokens are dropped.
    """
    rows = df.select(key, order, tokens).where(F.col(tokens).isNotNull()).repartition(key).sortWithinPartitions(key, order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: object = fold  # no key equals it
        kept = RunningMedian()
        for b in batches:
            good = []
            for k, n in zip(b.column(key).to_pylist(), b.column(tokens).to_pylist(), strict=True):
                if k != at:
                    at, kept = k, RunningMedian()
                good.append(kept.n <= after or n <= factor * kept.value())
                if good[-1]:
                    kept.add(n)
            yield b.filter(pa.array(good, pa.bool_()))

    good = rows.mapInArrow(fold, schema)
    if set(df.columns) == {key, order, tokens}:
        return good.select(*df.columns)
    named = good.select(F.col(key).alias("__key"), F.col(order).alias("__order"))
    return df.where(F.col(tokens).isNotNull()).join(named, F.col(key).eqNullSafe(F.col("__key")) & (F.col(order) == F.col("__order")), "left_semi")


def smallest_within(df: DataFrame, keys: Sequence[str], order: str, tokens: str, target: Column) -> DataFrame:
    """The shortest rows that fit ``target`` together, until 98 % of it is used; all if they fit, the first if none does.

    Lengths are added up by their histogram first (as many rows as there are different lengths), so only ties of the one
    length at the border are ordered.
    """
    lengths = df.groupBy(*keys, tokens).agg(F.count("*").alias("__c"))
    before = Window.partitionBy(*keys).orderBy(tokens).rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy(*keys)
    sums = lengths.withColumn("__start", F.coalesce(F.sum(F.col("__c") * F.col(tokens)).over(before), F.lit(0))).withColumn("__total", F.sum(F.col("__c") * F.col(tokens)).over(all_)).withColumn("__least", F.min(tokens).over(all_))
    near = sums.where((F.col("__total") <= target) | ((F.col("__start") + F.col(tokens) <= target) & (F.col("__start") < 0.98 * target)) | (F.col(tokens) == F.col("__least")))
    ranked = position(df.join(near.drop("__c"), [*keys, tokens]), [*keys, tokens], order, "__at")
    used = F.col("__start") + F.col("__at") * F.col(tokens)
    fits = (F.col("__total") <= target) | ((used + F.col(tokens) <= target) & (used < 0.98 * target))
    first = (F.col("__at") == 0) & (F.col(tokens) == F.col("__least")) & (F.col("__least") > target)
    return ranked.where(fits | first).drop("__start", "__total", "__least", "__at")


def seeded_sample(df: DataFrame, keys: Sequence[str], identity: Sequence[str], n: Column, seed: int = 42) -> DataFrame:
    """``n`` rows of each key without replacement, by a hash of the seed and the row's identity."""
    return position(df.withColumn("__u", shuffle_number(seed, *identity)), keys, "__u", "__at").where(F.col("__at") < n).drop("__u", "__at")


def uniform(seed: int, step: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the step only, from 52 bits of a hash."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(str(seed)), step.cast("string")), 256), 1, 13), 16, 10).cast("double") / float(1 << 52)


def weighted_draws(spark, weights: DataFrame, key: str, weight: str, size: str, n: int, seed: int = 42, start: int = 0) -> DataFrame:
    """``(step, key, index)`` of draws ``start`` to ``start + n - 1``: a key by weight, then one of its ``size`` rows, with replacement.

    A draw depends on the seed and its step only, so (seed, step) is all there is to save and a run may go on anywhere. ``weights`` is a
    plan of a few rows; it is sent to the tasks as one array. Keys of no weight or size are never drawn.
    """
    usable = weights.where((F.col(weight) > 0) & (F.col(size) > 0))
    total = F.sum(weight).over(Window.partitionBy())
    upper = F.sum(weight).over(Window.partitionBy().orderBy(key)) / total
    stretches = usable.select(F.col(key).alias("key"), F.col(size).cast("bigint").alias("size"), upper.alias("upper")).agg(F.sort_array(F.collect_list(F.struct("upper", "key", "size"))).alias("s"))
    steps = spark.range(start, start + n).select(F.col("id").alias("step"), uniform(seed, F.col("id")).alias("u"), uniform(seed + 1, F.col("id")).alias("v"))
    drawn = steps.crossJoin(F.broadcast(stretches)).withColumn("hit", F.filter("s", lambda x: x["upper"] > F.col("u"))).withColumn("hit", F.coalesce(F.get("hit", F.lit(0)), F.try_element_at("s", F.lit(-1))))
    return drawn.where("hit is not null").select("step", F.col("hit.key").alias(key), F.floor(F.col("v") * F.col("hit.size")).cast("bigint").alias("index"))


def observed_mix(draws: DataFrame, key: str) -> DataFrame:
    """``(key, draws, share)``."""
    return draws.groupBy(key).agg(F.count("*").alias("draws")).withColumn("share", F.col("draws") / F.sum("draws").over(Window.partitionBy()))


def weighted_mix(df: DataFrame, plan: DataFrame, key: str, weight: str, identity: Sequence[str], factor: float = 1.0, seed: int = 42) -> DataFrame:
    """Of each key, ``min(floor(n weight factor), n)`` rows without replacement, all in one seeded order (``mix_rank``)."""
    sizes = df.groupBy(key).agg(F.count("*").alias("__n")).join(plan.select(key, weight), key)
    quota = sizes.select(key, F.least(F.floor(F.col("__n") * F.col(weight) * factor), F.col("__n")).alias("__quota"))
    return seeded_sample(df.join(quota, key), [key], identity, F.col("__quota"), seed).drop("__quota").withColumn("mix_rank", hashed_rank(seed, *identity))


def interleave(df: DataFrame, draws: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of several keys in the sequence of ``draws`` (of ``weighted_draws``): the i-th draw of a key takes its i-th row, from the first again when all are used."""
    turns = position(draws.select("step", key), [key], "step", "__turn")
    sizes = df.groupBy(key).agg(F.count("*").alias("__n"))
    placed = position(df, [key], order, "__at")
    return turns.join(sizes, key).withColumn("__at", F.col("__turn") % F.col("__n")).join(placed, [key, "__at"]).drop("__turn", "__n", "__at")
