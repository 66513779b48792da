"""Scores of responses and aggregates of model evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import BLANKS, blank_words, is_blank, strip
from quern.session import let


def response_quality(response: Column) -> Column:
    """0 to 1 by length, sentences, repetition and ending; 0 for null and blank responses."""
    n = F.length(response)

    def varied(w: Column) -> Column:
        unique = F.size(F.array_distinct(w)) / F.nullif(F.size(w), F.lit(0))
        return F.when(F.size(w) > 5, F.when(unique > 0.7, 0.2).when(unique < 0.5, -0.2).otherwise(0.0)).otherwise(0.0)

    score = (
        F.lit(0.5)
        + F.when(n.between(10, 200), 0.1).when(n < 5, -0.3).when(n > 300, -0.1).otherwise(0.0)
        + F.when(F.contains(response, F.lit(".")), 0.1).otherwise(0.0)
        + let(blank_words(response), varied)
        + F.when(response.rlike(r"[.!?\"']\z"), 0.1).otherwise(0.0)
    )
    return F.when(is_blank(response), 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)))


def repetition(response: Column) -> Column:
    """The share of neighbouring words that are equal; 0 for fewer than two words."""
    def repeated(w: Column) -> Column:
        equal = F.aggregate(w, F.struct(F.lit("").alias("last"), F.lit(0).alias("n")), lambda a, x: F.struct(x.alias("last"), (a["n"] + (a["last"] == x).cast("int")).alias("n")), lambda a: a["n"])
        return F.when(F.size(w) < 2, 0.0).otherwise(equal / (F.size(w) - 1))

    return let(F.filter(F.split(response, BLANKS), lambda x: x != ""), repeated)


def coherence(response: Column) -> Column:
    """The share of the parts between full stops that have more than 5 characters and a space."""
    parts = F.split(response, "[.]", -1)
    good = F.filter(F.transform(parts, strip), lambda s: (F.length(s) > 5) & F.contains(s, F.lit(" ")))
    return F.size(good) / F.size(parts)


def is_smoke_valid(response: Column) -> Column:
    """More than 5 characters and more than 3 different words."""
    w = F.filter(F.split(response, BLANKS), lambda x: x != "")
    return F.coalesce((F.length(response) > 5) & (F.size(F.array_distinct(w)) > 3), F.lit(False))


def diversity(df: DataFrame, keys: list[str], response: str) -> DataFrame:
    """Different words over all words of each key's responses; words are counted, never gathered."""
    counted = df.select(*keys, F.explode(blank_words(F.col(response))).alias("w")).groupBy(*keys, "w").agg(F.count("*").alias("n"))
    return counted.groupBy(*keys).agg((F.count("*") / F.sum("n")).alias("diversity"))


def perplexity(df: DataFrame, keys: list[str], loss: str, tokens: str, weight: Column | None = None, clamp: float | None = 20.0) -> DataFrame:
    """``exp`` of the token-weighted mean loss; NaN and infinite losses are skipped, infinity for no tokens."""
    w = F.lit(1.0) if weight is None else weight
    good = df.where(F.col(loss).isNotNull() & ~F.isnan(loss) & (F.abs(F.col(loss)) != float("inf")))
    value = F.col(loss) if clamp is None else F.least(F.col(loss), F.lit(clamp))
    sums = good.groupBy(*keys).agg(F.sum(value * F.col(tokens) * w).alias("l"), F.sum(F.col(tokens) * w).alias("t"))
    return sums.select(*keys, F.when(F.coalesce(F.col("t"), F.lit(0.0)) > 0, F.exp(F.col("l") / F.col("t"))).otherwise(float("inf")).alias("perplexity"))


def reward_statistics(df: DataFrame, keys: list[str], chosen: str, rejected: str) -> DataFrame:
    """Margins, win rate and accuracy at thresholds of pairs with two rewards that are numbers."""
    both = df.where(F.col(chosen).isNotNull() & F.col(rejected).isNotNull() & ~F.isnan(chosen) & ~F.isnan(rejected))
    m = F.col(chosen) - F.col(rejected)
    share = lambda c: F.avg(c.cast("double"))
    return both.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg(m).alias("margin_mean"), F.stddev_pop(m).alias("margin_std"), F.median(m).alias("margin_median"), F.min(m).alias("margin_min"), F.max(m).alias("margin_max"),
        share(m > 0).alias("win_rate"), F.avg(chosen).alias("chosen_mean"), F.stddev_pop(chosen).alias("chosen_std"), F.avg(rejected).alias("rejected_mean"), F.stddev_pop(rejected).alias("rejected_std"),
        share(m > 0.0).alias("accuracy_0"), share(m > 0.1).alias("accuracy_01"), share(m > 0.5).alias("accuracy_05"),
    )


def graded(value: Column, good: Column, acceptable: Column, poor: Column) -> Column:
    """excellent, good, acceptable or poor by thresholds such as ``<20`` or ``>0.65``; the sign of ``good`` sets the direction."""
    number = lambda c: F.regexp_replace(c, "[<>]", "").cast("double")
    low = F.contains(good, F.lit("<"))
    beats = lambda c: F.when(low, value <= number(c)).otherwise(value >= number(c))
    return F.when(beats(good), "excellent").when(beats(acceptable), "good").when(beats(poor), "acceptable").otherwise("poor")


def verdict(excellent: Column, good: Column, poor: Column) -> Column:
    """The overall verdict of the numbers of excellent, good and poor grades."""
    return F.when((excellent > 0) | (good >= 2), "excellent").when((good > 0) & (poor == 0), "good").when(poor == 0, "acceptable").otherwise("needs work")


def model_size(parameters: Column) -> Column:
    return F.when(parameters < 20_000_000, "tiny").when(parameters < 80_000_000, "small").otherwise("base")


def parameters(layers: Column, width: Column, inner: Column, vocabulary: Column, tied: Column) -> Column:
    """Parameters of a decoder: embeddings, attention (4 w^2), gated feed-forward (3 w f), norms, and a head unless tied."""
    per_layer = width * width * 4 + width * inner * 3 + width * 2
    return (vocabulary * width + layers * per_layer + width + F.when(tied, 0).otherwise(width * vocabulary)).cast("bigint")


def training_memory(layers: Column, width: Column, inner: Column, vocabulary: Column, batch: int = 8, length: int = 1024) -> Column:
    """GB for training: weights, gradients, two moments and activations, and a fifth more."""
    count = vocabulary * width + layers * width * width * 4 + layers * (width * inner * 2 + inner + width) + layers * width * 2
    weights = count * 4 / F.lit(1e9)
    return (weights * 4 + F.lit(float(batch * length * 4)) * width * layers / F.lit(1e9)) * 1.2


#: Layers and width of well-known models.
REFERENCE_MODELS = {"LLaMA-7B": (32, 4096), "LLaMA-13B": (40, 5120), "GPT-2-small": (12, 768), "GPT-2-medium": (24, 1024)}


def nearest_model(layers: Column, width: Column) -> Column:
    """The reference model whose layers times width is nearest as a ratio; the first named of equals."""
    mine = (layers * width).cast("double")
    options = F.array(*[F.struct(F.greatest(F.lit(float(a * b)) / mine, mine / F.lit(float(a * b))).alias("r"), F.lit(i).alias("i"), F.lit(n).alias("name")) for i, (n, (a, b)) in enumerate(REFERENCE_MODELS.items())])
    return F.array_min(options)["name"]


def likelier(yes: Column, no: Column) -> Column:
    """Whether the first of two log-probabilities is the larger; a tie is the second, null if either is."""
    return yes > no


def sequence_log_likelihood(log_probs: Column, mask: Column) -> tuple[Column, Column]:
    """Sum of the log-probabilities of the predicted (masked-in) tokens and their number: both shifted by one place."""
    n = F.greatest(F.size(log_probs) - 1, F.lit(0))
    lp, m = F.slice(log_probs, F.lit(1), n), F.slice(mask, F.lit(2), n)
    total = F.aggregate(F.zip_with(lp, m, lambda a, b: a * b.cast("double")), F.lit(0.0), lambda a, x: a + x)
    return total, F.aggregate(m, F.lit(0), lambda a, x: a + x)


def entropy(counts: DataFrame, keys: list[str], n: str) -> DataFrame:
    """Shannon entropy in bits of the counts of each key."""
    p = F.col(n) / F.sum(n).over(Window.partitionBy(*keys))
    return counts.select(*keys, p.alias("p")).groupBy(*keys).agg((-F.sum(F.col("p") * F.log2("p"))).alias("entropy"))


def consistency(docs: Column, sentences: Column, chars: Column, estimated: Column, exact: Column) -> dict[str, Column]:
    """What doesn't fit together: tokens that differ from the estimate by over half, under 1 or over 1,000 sentences a document, characters a token that differ by over 30 %."""
    zero = F.lit(0.0)
    off = F.abs(exact - estimated) / F.nullif(estimated, zero)
    exact_ratio = chars / F.nullif(exact, zero)
    ratio = F.abs(chars / F.nullif(estimated, zero) - exact_ratio) / F.nullif(exact_ratio, zero)
    per = sentences / docs
    no = F.lit(False)
    return {"discrepancy": F.coalesce(off > 0.5, no), "unusual": F.coalesce((sentences > 0) & ((per < 1) | (per > 1000)), no), "inconsistent": F.coalesce(ratio > 0.3, no)}


def recommendations(grades: DataFrame, advice: DataFrame, keys: list[str], metric: str, grade: str, most: int = 8) -> DataFrame:
    """``(keys, advice)``: the advice for each key's weak metrics (acceptable or poor) in the order of their names, each piece once, ``most`` at the most.

    ``advice`` is a table of ``(metric, advice)`` with an array of texts for each metric, a row a metric; metrics without one give none.
    """
    weak = grades.where(F.col(grade).isin("acceptable", "poor")).select(*keys, F.col(metric).alias("__m"))
    named = weak.join(advice.select(F.col("metric").alias("__m"), F.col("advice").alias("__a")), "__m", "left")
    listed = named.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__m", F.coalesce("__a", F.array().cast("array<string>")).alias("a")))).alias("w"))  # a row a metric
    return listed.select(*keys, F.slice(F.array_distinct(F.flatten(F.transform("w", lambda x: x["a"]))), 1, most).alias("advice"))
