"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.words import gpt2_token_count
from quern.llm import binpack, leaks, minhash, mixing, pairs, quality, sql, stuffing
from quern.plans.sql import gpt2_pieces
from quern.session import broadcast_if_small, checkpointed, table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# 1. Text quality


def _statistics(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "sft_conversations", heavy=True).select("conv_id", "text", "template")
    return quality.text_statistics(d, "text", "template", keep=("conv_id",))


@query("p1_found")
def p1_found(spark, sf):
    return _statistics(spark, sf).where(F.col("kind").isin("list", "table", "junk")).select("conv_id", "kind").distinct()


@query("p1_statistics")
def p1_statistics(spark, sf):
    return _statistics(spark, sf)


# 2. Near-duplicates


def conversation():
    """A conversation's words: those of the prompt, a space and the response, null as empty."""
    return F.concat(F.coalesce("prompt", F.lit("")), F.lit(" "), F.coalesce("response", F.lit("")))


CONVERSATION_SETTINGS = minhash.Settings(k=3, threshold=0.70, bands=26, rows=4, min_words=20)


def _near_conversations(spark: SparkSession, sf: str, s: minhash.Settings) -> minhash.Groups:
    return minhash.near_duplicates(table(spark, sf, "sft_conversations", heavy=True).select("conv_id", "prompt", "response"), "conv_id", conversation(), s)


@query("p2_found", sql.P2_FOUND)
def p2_found(spark, sf):
    return minhash.duplicate_pairs(_near_conversations(spark, sf, CONVERSATION_SETTINGS)).select(F.col("record_a").alias("conv_a"), F.col("record_b").alias("conv_b"))


@query("p2_groups", sql.P2_GROUPS)
def p2_groups(spark, sf):
    """Near-duplicates of five-word shingles at 0.8, one row a conversation."""
    return minhash.duplicate_groups(_near_conversations(spark, sf, minhash.Settings())).withColumnRenamed("record", "conv_id")


@query("p2_weighted", sql.P2_WEIGHTED)
def p2_weighted(spark, sf):
    """Near-duplicates by the counts of five-word shingles: pairs of class representatives of a probability Jaccard similarity of 0.8 or more."""
    return minhash.class_pairs(_near_conversations(spark, sf, minhash.Settings(weights="count"))).withColumn("similarity", F.round("similarity", 6))


# 3. Packing


@query("p3_found", sql.P3_FOUND)
def p3_found(spark, sf):
    return binpack.needless_cuts(table(spark, sf, "packed_examples"), table(spark, sf, "pack_runs"))


def _packed_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations packed for every sequence length in use; missing token counts are counted, two tokens frame each."""
    capacities = table(spark, sf, "pack_runs").select(F.col("sequence_length").alias("capacity")).where("capacity > 0").distinct()
    d = table(spark, sf, "sft_conversations").select("conv_id", F.when(F.col("token_count") > 0, F.col("token_count").cast("bigint")).otherwise(gpt2_token_count(F.col("text"))).alias("n"))
    once = d.groupBy("conv_id").agg((F.max("n") + 2).alias("length"))
    sized = once.crossJoin(F.broadcast(capacities.groupBy().agg(F.collect_set("capacity").alias("cs")))).select("conv_id", "length", F.explode("cs").alias("capacity"))
    return binpack.pack(sized.withColumn("row_length", F.col("capacity")), "row_length", ["conv_id"], "length", "capacity")


@query("p3_packing")
def p3_packing(spark, sf):
    return _packed_conversations(spark, sf)


def _fill(spark: SparkSession, sf: str) -> DataFrame:
    capacities = table(spark, sf, "pack_runs").select(F.col("sequence_length").alias("row_length")).where("row_length > 0").distinct().withColumn("capacity", F.col("row_length"))
    return binpack.fill(_packed_conversations(spark, sf), "row_length", capacities)


@query("p3_fill")
def p3_fill(spark, sf):
    return _fill(spark, sf)


@query("p3_totals", sql.P3_TOTALS)
def p3_totals(spark, sf):
    """What doesn't depend on the order of packing: every place is used once, only too long items are cut, and the bins keep their bound."""
    return _fill(spark, sf).select("row_length", "items", "items_cut", "places_used", "least_bins", "within_bound")


@query(
    "p3_row_audit",
    """
    WITH p AS (SELECT DISTINCT example_id, run_id, seq_no, input_ids, labels FROM packed_examples),
    j AS (SELECT p.*, r.pad_id, r.sequence_length FROM p JOIN pack_runs r USING (run_id))
    SELECT example_id, run_id, seq_no, len(input_ids)::INT AS places, (sequence_length - len(input_ids))::INT AS missing_places,
      len(list_filter(input_ids, lambda x: x = pad_id))::INT AS pads,
      len(list_filter(labels, lambda x: x <> -100))::INT AS labelled,
      (len(input_ids) = len(labels)) AS same_length FROM j
    """,
)
def p3_row_audit(spark, sf):
    """Places, padding and labels of every packed row; repeated rows count once."""
    p = table(spark, sf, "packed_examples").select("example_id", "run_id", "seq_no", "input_ids", "labels").dropDuplicates(["example_id"])
    j = p.join(broadcast_runs(spark, sf), "run_id")
    return j.select(
        "example_id", "run_id", "seq_no", F.size("input_ids").alias("places"), (F.col("sequence_length") - F.size("input_ids")).alias("missing_places"),
        F.size(F.filter("input_ids", lambda x: x == F.col("pad_id"))).alias("pads"), F.size(F.filter("labels", lambda x: x != -100)).alias("labelled"),
        (F.size("input_ids") == F.size("labels")).alias("same_length"),
    )


def broadcast_runs(spark: SparkSession, sf: str) -> DataFrame:
    return broadcast_if_small(table(spark, sf, "pack_runs").select("run_id", "pad_id", "sequence_length"), 100_000)


# 4. Prompt and response pairs


@query("p4_found")
def p4_found(spark, sf):
    d = table(spark, sf, "sft_conversations", heavy=True).select("conv_id", "prompt", "response")
    return pairs.pair_defects(d, keep=("conv_id",)).where("defect is not null").select("conv_id", "defect").distinct()


# 5. Evaluation texts in documents


def _leaks(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.find_leaks(table(spark, sf, "documents", heavy=True).select("doc_id", "text"), table(spark, sf, "eval_items"))


@query("p5_found", sql.P5_FOUND)
def p5_found(spark, sf):
    return _leaks(spark, sf).where("edits = 0").select("doc_id", "item_id").distinct()


@query("p5_leaks")
def p5_leaks(spark, sf):
    """Leaks with up to one edited character, by the part of the item."""
    return _leaks(spark, sf)


# 6. Mixing

_TOKENS_SQL = f"""
    sizes AS (SELECT lower(trim(source)) AS source, sum(len({gpt2_pieces('text')}))::BIGINT AS source_tokens FROM documents WHERE source IS NOT NULL GROUP BY 1),
    plan AS (
      SELECT m.mix_name, m.source, m.weight, m.max_repeats, coalesce(s.source_tokens, 0) AS source_tokens,
        m.weight / sum(m.weight) OVER (PARTITION BY mix_name) * sum(coalesce(s.source_tokens, 0)) OVER (PARTITION BY mix_name) AS target_tokens,
        coalesce(s.source_tokens, 0) * m.max_repeats AS capacity_tokens
      FROM (SELECT mix_name, lower(trim(source)) AS source, max(weight) AS weight, max(max_repeats) AS max_repeats FROM mix_plan GROUP BY 1, 2) m LEFT JOIN sizes s USING (source))
"""


def _mix_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    docs = checkpointed(mixing.sized_documents(table(spark, sf, "documents", heavy=True).select("doc_id", "text", "source")))
    sizes = docs.groupBy("source").agg(F.sum("tokens").alias("source_tokens"))
    return docs, checkpointed(mixing.plan(table(spark, sf, "mix_plan"), sizes))


@query("p6_found", "WITH " + _TOKENS_SQL + "SELECT mix_name, source FROM plan WHERE capacity_tokens < target_tokens")
def p6_found(spark, sf):
    docs, planned = _mix_inputs(spark, sf)
    return mixing.shares(mixing.mix(docs, planned), planned).where("short").select("mix_name", "source")


@query("p6_plan", "WITH " + _TOKENS_SQL + "SELECT mix_name, source, weight, max_repeats, source_tokens::BIGINT AS source_tokens, round(target_tokens, 3) AS target_tokens, capacity_tokens::BIGINT AS capacity_tokens FROM plan")
def p6_plan(spark, sf):
    _, planned = _mix_inputs(spark, sf)
    return planned.withColumn("target_tokens", F.round("target_tokens", 3))


@query("p6_shares")
def p6_shares(spark, sf):
    docs, planned = _mix_inputs(spark, sf)
    return mixing.shares(mixing.mix(docs, planned), planned)


@query(
    "p6_reached",
    "WITH " + _TOKENS_SQL + " SELECT"
    " mix_name, source, round(weight / sum(weight) OVER (PARTITION BY mix_name), 9) AS target_share, capacity_tokens < target_tokens AS short, true AS exact FROM plan",
)
def p6_reached(spark, sf):
    """What doesn't depend on the draw: each source gives its target to within one document, or all it may if that is less."""
    docs, planned = _mix_inputs(spark, sf)
    longest = docs.agg(F.max("tokens").alias("longest"))
    s = mixing.shares(mixing.mix(docs, planned), planned).crossJoin(F.broadcast(longest))  # one row
    reached = F.when(F.col("short"), F.col("taken_tokens") == F.col("capacity_tokens")).otherwise((F.col("taken_tokens") >= F.col("target_tokens")) & (F.col("taken_tokens") <= F.col("target_tokens") + F.col("longest")))
    return s.select("mix_name", "source", F.round("target_share", 9).alias("target_share"), "short", (reached & (F.col("most_copies") <= F.col("max_repeats"))).alias("exact"))


@query("p6_mix")
def p6_mix(spark, sf):
    docs, planned = _mix_inputs(spark, sf)
    return mixing.mix(docs, planned).withColumnRenamed("doc", "doc_id")


# 7. Keyword-stuffed pages


def _stuffed(spark: SparkSession, sf: str) -> DataFrame:
    pages = checkpointed(stuffing.curves(table(spark, sf, "documents", heavy=True).select("doc_id", "text")))
    return stuffing.stuffed_pages(pages).withColumnRenamed("page", "doc_id")


@query("p7_found")
def p7_found(spark, sf):
    return _stuffed(spark, sf).where("stuffed").select("doc_id").distinct()


@query("p7_curves")
def p7_curves(spark, sf):
    return _stuffed(spark, sf)
