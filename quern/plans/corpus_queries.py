"""Queries of the pretraining corpus: filters, deduplication, budgets, shards and corpus statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.functions import estimate, text
from quern.functions.words import words
from quern.operators import budget, dedup, evaluate, filters, order, tokenize
from quern.plans import sql
from quern.plans.registry import query
from quern.session import checkpointed, table, with_once

_SOURCE = "lower(trim(source))"


def documents(spark, sf, *cols, heavy=False):
    return table(spark, sf, "documents", heavy).select("doc_id", F.expr(_SOURCE).alias("source"), *cols)


def _estimated(spark, sf):
    """Documents with a source, and their tokens estimated by length."""
    return documents(spark, sf, estimate.char_estimate(F.col("text")).alias("tokens"), heavy=True).where("source is not null")


_CHARS = f"(CASE WHEN text IS NULL OR len({sql.strip('text')}) = 0 THEN 0 ELSE greatest(1, floor(len(text)::DOUBLE / 4.0::DOUBLE)) END)::BIGINT"
_EST = f"e AS (SELECT doc_id, {_SOURCE} AS source, {_CHARS} AS tokens FROM documents WHERE source IS NOT NULL)"
_CORPUS = f"""c AS (SELECT doc_id, {_SOURCE} AS source, {sql.clean('text')} AS text FROM documents WHERE source IS NOT NULL AND lower(trim(lang)) = 'en'),
    f AS (SELECT * FROM c WHERE len(text) BETWEEN 50 AND 10000),
    u AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1),
    t AS (SELECT *, {sql.smart('text')} AS tokens FROM u),
    b AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM t),
    k AS (SELECT * FROM b WHERE before < 20000)"""


def corpus(spark, sf, per_source: int = 20_000):
    """Cleaned English documents of 50 to 10,000 characters, the first of each text, up to a token budget a source."""
    d = documents(spark, sf, "text", "lang", heavy=True).where("source is not null and lower(trim(lang)) = 'en'")
    d = with_once(d, "text", text.clean_text(F.col("text")))
    d = d.where(filters.length_between(F.col("text")) & text.is_english(F.col("text"), F.col("lang"))).drop("lang")
    # copies and the budget read their input again: written once here, cleaning and counting aren't done again
    d = checkpointed(with_once(d, "tokens", estimate.smart_estimate(F.col("text"))))
    return budget.within_budget(dedup.exact_first(d, "text", "doc_id"), ["source"], "doc_id", "tokens", F.lit(per_source))


@query(
    "pretrain_corpus_by_source",
    f"""WITH {_CORPUS} SELECT source, count(*) AS docs, sum(tokens)::BIGINT AS tokens, sum(len(text))::BIGINT AS chars, avg(tokens) AS avg_tokens,
    min(tokens) AS min_tokens, max(tokens) AS max_tokens FROM k GROUP BY source""",
)
def pretrain_corpus_by_source(spark, sf):
    return corpus(spark, sf).groupBy("source").agg(
        F.count("*").alias("docs"), F.sum("tokens").alias("tokens"), F.sum(F.length("text")).alias("chars"), F.avg("tokens").alias("avg_tokens"),
        F.min("tokens").alias("min_tokens"), F.max("tokens").alias("max_tokens"),
    )


@query("corpus_rows", f"WITH {_CORPUS} SELECT doc_id, source, text, tokens FROM k")
def corpus_rows(spark, sf):
    return corpus(spark, sf).select("doc_id", "source", "text", "tokens")


# Filters


@query("filter_length", "SELECT doc_id, coalesce(len(text) BETWEEN 50 AND 10000, false) AS kept FROM documents")
def filter_length(spark, sf):
    return documents(spark, sf, filters.length_between(F.col("text")).alias("kept")).drop("source")


@query("filter_language", "SELECT doc_id, coalesce(len(text) >= 20 AND lower(trim(lang)) = 'en', false) AS kept FROM documents")
def filter_language(spark, sf):
    return documents(spark, sf, text.is_english(F.col("text"), F.col("lang")).alias("kept")).drop("source")


_PAIR = r"""CASE WHEN len(p) < 10 THEN 'short_prompt' WHEN len(p) > 200 THEN 'long_prompt' WHEN len(r) < 20 THEN 'short_response' WHEN len(r) > 800 THEN 'long_response'
    WHEN regexp_matches(p, 'https?://') OR regexp_matches(r, 'https?://') THEN 'url' WHEN contains(p, '```') OR contains(r, '```') THEN 'code' WHEN regexp_matches(p || r, '[^\x00-\x7F]') THEN 'not_ascii' END"""


@query("filter_pair_reasons", f"SELECT coalesce({_PAIR}, 'kept') AS reason, count(*) AS n FROM (SELECT DISTINCT conv_id, coalesce(prompt, '') AS p, coalesce(response, '') AS r FROM sft_conversations) GROUP BY 1")
def filter_pair_reasons(spark, sf):
    d = table(spark, sf, "sft_conversations").select("conv_id", "prompt", "response").distinct()
    reason = filters.pair_quality(F.col("prompt"), F.col("response"), 10, 200, 20, 800, True, True, True)
    return filters.reason_counts(d.withColumn("reason", reason), "reason")


_FAULT = f"""CASE WHEN prompt IS NULL THEN 'missing_prompt' WHEN chosen IS NULL THEN 'missing_chosen' WHEN rejected IS NULL THEN 'missing_rejected'
    WHEN len({sql.strip('prompt')}) = 0 THEN 'empty_prompt' WHEN len({sql.strip('chosen')}) = 0 THEN 'empty_chosen' WHEN len({sql.strip('rejected')}) = 0 THEN 'empty_rejected' WHEN chosen = rejected THEN 'same' END"""


@query("filter_preference_faults", f"SELECT pair_id, {_FAULT} AS fault FROM preference_pairs")
def filter_preference_faults(spark, sf):
    return table(spark, sf, "preference_pairs").select("pair_id", filters.preference_fault(F.col("prompt"), F.col("chosen"), F.col("rejected")).alias("fault"))


@query("filter_preference_funnel", f"SELECT coalesce({_FAULT}, 'kept') AS reason, count(*) AS n FROM preference_pairs GROUP BY 1")
def filter_preference_funnel(spark, sf):
    d = table(spark, sf, "preference_pairs").select(filters.preference_fault(F.col("prompt"), F.col("chosen"), F.col("rejected")).alias("fault"))
    return filters.reason_counts(d, "fault")


def _tok(c: str) -> str:
    return f"(CASE WHEN {c} IS NULL OR len({sql.strip(c)}) = 0 THEN 0 ELSE greatest(1, floor(len({c})::DOUBLE / 4.0::DOUBLE)) END)::BIGINT"


@query("filter_preference_quality", f"SELECT pair_id, p BETWEEN 3 AND 100 AND c BETWEEN 3 AND 200 AND r BETWEEN 3 AND 200 AND abs(c - r) >= 5 AND NOT coalesce(chosen = rejected, false) AS kept FROM (SELECT *, {_tok('prompt')} AS p, {_tok('chosen')} AS c, {_tok('rejected')} AS r FROM preference_pairs)")
def filter_preference_quality(spark, sf):
    tokens = {c: estimate.char_estimate(F.col(c)) for c in ("prompt", "chosen", "rejected")}
    kept = filters.preference_quality(tokens, {"prompt": 3, "chosen": 3, "rejected": 3}, {"prompt": 100, "chosen": 200, "rejected": 200}, 5, F.coalesce(F.col("chosen") == F.col("rejected"), F.lit(False)))
    return table(spark, sf, "preference_pairs").select("pair_id", kept.alias("kept"))


@query("filter_sequence_length", "SELECT source_dataset, count(*) AS kept FROM (SELECT DISTINCT conv_id, source_dataset, token_count FROM sft_conversations) WHERE token_count <= 256 GROUP BY 1")
def filter_sequence_length(spark, sf):
    return table(spark, sf, "sft_conversations").select("conv_id", "source_dataset", "token_count").distinct().where("token_count <= 256").groupBy("source_dataset").agg(F.count("*").alias("kept"))


@query(
    "filter_outliers",
    f"""WITH RECURSIVE {_EST}, o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM e),
    f AS (SELECT source, doc_id, tokens, i, true AS kept, [tokens] AS l FROM o WHERE i = 1
      UNION ALL SELECT o.source, o.doc_id, o.tokens, o.i, {{ok}}, CASE WHEN {{ok}} THEN list_append(f.l, o.tokens) ELSE f.l END FROM f JOIN o ON o.source = f.source AND o.i = f.i + 1)
    SELECT doc_id, source, tokens FROM f WHERE kept""".replace("{ok}", "(len(f.l) <= 10 OR o.tokens <= 10 * list_aggregate(f.l, 'median'))"),
)
def filter_outliers(spark, sf):
    return budget.without_outliers(_estimated(spark, sf), "source", "doc_id", "tokens")


# Deduplication


@query("dedup_exact_first", "SELECT min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY text")
def dedup_exact_first(spark, sf):
    return dedup.exact_first(documents(spark, sf, "text").where("text is not null"), "text", "doc_id").select("doc_id")


@query("dedup_exact_statistics", "SELECT count(*) AS processed, count(DISTINCT text) AS unique_docs, count(*) - count(DISTINCT text) AS duplicates, (count(*) - count(DISTINCT text))::DOUBLE / count(*) AS rate FROM documents WHERE text IS NOT NULL")
def dedup_exact_statistics(spark, sf):
    d = documents(spark, sf, "text").where("text is not null")
    return dedup.dedup_statistics(d, dedup.exact_first(d, "text", "doc_id"))


@query("dedup_across_tables", "SELECT DISTINCT p.pair_id FROM preference_pairs p WHERE p.prompt IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sft_conversations s WHERE s.prompt = p.prompt)")
def dedup_across_tables(spark, sf):
    p = table(spark, sf, "preference_pairs").where("prompt is not null").select("pair_id", text.fingerprint(F.col("prompt")).alias("fp"))
    s = table(spark, sf, "sft_conversations").select(text.fingerprint(F.col("prompt")).alias("fp"))
    return p.join(s, "fp", "left_anti").select("pair_id").distinct()


_FIRST = "u AS (SELECT min(doc_id) AS id, text FROM documents WHERE text IS NOT NULL GROUP BY text)"
_CHARACTERS = "SELECT id, list_distinct(list_transform(range(1, len(t) - 1), lambda i: substr(t, i, 3))) AS x FROM (SELECT id, replace(lower(text), ' ', '') AS t FROM u)"


def _word_sets(of: str) -> str:
    return f"SELECT id, list_distinct({sql.pieces('lower(text)')}) AS x FROM {of}"


@query("dedup_near_characters", f"WITH RECURSIVE {_FIRST}, {sql.near_lost(_CHARACTERS, 0.8)} SELECT id AS doc_id FROM u WHERE len(replace(text, ' ', '')) >= 3 AND id NOT IN (SELECT id FROM lost)")
def dedup_near_characters(spark, sf):
    return dedup.near_first(documents(spark, sf, "text", heavy=True).where("text is not null"), "text", "doc_id").select("doc_id")


_LONG = f"u AS (SELECT min(doc_id) AS id, text FROM documents WHERE len({sql.pieces('text')}) >= 5 GROUP BY text)"
_SHORT = f"SELECT doc_id FROM documents WHERE text IS NOT NULL AND len({sql.pieces('text')}) < 5"


@query("dedup_near_words", f"WITH RECURSIVE {_LONG}, {sql.near_lost(_word_sets('u'), 0.85)} SELECT id AS doc_id FROM u WHERE id NOT IN (SELECT id FROM lost) UNION ALL {_SHORT}")
def dedup_near_words(spark, sf):
    return dedup.near_first_words(documents(spark, sf, "text", heavy=True).where("text is not null"), "text", "doc_id").select("doc_id")


@query("dedup_lsh_only", f"WITH RECURSIVE {sql.near_lost(_word_sets('(SELECT doc_id AS id, text FROM documents WHERE text IS NOT NULL)'), 0.85)} SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT id FROM lost)")
def dedup_lsh_only(spark, sf):
    return dedup.lsh_first(documents(spark, sf, "text", heavy=True), "text", "doc_id").select("doc_id")


#: Even documents are the first source, odd ones the second.
_RANKED = "(doc_id % 2) * 1000000000000 + doc_id"
_UNION = f"u AS (SELECT min({_RANKED}) AS id, text FROM documents WHERE len({sql.pieces('text')}) >= 5 GROUP BY text)"


@query("dedup_across_sources", f"WITH RECURSIVE {_UNION}, {sql.near_lost(_word_sets('u'), 0.85)} SELECT id % 1000000000000 AS doc_id, id // 1000000000000 AS source_rank FROM u WHERE id NOT IN (SELECT id FROM lost) UNION ALL SELECT doc_id, doc_id % 2 FROM ({_SHORT})")
def dedup_across_sources(spark, sf):
    """Two sources in turn through one deduplication: what the first admits shuts out near-copies of the second; texts of under five words all stay."""
    d = documents(spark, sf, "text", heavy=True).where("text is not null")
    memory = dedup.Admission("words")
    first, second = (memory.admit(d.where(F.col("doc_id") % 2 == rank), "text", "doc_id").select("doc_id", F.lit(rank).cast("bigint").alias("source_rank")) for rank in (0, 1))
    return first.unionAll(second)


# Budgets and samples


@query("budget_stop", f"WITH {_EST}, b AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e) SELECT doc_id, source, tokens FROM b WHERE before < 5000")
def budget_stop(spark, sf):
    return budget.within_budget(_estimated(spark, sf), ["source"], "doc_id", "tokens", F.lit(5000))


@query("budget_weighted", "SELECT mix_name, source, floor(1000000.0::DOUBLE * weight / sum(weight) OVER (PARTITION BY mix_name))::BIGINT AS budget FROM mix_plan")
def budget_weighted(spark, sf):
    return budget.weighted_budgets(table(spark, sf, "mix_plan"), ["mix_name"], "weight", F.lit(1_000_000.0)).select("mix_name", "source", "budget")


_STATS = "avg(tokens) AS avg_tokens, stddev_pop(tokens) AS std_tokens, median(tokens)::DOUBLE AS p50_tokens, quantile_cont(tokens, 0.9)::DOUBLE AS p90_tokens, count(tokens) AS n_samples"


@query("tokens_per_sample", f"WITH {_EST} SELECT source, {_STATS} FROM e GROUP BY source")
def tokens_per_sample(spark, sf):
    return budget.token_estimates(_estimated(spark, sf), ["source"], "tokens")


@query("budget_sampling_plan", f"""WITH {_EST}, s AS (SELECT source, {_STATS} FROM e GROUP BY source),
    w AS (SELECT mix_name, lower(trim(source)) AS source, floor(500000.0::DOUBLE * weight / sum(weight) OVER (PARTITION BY mix_name))::BIGINT AS budget FROM mix_plan)
    SELECT mix_name, source, budget, ceil(budget / (avg_tokens + std_tokens * 0.5::DOUBLE) * (1.0::DOUBLE + 0.1::DOUBLE))::BIGINT AS planned FROM w JOIN s USING (source)""")
def budget_sampling_plan(spark, sf):
    w = budget.weighted_budgets(table(spark, sf, "mix_plan"), ["mix_name"], "weight", F.lit(500_000.0)).select("mix_name", F.expr(_SOURCE).alias("source"), "budget")
    s = budget.token_estimates(_estimated(spark, sf), ["source"], "tokens")
    return w.join(s, "source").select("mix_name", "source", "budget", budget.samples_needed(F.col("budget"), F.col("avg_tokens"), F.col("std_tokens")).alias("planned"))


_CONVERSATIONS = "s AS (SELECT conv_id, max(source_dataset) AS ds, max(token_count) AS n FROM sft_conversations WHERE token_count > 0 AND source_dataset IS NOT NULL GROUP BY conv_id)"
_DATASETS = f"{_CONVERSATIONS}, g AS (SELECT ds, count(*) AS n, avg(n) AS avg_tokens, stddev_pop(n) AS std_tokens, (1 + ascii(ds) % 3)::DOUBLE AS weight FROM s GROUP BY ds)"
_PLANNED = {
    "target_tokens": "ceil(floor(200000.0::DOUBLE * weight / sum(weight) OVER ()) / (avg_tokens + std_tokens * 0.5::DOUBLE) * (1.0::DOUBLE + 0.02::DOUBLE))::BIGINT",
    "target_conversations": "floor(1000.0::DOUBLE * weight / sum(weight) OVER ())::BIGINT",
    "max_samples": "CASE WHEN n > 8 THEN 8 ELSE floor(n * weight / 4) END::BIGINT",
}


def _datasets(spark, sf):
    s = table(spark, sf, "sft_conversations").where("token_count > 0 and source_dataset is not null").groupBy("conv_id").agg(F.max("source_dataset").alias("ds"), F.max("token_count").alias("n"))
    g = s.groupBy("ds").agg(F.count("*").alias("n"), F.avg("n").alias("avg_tokens"), F.stddev_pop("n").alias("std_tokens"))
    return s, g.withColumn("weight", (1 + F.ascii("ds") % 3).cast("double"))


def _sampling(spark, sf, mode):
    s, g = _datasets(spark, sf)
    if mode == "max_samples":
        g = g.withColumn("weight", F.col("weight") / 4).withColumn("max_samples", F.lit(8))
    return s, budget.sampling_plan(g, [], mode, {"target_tokens": 200_000, "target_conversations": 1000}.get(mode))


for _mode in budget.SAMPLING_MODES:
    query(f"sampling_plan_{_mode}", f"WITH {_DATASETS} SELECT ds, {_PLANNED[_mode]} AS planned FROM g")(lambda spark, sf, _mode=_mode: _sampling(spark, sf, _mode)[1].select("ds", "planned"))
    query(f"sampling_applied_{_mode}", f"WITH {_DATASETS}, p AS (SELECT ds, {_PLANNED[_mode]} AS planned FROM g) SELECT conv_id, ds FROM s JOIN p USING (ds) QUALIFY row_number() OVER (PARTITION BY ds ORDER BY ('0x' || substr(sha256('42|' || conv_id), 1, 13))::BIGINT) <= planned")(
        lambda spark, sf, _mode=_mode: budget.planned_sample(*_sampling(spark, sf, _mode), "ds", ["conv_id"]).select("conv_id", "ds")
    )


_COUNTS = f"c AS (SELECT {_SOURCE} AS source, count(*) AS n, row_number() OVER (ORDER BY {_SOURCE}) AS i, count(*) OVER () AS shards FROM documents WHERE source IS NOT NULL GROUP BY 1)"


@query("sample_adaptive_quotas", f"""WITH RECURSIVE {_COUNTS}, q AS (SELECT source, n, i, shards, least(n, 300 // shards) AS quota, 300 - least(n, 300 // shards) AS wanted FROM c WHERE i = 1
      UNION ALL SELECT c.source, c.n, c.i, c.shards, least(c.n, q.wanted // (c.shards - c.i + 1)), q.wanted - least(c.n, q.wanted // (c.shards - c.i + 1)) FROM q JOIN c ON c.i = q.i + 1)
    SELECT source, n, quota FROM q""")
def sample_adaptive_quotas(spark, sf):
    """300 documents from all sources, each as a shard that gives an even part of what is still wanted."""
    c = documents(spark, sf).where("source is not null").groupBy("source").agg(F.count("*").alias("n"))
    return budget.adaptive_quotas(c, "source", "n", 300)


_UNIT = "('0x' || substr(sha256('42|' || {0}), 1, 13))::BIGINT"


@query("budget_seeded_sample", f"WITH {_EST} SELECT doc_id, source FROM e QUALIFY row_number() OVER (PARTITION BY source ORDER BY {_UNIT.format('doc_id')}) <= 20")
def budget_seeded_sample(spark, sf):
    return budget.seeded_sample(_estimated(spark, sf), ["source"], ["doc_id"], F.lit(20)).select("doc_id", "source")


@query("budget_shortfall", f"""WITH {_EST}, a AS (SELECT source, sum(tokens)::BIGINT AS available FROM e GROUP BY source),
    w AS (SELECT mix_name, lower(trim(source)) AS source, floor(500000.0::DOUBLE * weight / sum(weight) OVER (PARTITION BY mix_name))::BIGINT AS budget FROM mix_plan)
    SELECT mix_name, source, budget, least(coalesce(available, 0), budget) AS reached, least(coalesce(available, 0), budget) * 100.0::DOUBLE / nullif(budget, 0) AS achieved,
      CASE WHEN least(coalesce(available, 0), budget) < 0.5 * budget THEN 'too small' WHEN least(coalesce(available, 0), budget) < 0.8 * budget THEN 'short' WHEN least(coalesce(available, 0), budget) < 0.95 * budget THEN 'slightly short' ELSE 'met' END AS status
    FROM w LEFT JOIN a USING (source)""")
def budget_shortfall(spark, sf):
    w = budget.weighted_budgets(table(spark, sf, "mix_plan"), ["mix_name"], "weight", F.lit(500_000.0)).select("mix_name", F.expr(_SOURCE).alias("source"), "budget")
    a = _estimated(spark, sf).groupBy("source").agg(F.sum("tokens").alias("available"))
    r = F.least(F.coalesce("available", F.lit(0)), F.col("budget"))
    status = F.when(r < 0.5 * F.col("budget"), "too small").when(r < 0.8 * F.col("budget"), "short").when(r < 0.95 * F.col("budget"), "slightly short").otherwise("met")
    return w.join(a, "source", "left").select("mix_name", "source", "budget", r.alias("reached"), (r * 100.0 / F.nullif(F.col("budget"), F.lit(0))).alias("achieved"), status.alias("status"))


@query("budget_greedy", f"""WITH {_EST}, g AS (SELECT *, sum(tokens) OVER (PARTITION BY source) AS total, row_number() OVER w AS rn, sum(tokens) OVER (PARTITION BY source ORDER BY tokens, doc_id ROWS UNBOUNDED PRECEDING) AS cum FROM e WINDOW w AS (PARTITION BY source ORDER BY tokens, doc_id))
    SELECT doc_id, source, tokens FROM g WHERE total <= 4000 OR (cum <= 4000 AND cum - tokens < 0.98::DOUBLE * 4000) OR (rn = 1 AND tokens > 4000)""")
def budget_greedy(spark, sf):
    return budget.smallest_within(_estimated(spark, sf), ["source"], "doc_id", "tokens", F.lit(4000)).select("doc_id", "source", "tokens")


@query("sample_systematic", f"WITH {_EST} SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rn FROM e) WHERE rn % 7 = 0 AND rn < 70")
def sample_systematic(spark, sf):
    return order.systematic_sample(_estimated(spark, sf), ["source"], "doc_id", 7, 10).select("doc_id", "source")


_DRAWS = """s AS (SELECT lower(trim(source)) AS source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1),
    w AS (SELECT lower(trim(source)) AS source, max(weight) AS weight FROM mix_plan WHERE mix_name = 'anneal' GROUP BY 1),
    p AS (SELECT source, n, sum(weight) OVER (ORDER BY source) / sum(weight) OVER () AS upper FROM w JOIN s USING (source)),
    r AS (SELECT range AS step, ('0x' || substr(sha256('42|' || range), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u, ('0x' || substr(sha256('43|' || range), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS v FROM range(2000)),
    d AS (SELECT step, arg_min(source, upper) AS source, floor(v * arg_min(n, upper))::BIGINT AS index FROM r JOIN p ON upper > u GROUP BY step, v)"""


def _draws(spark, sf, n=2000):
    s = documents(spark, sf).where("source is not null").groupBy("source").agg(F.count("*").alias("n"))
    w = table(spark, sf, "mix_plan").where("mix_name = 'anneal'").groupBy(F.expr(_SOURCE).alias("source")).agg(F.max("weight").alias("weight"))
    return budget.weighted_draws(spark, w.join(s, "source"), "source", "weight", "n", n)


@query("sample_weighted_draws", f"WITH {_DRAWS} SELECT step, source, index FROM d")
def sample_weighted_draws(spark, sf):
    return _draws(spark, sf)


@query("sample_observed_mix", f"WITH {_DRAWS} SELECT source, count(*) AS draws, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM d GROUP BY source")
def sample_observed_mix(spark, sf):
    return budget.observed_mix(_draws(spark, sf), "source")


@query("sample_interleave", f"""WITH {_DRAWS}, t AS (SELECT step, source, row_number() OVER (PARTITION BY source ORDER BY step) - 1 AS turn FROM d),
    a AS (SELECT doc_id, lower(trim(source)) AS source, row_number() OVER (PARTITION BY lower(trim(source)) ORDER BY doc_id) - 1 AS at FROM documents WHERE source IS NOT NULL)
    SELECT t.step, a.source, a.doc_id FROM t JOIN s USING (source) JOIN a ON a.source = t.source AND a.at = t.turn % s.n""")
def sample_interleave(spark, sf):
    return budget.interleave(documents(spark, sf).where("source is not null"), checkpointed(_draws(spark, sf)), "source", "doc_id").select("step", "source", "doc_id")


@query("sample_weighted_mix", """WITH p AS (SELECT DISTINCT * FROM preference_pairs WHERE source_dataset IS NOT NULL), o AS (SELECT pair_id, min(source_dataset) AS ds FROM p GROUP BY pair_id),
    n AS (SELECT ds, count(*) AS n FROM o GROUP BY ds), q AS (SELECT ds, least(floor(n * 0.4::DOUBLE * 1.5::DOUBLE), n) AS quota FROM n)
    SELECT o.pair_id, o.ds, sha256('42|' || o.pair_id) AS mix_rank FROM o JOIN q USING (ds) QUALIFY row_number() OVER (PARTITION BY o.ds ORDER BY ('0x' || substr(sha256('42|' || o.pair_id), 1, 13))::BIGINT) <= quota""")
def sample_weighted_mix(spark, sf):
    o = table(spark, sf, "preference_pairs").where("source_dataset is not null").groupBy("pair_id").agg(F.min("source_dataset").alias("ds"))
    plan = o.select("ds").distinct().withColumn("w", F.lit(0.4))
    return budget.weighted_mix(o, plan, "ds", "w", ["pair_id"], 1.5).select("pair_id", "ds", "mix_rank")


@query("rows_concatenated", "SELECT prompt, chosen AS answer FROM preference_pairs UNION ALL SELECT prompt, response FROM sft_conversations")
def rows_concatenated(spark, sf):
    return table(spark, sf, "preference_pairs").select("prompt", F.col("chosen").alias("answer")).unionByName(table(spark, sf, "sft_conversations").select("prompt", F.col("response").alias("answer")))


@query("order_shuffle", "SELECT doc_id, row_number() OVER (ORDER BY ('0x' || substr(sha256('42|' || doc_id), 1, 13))::BIGINT) - 1 AS position FROM documents")
def order_shuffle(spark, sf):
    return order.position(documents(spark, sf, order.shuffle_number(42, "doc_id").alias("u")), [], "u").select("doc_id", "position")


@query("order_ratio_split", """WITH r AS (SELECT run_id, example_id, train_val_split AS ratio, row_number() OVER w - 1 AS place, count(*) OVER (PARTITION BY run_id) AS n
    FROM (SELECT DISTINCT run_id, example_id FROM packed_examples) JOIN pack_runs USING (run_id) WINDOW w AS (PARTITION BY run_id ORDER BY example_id))
    SELECT run_id, example_id, CASE WHEN place < floor(n * ratio) THEN 'train' ELSE 'val' END AS split FROM r""")
def order_ratio_split(spark, sf):
    p = table(spark, sf, "packed_examples").select("run_id", "example_id").distinct().join(table(spark, sf, "pack_runs").select("run_id", "train_val_split"), "run_id")
    return order.ratio_split(p, ["run_id"], "example_id", F.col("train_val_split")).select("run_id", "example_id", "split")


@query("order_top_lengths", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20")
def order_top_lengths(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(20)


@query("order_by_length", "SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS position FROM documents")
def order_by_length(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    key = F.col("n_chars") * F.lit(1 << 32) + F.col("doc_id")
    return order.position(d.withColumn("key", key), [], "key").select("doc_id", "position")


for _mode, _n in (("quick", 1), ("standard", 3), ("thorough", 1_000_000)):
    query(f"eval_mode_{_mode}", f"SELECT dataset, item_id FROM eval_items QUALIFY row_number() OVER (PARTITION BY dataset, lang ORDER BY item_id) <= {_n}")(
        lambda spark, sf, _n=_n: order.head(table(spark, sf, "eval_items").select("dataset", "lang", "item_id"), ["dataset", "lang"], "item_id", _n).select("dataset", "item_id")
    )


# Shards


@query("shard_fixed_count", "SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 300 AS shard, doc_id FROM documents")
def shard_fixed_count(spark, sf):
    return order.shard_numbers(documents(spark, sf), [], "doc_id", 300).select("shard", "doc_id")


@query("shard_statistics", "SELECT (rn - 1) // 300 AS shard, count(*) AS docs, sum(exact_tokens)::BIGINT AS tokens, sum(n_chars)::BIGINT AS chars FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) GROUP BY 1")
def shard_statistics(spark, sf):
    d = order.shard_numbers(documents(spark, sf, "exact_tokens", "n_chars"), [], "doc_id", 300)
    return d.groupBy("shard").agg(F.count("*").alias("docs"), F.sum("exact_tokens").alias("tokens"), F.sum("n_chars").alias("chars"))


@query("shard_by_split", """WITH r AS (SELECT run_id, example_id, row_number() OVER (PARTITION BY run_id ORDER BY example_id) - 1 AS place, count(*) OVER (PARTITION BY run_id) AS n, train_val_split AS ratio FROM (SELECT DISTINCT run_id, example_id FROM packed_examples) JOIN pack_runs USING (run_id)),
    s AS (SELECT run_id, example_id, CASE WHEN place < floor(n * ratio) THEN 'train' ELSE 'val' END AS split FROM r)
    SELECT run_id, split, (row_number() OVER (PARTITION BY run_id, split ORDER BY example_id) - 1) // 8 AS shard, example_id FROM s""")
def shard_by_split(spark, sf):
    p = table(spark, sf, "packed_examples").select("run_id", "example_id").distinct().join(table(spark, sf, "pack_runs").select("run_id", "train_val_split"), "run_id")
    s = order.ratio_split(p, ["run_id"], "example_id", F.col("train_val_split"))
    return order.shard_numbers(s, ["run_id", "split"], "example_id", 8).select("run_id", "split", "shard", "example_id")


@query("shard_subset", """WITH s AS (SELECT (rn - 1) // 100 AS shard, sum(exact_tokens)::BIGINT AS tokens, count(*) AS docs FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) GROUP BY 1),
    t AS (SELECT sum(tokens)::DOUBLE AS total, count(*) AS n FROM s), k AS (SELECT least(n, greatest(1, floor(least(20000, total) / (total / n)) + 1)) AS needed FROM t)
    SELECT shard, docs, tokens FROM (SELECT *, row_number() OVER (ORDER BY shard) AS r FROM s), k WHERE r <= needed""")
def shard_subset(spark, sf):
    """The first shards that hold a target of tokens, by the mean tokens a shard."""
    d = order.shard_numbers(documents(spark, sf, "exact_tokens"), [], "doc_id", 100)
    s = d.groupBy("shard").agg(F.sum("exact_tokens").alias("tokens"), F.count("*").alias("docs"))
    t = s.agg(F.sum("tokens").cast("double").alias("total"), F.count("*").alias("n"))
    needed = F.least(F.col("n"), F.greatest(F.lit(1), F.floor(F.least(F.lit(20000.0), F.col("total")) / (F.col("total") / F.col("n"))) + 1))
    return order.position(s, [], "shard").crossJoin(F.broadcast(t.select(needed.alias("needed")))).where("position < needed").select("shard", "docs", "tokens")


@query("shard_workers", "SELECT shard % 4 AS worker, count(*) AS shards FROM (SELECT DISTINCT (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS shard FROM documents) GROUP BY 1")
def shard_workers(spark, sf):
    s = order.shard_numbers(documents(spark, sf), [], "doc_id", 100).select("shard").distinct()
    return s.groupBy((F.col("shard") % 4).alias("worker")).agg(F.count("*").alias("shards"))


# Corpus statistics

_TOK = "CASE WHEN exact_tokens > 0 THEN exact_tokens END"


@query("stats_corpus", f"SELECT count(*) AS docs, sum(n_chars)::BIGINT AS chars, sum(exact_tokens)::BIGINT AS tokens, avg(n_chars) AS avg_chars, avg(exact_tokens) AS avg_tokens, min({_TOK}) AS min_tokens, max({_TOK}) AS max_tokens, count(DISTINCT {_SOURCE}) AS sources FROM documents")
def stats_corpus(spark, sf):
    some = F.when(F.col("exact_tokens") > 0, F.col("exact_tokens"))
    return documents(spark, sf, "n_chars", "exact_tokens").agg(
        F.count("*").alias("docs"), F.sum("n_chars").alias("chars"), F.sum("exact_tokens").alias("tokens"), F.avg("n_chars").alias("avg_chars"), F.avg("exact_tokens").alias("avg_tokens"),
        F.min(some).alias("min_tokens"), F.max(some).alias("max_tokens"), F.count_distinct("source").alias("sources"),
    )


@query("stats_by_source", f"SELECT {_SOURCE} AS source, count(*) AS docs, sum(exact_tokens)::BIGINT AS tokens, sum(n_chars)::BIGINT AS chars, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM documents GROUP BY 1")
def stats_by_source(spark, sf):
    g = documents(spark, sf, "n_chars", "exact_tokens").groupBy("source").agg(F.count("*").alias("docs"), F.sum("exact_tokens").alias("tokens"), F.sum("n_chars").alias("chars"))
    return g.withColumn("share", F.col("docs") / F.sum("docs").over(Window.partitionBy()))


@query("stats_lengths", f"SELECT {_SOURCE} AS source, count(n_chars) AS n, sum(n_chars)::BIGINT AS total, avg(n_chars) AS mean, min(n_chars) AS least, max(n_chars) AS most, median(n_chars) AS middle, stddev_pop(n_chars) AS deviation FROM documents GROUP BY 1")
def stats_lengths(spark, sf):
    c = "n_chars"
    return documents(spark, sf, c).groupBy("source").agg(F.count(c).alias("n"), F.sum(c).alias("total"), F.avg(c).alias("mean"), F.min(c).alias("least"), F.max(c).alias("most"), F.median(c).alias("middle"), F.stddev_pop(c).alias("deviation"))


@query("stats_length_histogram", "SELECT n_chars // 256 AS bucket, count(*) AS docs FROM documents GROUP BY 1")
def stats_length_histogram(spark, sf):
    return table(spark, sf, "documents").groupBy(F.expr("n_chars div 256").alias("bucket")).agg(F.count("*").alias("docs"))


@query("stats_original_keys", "SELECT k AS original_key, count(*) AS docs FROM (SELECT unnest(string_split(original_keys, ',')) AS k FROM documents) GROUP BY 1")
def stats_original_keys(spark, sf):
    return table(spark, sf, "documents").select(F.explode(F.split("original_keys", ",")).alias("original_key")).groupBy("original_key").agg(F.count("*").alias("docs"))


@query(
    "stats_shard_sentences",
    rf"""WITH d AS (SELECT doc_id, text, (row_number() OVER (ORDER BY doc_id) - 1) // 200 AS shard FROM documents),
    p AS (SELECT shard, doc_id, unnest(string_split_regex(regexp_replace(text, '([.!?]){sql.BL}+([A-Z"''(\[])', '\1' || chr(1) || '\2', 'g'), '[\x01\n]')) AS raw FROM d),
    s AS (SELECT shard, doc_id, {sql.strip('raw')} AS s FROM p), k AS (SELECT shard, count(*) AS n, sum(len(s))::BIGINT AS c, count(DISTINCT doc_id) AS nd FROM s WHERE len(s) BETWEEN 5 AND 2048 GROUP BY shard)
    SELECT d.shard, d.docs, coalesce(n, 0) AS sentences, coalesce(c + n - nd, 0)::BIGINT AS chars, round(coalesce(n, 0)::DOUBLE / d.docs, 1) AS sentences_per_doc FROM (SELECT shard, count(*) AS docs FROM d GROUP BY 1) d LEFT JOIN k USING (shard)""",
)
def stats_shard_sentences(spark, sf):
    d = order.shard_numbers(documents(spark, sf, F.size(s := text.sentences(F.col("text"))).alias("n"), F.length(F.array_join(s, "\n")).alias("c")), [], "doc_id", 200)
    some = lambda c: F.coalesce(F.sum(F.when(F.col("n") > 0, F.col(c))), F.lit(0)).cast("bigint")
    g = d.groupBy("shard").agg(F.count("*").alias("docs"), some("n").alias("sentences"), some("c").alias("chars"))
    return g.withColumn("sentences_per_doc", F.round(F.col("sentences").cast("double") / F.col("docs"), 1))


_PROFILE = rf"""SELECT {_SOURCE} AS source, sum(len(text))::DOUBLE AS chars, sum(len({sql.pieces('text')}))::DOUBLE AS words, sum(len(regexp_extract_all(text, '[.,!?;:]')))::DOUBLE AS punctuation,
    sum(len(regexp_extract_all(text, '\p{{Nd}}')))::DOUBLE AS digits, sum(len(regexp_extract_all(text, '{sql.BL}')))::DOUBLE AS blanks, sum(len(regexp_extract_all(text, '\n')))::DOUBLE AS breaks FROM documents WHERE text IS NOT NULL AND source IS NOT NULL GROUP BY 1"""
_DENSE = "(chars - blanks) / greatest(1.0, words) AS avg_word_length, punctuation / nullif(chars, 0) AS punctuation_density, digits / nullif(chars, 0) AS digit_density, blanks / nullif(chars, 0) AS whitespace_ratio, breaks / nullif(chars, 0) AS line_break_density"


def _profiles(spark, sf):
    sums = documents(spark, sf, "text").where("text is not null and source is not null").groupBy("source").agg(*[c.alias(n) for n, c in estimate.content_sums(F.col("text")).items()])
    p = estimate.content_profile(*[F.col(c) for c in ("chars", "words", "punctuation", "digits", "blanks", "breaks")])
    return sums.select("source", *[c.alias(n) for n, c in p.items()])


@query("stats_content_profile", f"SELECT source, {_DENSE} FROM ({_PROFILE})")
def stats_content_profile(spark, sf):
    return _profiles(spark, sf)


@query("tokens_calibrated", f"""SELECT source, greatest(2.0, least(8.0, 4.0 + CASE WHEN avg_word_length > 6 THEN 0.3 ELSE 0 END + CASE WHEN avg_word_length < 4 THEN -0.2 ELSE 0 END + CASE WHEN punctuation_density > 0.1 THEN -0.1 ELSE 0 END
    + CASE WHEN punctuation_density < 0.03 THEN 0.1 ELSE 0 END + CASE WHEN digit_density > 0.05 THEN 0.1 ELSE 0 END + CASE WHEN whitespace_ratio > 0.25 THEN -0.1 ELSE 0 END + CASE WHEN line_break_density > 0.05 THEN -0.1 ELSE 0 END))::DOUBLE AS chars_per_token FROM (SELECT source, {_DENSE} FROM ({_PROFILE}))""")
def tokens_calibrated(spark, sf):
    p = _profiles(spark, sf)
    return p.select("source", F.round(estimate.calibrated_chars_per_token({c: F.col(c) for c in p.columns[1:]}), 6).alias("chars_per_token"))


@query("tokens_tokenizer_calibration", f"SELECT {_SOURCE} AS source, median(n_chars::DOUBLE / exact_tokens) AS median_ratio, sum(n_chars)::DOUBLE / sum(exact_tokens) AS ratio_of_sums FROM documents WHERE exact_tokens > 0 GROUP BY 1")
def tokens_tokenizer_calibration(spark, sf):
    d = documents(spark, sf, "n_chars", "exact_tokens").where("exact_tokens > 0")
    return d.groupBy("source").agg(F.median(F.col("n_chars") / F.col("exact_tokens")).alias("median_ratio"), (F.sum("n_chars") / F.sum("exact_tokens")).alias("ratio_of_sums"))


@query("tokens_content_table", "SELECT mix_name, source, (CASE split WHEN 'code' THEN 3.2 WHEN 'news' THEN 3.9 ELSE 4.0 END)::DOUBLE AS chars_per_token FROM mix_plan")
def tokens_content_table(spark, sf):
    return table(spark, sf, "mix_plan").select("mix_name", "source", estimate.content_estimate(F.col("split")).alias("chars_per_token"))


@query("stats_cross_validation", f"""WITH {_EST}, j AS (SELECT e.source, sum(e.tokens) AS estimated, sum(d.exact_tokens) AS exact FROM e JOIN documents d USING (doc_id) WHERE d.exact_tokens > 0 GROUP BY 1)
    SELECT source, estimated * 100.0::DOUBLE / exact AS accuracy, CASE WHEN abs(estimated * 100.0::DOUBLE / exact - 100) < 5 THEN 'excellent' WHEN abs(estimated * 100.0::DOUBLE / exact - 100) < 10 THEN 'good' ELSE 'poor' END AS agreement FROM j""")
def stats_cross_validation(spark, sf):
    d = documents(spark, sf, "exact_tokens", estimate.char_estimate(F.col("text")).alias("tokens")).where("source is not null and exact_tokens > 0")
    g = d.groupBy("source").agg((F.sum("tokens") * 100.0 / F.sum("exact_tokens")).alias("accuracy"))
    off = F.abs(F.col("accuracy") - 100)
    return g.withColumn("agreement", F.when(off < 5, "excellent").when(off < 10, "good").otherwise("poor"))


@query("stats_consistency", rf"""WITH d AS (SELECT {_SOURCE} AS source, exact_tokens, {_CHARS} AS tokens, len(text) AS chars, string_split_regex(regexp_replace(text, '([.!?]){sql.BL}+([A-Z"''(\[])', '\1' || chr(1) || '\2', 'g'), '[\x01\n]') AS p FROM documents WHERE source IS NOT NULL AND text IS NOT NULL),
    s AS (SELECT *, len(list_filter(list_transform(p, lambda x: {sql.strip('x')}), lambda x: len(x) BETWEEN 5 AND 2048)) AS n FROM d),
    g AS (SELECT source, count(*) AS docs, sum(tokens)::DOUBLE AS estimated, sum(exact_tokens)::DOUBLE AS exact, sum(n)::DOUBLE AS sentences, sum(chars)::DOUBLE AS chars FROM s GROUP BY 1)
    SELECT source, coalesce(abs(exact - estimated) / nullif(estimated, 0) > 0.5, false) AS discrepancy, sentences > 0 AND (sentences / docs < 1 OR sentences / docs > 1000) AS unusual,
      coalesce(abs(chars / nullif(estimated, 0) - chars / nullif(exact, 0)) / nullif(chars / nullif(exact, 0), 0) > 0.3, false) AS inconsistent FROM g""")
def stats_consistency(spark, sf):
    """Sources whose recorded tokens differ from the estimate by half, with unusually many or few sentences a document, or whose characters a token differ by 30 %."""
    d = documents(spark, sf, "text", "exact_tokens", estimate.char_estimate(F.col("text")).alias("tokens"), F.size(text.sentences(F.col("text"))).alias("n"), heavy=True).where("source is not null and text is not null")
    g = d.groupBy("source").agg(F.count("*").alias("docs"), *[F.sum(c).cast("double").alias(n) for c, n in (("tokens", "estimated"), ("exact_tokens", "exact"), ("n", "sentences"), (F.length("text"), "chars"))])
    return g.select("source", *[c.alias(n) for n, c in evaluate.consistency(*[F.col(x) for x in ("docs", "sentences", "chars", "estimated", "exact")]).items()])


@query("stats_anomalous_shards", rf"""WITH d AS (SELECT doc_id % 50 AS shard, string_split_regex(regexp_replace(text, '([.!?]){sql.BL}+([A-Z"''(\[])', '\1' || chr(1) || '\2', 'g'), '[\x01\n]') AS p FROM documents WHERE text IS NOT NULL),
    s AS (SELECT shard, len(list_filter(list_transform(p, lambda x: {sql.strip('x')}), lambda x: len(x) BETWEEN 5 AND 2048)) AS n FROM d)
    SELECT shard, count(*) AS docs, sum(n)::BIGINT AS sentences FROM s GROUP BY 1 HAVING sum(n)::DOUBLE / count(*) > 12""")
def stats_anomalous_shards(spark, sf):
    """Shards with more sentences a document than is usual (here 12)."""
    d = table(spark, sf, "documents", heavy=True).where("text is not null").select((F.col("doc_id") % 50).alias("shard"), F.size(text.sentences(F.col("text"))).alias("n"))
    g = d.groupBy("shard").agg(F.count("*").alias("docs"), F.sum("n").alias("sentences"))
    return g.where(F.col("sentences") / F.col("docs") > 12)


@query("stats_vocabulary_composition", f"""WITH v AS (SELECT DISTINCT unnest({sql.pieces('text')}) AS w FROM documents WHERE text IS NOT NULL), t AS (SELECT '▁' || w AS t, false AS s FROM v UNION ALL SELECT * FROM (VALUES ('<s>', true), ('ing', false)))
    SELECT count(*) AS entries, count(CASE WHEN s THEN 1 END) AS special, count(CASE WHEN NOT s AND t[1] = '▁' THEN 1 END) AS word_starts, count(CASE WHEN NOT s AND t[1] <> '▁' THEN 1 END) AS regular,
      avg(len(t)) AS mean_length, median(len(t)) AS median_length, min(len(t))::INT AS min_length, max(len(t))::INT AS max_length, stddev_samp(len(t)) AS length_deviation FROM t""")
def stats_vocabulary_composition(spark, sf):
    """The composition of a vocabulary made of the corpus's pieces between white space."""
    v = table(spark, sf, "documents").where("text is not null").select(F.explode(F.filter(F.split("text", text.BLANKS), lambda w: w != "")).alias("w")).distinct().select(F.concat(F.lit("▁"), "w").alias("t"), F.lit(False).alias("s"))
    return tokenize.vocabulary_composition(v.unionAll(spark.createDataFrame([("<s>", True), ("ing", False)], "t string, s boolean")), "t", F.col("s"))


@query("stats_characters", "WITH c AS (SELECT unnest(regexp_extract_all(text, '(?s).')) AS c FROM documents WHERE text IS NOT NULL) SELECT count(DISTINCT c) AS unique_characters, count(*) AS characters FROM c")
def stats_characters(spark, sf):
    """Characters are counted one row a character and text first, so that what is exchanged are the different ones."""
    c = documents(spark, sf, F.explode(F.regexp_extract_all("text", F.lit("(?s)(.)"), F.lit(1))).alias("c"), heavy=True).groupBy("c").agg(F.count("*").alias("n"))
    return c.agg(F.count("*").alias("unique_characters"), F.sum("n").alias("characters"))


@query("stats_planning_report", f"""WITH {_EST}, s AS (SELECT source, avg(tokens) AS mean, sum(tokens)::BIGINT AS tokens FROM e GROUP BY source)
    SELECT source, tokens, tokens * 100.0::DOUBLE / sum(tokens) OVER () AS percent, CASE WHEN mean < 1000 THEN 'short' WHEN mean < 10000 THEN 'medium' ELSE 'long' END AS size_class,
      tokens = max(tokens) OVER () AS largest, tokens = min(tokens) OVER () AS smallest FROM s""")
def stats_planning_report(spark, sf):
    s = _estimated(spark, sf).groupBy("source").agg(F.avg("tokens").alias("mean"), F.sum("tokens").alias("tokens"))
    w = Window.partitionBy()
    size = F.when(F.col("mean") < 1000, "short").when(F.col("mean") < 10000, "medium").otherwise("long")
    return s.select("source", "tokens", (F.col("tokens") * 100.0 / F.sum("tokens").over(w)).alias("percent"), size.alias("size_class"), (F.col("tokens") == F.max("tokens").over(w)).alias("largest"), (F.col("tokens") == F.min("tokens").over(w)).alias("smallest"))


@query("stats_cache", f"SELECT {_SOURCE} AS source, count(*) AS docs, sum(coalesce(exact_tokens, n_chars // 4))::BIGINT AS tokens, sum(strlen(text))::BIGINT AS bytes, epoch_us(max(ingested_at)) AS latest FROM documents WHERE source IS NOT NULL GROUP BY 1")
def stats_cache(spark, sf):
    """What the metadata of a cached source hold: documents, tokens (filled in where missing), bytes and the latest row."""
    d = documents(spark, sf, "text", F.coalesce("exact_tokens", F.expr("n_chars div 4")).alias("tokens"), "ingested_at").where("source is not null")
    return d.groupBy("source").agg(F.count("*").alias("docs"), F.sum("tokens").cast("bigint").alias("tokens"), F.sum(F.octet_length("text")).cast("bigint").alias("bytes"), F.unix_micros(F.max("ingested_at")).alias("latest"))


@query("stats_vocabulary", r"WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS w FROM documents) SELECT w AS word, count(*) AS n FROM w GROUP BY 1 ORDER BY n DESC, word LIMIT 20")
def stats_vocabulary(spark, sf):
    w = documents(spark, sf, F.explode(words(F.col("text"))).alias("word"))
    return w.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(20)
