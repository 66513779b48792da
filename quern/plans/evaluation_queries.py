"""Queries of preference pairs, response quality and evaluation results."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.functions import estimate
from quern.functions.text import blank_words
from quern.operators import budget, evaluate, filters, order
from quern.plans import sql
from quern.plans.registry import query
from quern.session import table


def _preferences(spark, sf, *cols):
    return table(spark, sf, "preference_pairs").select("pair_id", *cols).distinct()


_GOOD = "SELECT DISTINCT pair_id, source_dataset, chosen_reward AS c, rejected_reward AS r FROM preference_pairs WHERE chosen_reward IS NOT NULL AND rejected_reward IS NOT NULL AND NOT isnan(chosen_reward) AND NOT isnan(rejected_reward)"
_REWARD = """count(*) AS n, avg(c - r) AS margin_mean, stddev_pop(c - r) AS margin_std, median(c - r) AS margin_median, min(c - r) AS margin_min, max(c - r) AS margin_max, avg((c - r > 0)::INT) AS win_rate, avg(c) AS chosen_mean, stddev_pop(c) AS chosen_std,
    avg(r) AS rejected_mean, stddev_pop(r) AS rejected_std, avg((c - r > 0.0)::INT) AS accuracy_0, avg((c - r > 0.1)::INT) AS accuracy_01, avg((c - r > 0.5)::INT) AS accuracy_05"""


@query("preference_rewards", f"SELECT {_REWARD} FROM ({_GOOD})")
def preference_rewards(spark, sf):
    return evaluate.reward_statistics(_preferences(spark, sf, "chosen_reward", "rejected_reward"), [], "chosen_reward", "rejected_reward")


@query("preference_rewards_by_source", f"SELECT source_dataset, {_REWARD} FROM ({_GOOD}) GROUP BY 1")
def preference_rewards_by_source(spark, sf):
    return evaluate.reward_statistics(_preferences(spark, sf, "source_dataset", "chosen_reward", "rejected_reward"), ["source_dataset"], "chosen_reward", "rejected_reward")


@query("preference_reward_from_loss", "SELECT avg(r - c) AS margin, avg((r - c > 0)::INT) AS win_rate, avg((r - c > 0.1)::INT) AS accuracy_01 FROM (" + _GOOD + ")")
def preference_reward_from_loss(spark, sf):
    """Rewards that are losses with the sign turned."""
    d = _preferences(spark, sf, (-F.col("chosen_reward")).alias("c"), (-F.col("rejected_reward")).alias("r"))
    s = evaluate.reward_statistics(d, [], "c", "r")
    return s.select(F.col("margin_mean").alias("margin"), "win_rate", "accuracy_01")


@query("preference_perplexity_comparison", f"SELECT avg(c) AS chosen_mean, median(c) AS chosen_median, avg(r) AS rejected_mean, median(r) AS rejected_median, avg(r) - avg(c) AS difference FROM ({_GOOD})")
def preference_perplexity_comparison(spark, sf):
    d = _preferences(spark, sf, F.col("chosen_reward").alias("c"), F.col("rejected_reward").alias("r")).where("c is not null and r is not null and not isnan(c) and not isnan(r)")
    return d.agg(F.avg("c").alias("chosen_mean"), F.median("c").alias("chosen_median"), F.avg("r").alias("rejected_mean"), F.median("r").alias("rejected_median"), (F.avg("r") - F.avg("c")).alias("difference"))


def _t(c):
    return f"(CASE WHEN {c} IS NULL OR len({sql.strip(c)}) = 0 THEN 0 ELSE greatest(1, floor(len({c})::DOUBLE / 4.0::DOUBLE)) END)::BIGINT"


@query("preference_lengths", "SELECT field, avg(n) AS mean, median(n) AS middle, min(n) AS least, max(n) AS most FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS field, {_t(c)} AS n FROM preference_pairs WHERE {c} IS NOT NULL" for c in ("prompt", "chosen", "rejected")) + ") GROUP BY field")
def preference_lengths(spark, sf):
    d = table(spark, sf, "preference_pairs").select(*[F.when(F.col(c).isNotNull(), estimate.char_estimate(F.col(c))).alias(c) for c in ("prompt", "chosen", "rejected")])
    long = d.unpivot([], ["prompt", "chosen", "rejected"], "field", "n").where("n is not null")
    return long.groupBy("field").agg(F.avg("n").alias("mean"), F.median("n").alias("middle"), F.min("n").alias("least"), F.max("n").alias("most"))


@query("preference_validation_summary", f"SELECT count(*) AS rows, count(CASE WHEN ok THEN 1 END) AS valid, avg(ok::INT) AS rate FROM (SELECT coalesce(len({sql.strip('prompt')}) > 0 AND len({sql.strip('chosen')}) > 0 AND len({sql.strip('rejected')}) > 0 AND chosen <> rejected, false) AS ok FROM preference_pairs)")
def preference_validation_summary(spark, sf):
    ok = filters.preference_fault(F.col("prompt"), F.col("chosen"), F.col("rejected")).isNull()
    return table(spark, sf, "preference_pairs").select(ok.alias("ok")).agg(F.count("*").alias("rows"), F.count_if("ok").alias("valid"), F.avg(F.col("ok").cast("int")).alias("rate"))


@query("preference_validation_sample", f"""WITH p AS (SELECT pair_id, min(CASE WHEN prompt IS NULL THEN 'missing_prompt' WHEN chosen IS NULL THEN 'missing_chosen' WHEN rejected IS NULL THEN 'missing_rejected'
      WHEN len({sql.strip('prompt')}) = 0 THEN 'empty_prompt' WHEN len({sql.strip('chosen')}) = 0 THEN 'empty_chosen' WHEN len({sql.strip('rejected')}) = 0 THEN 'empty_rejected' WHEN chosen = rejected THEN 'same' ELSE 'kept' END) AS reason FROM preference_pairs GROUP BY 1),
    s AS (SELECT * FROM p QUALIFY row_number() OVER (ORDER BY ('0x' || substr(sha256('42|' || pair_id), 1, 13))::BIGINT) <= 100)
    SELECT reason, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM s GROUP BY 1""")
def preference_validation_sample(spark, sf):
    """Faults of a seeded sample of 100 pairs."""
    fault = F.coalesce(filters.preference_fault(F.col("prompt"), F.col("chosen"), F.col("rejected")), F.lit("kept"))
    p = table(spark, sf, "preference_pairs").groupBy("pair_id").agg(F.min(fault).alias("reason"))
    g = budget.seeded_sample(p, [], ["pair_id"], F.lit(100)).groupBy("reason").agg(F.count("*").alias("n"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))  # a row a reason


# Responses

_W = sql.pieces("lower(response)")
_QUALITY = rf"""CASE WHEN response IS NULL OR len({sql.strip('response')}) = 0 THEN 0.0::DOUBLE ELSE least(1.0::DOUBLE, greatest(0.0::DOUBLE, 0.5::DOUBLE
    + CASE WHEN len(response) BETWEEN 10 AND 200 THEN 0.1::DOUBLE WHEN len(response) < 5 THEN -0.3::DOUBLE WHEN len(response) > 300 THEN -0.1::DOUBLE ELSE 0 END + CASE WHEN contains(response, '.') THEN 0.1::DOUBLE ELSE 0 END
    + CASE WHEN len({_W}) > 5 THEN CASE WHEN len(list_distinct({_W}))::DOUBLE / len({_W}) > 0.7 THEN 0.2::DOUBLE WHEN len(list_distinct({_W}))::DOUBLE / len({_W}) < 0.5 THEN -0.2::DOUBLE ELSE 0 END ELSE 0 END
    + CASE WHEN regexp_matches(response, '[.!?"'']\z') THEN 0.1::DOUBLE ELSE 0 END)) END"""


def _responses(spark, sf, *cols):
    return table(spark, sf, "sft_conversations", heavy=True).select("conv_id", "source_dataset", *cols).distinct()


@query("response_quality", f"SELECT DISTINCT conv_id, round({_QUALITY}, 6) AS quality FROM sft_conversations")
def response_quality(spark, sf):
    return _responses(spark, sf, F.round(evaluate.response_quality(F.col("response")), 6).alias("quality")).select("conv_id", "quality").distinct()


@query("response_quality_by_category", f"WITH q AS (SELECT DISTINCT conv_id, template, {_QUALITY} AS q FROM sft_conversations) SELECT template, round(avg(q), 6) AS quality, count(*) AS n FROM q GROUP BY ROLLUP(template) HAVING template IS NOT NULL OR grouping(template) = 1")
def response_quality_by_category(spark, sf):
    q = _responses(spark, sf, "template", evaluate.response_quality(F.col("response")).alias("q")).select("conv_id", "template", "q").distinct()
    r = q.rollup("template").agg(F.avg("q").alias("quality"), F.count("*").alias("n"), F.grouping("template").alias("g"))
    return r.where("template is not null or g = 1").select("template", F.round("quality", 6).alias("quality"), "n")


@query("response_diversity", f"WITH w AS (SELECT source_dataset, unnest({_W}) AS w FROM (SELECT DISTINCT conv_id, source_dataset, response FROM sft_conversations)) SELECT source_dataset, count(DISTINCT w)::DOUBLE / count(*) AS diversity FROM w GROUP BY 1")
def response_diversity(spark, sf):
    return evaluate.diversity(_responses(spark, sf, "response"), ["source_dataset"], "response")


@query("response_repetition", f"WITH w AS (SELECT conv_id, {sql.pieces('response')} AS w FROM (SELECT DISTINCT conv_id, response FROM sft_conversations WHERE response IS NOT NULL)) SELECT conv_id, CASE WHEN len(w) < 2 THEN 0.0::DOUBLE ELSE len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1]))::DOUBLE / (len(w) - 1) END AS repetition FROM w")
def response_repetition(spark, sf):
    return _responses(spark, sf, "response").where("response is not null").select("conv_id", evaluate.repetition(F.col("response")).alias("repetition")).distinct()


@query("response_coherence", f"WITH p AS (SELECT conv_id, string_split(response, '.') AS p FROM (SELECT DISTINCT conv_id, response FROM sft_conversations WHERE response IS NOT NULL)) SELECT conv_id, len(list_filter(list_transform(p, lambda x: {sql.strip('x')}), lambda s: len(s) > 5 AND contains(s, ' ')))::DOUBLE / len(p) AS coherence FROM p")
def response_coherence(spark, sf):
    return _responses(spark, sf, "response").where("response is not null").select("conv_id", evaluate.coherence(F.col("response")).alias("coherence")).distinct()


@query("response_bundle", f"WITH d AS (SELECT DISTINCT conv_id, source_dataset, response FROM sft_conversations WHERE response IS NOT NULL), w AS (SELECT source_dataset, response, {sql.pieces('response')} AS w, string_split(response, '.') AS p FROM d) SELECT source_dataset, avg(len(w)) AS mean_words, avg(CASE WHEN len(w) < 2 THEN 0.0::DOUBLE ELSE len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1]))::DOUBLE / (len(w) - 1) END) AS repetition, avg(len(list_filter(list_transform(p, lambda x: {sql.strip('x')}), lambda s: len(s) > 5 AND contains(s, ' ')))::DOUBLE / len(p)) AS coherence FROM w GROUP BY 1")
def response_bundle(spark, sf):
    r = F.col("response")
    d = _responses(spark, sf, "response").where("response is not null")
    return d.groupBy("source_dataset").agg(F.avg(F.size(blank_words(r))).alias("mean_words"), F.avg(evaluate.repetition(r)).alias("repetition"), F.avg(evaluate.coherence(r)).alias("coherence"))


@query("response_smoke", f"WITH d AS (SELECT DISTINCT conv_id, template, response FROM sft_conversations) SELECT template, count(*) AS n, count(CASE WHEN len(response) > 5 AND len(list_distinct({sql.pieces('response')})) > 3 THEN 1 END)::DOUBLE / count(*) AS pass_rate FROM d GROUP BY 1")
def response_smoke(spark, sf):
    d = table(spark, sf, "sft_conversations").select("conv_id", "template", "response").distinct()
    return d.groupBy("template").agg(F.count("*").alias("n"), F.avg(evaluate.is_smoke_valid(F.col("response")).cast("double")).alias("pass_rate"))


# Losses: the rewards stand for mean losses, the lengths of the prompts for tokens

_LOSS = f"l AS (SELECT source_dataset AS ds, abs(chosen_reward) * 30 AS loss, {_t('prompt')} AS n FROM preference_pairs)"


def _losses(spark, sf):
    return table(spark, sf, "preference_pairs").select(F.col("source_dataset").alias("ds"), (F.abs("chosen_reward") * 30).alias("loss"), estimate.char_estimate(F.col("prompt")).alias("n"))


@query("eval_perplexity", f"WITH {_LOSS} SELECT ds, CASE WHEN sum(n) > 0 THEN exp(sum(least(loss, 20.0::DOUBLE) * n) / sum(n)) ELSE 'inf'::DOUBLE END AS perplexity FROM l WHERE loss IS NOT NULL AND NOT isnan(loss) GROUP BY ds")
def eval_perplexity(spark, sf):
    return evaluate.perplexity(_losses(spark, sf), ["ds"], "loss", "n")


@query("eval_perplexity_weighted", f"WITH {_LOSS}, w AS (SELECT ds, (row_number() OVER (ORDER BY ds))::DOUBLE AS w FROM (SELECT DISTINCT ds FROM l WHERE ds IS NOT NULL)), v AS (SELECT ds, w / sum(w) OVER () AS w FROM w) SELECT exp(sum(least(loss, 20.0::DOUBLE) * n * w) / sum(n * w)) AS perplexity FROM l JOIN v USING (ds) WHERE loss IS NOT NULL AND NOT isnan(loss)")
def eval_perplexity_weighted(spark, sf):
    losses = _losses(spark, sf)
    w = losses.where("ds is not null").select("ds").distinct().withColumn("w", F.row_number().over(Window.partitionBy().orderBy("ds")).cast("double"))
    v = w.withColumn("w", F.col("w") / F.sum("w").over(Window.partitionBy()))
    return evaluate.perplexity(losses.join(v, "ds"), [], "loss", "n", F.col("w"))


@query("eval_accuracy", "SELECT dataset, lang, avg((answer = contains(lower(passage), 'the first'))::INT) AS accuracy, count(*) AS n FROM eval_items WHERE answer IS NOT NULL GROUP BY 1, 2")
def eval_accuracy(spark, sf):
    """Accuracy of an answer read off the passage by a substring."""
    e = table(spark, sf, "eval_items").where("answer is not null")
    right = F.col("answer") == F.contains(F.lower("passage"), F.lit("the first"))
    return e.groupBy("dataset", "lang").agg(F.avg(right.cast("int")).alias("accuracy"), F.count("*").alias("n"))


@query("eval_accuracy_argmax", f"SELECT source_dataset, avg(((chosen_reward > rejected_reward) = (len(chosen) >= len(rejected)))::INT) AS accuracy, count(*) AS n FROM preference_pairs WHERE chosen_reward IS NOT NULL AND rejected_reward IS NOT NULL AND NOT isnan(chosen_reward) AND NOT isnan(rejected_reward) AND chosen IS NOT NULL AND rejected IS NOT NULL GROUP BY 1")
def eval_accuracy_argmax(spark, sf):
    """Accuracy of the likelier of two answers; the rewards stand for their log-probabilities, the longer side for the right one."""
    p = table(spark, sf, "preference_pairs").where("chosen_reward is not null and rejected_reward is not null and not isnan(chosen_reward) and not isnan(rejected_reward) and chosen is not null and rejected is not null")
    right = evaluate.likelier(F.col("chosen_reward"), F.col("rejected_reward")) == (F.length("chosen") >= F.length("rejected"))
    return p.groupBy("source_dataset").agg(F.avg(right.cast("int")).alias("accuracy"), F.count("*").alias("n"))


_THRESHOLDS = "t AS (SELECT * FROM (VALUES ('perplexity', '<2', '<50', '<1000000'), ('margin', '>0.3', '>0.1', '>0')) v(metric, good, acceptable, poor))"
_METRICS = f"""{_LOSS}, p AS (SELECT ds, CASE WHEN sum(n) > 0 THEN exp(sum(least(loss, 20.0::DOUBLE) * n) / sum(n)) ELSE 'inf'::DOUBLE END AS v FROM l WHERE loss IS NOT NULL AND NOT isnan(loss) GROUP BY ds),
    m AS (SELECT source_dataset AS ds, avg(c - r) AS v FROM ({_GOOD}) GROUP BY 1), a AS (SELECT ds, 'perplexity' AS metric, v FROM p UNION ALL SELECT ds, 'margin', v FROM m), {_THRESHOLDS},
    x AS (SELECT ds, metric, v, contains(good, '<') AS low, regexp_replace(good, '[<>]', '')::DOUBLE AS g, regexp_replace(acceptable, '[<>]', '')::DOUBLE AS c, regexp_replace(poor, '[<>]', '')::DOUBLE AS b FROM a JOIN t USING (metric)),
    gr AS (SELECT ds, metric, CASE WHEN (low AND v <= g) OR (NOT low AND v >= g) THEN 'excellent' WHEN (low AND v <= c) OR (NOT low AND v >= c) THEN 'good' WHEN (low AND v <= b) OR (NOT low AND v >= b) THEN 'acceptable' ELSE 'poor' END AS grade FROM x)"""


def _grades(spark, sf):
    p = evaluate.perplexity(_losses(spark, sf), ["ds"], "loss", "n").select("ds", F.lit("perplexity").alias("metric"), F.col("perplexity").alias("v"))
    m = evaluate.reward_statistics(_preferences(spark, sf, F.col("source_dataset").alias("ds"), "chosen_reward", "rejected_reward"), ["ds"], "chosen_reward", "rejected_reward").select("ds", F.lit("margin").alias("metric"), F.col("margin_mean").alias("v"))
    t = spark.createDataFrame([("perplexity", "<2", "<50", "<1000000"), ("margin", ">0.3", ">0.1", ">0")], "metric string, good string, acceptable string, poor string")
    return p.unionAll(m).join(F.broadcast(t), "metric").select("ds", "metric", evaluate.graded(F.col("v"), F.col("good"), F.col("acceptable"), F.col("poor")).alias("grade"))


@query("eval_grades", f"WITH {_METRICS} SELECT ds, metric, grade FROM gr")
def eval_grades(spark, sf):
    return _grades(spark, sf)


@query("eval_verdict", f"WITH {_METRICS}, n AS (SELECT ds, count(CASE WHEN grade = 'excellent' THEN 1 END) AS e, count(CASE WHEN grade = 'good' THEN 1 END) AS g, count(CASE WHEN grade = 'poor' THEN 1 END) AS p FROM gr GROUP BY ds) SELECT ds, CASE WHEN e > 0 OR g >= 2 THEN 'excellent' WHEN g > 0 AND p = 0 THEN 'good' WHEN p = 0 THEN 'acceptable' ELSE 'needs work' END AS verdict FROM n")
def eval_verdict(spark, sf):
    n = _grades(spark, sf).groupBy("ds").agg(*[F.count_if(F.col("grade") == g).alias(g) for g in ("excellent", "good", "poor")])
    return n.select("ds", evaluate.verdict(F.col("excellent"), F.col("good"), F.col("poor")).alias("verdict"))


@query("eval_metrics_long", "WITH a AS (SELECT dataset, avg(len(passage)) AS passage_chars, avg(len(question)) AS question_chars, avg(answer::INT) AS yes_share FROM eval_items GROUP BY 1) UNPIVOT a ON passage_chars, question_chars, yes_share INTO NAME metric VALUE value")
def eval_metrics_long(spark, sf):
    """Numeric results as (metric, value) rows, as the CSV sink writes them."""
    a = table(spark, sf, "eval_items").groupBy("dataset").agg(F.avg(F.length("passage")).alias("passage_chars"), F.avg(F.length("question")).alias("question_chars"), F.avg(F.col("answer").cast("int")).alias("yes_share"))
    return a.unpivot(["dataset"], ["passage_chars", "question_chars", "yes_share"], "metric", "value")


#: Configurations made of the packing runs: layers, width and vocabulary by the run's number.
_CONFIG = "g AS (SELECT run_id, (6 + run_id % 30)::BIGINT AS l, (256 * (1 + run_id % 16))::BIGINT AS w, (1024 * (1 + run_id % 16))::BIGINT AS f, 32768::BIGINT AS v, run_id % 2 = 0 AS tied FROM pack_runs)"
_PARAMS = "v * w + l * (w * w * 4 + w * f * 3 + w * 2) + w + CASE WHEN tied THEN 0 ELSE w * v END"


def _configs(spark, sf):
    return table(spark, sf, "pack_runs").selectExpr("run_id", "6 + run_id % 30 as l", "256 * (1 + run_id % 16) as w", "1024 * (1 + run_id % 16) as f", "cast(32768 as bigint) as v", "run_id % 2 = 0 as tied")


@query("model_parameters", f"WITH {_CONFIG}, p AS (SELECT *, ({_PARAMS})::BIGINT AS parameters FROM g) SELECT run_id, parameters, CASE WHEN parameters < 20000000 THEN 'tiny' WHEN parameters < 80000000 THEN 'small' ELSE 'base' END AS size, floor(parameters * 4 / 1048576.0::DOUBLE)::BIGINT AS memory_mb, floor(parameters * 4 / 1048576.0::DOUBLE * 3.5::DOUBLE)::BIGINT AS gpu_memory_mb FROM p")
def model_parameters(spark, sf):
    c = _configs(spark, sf).withColumn("parameters", evaluate.parameters(*[F.col(x) for x in ("l", "w", "f", "v", "tied")]))
    mb = F.col("parameters") * 4 / 1048576.0
    return c.select("run_id", "parameters", evaluate.model_size(F.col("parameters")).alias("size"), F.floor(mb).alias("memory_mb"), F.floor(mb * 3.5).alias("gpu_memory_mb"))


@query("model_training_memory", f"WITH {_CONFIG} SELECT run_id, ((v * w + l * w * w * 4 + l * (w * f * 2 + f + w) + l * w * 2) * 4 / 1e9::DOUBLE * 4 + 8 * 1024 * 4 * w * l / 1e9::DOUBLE) * 1.2::DOUBLE AS gb FROM g")
def model_training_memory(spark, sf):
    return _configs(spark, sf).select("run_id", evaluate.training_memory(*[F.col(x) for x in ("l", "w", "f", "v")]).alias("gb"))


@query("model_nearest", f"WITH {_CONFIG}, n AS (SELECT * FROM (VALUES (0, 'LLaMA-7B', 32 * 4096), (1, 'LLaMA-13B', 40 * 5120), (2, 'GPT-2-small', 12 * 768), (3, 'GPT-2-medium', 24 * 1024)) t(i, name, c)) SELECT run_id, arg_min(name, (greatest(c::DOUBLE / (l * w), (l * w)::DOUBLE / c), i)) AS nearest FROM g, n GROUP BY run_id")
def model_nearest(spark, sf):
    return _configs(spark, sf).select("run_id", evaluate.nearest_model(F.col("l"), F.col("w")).alias("nearest"))


@query("eval_log_likelihood", "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: -abs(x::DOUBLE)) AS lp, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS m FROM embeddings) SELECT vec_id, round(list_sum(list_transform(range(1, len(lp)), lambda i: lp[i] * m[i + 1])), 6) AS log_likelihood, list_sum(m[2:])::INT AS predicted FROM e")
def eval_log_likelihood(spark, sf):
    """The vectors stand for log-probabilities and masks."""
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: -F.abs(x.cast("double"))).alias("lp"), F.transform("embedding", lambda x: (x > 0).cast("int")).alias("m"))
    total, n = evaluate.sequence_log_likelihood(F.col("lp"), F.col("m"))
    return e.select("vec_id", F.round(total, 6).alias("log_likelihood"), n.alias("predicted"))


@query("checkpoint_latest", "SELECT source_dataset, arg_max(conv_id, (written_at, conv_id)) AS latest FROM sft_conversations WHERE response IS NOT NULL GROUP BY 1")
def checkpoint_latest(spark, sf):
    """The last valid entry of a listing, by time."""
    d = table(spark, sf, "sft_conversations").where("response is not null")
    return d.groupBy("source_dataset").agg(F.max_by("conv_id", F.struct("written_at", "conv_id")).alias("latest"))


@query("prompts_by_category", "SELECT dataset || '/' || lang AS category, question AS prompt FROM eval_items QUALIFY row_number() OVER (PARTITION BY dataset, lang ORDER BY item_id) <= 5")
def prompts_by_category(spark, sf):
    return order.head(table(spark, sf, "eval_items"), ["dataset", "lang"], "item_id", 5).select(F.concat("dataset", F.lit("/"), "lang").alias("category"), F.col("question").alias("prompt"))


_ADVICE = "adv AS (SELECT * FROM (VALUES ('margin', ['look at margin', 'look at the data']), ('perplexity', ['look at perplexity', 'look at the data'])) t(metric, advice))"


@query("eval_recommendations", f"WITH {_METRICS}, {_ADVICE}, f AS (SELECT ds, metric, unnest(advice) AS x, generate_subscripts(advice, 1) AS i FROM gr JOIN adv USING (metric) WHERE grade IN ('acceptable', 'poor')), d AS (SELECT ds, x, min((metric, i)) AS k FROM f GROUP BY ds, x) SELECT ds, list(x ORDER BY k)[1:8] AS advice FROM d GROUP BY ds")
def eval_recommendations(spark, sf):
    """The advice is a table of the caller's."""
    advice = spark.createDataFrame([(m, [f"look at {m}", "look at the data"]) for m in ("margin", "perplexity")], "metric string, advice array<string>")
    return evaluate.recommendations(_grades(spark, sf), advice, ["ds"], "metric", "grade")
