"""Queries over token arrays: packing, windows, batches and vocabulary statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.operators import evaluate, order, pack
from quern.plans.registry import query
from quern.session import table

_ROWS = "r AS (SELECT DISTINCT example_id, run_id, seq_no, input_ids FROM packed_examples)"


def _rows(spark, sf, *cols):
    return table(spark, sf, "packed_examples").select("example_id", "run_id", "seq_no", "input_ids", *cols).dropDuplicates(["example_id"])


@query(
    "pack_stream",
    f"""WITH {_ROWS}, t AS (SELECT run_id, seq_no, unnest(input_ids) AS t, generate_subscripts(input_ids, 1) AS i FROM r),
    n AS (SELECT run_id, t, row_number() OVER (PARTITION BY run_id ORDER BY seq_no, i) - 1 AS k FROM t)
    SELECT run_id, k // 300 AS row, list(t ORDER BY k) AS tokens FROM n GROUP BY 1, 2 HAVING count(*) = 300""",
)
def pack_stream(spark, sf):
    """All tokens of a run made one stream and cut into rows of 300."""
    return pack.pack_stream(_rows(spark, sf), ["run_id"], "seq_no", "input_ids", 300)


@query("pack_shifted", "SELECT DISTINCT example_id, input_ids[1:len(input_ids)-1] AS inputs, input_ids[2:len(input_ids)] AS targets FROM packed_examples")
def pack_shifted(spark, sf):
    inputs, targets = pack.shifted(F.col("input_ids"))
    return _rows(spark, sf).select("example_id", inputs.alias("inputs"), targets.alias("targets"))


@query(
    "pack_sliding_windows",
    f"""WITH {_ROWS}, t AS (SELECT run_id, seq_no, unnest(input_ids) AS t, generate_subscripts(input_ids, 1) AS i FROM r),
    n AS (SELECT run_id, t, row_number() OVER (PARTITION BY run_id ORDER BY seq_no, i) - 1 AS k FROM t), z AS (SELECT run_id, count(*) AS n FROM n GROUP BY 1),
    w AS (SELECT run_id, unnest(range(0, (n - 128) // 100 + 1)) AS window FROM z WHERE n >= 128)
    SELECT w.run_id, w.window, list(t ORDER BY k) AS tokens FROM w JOIN n ON n.run_id = w.run_id AND n.k >= w.window * 100 AND n.k < w.window * 100 + 128 GROUP BY 1, 2""",
)
def pack_sliding_windows(spark, sf):
    return pack.sliding_windows(_rows(spark, sf), ["run_id"], "seq_no", "input_ids", 128, 100)


_NEXT_FIT = """WITH RECURSIVE c AS (SELECT conv_id, max(token_count) + 1 AS len FROM sft_conversations WHERE token_count IS NOT NULL GROUP BY 1),
    s AS (SELECT len, conv_id, row_number() OVER (ORDER BY least(len, 513), conv_id) AS i FROM c),
    f AS (SELECT 0::BIGINT AS i, 0::BIGINT AS row, 0::BIGINT AS fill, true AS empty, 0::BIGINT AS conv_id, 0 AS len
      UNION ALL SELECT s.i, CASE WHEN f.empty THEN f.row WHEN s.len <= 512 AND f.fill + s.len <= 512 THEN f.row ELSE f.row + 1 END + CASE WHEN f.empty AND f.fill = -1 THEN 1 ELSE 0 END,
        CASE WHEN s.len > 512 THEN -1 WHEN f.empty OR f.fill + s.len > 512 THEN s.len ELSE f.fill + s.len END, s.len > 512, s.conv_id, s.len FROM f JOIN s ON s.i = f.i + 1)"""


def _next_fit(spark, sf):
    c = table(spark, sf, "sft_conversations").where("token_count is not null").groupBy("conv_id").agg((F.max("token_count") + 1).alias("len"))
    return pack.next_fit(c, "conv_id", "len", 512)


@query("pack_next_fit", f"{_NEXT_FIT} SELECT conv_id, len, row FROM f WHERE i > 0")
def pack_next_fit(spark, sf):
    return _next_fit(spark, sf).select("conv_id", "len", "row")


@query(
    "pack_next_fit_statistics",
    f"""{_NEXT_FIT}, r AS (SELECT row, least(sum(len), 512) AS used, count(*) AS items FROM f WHERE i > 0 GROUP BY row)
    SELECT count(*) AS rows, sum(items)::BIGINT AS items, sum(used)::BIGINT AS real_tokens, (count(*) * 512 - sum(used))::BIGINT AS padding, round(sum(used) * 100.0::DOUBLE / (count(*) * 512), 2) AS efficiency, round(sum(items)::DOUBLE / count(*), 2) AS items_per_row FROM r""",
)
def pack_next_fit_statistics(spark, sf):
    return pack.packing_statistics(_next_fit(spark, sf), "len", 512)


@query(
    "pack_rows_rendered",
    f"""WITH {_ROWS}, i AS (SELECT example_id AS id, list_filter(input_ids, lambda x: x <> 0) AS ids FROM r)
    SELECT id, list_concat(ids, list_resize([]::INT[], 1024 - len(ids), 3)) AS input_ids, list_concat(list_resize([]::INT[], len(ids), 1), list_resize([]::INT[], 1024 - len(ids), 0)) AS attention_mask,
    list_concat(ids, list_resize([]::INT[], 1024 - len(ids), -100)) AS labels FROM i""",
)
def pack_rows_rendered(spark, sf):
    """Padding, mask and labels of sequences of several lengths."""
    i = _rows(spark, sf).select(F.col("example_id").alias("id"), F.filter("input_ids", lambda x: x != 0).alias("ids"))
    to = F.lit(1024)
    return i.select("id", pack.padded(F.col("ids"), to, 3).alias("input_ids"), pack.mask(F.col("ids"), to).alias("attention_mask"), pack.padded(F.col("ids"), to, pack.IGNORED).alias("labels"))


@query(
    "pack_batches",
    f"""WITH {_ROWS}, i AS (SELECT example_id, list_filter(input_ids, lambda x: x <> 0) AS ids, (row_number() OVER (ORDER BY example_id) - 1) // 16 AS batch FROM r),
    m AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch) AS n FROM i)
    SELECT batch, example_id, list_concat(ids, list_resize([]::INT[], n - len(ids), 0)) AS input_ids, list_concat(list_resize([]::INT[], len(ids), 1), list_resize([]::INT[], n - len(ids), 0)) AS attention_mask,
    list_concat(ids, list_resize([]::INT[], n - len(ids), -100)) AS labels FROM m""",
)
def pack_batches(spark, sf):
    i = _rows(spark, sf).select("example_id", F.filter("input_ids", lambda x: x != 0).alias("ids"))
    return pack.batches(i, "example_id", "ids", 16)


_TOKENS = f"WITH {_ROWS}, t AS (SELECT run_id, unnest(input_ids) AS t FROM r), c AS (SELECT run_id, t, count(*) AS n FROM t GROUP BY 1, 2)"


def _counts(spark, sf):
    return _rows(spark, sf).select("run_id", F.explode("input_ids").alias("t")).groupBy("run_id", "t").agg(F.count("*").alias("n"))


@query("vocabulary_usage", f"{_TOKENS} SELECT run_id, count(*) AS used, sum(n)::BIGINT AS tokens, count(*) * 100.0::DOUBLE / 32000 AS coverage, count(CASE WHEN n = 1 THEN 1 END) AS singletons FROM c GROUP BY run_id")
def vocabulary_usage(spark, sf):
    c = _counts(spark, sf)
    return c.groupBy("run_id").agg(F.count("*").alias("used"), F.sum("n").alias("tokens"), (F.count("*") * 100.0 / 32000).alias("coverage"), F.count_if(F.col("n") == 1).alias("singletons"))


@query("vocabulary_top", f"{_TOKENS} SELECT t AS token_id, sum(n)::BIGINT AS n FROM c GROUP BY 1 ORDER BY n DESC, token_id LIMIT 20")
def vocabulary_top(spark, sf):
    return _counts(spark, sf).groupBy(F.col("t").alias("token_id")).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token_id").limit(20)


@query("vocabulary_unused", f"{_TOKENS} SELECT range AS token_id FROM range(32000) WHERE range NOT IN (SELECT t FROM c)")
def vocabulary_unused(spark, sf):
    return spark.range(32000).withColumnRenamed("id", "token_id").join(_counts(spark, sf).select(F.col("t").cast("bigint").alias("token_id")), "token_id", "left_anti")


@query("vocabulary_entropy", f"{_TOKENS}, p AS (SELECT run_id, n::DOUBLE / sum(n) OVER (PARTITION BY run_id) AS p FROM c) SELECT run_id, round(-sum(p * log2(p)), 6) AS entropy FROM p GROUP BY run_id")
def vocabulary_entropy(spark, sf):
    return evaluate.entropy(_counts(spark, sf), ["run_id"], "n").withColumn("entropy", F.round("entropy", 6))


@query("sequence_statistics", f"WITH {_ROWS}, l AS (SELECT run_id, len(list_filter(input_ids, lambda x: x <> 0)) AS n FROM r) SELECT run_id, count(*) AS sequences, sum(n)::BIGINT AS tokens, avg(n) AS mean, median(n) AS middle, min(n) AS least, max(n) AS most, stddev_samp(n) AS deviation FROM l GROUP BY 1")
def sequence_statistics(spark, sf):
    n = _rows(spark, sf).select("run_id", F.size(F.filter("input_ids", lambda x: x != 0)).alias("n"))
    return n.groupBy("run_id").agg(F.count("*").alias("sequences"), F.sum("n").alias("tokens"), F.avg("n").alias("mean"), F.median("n").alias("middle"), F.min("n").cast("bigint").alias("least"), F.max("n").cast("bigint").alias("most"), F.stddev_samp("n").alias("deviation"))


@query("compression_statistics", "WITH c AS (SELECT DISTINCT conv_id, source_dataset, token_count::DOUBLE / len(text) AS r FROM sft_conversations WHERE token_count > 0) SELECT source_dataset, avg(r) AS mean, median(r) AS middle, avg(1 / r) AS chars_per_token, count(CASE WHEN r < 0.2 THEN 1 END) AS excellent, count(CASE WHEN r >= 0.2 AND r < 0.3 THEN 1 END) AS good, count(CASE WHEN r >= 0.3 AND r < 0.4 THEN 1 END) AS acceptable, count(CASE WHEN r >= 0.4 THEN 1 END) AS poor, coalesce(stddev_samp(r), 0) AS variability FROM c GROUP BY 1")
def compression_statistics(spark, sf):
    c = table(spark, sf, "sft_conversations").where("token_count > 0").select("conv_id", "source_dataset", (F.col("token_count") / F.length("text")).alias("r")).distinct()
    r = F.col("r")
    return c.groupBy("source_dataset").agg(
        F.avg(r).alias("mean"), F.median(r).alias("middle"), F.avg(1 / r).alias("chars_per_token"), F.count_if(r < 0.2).alias("excellent"), F.count_if((r >= 0.2) & (r < 0.3)).alias("good"),
        F.count_if((r >= 0.3) & (r < 0.4)).alias("acceptable"), F.count_if(r >= 0.4).alias("poor"), F.coalesce(F.stddev_samp(r), F.lit(0.0)).alias("variability"),
    )


@query("tokens_head_sample", "WITH s AS (SELECT conv_id, source_dataset, max(token_count) AS n FROM sft_conversations WHERE token_count > 0 AND source_dataset IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY source_dataset ORDER BY conv_id) AS k, count(*) OVER (PARTITION BY source_dataset) AS c FROM s) SELECT source_dataset, count(*) AS sampled, sum(n)::BIGINT AS tokens, floor(sum(n)::DOUBLE * max(c) / count(*))::BIGINT AS extrapolated FROM r WHERE k <= greatest(1, floor(c * 0.1::DOUBLE)) GROUP BY 1")
def tokens_head_sample(spark, sf):
    """Tokens of a source counted on its first tenth and carried on to all of it."""
    s = table(spark, sf, "sft_conversations").where("token_count > 0 and source_dataset is not null").groupBy("conv_id", "source_dataset").agg(F.max("token_count").alias("n"))
    c = s.groupBy("source_dataset").agg(F.count("*").alias("c"))
    r = order.position(s, ["source_dataset"], "conv_id", "k").join(c, "source_dataset").where(F.col("k") < F.greatest(F.lit(1), F.floor(F.col("c") * 0.1)))
    return r.groupBy("source_dataset").agg(F.count("*").alias("sampled"), F.sum("n").alias("tokens"), F.floor(F.sum("n").cast("double") * F.max("c") / F.count("*")).alias("extrapolated"))


@query("tokenizer_consistency", "SELECT bos_id, eos_id, pad_id, count(*) AS runs, count(*) = sum(count(*)) OVER () AS consistent FROM pack_runs GROUP BY 1, 2, 3")
def tokenizer_consistency(spark, sf):
    """Runs by their special tokens; consistent if all agree."""
    g = table(spark, sf, "pack_runs").groupBy("bos_id", "eos_id", "pad_id").agg(F.count("*").alias("runs"))
    return g.withColumn("consistent", F.col("runs") == F.sum("runs").over(Window.partitionBy()))


@query("tokenizer_hash_consistency", "WITH h AS (SELECT run_id, sha256(bos_id || '|' || eos_id || '|' || pad_id) AS hash FROM pack_runs) SELECT run_id, hash, hash = (SELECT arg_min(hash, run_id) FROM h) AS same FROM h")
def tokenizer_hash_consistency(spark, sf):
    """Runs whose tokenizer settings hash to another value than the first run's can't be mixed with it."""
    h = table(spark, sf, "pack_runs").select("run_id", F.sha2(F.concat_ws("|", "bos_id", "eos_id", "pad_id"), 256).alias("hash"))
    first = h.agg(F.min_by("hash", "run_id").alias("first"))
    return h.crossJoin(F.broadcast(first)).select("run_id", "hash", (F.col("hash") == F.col("first")).alias("same"))  # one row


@query("manifest_join", "SELECT r.run_id, r.run_name, count(DISTINCT p.example_id) AS found, max(p.seq_no) + 1 AS expected, count(DISTINCT p.example_id) = max(p.seq_no) + 1 AS complete FROM pack_runs r LEFT JOIN packed_examples p USING (run_id) GROUP BY 1, 2")
def manifest_join(spark, sf):
    p = table(spark, sf, "packed_examples").groupBy("run_id").agg(F.count_distinct("example_id").alias("found"), (F.max("seq_no") + 1).alias("expected"))
    j = table(spark, sf, "pack_runs").select("run_id", "run_name").join(p, "run_id", "left")
    return j.select("run_id", "run_name", F.coalesce("found", F.lit(0)).alias("found"), "expected", (F.col("found") == F.col("expected")).alias("complete"))
