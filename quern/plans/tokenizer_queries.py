"""Queries that encode with a public vocabulary file (``QUERN_TOKENIZER`` names another than the default)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from quern.functions.words import words
from quern.operators import pack, tokenize
from quern.operators.shards import capped_shards
from quern.plans.corpus_queries import documents
from quern.plans.registry import query
from quern.session import checkpointed, table


def tokenizer_path() -> str:
    return os.environ.get("QUERN_TOKENIZER", "/opt/tokenizers/piece_bpe_32k.model")


def _encoded(spark, sf):
    return tokenize.encoded(documents(spark, sf, "text", heavy=True).where("text is not null"), "text", tokenizer_path())


@query("tokenizer_counts")
def tokenizer_counts(spark, sf):
    return _encoded(spark, sf).select("doc_id", F.size("ids").alias("tokens"))


@query("tokenizer_round_trip")
def tokenizer_round_trip(spark, sf):
    d = tokenize.decoded(_encoded(spark, sf), "ids", tokenizer_path())
    return d.groupBy("source").agg(F.count("*").alias("n"), F.avg((F.col("decoded") == F.col("text")).cast("double")).alias("same"))


@query("tokenizer_coverage")
def tokenizer_coverage(spark, sf):
    f = tokenize.facts(tokenizer_path())
    return tokenize.coverage(_encoded(spark, sf), "ids", f.size, f.unknown)


@query("tokenizer_top_pieces")
def tokenizer_top_pieces(spark, sf):
    """The ten most frequent tokens with their pieces."""
    c = _encoded(spark, sf).select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    return tokenize.with_pieces(c.orderBy(F.desc("n"), "id").limit(10), tokenize.vocabulary_table(spark, tokenizer_path()))


@query("tokenizer_vocabulary")
def tokenizer_vocabulary(spark, sf):
    return tokenize.vocabulary_composition(tokenize.vocabulary_table(spark, tokenizer_path()), "piece", F.col("is_special"))


@query("tokenizer_exact_by_source")
def tokenizer_exact_by_source(spark, sf):
    """Tokens, unknown ones and characters of each source by the vocabulary, and how the recorded counts agree with them."""
    unknown = tokenize.facts(tokenizer_path()).unknown
    e = tokenize.encoded(documents(spark, sf, "text", "exact_tokens", heavy=True).where("text is not null"), "text", tokenizer_path())
    n = F.size("ids")
    return e.groupBy("source").agg(
        F.sum(n).alias("tokens"), F.sum(F.size(F.filter("ids", lambda x: x == (-1 if unknown is None else unknown)))).alias("unknown"), F.sum(F.length("text")).alias("chars"),
        (F.sum("exact_tokens") * 100.0 / F.nullif(F.sum(n), F.lit(0))).alias("recorded_percent"), F.count_if(n < 100).alias("short"), F.count_if(n.between(100, 1000)).alias("middle"), F.count_if(n > 1000).alias("long"),
    )


@query("tokenizer_compression")
def tokenizer_compression(spark, sf):
    r = _encoded(spark, sf).where("length(text) > 0 and size(ids) > 0").select("source", (F.size("ids") / F.length("text")).alias("r"))
    return r.groupBy("source").agg(F.avg("r").alias("mean"), F.median("r").alias("middle"), F.avg(1 / F.col("r")).alias("chars_per_token"), F.coalesce(F.stddev_samp("r"), F.lit(0.0)).alias("variability"))


@query("tokenizer_linguistic")
def tokenizer_linguistic(spark, sf):
    w = documents(spark, sf, F.explode(words(F.col("text"))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    return tokenize.word_round_trips(w, "w", "n", tokenizer_path())


@query("tokenizer_quality")
def tokenizer_quality(spark, sf):
    """The corpus is encoded once; its ids give coverage and compression."""
    f = tokenize.facts(tokenizer_path())
    e = checkpointed(_encoded(spark, sf).select("ids", F.length("text").alias("chars")))
    c = tokenize.coverage(e, "ids", f.size, f.unknown).select("unknown_percent", "utilisation_percent")
    r = e.where("chars > 0 and size(ids) > 0").agg(F.avg(F.size("ids") / F.col("chars")).alias("ratio"), F.avg(F.col("chars") / F.size("ids")).alias("chars_per_token"))
    s = tokenizer_linguistic(spark, sf).select("preserved_percent").crossJoin(F.broadcast(c)).crossJoin(F.broadcast(r))  # one row each
    score = tokenize.tokenizer_score(F.col("unknown_percent"), F.col("ratio"), F.lit(f.size - len(f.special)), F.col("preserved_percent"))
    strong, weak = tokenize.findings(*[F.col(x) for x in ("unknown_percent", "utilisation_percent", "chars_per_token", "preserved_percent")])
    return s.withColumn("score", score).withColumn("grade", tokenize.grade(F.col("score"))).withColumn("strengths", strong).withColumn("weaknesses", weak)


@query("tokenizer_dataset_score")
def tokenizer_dataset_score(spark, sf):
    """How well the recorded token counts of each source agree with the vocabulary's, its unknown tokens and round trips, and the score that follows."""
    unknown = tokenize.facts(tokenizer_path()).unknown
    d = documents(spark, sf, "exact_tokens", "text", heavy=True).where("source is not null and exact_tokens > 0 and text is not null")
    e = tokenize.decoded(tokenize.encoded(d, "text", tokenizer_path()), "ids", tokenizer_path())
    n = F.size("ids")
    bad = F.size(F.filter("ids", lambda x: x == (-1 if unknown is None else unknown)))
    g = e.groupBy("source").agg(
        (F.lit(100.0) - F.abs(F.sum("exact_tokens") - F.sum(n)) * 100.0 / F.greatest(F.sum(n), F.lit(1))).alias("accuracy"), (F.sum(bad) * 100.0 / F.greatest(F.sum(n), F.lit(1))).alias("unknown_percent"),
        F.stddev_pop(n).alias("deviation"), F.avg(n).alias("mean"), F.avg((F.col("decoded") == F.col("text")).cast("double")).alias("same"),
    )
    return g.select("source", "accuracy", "unknown_percent", "same", tokenize.dataset_score(F.col("accuracy"), F.col("unknown_percent"), F.col("deviation") < 2 * F.col("mean"), F.col("same") > 0.9).alias("score"))


@query("pack_pretraining")
def pack_pretraining(spark, sf):
    """Documents of each source encoded once, made one stream and cut into rows of 512 tokens."""
    e = checkpointed(_encoded(spark, sf).where("source is not null").select("source", "doc_id", "ids"))
    return pack.pack_stream(e, ["source"], "doc_id", "ids", 512)


@query("pack_finetuning")
def pack_finetuning(spark, sf):
    """Conversations encoded once with an end token, packed by next-fit, as padded rows with masks and labels."""
    f = tokenize.facts(tokenizer_path())
    c = table(spark, sf, "sft_conversations").groupBy("conv_id").agg(F.max("text").alias("text"))
    e = checkpointed(tokenize.encoded(c, "text", tokenizer_path(), append=[f.special.get("eos", 0)]).select("conv_id", "ids", F.size("ids").alias("len")))
    return pack.packed_rows(pack.next_fit(e, "conv_id", "len", 512), "conv_id", "ids", 512, f.special.get("pad", f.special.get("unk", 0)))


#: Stand-in ids that any engine can make: a word's hash.
_WORD_IDS = "list_transform(regexp_extract_all(lower({}), '[\\p{{L}}\\p{{N}}]+'), lambda w: (('0x' || substr(md5(w), 1, 4))::INT % 32768)::INT)"


def _word_ids(c):
    return F.transform(words(F.col(c)), lambda w: (F.conv(F.substring(F.md5(w), 1, 4), 16, 10).cast("int") % 32768).cast("int"))


@query(
    "pack_pretraining_words",
    f"""WITH d AS (SELECT lower(trim(source)) AS source, doc_id, {_WORD_IDS.format("text")} AS ids FROM documents WHERE source IS NOT NULL AND text IS NOT NULL),
    t AS (SELECT source, doc_id, unnest(ids) AS t, generate_subscripts(ids, 1) AS i FROM d), n AS (SELECT source, t, row_number() OVER (PARTITION BY source ORDER BY doc_id, i) - 1 AS k FROM t)
    SELECT source, k // 256 AS row, list(t ORDER BY k) AS tokens FROM n GROUP BY 1, 2 HAVING count(*) = 256""",
)
def pack_pretraining_words(spark, sf):
    e = documents(spark, sf, _word_ids("text").alias("ids"), heavy=True).where("source is not null and ids is not null")
    return pack.pack_stream(checkpointed(e), ["source"], "doc_id", "ids", 256)


@query(
    "pack_finetuning_words",
    f"""WITH RECURSIVE c AS (SELECT conv_id, list_concat({_WORD_IDS.format("max(text)")}, [2]::INT[]) AS ids FROM sft_conversations GROUP BY conv_id),
    s AS (SELECT conv_id, ids, least(len(ids), 129) AS n, row_number() OVER (ORDER BY least(len(ids), 129), conv_id) AS i FROM c),
    f AS (SELECT i, conv_id, 0::BIGINT AS row, n::BIGINT AS fill FROM s WHERE i = 1
      UNION ALL SELECT s.i, s.conv_id, CASE WHEN f.fill + s.n <= 128 THEN f.row ELSE f.row + 1 END, CASE WHEN f.fill + s.n <= 128 THEN f.fill + s.n ELSE s.n END FROM f JOIN s ON s.i = f.i + 1),
    r AS (SELECT row, flatten(list(ids ORDER BY len(ids), f.conv_id))[1:128] AS ids FROM f JOIN s USING (i) GROUP BY row)
    SELECT row, list_concat(ids, list_resize([]::INT[], 128 - len(ids), 0)) AS input_ids, list_concat(list_resize([]::INT[], len(ids), 1), list_resize([]::INT[], 128 - len(ids), 0)) AS attention_mask,
      list_concat(ids, list_resize([]::INT[], 128 - len(ids), -100)) AS labels FROM r""",
)
def pack_finetuning_words(spark, sf):
    c = table(spark, sf, "sft_conversations").groupBy("conv_id").agg(F.max("text").alias("text"))
    e = checkpointed(c.select("conv_id", F.concat(_word_ids("text"), F.array(F.lit(2))).alias("ids")).withColumn("len", F.size("ids")))
    return pack.packed_rows(pack.next_fit(e, "conv_id", "len", 128), "conv_id", "ids", 128, 0)


_CAP = """WITH RECURSIVE d AS (SELECT coalesce(lower(trim(source)), '') AS s, doc_id, coalesce(exact_tokens, 0) AS n, row_number() OVER (PARTITION BY coalesce(lower(trim(source)), '') ORDER BY doc_id) AS i FROM documents),
    f AS (SELECT s, doc_id, i, 0::BIGINT AS shard, n::BIGINT AS used, 1 AS docs FROM d WHERE i = 1
      UNION ALL SELECT d.s, d.doc_id, d.i, CASE WHEN {full} THEN f.shard + 1 ELSE f.shard END, CASE WHEN {full} THEN d.n ELSE f.used + d.n END, CASE WHEN {full} THEN 1 ELSE f.docs + 1 END FROM f JOIN d ON d.s = f.s AND d.i = f.i + 1)
    SELECT s AS source, doc_id, shard FROM f"""


@query("shard_capped", _CAP.format(full="(f.used >= 3000 OR f.docs >= 20)"))
def shard_capped(spark, sf):
    d = table(spark, sf, "documents").select(F.coalesce(F.lower(F.trim("source")), F.lit("")).alias("source"), "doc_id", "exact_tokens")
    return capped_shards(d, "source", "doc_id", "exact_tokens", 3000, 20)


@query("shard_capped_overflow", _CAP.format(full="(f.used > 0 AND f.used + d.n > 3000)"))
def shard_capped_overflow(spark, sf):
    d = table(spark, sf, "documents").select(F.coalesce(F.lower(F.trim("source")), F.lit("")).alias("source"), "doc_id", "exact_tokens")
    return capped_shards(d, "source", "doc_id", "exact_tokens", 3000, overflow=True)
