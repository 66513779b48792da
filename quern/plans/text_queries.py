"""Queries of the text projections, templates and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import estimate, templates, text
from quern.functions.words import gpt2_token_count, words
from quern.operators import filters
from quern.plans import sql
from quern.plans.registry import query
from quern.session import table


def _docs(spark, sf, *cols):
    return table(spark, sf, "documents", heavy=True).select("doc_id", *cols)


def _sft(spark, sf, *cols):
    """Conversations, each delivery once."""
    return table(spark, sf, "sft_conversations", heavy=True).select("conv_id", *cols).distinct()


_ALPHABET = {
    "text_clean": (text.clean_text, sql.clean("text")),
    "text_strip_urls": (text.strip_urls, r"regexp_replace(text, 'http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\(\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+', '', 'g')"),
    "text_strip_code": (text.strip_code, r"regexp_replace(regexp_replace(text, '```[\s\S]*?```', '', 'g'), '`[^`]*`', '', 'g')"),
    "text_strip_control": (text.strip_control, r"regexp_replace(text, '[\x00-\x08\x0b-\x0c\x0e-\x1f\x7f-\x{9f}]', '', 'g')"),
    "text_collapse_blanks": (text.collapse_blanks, sql.collapse("text")),
    "text_fingerprint": (text.fingerprint, "sha256(text)"),
    "text_template_normalised": (templates.normalised_message, sql.message("text")),
    "tokens_smart_estimate": (estimate.smart_estimate, sql.smart("text")),
    "tokens_char_estimate": (estimate.char_estimate, f"(CASE WHEN text IS NULL OR len({sql.strip('text')}) = 0 THEN 0 ELSE greatest(1, floor(len(text)::DOUBLE / 4.0::DOUBLE)) END)::BIGINT"),
    "text_english_share": (
        text.english_share,
        f"len(list_filter({sql.pieces('lower(text)')}, lambda w: list_contains([{', '.join(repr(w) for w in text.ENGLISH)}], w)))::DOUBLE / nullif(len({sql.pieces('lower(text)')}), 0)",
    ),
}
for _name, (_f, _sql) in _ALPHABET.items():
    query(_name, f"SELECT doc_id, {_sql} AS value FROM documents")(lambda spark, sf, _f=_f: _docs(spark, sf, "text").select("doc_id", _f(F.col("text")).alias("value")))


@query("text_join_fields", "SELECT pair_id, concat_ws(' ', prompt, chosen, chosen_reward::VARCHAR IS NOT NULL) AS value FROM preference_pairs WHERE prompt IS NOT NULL OR chosen IS NOT NULL OR chosen_reward IS NOT NULL")
def text_join_fields(spark, sf):
    """Several fields made one text; rows without any are left out."""
    d = table(spark, sf, "preference_pairs").withColumn("rated", F.col("chosen_reward").isNotNull())
    d = d.where("prompt is not null or chosen is not null or chosen_reward is not null")
    return d.select("pair_id", text.joined_fields(["prompt", "chosen", "rated"]).alias("value"))


@query("text_dotted_path", "SELECT event_id, json_extract_string(props, '$.k') AS k, NULL::VARCHAR AS missing FROM events")
def text_dotted_path(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", text.dotted_path(F.col("props"), "k", of_json=True).alias("k"), text.dotted_path(F.col("props"), "k.0.x", of_json=True).alias("missing"))


@query("text_nested_path", "SELECT mix_name, source, NULLIF(regexp_replace(string_split(text_keys, ',')[2], '^ +| +$', '', 'g'), '') AS second_key FROM mix_plan")
def text_nested_path(spark, sf):
    m = table(spark, sf, "mix_plan").withColumn("config", F.struct(F.split("text_keys", ",").alias("keys")))
    return m.select("mix_name", "source", F.nullif(text.dotted_path(F.col("config"), "keys.1"), F.lit("")).alias("second_key"))


@query("text_response_alias", "SELECT pair_id, coalesce(chosen, rejected) AS value FROM preference_pairs")
def text_response_alias(spark, sf):
    d = table(spark, sf, "preference_pairs").select("pair_id", F.col("chosen").alias("answer"), F.col("rejected").alias("output"))
    return d.select("pair_id", text.response_alias(d.columns).alias("value"))


@query(
    "text_preference_fields",
    f"""SELECT pair_id, {sql.strip('prompt')} AS prompt, {sql.strip('chosen')} AS chosen, {sql.strip('rejected')} AS rejected FROM preference_pairs
    WHERE prompt <> '' AND chosen <> '' AND rejected <> ''""",
)
def text_preference_fields(spark, sf):
    d = table(spark, sf, "preference_pairs").where("prompt <> '' and chosen <> '' and rejected <> ''")
    return d.select("pair_id", *[text.strip(F.col(c)).alias(c) for c in ("prompt", "chosen", "rejected")])


@query(
    "text_sentences",
    rf"""WITH p AS (SELECT doc_id, string_split_regex(regexp_replace(text, '([.!?]){sql.BL}+([A-Z"''(\[])', '\1' || chr(1) || '\2', 'g'), '[\x01\n]') AS parts FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, s AS sentence FROM (SELECT doc_id, unnest(parts) AS raw FROM p), LATERAL (SELECT {sql.strip('raw')} AS s) WHERE len(s) BETWEEN 5 AND 2048""",
)
def text_sentences(spark, sf):
    return _docs(spark, sf, "text").select("doc_id", F.explode(text.sentences(F.col("text"))).alias("sentence"))


@query(
    "text_training_sentences",
    rf"""WITH p AS (SELECT doc_id, string_split_regex(regexp_replace(text, '([.!?]){sql.BL}+([A-Z"''(\[])', '\1' || chr(1) || '\2', 'g'), '[\x01\n]') AS parts FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, substr(s, 1, 120) AS sentence FROM (SELECT doc_id, unnest(parts) AS raw FROM p), LATERAL (SELECT {sql.strip('raw')} AS s) WHERE len(s) >= 20""",
)
def text_training_sentences(spark, sf):
    return _docs(spark, sf, "text").select("doc_id", F.explode(text.training_sentences(F.col("text"), 20, 120)).alias("sentence"))


@query(
    "text_first_sentences",
    rf"""WITH p AS (SELECT doc_id, string_split_regex(regexp_replace(text, '([.!?]){sql.BL}+([A-Z"''(\[])', '\1' || chr(1) || '\2', 'g'), '[\x01\n]') AS parts FROM documents WHERE text IS NOT NULL),
    s AS (SELECT doc_id, list_filter(list_transform(parts, lambda x: {sql.strip('x')}), lambda x: len(x) >= 20) AS l FROM p), u AS (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) - 1 AS pos FROM s)
    SELECT doc_id, pos::INT AS pos, substr(s, 1, 120) AS sentence FROM u ORDER BY doc_id, pos LIMIT 777""",
)
def text_first_sentences(spark, sf):
    """A training sample of a stated number of sentences."""
    return filters.first_sentences(_docs(spark, sf, "text"), "doc_id", text.training_sentences(F.col("text"), 20, 120), 777)


@query("text_blank_words", f"SELECT doc_id, count(*) AS n, count(DISTINCT w) AS n_distinct FROM (SELECT doc_id, unnest({sql.pieces('lower(text)')}) AS w FROM documents) GROUP BY doc_id")
def text_blank_words(spark, sf):
    w = text.blank_words(F.col("text"))
    d = _docs(spark, sf, w.alias("w")).where("size(w) > 0")
    return d.select("doc_id", F.size("w").cast("bigint").alias("n"), F.size(F.array_distinct("w")).cast("bigint").alias("n_distinct"))


@query("text_unicode_words", r"SELECT doc_id, len(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))::BIGINT AS n FROM documents")
def text_unicode_words(spark, sf):
    return _docs(spark, sf, F.size(words(F.col("text"))).cast("bigint").alias("n"))


@query(
    "text_char_shingles",
    """WITH t AS (SELECT doc_id, replace(lower(text), ' ', '') AS t FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, len(list_distinct(list_transform(range(1, len(t) - 1), lambda i: substr(t, i::INT, 3))))::BIGINT AS shingles FROM t""",
)
def text_char_shingles(spark, sf):
    return _docs(spark, sf, "text").where("text is not null").select("doc_id", F.size(text.char_shingles(F.col("text"))).cast("bigint").alias("shingles"))


@query(
    "text_word_shingles",
    """WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, len(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))))::BIGINT AS shingles FROM t""",
)
def text_word_shingles(spark, sf):
    return _docs(spark, sf, "text").where("text is not null").select("doc_id", F.size(text.word_shingles(words(F.col("text")), 5)).cast("bigint").alias("shingles"))


# Templates

_P, _R = sql.message("prompt"), sql.message("response")
_INSTRUCT = f"concat('### Instruction:', chr(10), {_P}, chr(10), chr(10), '### Response:', chr(10), {_R})"
_RENDERED = {
    "chatml": f"concat('<|im_start|>user', chr(10), {_P}, chr(10), '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10), {_R}, chr(10), '<|im_end|>')",
    "instruct": _INSTRUCT,
    "chat": f"concat('Human: ', {_P}, chr(10), chr(10), 'Assistant: ', {_R})",
    "alpaca": f"concat('{templates.TASK}', chr(10), chr(10), {_INSTRUCT})",
}
for _name, _sql in _RENDERED.items():
    query(f"template_{_name}", f"SELECT DISTINCT conv_id, {_sql} AS text FROM sft_conversations")(
        lambda spark, sf, _n=_name: _sft(spark, sf, templates.format_conversation(_n, F.col("prompt"), F.col("response")).alias("text"))
    )


@query("template_system_chatml", f"SELECT DISTINCT conv_id, concat('<|im_start|>system', chr(10), source_dataset, chr(10), '<|im_end|>', chr(10), '<|im_start|>user', chr(10), prompt, chr(10), '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10), response, chr(10), '<|im_end|>') AS text FROM sft_conversations WHERE source_dataset <> '' AND response IS NOT NULL")
def template_system_chatml(spark, sf):
    d = table(spark, sf, "sft_conversations").where("source_dataset <> '' and response is not null")
    return d.select("conv_id", templates.render("chatml", F.col("prompt"), F.col("response"), F.col("source_dataset")).alias("text")).distinct()


_DETECTED = """CASE WHEN contains(text, '<|im_start|>') AND contains(text, '<|im_end|>') THEN 'chatml' WHEN contains(text, '### Instruction:') AND contains(text, '### Response:') THEN 'instruct'
    WHEN contains(text, 'Human:') AND contains(text, 'Assistant:') THEN 'chat' END"""


@query("template_detected", f"SELECT DISTINCT conv_id, {_DETECTED} AS detected FROM sft_conversations")
def template_detected(spark, sf):
    return _sft(spark, sf, templates.detected_template(F.col("text")).alias("detected"))


_EXTRACT = {
    "chatml": r"(?s)<\|im_start\|>assistant\n(.*?)<\|im_end\|>",
    "instruct": r"(?s)### Response:\s*(.*?)(?:### |\z)",
    "chat": r"(?s)Assistant:\s*(.*?)(?:Human:|\z)",
    "alpaca": r"(?s)### Response:\s*(.*?)\z",
}
_CASES = " ".join(f"WHEN template = '{n}' AND regexp_matches(text, '{p}') THEN {sql.strip(f'''regexp_extract(text, '{p}', 1)''')}" for n, p in _EXTRACT.items())


@query("template_extracted", f"SELECT DISTINCT conv_id, CASE {_CASES} ELSE text END AS response FROM sft_conversations WHERE template IS NOT NULL")
def template_extracted(spark, sf):
    d = table(spark, sf, "sft_conversations").where("template is not null")
    found = F.col("text")
    for name in _EXTRACT:
        found = F.when(F.col("template") == name, templates.extracted_response(name, F.col("text"))).otherwise(found)
    return d.select("conv_id", found.alias("response")).distinct()


@query(
    "template_generation_prompt",
    """SELECT DISTINCT conv_id, CASE template WHEN 'chatml' THEN concat('<|im_start|>user', chr(10), prompt, chr(10), '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10))
    WHEN 'chat' THEN concat('Human: ', prompt, chr(10), chr(10), 'Assistant: ') ELSE concat('### Instruction:', chr(10), prompt, chr(10), chr(10), '### Response:', chr(10)) END AS text
    FROM sft_conversations WHERE template IN ('chatml', 'chat', 'instruct')""",
)
def template_generation_prompt(spark, sf):
    d = table(spark, sf, "sft_conversations").where("template in ('chatml', 'chat', 'instruct')")
    p = F.col("prompt")
    by = F.when(F.col("template") == "chatml", templates.generation_prompt("chatml", p)).when(F.col("template") == "chat", templates.generation_prompt("chat", p)).otherwise(templates.generation_prompt("instruct", p))
    return d.select("conv_id", by.alias("text")).distinct()


@query("template_boolq_prompt", "SELECT item_id, concat('Passage: ', substr(passage, 1, 500), '...', chr(10), 'Question: ', question, chr(10), 'Answer: ') AS short_prompt, concat('Passage: ', passage, chr(10), chr(10), 'Question: ', question, chr(10), chr(10), 'Answer (true or false):') AS long_prompt FROM eval_items")
def template_boolq_prompt(spark, sf):
    e = table(spark, sf, "eval_items")
    short = F.concat(F.lit("Passage: "), F.substring("passage", 1, 500), F.lit("...\nQuestion: "), "question", F.lit("\nAnswer: "))
    long = F.concat(F.lit("Passage: "), "passage", F.lit("\n\nQuestion: "), "question", F.lit("\n\nAnswer (true or false):"))
    return e.select("item_id", short.alias("short_prompt"), long.alias("long_prompt"))


@query("template_legacy", "SELECT DISTINCT conv_id, concat('Human: ', prompt, chr(10), chr(10), 'Assistant: ', response, '<|endoftext|>') AS chat, concat('### Instruction:', chr(10), prompt, chr(10), chr(10), '### Response:', chr(10), response, '<|endoftext|>') AS instruction, concat(prompt, chr(10), response, '<|endoftext|>') AS raw FROM sft_conversations WHERE response IS NOT NULL")
def template_legacy(spark, sf):
    d = table(spark, sf, "sft_conversations").where("response is not null")
    return d.select("conv_id", *[templates.legacy_format(k, F.col("prompt"), F.col("response")).alias(k) for k in ("chat", "instruction", "raw")]).distinct()


@query("template_valid", f"SELECT DISTINCT conv_id, coalesce(len({sql.strip('prompt')}) > 0, false) AND coalesce(len({sql.strip('response')}) > 0, false) AS valid FROM sft_conversations")
def template_valid(spark, sf):
    return _sft(spark, sf, templates.is_valid_pair(F.col("prompt"), F.col("response")).alias("valid"))


@query("template_table", "SELECT * FROM (VALUES ('alpaca', 3), ('chat', 3), ('chatml', 4), ('instruct', 2)) t(name, n_tokens)")
def template_table(spark, sf):
    return templates.template_table(spark).select("name", F.size("special_tokens").alias("n_tokens"))


#: Histories made of the conversations of a source: turn 2i is the i-th prompt, turn 2i + 1 its response.
_TURNS_SQL = """WITH c AS (SELECT DISTINCT conv_id, source_dataset, prompt, response FROM sft_conversations WHERE source_dataset IS NOT NULL),
    n AS (SELECT *, (row_number() OVER (PARTITION BY source_dataset ORDER BY conv_id) - 1) // 4 AS part FROM c),
    t AS (SELECT source_dataset || '-' || part AS history, conv_id * 2 AS turn, CASE WHEN conv_id % 5 = 0 THEN 'system' ELSE 'user' END AS role, prompt AS content FROM n
      UNION ALL SELECT source_dataset || '-' || part, conv_id * 2 + 1, CASE WHEN conv_id % 7 = 0 THEN 'user' ELSE 'assistant' END, response FROM n)"""


def _turns(spark, sf):
    from pyspark.sql import Window

    c = table(spark, sf, "sft_conversations").where("source_dataset is not null").select("conv_id", "source_dataset", "prompt", "response").distinct()
    part = F.floor((F.row_number().over(Window.partitionBy("source_dataset").orderBy("conv_id")) - 1) / 4)
    n = c.withColumn("history", F.concat("source_dataset", F.lit("-"), part.cast("string")))
    roles = F.array(
        F.struct((F.col("conv_id") * 2).alias("turn"), F.when(F.col("conv_id") % 5 == 0, "system").otherwise("user").alias("role"), F.col("prompt").alias("content")),
        F.struct((F.col("conv_id") * 2 + 1).alias("turn"), F.when(F.col("conv_id") % 7 == 0, "user").otherwise("assistant").alias("role"), F.col("response").alias("content")),
    )
    return n.select("history", F.inline(roles))


@query("template_multi_turn_chatml", f"{_TURNS_SQL} SELECT history, string_agg(concat('<|im_start|>', role, chr(10), {sql.message('content')}, chr(10), '<|im_end|>'), chr(10) ORDER BY turn) AS text FROM t GROUP BY history")
def template_multi_turn_chatml(spark, sf):
    return templates.multi_turn_chatml(_turns(spark, sf), "history", "turn", "role", "content")


@query(
    "template_multi_turn_pairs",
    f"""{_TURNS_SQL}, s AS (SELECT *, lag(role) OVER w AS r, lag(content) OVER w AS c0 FROM t WHERE role IN ('user', 'assistant') WINDOW w AS (PARTITION BY history ORDER BY turn))
    SELECT history, string_agg(concat('### Instruction:', chr(10), {sql.message('c0')}, chr(10), chr(10), '### Response:', chr(10), {sql.message('content')}), chr(10) || chr(10) ORDER BY turn) AS text
    FROM s WHERE role = 'assistant' AND r = 'user' AND c0 <> '' GROUP BY history""",
)
def template_multi_turn_pairs(spark, sf):
    return templates.multi_turn_pairs(_turns(spark, sf), "history", "turn", "role", "content", "instruct")


@query("tokens_gpt2_count", f"SELECT DISTINCT conv_id, len({sql.gpt2_pieces('text')})::BIGINT AS tokens, token_count FROM sft_conversations")
def tokens_gpt2_count(spark, sf):
    return _sft(spark, sf, gpt2_token_count(F.col("text")).alias("tokens"), "token_count")
