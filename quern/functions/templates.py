"""Conversation templates: formatting, detection, extraction and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.functions.text import collapse_blanks, is_blank, strip

#: The templates' marks.
TASK = "Below is an instruction that describes a task. Write a response that appropriately completes the request."
SPECIAL_TOKENS = {
    "chatml": ["<|im_start|>system", "<|im_start|>user", "<|im_start|>assistant", "<|im_end|>"],
    "instruct": ["### Instruction:", "### Response:"],
    "chat": ["System:", "Human:", "Assistant:"],
    "alpaca": [TASK, "### Instruction:", "### Response:"],
}
END_OF_TEXT = "<|endoftext|>"
#: Parts of templates that are removed from messages, in this order, whatever their case.
FOREIGN_MARKS = (r"(?is)<\|im_start\|>.*?<\|im_end\|>", r"(?i)### Instruction:", r"(?i)### Response:", r"(?i)Human:\s*", r"(?i)Assistant:\s*")


def normalised_message(text: Column) -> Column:
    """White space collapsed, marks of templates removed, stripped; null gives an empty message."""
    t = collapse_blanks(F.coalesce(text, F.lit("")))
    for p in FOREIGN_MARKS:
        t = F.regexp_replace(t, p, "")
    return strip(t)


def _lines(*parts: Column) -> Column:
    return F.concat_ws("\n", *parts)  # leaves out nulls


def _given(system: Column | None) -> Column:
    return F.lit(False) if system is None else F.coalesce(F.length(system) > 0, F.lit(False))


def _block(role: str, content: Column) -> Column:
    return F.concat(F.lit(f"<|im_start|>{role}\n"), content, F.lit("\n<|im_end|>"))


def render(template: str, prompt: Column, response: Column, system: Column | None = None) -> Column:
    """A prompt and response, with a system message if it isn't empty, in a template."""
    s = system if system is not None else F.lit("")
    has = _given(system)
    instruct = (F.lit("### Instruction:"), prompt, F.lit(""), F.lit("### Response:"), response)
    if template == "chatml":
        return _lines(F.when(has, _block("system", s)), _block("user", prompt), _block("assistant", response))
    if template == "instruct":
        return _lines(F.when(has, F.concat(s, F.lit("\n"))), *instruct)
    if template == "chat":
        return _lines(F.when(has, F.concat(F.lit("System: "), s, F.lit("\n"))), F.concat(F.lit("Human: "), prompt), F.lit(""), F.concat(F.lit("Assistant: "), response))
    if template == "alpaca":
        return _lines(F.lit(TASK), F.lit(""), F.when(has, F.concat(s, F.lit("\n"))), *instruct)
    raise ValueError(f"no template {template!r}; there are {', '.join(SPECIAL_TOKENS)}")


def format_conversation(template: str, prompt: Column, response: Column, system: Column | None = None) -> Column:
    """``render`` of normalised messages."""
    return render(template, normalised_message(prompt), normalised_message(response), None if system is None else normalised_message(system))


def generation_prompt(template: str, prompt: Column) -> Column:
    """The template up to where the response begins."""
    if template == "chatml":
        return F.concat(_block("user", prompt), F.lit("\n<|im_start|>assistant\n"))
    if template == "chat":
        return F.concat(F.lit("Human: "), prompt, F.lit("\n\nAssistant: "))
    return F.concat(F.lit(f"{TASK}\n\n" if template == "alpaca" else ""), F.lit("### Instruction:\n"), prompt, F.lit("\n\n### Response:\n"))


def legacy_format(kind: str, prompt: Column, response: Column) -> Column:
    """Older formats that end with an end-of-text mark."""
    if kind == "chat":
        return F.concat(F.lit("Human: "), prompt, F.lit("\n\nAssistant: "), response, F.lit(END_OF_TEXT))
    if kind == "instruction":
        return F.concat(F.lit("### Instruction:\n"), prompt, F.lit("\n\n### Response:\n"), response, F.lit(END_OF_TEXT))
    return F.concat(prompt, F.lit("\n"), response, F.lit(END_OF_TEXT))


def detected_template(text: Column) -> Column:
    """chatml, instruct or chat by the marks in a text, else null. Alpaca texts hold instruct's marks and count as such."""
    has = lambda *marks: F.contains(text, F.lit(marks[0])) & F.contains(text, F.lit(marks[1]))
    return F.when(has("<|im_start|>", "<|im_end|>"), "chatml").when(has("### Instruction:", "### Response:"), "instruct").when(has("Human:", "Assistant:"), "chat")


#: Where each template's response stands in generated text.
RESPONSE_PATTERNS = {
    "chatml": r"(?s)<\|im_start\|>assistant\n(.*?)<\|im_end\|>",
    "instruct": r"(?s)### Response:\s*(.*?)(?:### |\z)",
    "chat": r"(?s)Assistant:\s*(.*?)(?:Human:|\z)",
    "alpaca": r"(?s)### Response:\s*(.*?)\z",
}


def extracted_response(template: str, text: Column) -> Column:
    """The response in generated text, stripped; the text as it is if the template's marks aren't there."""
    p = RESPONSE_PATTERNS[template]
    return F.when(text.rlike(p), strip(F.regexp_extract(text, p, 1))).otherwise(text)


def is_valid_pair(prompt: Column, response: Column) -> Column:
    return ~is_blank(prompt) & ~is_blank(response)


def template_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(name, tokens) for name, tokens in SPECIAL_TOKENS.items()], "name string, special_tokens array<string>")


def multi_turn_chatml(turns: DataFrame, conversation: str, turn: str, role: str, content: str) -> DataFrame:
    """``(conversation, text)``: all system, user and assistant turns as ChatML blocks in order; other roles are left out."""
    known = turns.where(F.col(role).isin("system", "user", "assistant"))
    block = F.concat(F.lit("<|im_start|>"), F.col(role), F.lit("\n"), normalised_message(F.col(content)), F.lit("\n<|im_end|>"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("turn"), block.alias("block"))))
    return known.groupBy(conversation).agg(F.array_join(F.transform(ordered, lambda x: x["block"]), "\n").alias("text"))


def multi_turn_pairs(turns: DataFrame, conversation: str, turn: str, role: str, content: str, template: str) -> DataFrame:
    """``(conversation, text)``: each assistant turn with the user turn right before it (system turns aside), joined by blank lines."""
    w = Window.partitionBy(conversation).orderBy(turn)
    spoken = turns.where(F.col(role).isin("user", "assistant"))
    paired = spoken.withColumn("__role", F.lag(role).over(w)).withColumn("__said", F.lag(content).over(w))
    paired = paired.where((F.col(role) == "assistant") & (F.col("__role") == "user") & (F.col("__said") != ""))
    exchange = format_conversation(template, F.col("__said"), F.col(content))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("turn"), exchange.alias("exchange"))))
    return paired.groupBy(conversation).agg(F.array_join(F.transform(ordered, lambda x: x["exchange"]), "\n\n").alias("text"))
