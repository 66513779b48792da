"""Text expressions against plain Python."""

import re

from pyspark.sql import functions as F

from quern.functions import estimate, templates, text, words

NBSP, WIDE, ZERO = "\u00a0", "\u3000", "\u200b"
TEXTS = [
    None, "", " ", f"{NBSP}{WIDE}\n", "one", "See https://a.b/c?d=e&f=g now", "http://é", "```\ncode\n``` after `x` and ` left", "bell\x07 next\x85line", f"a{NBSP}{WIDE}b{ZERO}c", "https://only.url",
    "It ends. The next (one) starts! \"Quoted\" here? (Yes)\n\nNew par\nline", "e.g. The abbreviation", "1234 567", "été naïve über", "extraordinarily extraordinarily long words", "x" * 3000, "\U0001f600 emoji \U0001f600",
]
SPACE = re.compile(r"\s+")


def rows(spark, *cols):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    return [tuple(r)[1:] if len(r) > 2 else r[1] for r in d.select("i", *cols).orderBy("i").collect()]


CLEANED = [
    None, "", "", "", "one", "See now", "http://é", "after and ` left", "bell nextline", f"a b{ZERO}c", "",
    "It ends. The next (one) starts! \"Quoted\" here? (Yes) New par line", "e.g. The abbreviation", "1234 567", "été naïve über", "extraordinarily extraordinarily long words", "x" * 3000, "\U0001f600 emoji \U0001f600",
]


def smart(t):
    if t is None or not t.strip():
        return 0
    w = re.findall(r"\w+", t)
    mean = sum(map(len, w)) / len(w) if w else 5
    v = len(t) / 4.0 * (1.0 + max(0, mean - 5) * 0.02) * min(1.2, 0.8 + len(set(t.lower())) / 100)
    v += len(re.findall("[.!?;:,]", t)) * 0.5 + sum(x.isdecimal() for x in w) * 0.3 - max(0, len(SPACE.findall(t)) - len(t.split())) * 0.1
    return max(1, int(v))


def sentences(t):
    if t is None:
        return None
    parts = re.split(r"(?<=[.!?])\s+(?=[A-Z\"'(\[])", t)
    return [s for p in parts for line in p.split("\n") if 5 <= len(s := line.strip()) <= 2048]


def test_clean(spark):
    assert rows(spark, text.clean_text(F.col("t"))) == CLEANED


def test_smart_estimate(spark):
    assert rows(spark, estimate.smart_estimate(F.col("t"))) == [smart(t) for t in TEXTS]


def test_sentences(spark):
    assert rows(spark, text.sentences(F.col("t"))) == [sentences(t) for t in TEXTS]


def test_strip_and_blank(spark):
    got = rows(spark, text.strip(F.col("t")).alias("s"), text.is_blank(F.col("t")).alias("b"))
    assert got == [(None if t is None else t.strip(), t is None or not t.strip()) for t in TEXTS]


def test_shingles(spark):
    def grams(t):
        if t is None:
            return None
        t = t.lower().replace(" ", "")
        return sorted({t[i : i + 3] for i in range(len(t) - 2)})

    assert [None if x is None else sorted(x) for x in rows(spark, text.char_shingles(F.col("t")))] == [grams(t) for t in TEXTS]
    runs = rows(spark, text.word_shingles(words.words(F.col("t")), 2))
    expected = [None if t is None else {" ".join(w[i : i + 2]) for i in range(len(w) - 1)} for t in TEXTS for w in [re.findall(r"[^\W_]+", (t or "").lower())]]
    assert [None if x is None else set(x) for x in runs] == expected


def test_gpt2_tokens(spark):
    import regex

    p = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
    assert rows(spark, words.gpt2_token_count(F.col("t"))) == [len(p.findall(t or "")) for t in TEXTS]


def test_paths_and_fields(spark):
    d = spark.createDataFrame([(["x", " y "], 1, None), ([], None, None)], "a array<string>, b int, c string")
    got = d.select(text.dotted_path(F.struct("a"), "a.1"), text.dotted_path(F.struct("b"), "b"), text.joined_fields(["b", "c"]), text.response_alias(["x", "y"])).collect()
    assert [tuple(r) for r in got] == [("y", "1", "1", None), (None, None, None, None)]
    j = spark.createDataFrame([('{"m": [{"c": " hi "}]}',), ("no json",), (None,)], "j string")
    assert [r[0] for r in j.select(text.dotted_path(F.col("j"), "m.0.c", of_json=True)).collect()] == ["hi", None, None]


def test_templates(spark):
    d = spark.createDataFrame([("human: <|im_start|>x<|im_end|> Why?", "Because\n### Response: it is", ""), (None, "a", "Be kind")], "p string, r string, s string")
    got = d.select(*[templates.format_conversation(n, F.col("p"), F.col("r"), F.col("s")) for n in ("chatml", "instruct", "chat", "alpaca")]).collect()
    assert got[0][0] == "<|im_start|>user\nWhy?\n<|im_end|>\n<|im_start|>assistant\nBecause  it is\n<|im_end|>"
    assert got[0][1] == "### Instruction:\nWhy?\n\n### Response:\nBecause  it is"
    assert got[1][2] == "System: Be kind\n\nHuman: \n\nAssistant: a"
    assert got[1][3] == f"{templates.TASK}\n\nBe kind\n\n### Instruction:\n\n\n### Response:\na"
    e = d.select(templates.extracted_response("chat", F.lit("Human: q\n\nAssistant:  yes \nHuman: more")), templates.extracted_response("chatml", F.lit("none"))).first()
    assert tuple(e) == ("yes", "none")


def test_multi_turn_pairs(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "user", "b"), (1, 3, "system", "t"), (1, 4, "assistant", "c"), (1, 5, "assistant", "d"), (2, 0, "assistant", "x"), (2, 1, "user", ""), (2, 2, "assistant", "y")]
    d = spark.createDataFrame(turns, "h int, n int, role string, c string")
    assert [tuple(r) for r in templates.multi_turn_pairs(d, "h", "n", "role", "c", "chat").collect()] == [(1, "Human: b\n\nAssistant: c")]
    whole = {r[0]: r[1] for r in templates.multi_turn_chatml(d, "h", "n", "role", "c").collect()}
    assert whole[1].count("<|im_start|>") == 6 and whole[1].startswith("<|im_start|>system\ns\n")
