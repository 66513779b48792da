"""Encoding and decoding with vocabulary files of public tokenizers, in Arrow batches.

A tokenizer is named by the path of its file, which every executor must see; each Python worker loads it once.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.estimate import char_estimate, smart_estimate
from quern.session import broadcast_if_small

#: Fixed value: GPT-2's split pattern, as the byte-level vocabularies need it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def opened(path: str) -> tuple[Callable[[list[str]], list[list[int]]], Callable[[list[int]], str], int]:
    """``(encode, decode, size)`` of a ``.model``, ``.tiktoken`` or ``.json`` file."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: sp.encode(texts, num_threads=1), lambda ids: sp.decode(ids), sp.vocab_size()
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        t = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [t.encode_ordinary(x) for x in texts], lambda ids: t.decode(ids), len(ranks)
    from tokenizers import Tokenizer

    k = Tokenizer.from_file(path)
    k.encode_special_tokens = True
    return lambda texts: [e.ids for e in k.encode_batch(texts, add_special_tokens=False)], lambda ids: k.decode(ids), k.get_vocab_size()


@dataclass(frozen=True)
class Facts:
    """What a vocabulary file says about itself; ``unknown`` is None where every text can be encoded."""

    size: int
    unknown: int | None
    special: dict[str, int]
    sha256: str


def facts(path: str) -> Facts:
    """Size, unknown id and special ids of a vocabulary, read from the opened file and never assumed; and the file's hash."""
    with open(path, "rb") as f:
        digest = hashlib.sha256(f.read()).hexdigest()
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        named = {"unk": sp.unk_id(), "bos": sp.bos_id(), "eos": sp.eos_id(), "pad": sp.pad_id()}
        return Facts(sp.vocab_size(), sp.unk_id() if sp.unk_id() >= 0 else None, {k: v for k, v in named.items() if v >= 0}, digest)
    if path.endswith(".tiktoken"):
        return Facts(opened(path)[2], None, {}, digest)
    from tokenizers import Tokenizer

    k = Tokenizer.from_file(path)
    unknown = getattr(k.model, "unk_token", None)
    special = {t.content: i for i, t in k.get_added_tokens_decoder().items() if t.special}
    return Facts(k.get_vocab_size(), k.token_to_id(unknown) if unknown else None, special, digest)


def verify(path: str, sha256: str | None = None, size: int | None = None, special: dict[str, int] | None = None) -> list[str]:
    """What differs between a vocabulary file and what a manifest recorded of it; nothing for what wasn't recorded."""
    f = facts(path)
    faults = []
    if sha256 is not None and sha256 != f.sha256:
        faults.append(f"the file's hash is {f.sha256}, not {sha256}")
    if size is not None and size != f.size:
        faults.append(f"the vocabulary has {f.size} entries, not {size}")
    for name, i in (special or {}).items():
        if f.special.get(name) != i:
            faults.append(f"{name} is {f.special.get(name)}, not {i}")
    return faults


def vocabulary_table(spark: SparkSession, path: str) -> DataFrame:
    """``(id, piece, is_special)`` of every entry of a vocabulary file, by which ids are joined to their pieces."""
    size, special = facts(path).size, set(facts(path).special.values())
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        rows = [(i, sp.id_to_piece(i), sp.is_control(i) or sp.is_unknown(i)) for i in range(size)]
    elif path.endswith(".tiktoken"):
        with open(path, "rb") as f:
            rows = [(int(b), base64.b64decode(a).decode("utf-8", "replace"), False) for a, b in map(bytes.split, f)]
    else:
        from tokenizers import Tokenizer

        k = Tokenizer.from_file(path)
        rows = [(i, k.id_to_token(i), i in special) for i in range(size)]
    return spark.createDataFrame(rows, "id int, piece string, is_special boolean")


def with_pieces(counts: DataFrame, vocabulary: DataFrame, id: str = "id") -> DataFrame:
    """``counts`` with the ``piece`` of each ``id`` (null for ids that the vocabulary hasn't). A vocabulary is broadcast up to a million entries."""
    v = broadcast_if_small(vocabulary.select(F.col("id").alias("__v"), "piece"), 1_000_000)
    return counts.join(v, F.col(id) == F.col("__v"), "left").drop("__v")


def counted(df: DataFrame, text: str, name: str = "tokens", path: str | None = None, smart: bool = True) -> DataFrame:
    """``df`` with the token count of ``text``: by the vocabulary file ``path`` if there is one, else by the smart estimate, else by four characters a token."""
    if path is not None:
        e = encoded(df, text, path, ids="__ids")
        return e.withColumn(name, F.size("__ids").cast("bigint")).drop("__ids")
    return df.withColumn(name, smart_estimate(F.col(text)) if smart else char_estimate(F.col(text)))


def encoded(df: DataFrame, text: str, path: str, ids: str = "ids", append: list[int] | None = None) -> DataFrame:
    """``df`` with the token ids of ``text`` (none for null), followed by the ids ``append``."""
    kept = [c for c in df.columns if c != ids]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema] + [f"`{ids}` array<int>"])
    more = list(append or [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = opened(path)[0]
        for b in batches:
            texts = b.column(text).to_pylist()
            found = encode([t or "" for t in texts])
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array([list(x) + more for x in found], pa.list_(pa.int32()))], names=[*kept, ids])

    return df.select(*kept).mapInArrow(run, schema)


def decoded(df: DataFrame, ids: str, path: str, text: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids``; null for null."""
    kept = [c for c in df.columns if c != text]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema] + [f"`{text}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = opened(path)[1]
        for b in batches:
            out = [None if x is None else decode(x) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(out, pa.string())], names=[*kept, text])

    return df.select(*kept).mapInArrow(run, schema)


def coverage(tokens: DataFrame, ids: str, size: int, unknown: int | None = None) -> DataFrame:
    """Tokens, share of unknown ones in percent (0 for a vocabulary without an unknown token), used ids, utilisation in percent, and a grade."""
    unknown = -1 if unknown is None else unknown
    c = tokens.select(F.explode(ids).alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    g = c.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.coalesce(F.sum(F.when(F.col("t") == unknown, F.col("n"))), F.lit(0)).alias("unknown"), F.count("*").alias("used"))
    rate = F.col("unknown") * 100.0 / F.greatest(F.col("tokens"), F.lit(1))
    return g.select("tokens", rate.alias("unknown_percent"), "used", (F.col("used") * 100.0 / size).alias("utilisation_percent"), (F.lit(size) - F.col("used")).alias("unused"), F.when(rate < 0.1, "excellent").when(rate < 1.0, "good").otherwise("needs improvement").alias("grade"))


def word_round_trips(words: DataFrame, word: str, n: str, path: str) -> DataFrame:
    """Of ``(word, n)``: the percentage of words that come back from their ids, and of words of several tokens, by ``n``. Each different word is encoded once."""
    there = decoded(encoded(words, word, path, "__ids"), "__ids", path, "__back")
    total = F.greatest(F.sum(n), F.lit(1))
    share = lambda c: F.sum(F.when(c, F.col(n)).otherwise(0)) * 100.0 / total
    return there.agg(share(F.trim("__back") == F.col(word)).alias("preserved_percent"), share(F.size("__ids") > 1).alias("subword_percent"), F.sum(n).alias("words"))


def tokenizer_score(unknown_percent, ratio, regular, preserved_percent):
    """The weighted score of a tokenizer (0 to 100) from coverage, tokens a character, regular vocabulary and preserved words."""
    zero, most = F.lit(0.0), F.lit(100.0)
    return (
        F.greatest(zero, most - unknown_percent * 10) * 0.3 + F.greatest(zero, most - F.abs(ratio - 0.25) * 200) * 0.25 + F.least(most, regular / 320.0) * 0.2 + preserved_percent * 0.25
    )


def grade(score):
    return F.when(score >= 90, "A").when(score >= 80, "B").when(score >= 70, "C").when(score >= 60, "D").otherwise("F")


def vocabulary_composition(vocabulary: DataFrame, token: str, special: Column, mark: str = "▁") -> DataFrame:
    """Special entries, entries that begin a word (``mark``) and all others, and mean, median, extremes and deviation of the entries' lengths."""
    n = F.length(token)
    begins = F.startswith(token, F.lit(mark)) & ~special
    return vocabulary.agg(
        F.count("*").alias("entries"), F.count_if(special).alias("special"), F.count_if(begins).alias("word_starts"), F.count_if(~special & ~begins).alias("regular"),
        F.avg(n).alias("mean_length"), F.median(n).alias("median_length"), F.min(n).alias("min_length"), F.max(n).alias("max_length"), F.stddev_samp(n).alias("length_deviation"),
    )


def findings(unknown_percent: Column, utilisation_percent: Column, chars_per_token: Column, preserved_percent: Column) -> tuple[Column, Column]:
    """Strengths and weaknesses of a tokenizer, as arrays of what they concern: ``coverage``, ``compression``, ``words``, ``utilisation``."""
    named = lambda *of: F.array_compact(F.array(*[F.when(c, n) for n, c in of]))
    strong = named(("coverage", unknown_percent < 0.5), ("compression", chars_per_token.between(3.5, 4.5)), ("words", preserved_percent > 80))
    return strong, named(("coverage", unknown_percent > 1.0), ("utilisation", utilisation_percent < 80), ("words", preserved_percent < 60))


def rates(observed: dict, seconds: float) -> dict[str, float]:
    """Docs, characters and tokens a second, and tokens a document, of what ``throughput`` observed."""
    s = max(seconds, 1e-9)
    out = {f"{k}_per_second": v / s for k, v in observed.items() if k in ("docs", "chars", "tokens")}
    return out | ({"tokens_per_doc": observed["tokens"] / max(1, observed["docs"])} if "tokens" in observed else {})


def throughput(df: DataFrame, text: str, tokens: str | None = None):
    """``(df, observation)``: what passes through ``df`` is counted while an action runs; ``observation.get`` then has docs, chars and tokens, to be divided by the seconds."""
    from pyspark.sql import Observation

    o = Observation()
    sums = [F.count("*").alias("docs"), F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("chars"), *([F.coalesce(F.sum(tokens), F.lit(0)).alias("tokens")] if tokens else [])]
    return df.observe(o, *sums), o


def dataset_score(accuracy_percent, unknown_percent, distribution_good, samples_good):
    """The weighted score of a dataset's token counts: accuracy, unknown tokens, length distribution and sample round trips."""
    step = lambda c: F.when(c, 100.0).otherwise(70.0)
    return F.least(F.lit(100.0), accuracy_percent) * 0.3 + F.greatest(F.lit(0.0), F.lit(100.0) - unknown_percent * 10) * 0.3 + step(distribution_good) * 0.2 + step(samples_good) * 0.2
