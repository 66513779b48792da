"""Exact and near-duplicate removal where the first document in a total order wins.

Near-duplicates are documents whose MinHash signatures agree in a whole band; similarity itself isn't looked at (``verify`` does).
A document is dropped if it agrees with an *earlier kept* one: dropped documents drop nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import BLANK, NOT_BLANK, blank_words, char_shingles
from quern.session import checkpointed

PRIME = (1 << 31) - 1


def exact_first(df: DataFrame, text: str, order: str) -> DataFrame:
    """One row for each different ``text``: the one with the smallest ``order``, which must not be null. Null texts are one text.

    Only fingerprints and orders are aggregated, and copies collapse in the partial step, so a text that makes up a third of the rows is no task of its own;
    whole rows move once, to meet the orders that won. Repeated rows of one order are one row. ``df`` is read twice: checkpoint what is costly to make.
    """
    fp = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("\0null")), 256))
    firsts = df.select(fp.alias("__fp"), F.col(order).alias("__first")).groupBy("__fp").agg(F.min("__first").alias("__first"))
    return df.join(firsts.select("__first"), F.col(order) == F.col("__first"), "left_semi").dropDuplicates([order])


@lru_cache
def bands_for(threshold: float, permutations: int) -> tuple[int, int]:
    """``(bands, rows)`` with the least sum of false positives and negatives around the threshold, in equal parts."""
    s = np.linspace(0, 1, 2001)
    below, above = s < threshold, s >= threshold
    best = (float("inf"), 1, 1)
    for rows in range(1, permutations + 1):
        for b in range(1, permutations // rows + 1):
            hit = 1 - (1 - s**rows) ** b
            error = float(hit[below].sum() + (1 - hit[above]).sum()) / len(s)
            best = min(best, (error, b, rows))
    return best[1], best[2]


def md5_number(text: str) -> int:
    """The first 28 bits of a text's MD5: a hash that any engine has."""
    return int(hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()[:7], 16)


def permutation(i: int) -> tuple[int, int]:
    """Factor and summand of the ``i``-th permutation ``(a x + b) mod (2^31 - 1)`` of hashes."""
    return md5_number(f"a{i}") + 1, md5_number(f"b{i}")


def minhash_bands(df: DataFrame, order: str, shingles: Column, threshold: float, permutations: int = 128) -> DataFrame:
    """``(ord, key)``: a 64-bit key for each band of each document with shingles.

    Hashes are ``md5_number`` and ``permutation``, so signatures can be repeated in SQL. In each Arrow batch every different shingle is hashed and permuted once; a
    document's signature is then the smallest of its shingles' rows.
    """
    bands, rows = bands_for(threshold, permutations)
    pairs = [permutation(i) for i in range(bands * rows)]
    a, b = (np.array(x, np.uint64) for x in zip(*pairs, strict=True))
    listed = df.select(F.col(order).alias("__id"), shingles.alias("x")).where(F.size("x") > 0)
    kind = df.select(order).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            lists = batch.column("x")
            different = lists.values.dictionary_encode()
            codes, ends = different.indices.to_numpy(), lists.offsets.to_numpy()
            x = np.empty(len(different.dictionary), np.uint64)
            if len(known) > 1_000_000:
                known.clear()
            for i, t in enumerate(different.dictionary.to_pylist()):
                h = known.get(t)
                if h is None:
                    h = known[t] = int(hashlib.md5(t.encode("utf-8", "surrogatepass")).hexdigest()[:7], 16)
                x[i] = h
            table = np.empty((len(x), bands * rows), np.uint32)
            for at in range(0, len(x), 4096):
                table[at : at + 4096] = (x[at : at + 4096, None] * a + b) % np.uint64(PRIME)
            keys = np.empty((batch.num_rows, bands), np.int64)
            for i in range(batch.num_rows):
                sig = table[codes[ends[i] : ends[i + 1]]].min(axis=0).reshape(bands, rows).astype(np.uint64)
                with np.errstate(over="ignore"):
                    k = np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    for j in range(rows):
                        k = (k ^ sig[:, j]) * np.uint64(0xBF58476D1CE4E5B9)
                        k ^= k >> np.uint64(29)
                keys[i] = k.view(np.int64)
            flat = pa.array(np.repeat(np.arange(batch.num_rows), bands))
            yield pa.RecordBatch.from_arrays([batch.column("__id").take(flat), pa.array(keys.ravel())], names=["ord", "key"])

    return listed.mapInArrow(run, f"ord {kind}, key bigint")


def _folded(undecided: DataFrame) -> DataFrame:
    """``(ord)`` of the documents that lose, by one pass over ``(ord, key)`` in order, in one task."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken: set[int] = set()
        at, keys = None, []

        def lost() -> bool:
            if any(k in taken for k in keys):
                return True
            taken.update(keys)
            return False

        for b in batches:
            orders, losers = b.column("ord").to_pylist(), []
            for o, k in zip(orders, b.column("key").to_pylist(), strict=True):
                if o != at:
                    if keys and lost():
                        losers.append(at)
                    at, keys = o, []
                keys.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(losers, b.column("ord").type)], names=["ord"])
        if keys and lost():
            yield pa.RecordBatch.from_arrays([pa.array([at], b.column("ord").type)], names=["ord"])

    return undecided.repartition(1).sortWithinPartitions("ord").mapInArrow(fold, f"ord {undecided.schema['ord'].dataType.simpleString()}")


def first_wins(bands: DataFrame, fold_rows: int = 1_000_000) -> DataFrame:
    """``(ord)`` of the documents to drop, of ``(ord, key)``: those that share a key with an earlier kept document.

    Keys of one document go first, and with them all documents that share nothing. What is left is decided in rounds: a document that is the first undecided one in
    all its keys is kept, and the others in these keys are dropped. A key is aggregated to its first document, so a key that many documents share costs no more than
    its rows. As soon as at most ``fold_rows`` rows (a few dozen bytes each) are undecided, one task decides them in order, so that long chains don't take a round a
    link. Both ways are exact. Rounds end in checkpoints.
    """
    every = checkpointed(bands.distinct())
    several = every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    undecided = checkpointed(every.join(several, "key", "left_semi"))
    dropped: list[DataFrame] = []
    while undecided.limit(fold_rows + 1).count() > fold_rows:
        firsts = undecided.groupBy("key").agg(F.min("ord").alias("first"), F.max("ord").alias("last"))
        shared = undecided.join(firsts, "key")
        ahead = checkpointed(shared.groupBy("ord").agg(F.min("first").alias("first")).where("first = ord").select("ord"))  # nobody before it in any key
        taken = firsts.where("first < last").join(ahead.withColumnRenamed("ord", "first"), "first", "left_semi").select("key", "first")
        losing = checkpointed(undecided.join(taken, "key").where("ord > first").select("ord").distinct())
        dropped.append(losing)
        undecided = checkpointed(undecided.join(losing.unionAll(ahead), "ord", "left_anti"))
    lost = _folded(undecided)
    for d in dropped:
        lost = lost.unionAll(d)
    return lost


def _without(df: DataFrame, order: str, dropped: DataFrame) -> DataFrame:
    return df.join(dropped.select(F.col("ord").alias("__ord")), F.col(order) == F.col("__ord"), "left_anti")


def near_first(df: DataFrame, text: str, order: str, threshold: float = 0.8, permutations: int = 128, k: int = 3) -> DataFrame:
    """Exact copies, texts without a run of ``k`` characters, and near-duplicates by character runs removed."""
    kept = exact_first(df, text, order).where(F.length(F.replace(F.col(text), F.lit(" "), F.lit(""))) >= k)
    return _without(kept, order, first_wins(minhash_bands(kept, order, char_shingles(F.col(text), k), threshold, permutations)))


def near_first_words(df: DataFrame, text: str, order: str, threshold: float = 0.85, permutations: int = 128, short_exact: bool = False) -> DataFrame:
    """Copies and near-duplicates by sets of words removed.

    Texts of fewer than 5 words are neither recorded nor compared: all of them stay, copies too (one of each with ``short_exact``).
    """
    short = df.where(~has_words(F.col(text)))
    kept = exact_first(df.where(has_words(F.col(text))), text, order)
    long = _without(kept, order, first_wins(minhash_bands(kept, order, F.array_distinct(blank_words(F.col(text))), threshold, permutations)))
    return long.unionByName(exact_first(short, text, order) if short_exact else short)


def has_words(text: Column, n: int = 5) -> Column:
    """Whether ``text`` has ``n`` pieces between white space; false for null. The search ends at the ``n``-th."""
    return F.coalesce(text.rlike(rf"(?:(?:[!-~]++|{NOT_BLANK})++{BLANK}++){{{n - 1}}}{NOT_BLANK}"), F.lit(False))


class Admission:
    """What one deduplication over several sources remembers: the fingerprints and band keys of the documents that were admitted.

    Sources come in turn, as what a source's budget shut out doesn't shut out later copies; each is hashed once, whatever came before it. ``near`` is ``words``
    (texts of fewer than 5 words are all admitted and never remembered), ``characters`` (texts without a run of ``k`` characters are dropped) or None (exact copies).
    """

    def __init__(self, near: str | None = "words", threshold: float = 0.85, permutations: int = 128, k: int = 3) -> None:
        self.near, self.threshold, self.permutations, self.k = near, threshold, permutations, k
        self.fingerprints: DataFrame | None = None
        self.keys: DataFrame | None = None

    def admit(self, df: DataFrame, text: str, order: str, limit: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
        """The rows of a source that no admitted document shuts out and ``limit`` (a budget) leaves, checkpointed; ``order`` must be unique in ``df``.

        ``text`` and all other columns travel once to the exact step and once to the final join; what is remembered are 32 bytes a document and 8 a band.
        """
        fp = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("\0null")), 256)).alias("__fp")
        compared = {"words": has_words(F.col(text)), "characters": F.length(F.replace(F.col(text), F.lit(" "), F.lit(""))) >= self.k}.get(self.near, F.lit(True))
        short = df.where(~compared) if self.near == "words" else df.limit(0)
        fresh = checkpointed(df.where(compared).select(F.col(order).alias("__ord"), fp).groupBy("__fp").agg(F.min("__ord").alias("__ord")))
        if self.fingerprints is not None:
            fresh = fresh.join(self.fingerprints, "__fp", "left_anti")
        kept = df.join(fresh.select("__ord"), F.col(order) == F.col("__ord"), "left_semi")
        bands = None
        if self.near:
            shingles = F.array_distinct(blank_words(F.col(text))) if self.near == "words" else char_shingles(F.col(text), self.k)
            bands = checkpointed(minhash_bands(kept, order, shingles, self.threshold, self.permutations))
            rest = bands
            if self.keys is not None:
                shut_out = checkpointed(bands.join(self.keys, "key", "left_semi").select("ord").distinct())
                rest = bands.join(shut_out, "ord", "left_anti")
                kept = _without(kept, order, shut_out)
            kept = _without(kept, order, first_wins(rest))
        admitted = checkpointed(limit(kept.unionByName(short)))
        orders = admitted.select(F.col(order).alias("ord"))
        self.fingerprints = self._with(self.fingerprints, admitted.where(compared).select(fp))
        if bands is not None:
            self.keys = self._with(self.keys, bands.join(orders, "ord", "left_semi").select("key").distinct())
        return admitted

    @staticmethod
    def _with(known: DataFrame | None, new: DataFrame) -> DataFrame:
        new = checkpointed(new)
        return new if known is None else known.unionAll(new)


def lsh_first(df: DataFrame, text: str, order: str, threshold: float = 0.85, permutations: int = 128) -> DataFrame:
    """Near-duplicates by sets of words removed, without the exact step and without an exemption for short texts: texts without words stay."""
    bands = minhash_bands(df.where(F.col(text).isNotNull()), order, F.array_distinct(blank_words(F.col(text))), threshold, permutations)
    return _without(df, order, first_wins(bands))


def dedup_statistics(before: DataFrame, after: DataFrame) -> DataFrame:
    """Documents processed, unique and duplicate, and the duplicates' share of those processed."""
    n = before.agg(F.count("*").alias("processed")).crossJoin(after.agg(F.count("*").alias("unique_docs")))
    return n.select("processed", "unique_docs", (F.col("processed") - F.col("unique_docs")).alias("duplicates"), ((F.col("processed") - F.col("unique_docs")) / F.nullif(F.col("processed"), F.lit(0))).alias("rate"))
