"""Evaluation texts in training documents: q-gram lemma filtering and banded alignment.

Documents and items are folded to their words, single spaces between and around them. A *region* of an
item is a run of ``min_words`` words of its passage, or its whole question; it may hold one edit for every
``chars_per_edit`` characters. By the q-gram lemma, a text
that holds a region of ``n`` characters with at most ``k`` edits shares ``n + 1 - (k + 1) q`` of the region's
q-grams with it, on diagonals (position in the document less position in the item) that lie no more than
``k`` apart. So the documents' q-grams are looked up among the items', the hits are counted in
overlapping bands of diagonals, bands with too few for any region are dropped, and in the others every region that
has enough is aligned with the document inside the band, many regions at a time. The alignment alone says how many edits there are.

The items are the stated query set: they are cut into blocks of bounded size. A scan takes several blocks, whose
indexes of q-grams are sent to the tasks and opened one at a time; it reads the documents once, whole, and shuffles nothing.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.lexicon import portions, words

_BASE = 0x100000001B3 | 1
_SCRAMBLE = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 22


@dataclass(frozen=True)
class Settings:
    #: Consecutive words of a passage that make a leak.
    min_words: int = 10
    #: A region may hold one character edit for so many of its characters.
    chars_per_edit: int = 25
    #: Characters of items in a block, which bound an index: about 16 bytes each.
    block_chars: int = 4_000_000
    #: Blocks that one scan of the documents serves.
    blocks_per_scan: int = 8


def folded(text: str | None) -> str:
    """`` word word … ``; empty if there are no words."""
    found = words(text)
    return f" {' '.join(found)} " if found else ""


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(c: np.ndarray, q: int) -> np.ndarray:
    """A hash of the ``q`` codes from each position on; ``q`` is a power of two."""
    h, width, factor = c.astype(np.uint64), 1, _BASE
    while width < q:
        h = h[:-width] * np.uint64(factor) + h[width:]
        width, factor = width * 2, factor * factor % (1 << 64)
    return h * _SCRAMBLE


@dataclass
class Target:
    """A folded passage or question, the regions to look for as (start, end) in it, the edits that each may hold, and its items."""

    text: str
    part: str
    starts: np.ndarray
    ends: np.ndarray
    edits: np.ndarray
    items: list

    def bounds(self, q: int) -> np.ndarray:
        """The q-grams that each region shares at least."""
        return self.ends - self.starts + 1 - (self.edits + 1) * q


def targets(items: list[tuple], s: Settings) -> list[Target]:
    """Of ``(item, passage, question)`` rows; equal texts are one target with several items."""
    found: dict[tuple[str, str], Target] = {}
    for item, passage, question in items:
        for part, text in (("passage", folded(passage)), ("question", folded(question))):
            blanks = np.flatnonzero(codes(text) == 32) if text else np.empty(0, np.int64)
            n = s.min_words if part == "passage" else len(blanks) - 1
            if n < 1 or len(blanks) <= n:
                continue
            if (part, text) not in found:
                starts, ends = blanks[:-n], blanks[n:] + 1
                found[part, text] = Target(text, part, starts, ends, (ends - starts) // s.chars_per_edit, [])
            found[part, text].items.append(item)
    return list(found.values())


class Index:
    """The q-grams of targets that share ``q``."""

    def __init__(self, of: list[Target], q: int) -> None:
        self.targets, self.q = of, q
        self.least = np.array([int(t.bounds(q).min()) for t in of], np.int64)
        self.longest = max(len(t.text) for t in of)
        #: Half the width of a band of diagonals; bands overlap by as much, so diagonals that ``half`` edits drift over lie in one.
        self.half = max(8, max(int(t.edits.max()) for t in of))
        with np.errstate(over="ignore"):
            each = [grams(codes(t.text), q) for t in of]
        h = np.concatenate(each)
        target = np.repeat(np.arange(len(of)), [len(x) for x in each])
        position = np.concatenate([np.arange(len(x)) for x in each])
        order = np.argsort(h, kind="stable")
        self.hash, self.target, self.position = h[order], target[order].astype(np.int32), position[order].astype(np.int32)
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self.hash >> np.uint64(64 - _TABLE_BITS)] = True

    def hits(self, all_codes: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """``(position, target, position in the target)`` of every q-gram that is a target's too; None for more than ``most``."""
        with np.errstate(over="ignore"):
            h = grams(all_codes, self.q)
        at = np.flatnonzero(self.table[h >> np.uint64(64 - _TABLE_BITS)])
        lo = np.searchsorted(self.hash, h[at], "left")
        n = np.searchsorted(self.hash, h[at], "right") - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        if most is not None and n.sum() > most:
            return None
        entry = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(at, n), self.target[entry], self.position[entry]


def indexes(of: list[Target]) -> list[Index]:
    """One index for each q: the largest of 16, 8, 4, 2, 1 that leaves every region a bound of at least one q-gram (q = 1 always does)."""
    groups: dict[int, list[Target]] = {}
    for t in of:
        groups.setdefault(next(q for q in (16, 8, 4, 2, 1) if q == 1 or t.bounds(q).min() >= 1), []).append(t)
    return [Index(ts, q) for q, ts in groups.items()]


def banded_edits(region: np.ndarray, length: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The fewest edits that make each region a substring of its stretch of text, along the stretch's diagonals.

    Row i of ``region`` (codes, ``length[i]`` of them count) meets row i of ``text``, in which the region's first character may stand at any of the
    ``text.shape[1] - region.shape[1] + 1`` places of the band. All rows are aligned together, a character of the regions at a time; insertions along the
    band are a running minimum.
    """
    rows, longest = region.shape
    width = text.shape[1] - longest + 1
    step = np.arange(width)
    cost = np.zeros((rows, width), np.int32)
    best = np.full(rows, longest + 1, np.int32)
    best[length == 0] = 0
    for i in range(longest):
        changed = cost + (text[:, i : i + width] != region[:, i, None])
        changed[:, :-1] = np.minimum(changed[:, :-1], cost[:, 1:] + 1)  # the region's character is left out
        cost = np.minimum.accumulate(changed - step, axis=1) + step  # characters of the text are put in
        done = length == i + 1
        if done.any():
            best[done] = cost[done].min(axis=1)
    return best


#: Hits of a slice of documents that are looked at together, and cells of alignments.
_MOST_HITS, _MOST_CELLS = 4_000_000, 2_000_000


def _candidates(hit: tuple[np.ndarray, np.ndarray, np.ndarray], offsets: np.ndarray, sizes: np.ndarray, index: Index) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(document, target, regions, lowest, highest diagonal)`` of the regions that have enough q-grams in a band."""
    at, target, position = hit
    doc = np.searchsorted(offsets, at, "right") - 1
    diagonal = at - offsets[doc] - position
    pair = doc.astype(np.int64) * len(index.targets) + target
    width = 2 * index.half
    span = int(sizes.max()) + index.longest + 2 * width
    for shift in (0, index.half):
        key = pair * (2 * span // width + 2) + (diagonal + span + shift) // width
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        starts = np.flatnonzero(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]))
        counts = np.diff(np.append(starts, len(sorted_key)))
        for i in np.flatnonzero(counts >= index.least[target[order[starts]]]):
            member = order[starts[i] : starts[i] + counts[i]]
            of = index.targets[int(target[member[0]])]
            places = np.sort(position[member])
            places = places[np.concatenate([[True], places[1:] != places[:-1]])]
            count = np.searchsorted(places, of.ends - index.q, "right") - np.searchsorted(places, of.starts, "left")
            regions = np.flatnonzero((count >= of.bounds(index.q)) & (count > 0))
            if len(regions):
                d = diagonal[member]
                yield int(doc[member[0]]), int(target[member[0]]), regions, np.full(len(regions), d.min()), np.full(len(regions), d.max())


def scan(texts: list[str | None], index: Index) -> Iterator[tuple[int, Target, int, int]]:
    """``(document, target, regions, edits)``: the regions of a target that a document holds with the fewest edits found, if these are within the regions' bounds."""
    q = index.q
    docs = [folded(t) for t in texts]
    sizes = np.array([len(d) + q for d in docs], np.int64)
    joined = codes(("\0" * q).join(docs) + "\0" * q)
    offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    if len(joined) < q:
        return
    hit = index.hits(joined, _MOST_HITS if len(texts) > 1 else None)
    if hit is None:  # q-grams that many items share: fewer documents at a time
        half = len(texts) // 2
        yield from scan(texts[:half], index)
        for d, of, regions, edits in scan(texts[half:], index):
            yield d + half, of, regions, edits
        return
    if not len(hit[0]):
        return
    found: dict[tuple[int, int], dict[int, int]] = {}
    held: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = []

    def align() -> None:
        doc = np.repeat([h[0] for h in held], [len(h[2]) for h in held])
        target = np.repeat([h[1] for h in held], [len(h[2]) for h in held])
        region, low, high = (np.concatenate([h[i] for h in held]) for i in (2, 3, 4))
        start = np.array([index.targets[t].starts[r] for t, r in zip(target, region, strict=True)])
        end = np.array([index.targets[t].ends[r] for t, r in zip(target, region, strict=True)])
        allowed = np.array([index.targets[t].edits[r] for t, r in zip(target, region, strict=True)])
        length = end - start
        wide = int((high - low + 2 * allowed).max()) + 1
        longest = int(length.max())
        what = np.zeros((len(doc), longest), np.uint32)
        for i, (t, s, e) in enumerate(zip(target, start, end, strict=True)):
            what[i, : e - s] = targets_codes[t][s:e]
        # the band's first diagonal; beyond a document lies \0, which no region holds
        first = offsets[doc] + start + low - allowed
        at = first[:, None] + np.arange(longest + wide - 1)
        inside = (at >= offsets[doc][:, None]) & (at < (offsets + sizes)[doc][:, None])
        where = np.where(inside, joined[np.clip(at, 0, len(joined) - 1)], np.uint32(0))
        edits = banded_edits(what, length, where)
        for d, t, r, n, k in zip(doc.tolist(), target.tolist(), region.tolist(), edits.tolist(), allowed.tolist(), strict=True):
            if n <= k:
                of_pair = found.setdefault((d, t), {})
                of_pair[r] = min(n, of_pair.get(r, n))
        held.clear()

    targets_codes: dict[int, np.ndarray] = {}
    cells = 0
    for c in _candidates(hit, offsets, sizes, index):
        if c[1] not in targets_codes:
            targets_codes[c[1]] = codes(index.targets[c[1]].text)
        held.append(c)
        of = index.targets[c[1]]
        cells += len(c[2]) * int((of.ends - of.starts).max()) * 3 * index.half
        if cells > _MOST_CELLS:
            align()
            cells = 0
    if held:
        align()
    for (d, t), regions in found.items():
        least = min(regions.values())
        yield d, index.targets[t], sum(n == least for n in regions.values()), least


def find_leaks(documents: DataFrame, items: DataFrame, document: str = "doc_id", text: str = "text", item: str = "item_id", passage: str = "passage", question: str = "question", s: Settings = Settings()) -> DataFrame:
    """``(document, item, part, words, edits)`` of every document that holds a region of an item.

    ``part`` is ``passage`` or ``question``, ``words`` the number of consecutive words held (of the regions with the
    fewest edits), ``edits`` the character edits of these (0: word for word). Items with the same passage all count.
    Null and blank texts, passages of fewer than ``s.min_words`` words and questions without words hold nothing. Every
    row of ``documents`` is looked at on its own, repeated rows give repeated results; repeated rows of ``items`` count once. Columns keep the names of
    ``document`` and ``item``.

    Items are gathered block by block, ``s.block_chars`` characters at a time whatever passages they share, and the documents are read once for
    ``s.blocks_per_scan`` blocks.
    """
    doc_type = documents.select(document).schema[0].dataType.simpleString()
    item_type = items.select(item).schema[0].dataType.simpleString()
    schema = f"document {doc_type}, item {item_type}, part string, words int, edits int"
    inner = documents.select(F.col(document).alias("__id"), F.col(text).alias("__text")).where(F.col("__text").isNotNull())
    chosen = items.select(F.col(item).alias("__item"), F.col(passage).alias("__p"), F.col(question).alias("__q")).distinct()
    chars = chosen.agg(F.sum(F.coalesce(F.length("__p"), F.lit(0)) + F.coalesce(F.length("__q"), F.lit(0))).cast("bigint")).first()[0] or 0
    blocks = -(-chars // s.block_chars) or 1
    sc = documents.sparkSession.sparkContext
    shared = []
    for block in range(blocks):
        part = chosen.where(F.pmod(F.xxhash64("__p", "__q", "__item"), F.lit(blocks)) == block) if blocks > 1 else chosen
        shared.append(sc.broadcast(cloudpickle.dumps(indexes(targets([tuple(r) for r in part.collect()], s)))))
    results = []
    for first in range(0, blocks, s.blocks_per_scan):

        def run(batches: Iterator[pa.RecordBatch], some=tuple(shared[first : first + s.blocks_per_scan])) -> Iterator[pa.RecordBatch]:
            opened = pickle.loads(some[0].value) if len(some) == 1 else None
            for b in batches:
                ids, texts = b.column("__id"), b.column("__text").to_pylist()
                for one in some:
                    for index in opened or pickle.loads(one.value):
                        rows, out = [], []
                        for start, end in portions(texts):
                            for d, of, regions, edits in scan(texts[start:end], index):
                                n = regions + s.min_words - 1 if of.part == "passage" else of.text.count(" ") - 1
                                for i in of.items:
                                    rows.append(start + d)
                                    out.append((i, of.part, n, edits))
                        if rows:
                            columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (None, pa.string(), pa.int32(), pa.int32()), strict=True)]
                            yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), *columns], names=["document", "item", "part", "words", "edits"])

        results.append(inner.mapInArrow(run, schema))
    whole = results[0]
    for r in results[1:]:
        whole = whole.unionAll(r)
    return whole.withColumnsRenamed({"document": document, "item": item})
