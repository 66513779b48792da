"""Near-duplicate records with small edits: ProbMinHash, banding and verification.

Every record's words are hashed, runs of ``k`` words become weighted elements, and each element sends
out the arrivals of a Poisson process whose rate is its weight. An arrival falls on a random one of
``m`` registers; a register keeps the element that arrives first. Arrivals come in the order of time, so an
element whose time has passed the last register's can be dropped (early termination): about
``m ln m`` arrivals a record are drawn, however long it is. Two records agree in a register with
the probability Jaccard similarity of their weights, which for equal weights (``weights="set"``) is the
ordinary Jaccard similarity of the sets.

The signature is cut into ``bands`` of ``rows`` registers. Records with the same (weighted) elements are one
*class* and go on as one, so that copies never meet each other. Classes that agree in a band are
candidates; each candidate pair is then verified on the elements themselves. With 26 bands of 4 rows a
pair of similarity 0.7 is missed with probability (1 - 0.7^4)^26 = 0.0008, of 0.8 with 1e-6.

A band key that very many classes share comes of text that they all carry, and says little about any two of
them. Such classes are paired by *prefixes* instead: of a class's elements, the rarest first, two classes of similarity t
must share one of those that make up a share of 1 - t of its weight. That is exact, and text which all carry is no rare element.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.lexicon import WORD, portions
from quern.session import broadcast_if_small, checkpointed

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@dataclass(frozen=True)
class Settings:
    """How records are compared. ``min_words``: records with fewer words take no part."""

    k: int = 5
    threshold: float = 0.8
    bands: int = 26
    rows: int = 4
    min_words: int = 0
    #: ``set`` compares sets by Jaccard similarity, ``count`` the elements' counts by probability Jaccard similarity.
    weights: str = "set"
    #: Classes of one band key that are paired by it; those of larger ones are paired by prefixes, without loss.
    bucket: int = 1000
    #: Candidate ids up to this number are broadcast (8 bytes each, and as much again for the table).
    max_broadcast_ids: int = 1_000_000

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


class WordHashes:
    """64-bit hashes of words; the last ``limit`` words seen or so are kept."""

    def __init__(self, limit: int = 200_000) -> None:
        self.known: dict[str, int] = {}
        self.limit = limit

    def of(self, found: list[str]) -> list[int]:
        known = self.known
        try:
            return [known[w] for w in found]
        except KeyError:
            if len(known) > self.limit:
                known.clear()
            for w in found:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            return [known[w] for w in found]


def shingles(texts: list[str], k: int, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(row, element, count, words)``: the distinct runs of ``k`` words of each text, sorted by row and element, and each text's number of words."""
    flat: list[int] = []
    sizes = np.empty(len(texts), np.int64)
    for i, t in enumerate(texts):
        found = WORD.findall(t.lower())
        sizes[i] = len(found)
        flat += hashes.of(found)
    h = np.array(flat, np.uint64)
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), sizes
    with np.errstate(over="ignore"):
        run = h[:n].copy()
        for j in range(1, k):
            run = mixed(run * np.uint64(3) + _GOLDEN) + h[j : j + n]
        run = mixed(run)
    row = np.repeat(np.arange(len(texts)), sizes)[:n]
    left = (np.cumsum(sizes))[row] - np.arange(n)  # words from here to the end of the text
    ok = left >= k
    row, run = row[ok], run[ok]
    order = np.lexsort((run, row))
    row, run = row[order], run[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (run[1:] != run[:-1])
    starts = np.flatnonzero(first)
    return row[starts], run[starts], np.diff(np.append(starts, len(row))), sizes


def probminhash(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n_rows: int, m: int) -> np.ndarray:
    """The signatures of ``n_rows`` records as an array of ``n_rows`` x ``m`` elements (0: no element).

    All records of a batch advance together, one arrival of every element that is still alive at a
    time. ``weight`` is the rate of an element's arrivals.
    """
    first = np.full(n_rows * m, np.inf)
    kept = np.zeros(n_rows * m, np.uint64)
    time = np.zeros(len(row))
    state = mixed(element ^ _GOLDEN)
    inverse = 1.0 / weight
    with np.errstate(over="ignore"):
        while len(row):
            state = state + _GOLDEN
            r = mixed(state)
            u = ((r >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))
            time = time - np.log(u) * inverse
            at = row * m + (mixed(r ^ _MIX1) % np.uint64(m)).astype(np.int64)
            sooner = time < first[at]
            if sooner.any():
                i, t, e = at[sooner], time[sooner], element[sooner]
                np.minimum.at(first, i, t)
                won = first[i] == t
                kept[i[won]] = e[won]
            alive = time < first.reshape(n_rows, m).max(axis=1)[row]
            if not alive.all():
                row, element, time, state, inverse = row[alive], element[alive], time[alive], state[alive], inverse[alive]
    return kept.reshape(n_rows, m)


def _set_keys(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each record's elements: records with the same elements and weights have the same."""
    a, b = np.zeros(n_rows, np.uint64), np.zeros(n_rows, np.uint64)
    with np.errstate(over="ignore"):
        weighted = element + weight.astype(np.uint64) * _GOLDEN
        np.add.at(a, row, mixed(weighted ^ _MIX1))
        np.add.at(b, row, mixed(weighted ^ _MIX2))
    return a, b


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """The probability Jaccard similarity of weights ``x`` of the sorted elements ``a`` and ``y`` of ``b``.

    It is the sum over the common elements i of 1 / sum over all j of max(x_j / x_i, y_j / y_i). Sorted by y / x, the maximum is the first
    term for all j up to i and the second beyond.
    """
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(at_a):
        return 0.0
    p, q = x[at_a].astype(float), y[at_b].astype(float)
    order = np.argsort(q / p, kind="stable")
    p, q = p[order], q[order]
    ratio = q / p
    last = np.searchsorted(ratio, ratio, "right")  # equal ratios count on one side
    only_x, only_y = x.sum() - p.sum(), y.sum() - q.sum()
    first = only_x + np.append(0.0, np.cumsum(p))[last]
    rest = only_y + q.sum() - np.append(0.0, np.cumsum(q))[last]
    return float((1.0 / (first / p + rest / q)).sum())


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def signatures(df: DataFrame, record: str, text: Column, s: Settings) -> DataFrame:
    """``(record, class, check, n, band_keys)`` of the records that have an element and ``min_words`` words.

    ``class`` and ``check`` are two 64-bit keys of the record's (weighted) elements, ``n`` is the number of different ones,
    ``band_keys`` holds a 64-bit key for each band.
    """
    kind = df.select(record).schema[0].dataType.simpleString()
    inner = df.select(F.col(record).alias("__id"), text.alias("__text")).where(F.col("__text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for whole in batches:
            texts = whole.column("__text").to_pylist()
            for start, end in portions(texts):
                b = whole.slice(start, end - start)
                row, element, count, sizes = shingles(texts[start:end], s.k, hashes)
                n = np.bincount(row, minlength=b.num_rows)
                take = np.flatnonzero((n > 0) & (sizes >= s.min_words))
                if not len(take):
                    continue
                to = np.full(b.num_rows, -1)
                to[take] = np.arange(len(take))
                ok = to[row] >= 0
                row, element, count = to[row[ok]], element[ok], count[ok]
                weight = count if s.weights == "count" else np.ones(len(count), np.int64)
                name, check = _set_keys(row, element, weight, len(take))
                sig = probminhash(row, element, weight.astype(float), len(take), s.registers)
                with np.errstate(over="ignore"):
                    key = np.zeros((len(take), s.bands), np.uint64)
                    for j in range(s.rows):
                        key = mixed(key * np.uint64(31) + sig[:, j :: s.rows])
                    key = mixed(key + np.arange(s.bands, dtype=np.uint64) * _GOLDEN)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, key.size + 1, s.bands), pa.int32()), _signed(key.ravel()))
                columns = [b.column("__id").take(pa.array(take)), _signed(name), _signed(check), pa.array(n[take], pa.int32()), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["record", "class", "check", "n", "band_keys"])

    return inner.mapInArrow(run, f"record {kind}, class bigint, check bigint, n int, band_keys array<bigint>")


def elements(df: DataFrame, text: Column, s: Settings) -> DataFrame:
    """``(class, elements, weights)``: the sorted distinct elements, as signed numbers, of each record of ``df`` that has any, and their weights."""
    inner = df.select(text.alias("__text")).where(F.col("__text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for texts in (b.column("__text").to_pylist() for b in batches):
            for start, end in portions(texts):
                row, element, count, _ = shingles(texts[start:end], s.k, hashes)
                weight = count if s.weights == "count" else np.ones(len(count), np.int64)
                name, _ = _set_keys(row, element, weight, end - start)
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=end - start))]), pa.int32())
                yield pa.RecordBatch.from_arrays([_signed(name), pa.ListArray.from_arrays(ends, _signed(element)), pa.ListArray.from_arrays(ends, pa.array(weight, pa.int32()))], names=["class", "elements", "weights"])

    return inner.mapInArrow(run, "class bigint, elements array<bigint>, weights array<int>").where(F.size("elements") > 0)


@dataclass
class Groups:
    """``members``: (record, class, check) of every record that took part; ``links``: (class_a, class_b, similarity), class_a < class_b."""

    members: DataFrame
    links: DataFrame


def _elements_of(df: DataFrame, record: str, text: Column, signed: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """``elements`` of the ``classes`` only: one record of each is read again."""
    reps = checkpointed(signed.select("record", "class").join(classes, "class", "left_semi").groupBy("class").agg(F.min("record").alias("__rep")))
    ids = broadcast_if_small(reps.select("__rep").distinct(), s.max_broadcast_ids)
    return elements(df.join(ids, df[record] == ids["__rep"], "left_semi"), text, s).dropDuplicates(["class"])


def _pairs_by_prefix(sets: DataFrame, s: Settings) -> DataFrame:
    """``(class_a, class_b, n_a, n_b)`` of all classes of ``sets`` that may have the similarity ``s.threshold``."""
    each = sets.select("class", F.size("elements").alias("n"), F.explode(F.arrays_zip("elements", "weights")).alias("e"), F.aggregate("weights", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("mass"))
    each = each.select("class", "n", "mass", F.col("e.elements").alias("element"), F.col("e.weights").alias("weight"))
    common = each.groupBy("element").agg(F.count("*").alias("classes")).where("classes > 1")  # an element of one class pairs nothing, and is the rarest
    w = Window.partitionBy("class").orderBy("classes", "element").rowsBetween(Window.unboundedPreceding, -1)
    ranked = each.join(common, "element", "left").fillna(1, ["classes"]).withColumn("before", F.coalesce(F.sum("weight").over(w), F.lit(0)))
    prefix = ranked.where((F.col("classes") > 1) & (F.col("before") <= (1 - s.threshold) * F.col("mass") + 1e-9)).select("element", "class", "n")
    a, b = (prefix.select("element", F.col("class").alias(f"class_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
    return a.join(b, "element").where(F.col("class_a") < F.col("class_b")).drop("element")


def near_duplicates(df: DataFrame, record: str, text: Column, s: Settings = Settings()) -> Groups:
    """Links between all different classes whose similarity is at least ``s.threshold``, and the classes' members.

    Exact copies (records with the same elements and weights) are members of one class and are not paired; nothing
    else is merged, capped or dropped. Null texts and records with fewer than ``s.min_words`` words or no
    element take no part. A record that is delivered several times counts once for each set of elements it came
    with. An empty table gives empty results. ``s.weights`` says what is searched for and measured: the Jaccard similarity of sets, or
    the probability Jaccard similarity of counts.

    What is shuffled: a signature for each record (8 bytes a band), then one key and class for each band and
    class, never texts; texts are read again only for records whose class is in a candidate pair.
    """
    signed = checkpointed(signatures(df, record, text, s))
    members = signed.select("record", "class", "check").distinct()
    classes = signed.groupBy("class", "check").agg(F.first("band_keys").alias("band_keys"), F.first("n").alias("n"))
    bands = classes.select(F.explode("band_keys").alias("key"), "class", "n")
    shared = checkpointed(bands.join(bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "key"))
    a, b = (shared.where(F.col("size") <= s.bucket).select("key", F.col("class").alias(f"class_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
    pairs = a.join(b, "key").where(F.col("class_a") < F.col("class_b")).drop("key")
    crowded = shared.where(F.col("size") > s.bucket).select("class").distinct()
    if not crowded.isEmpty():
        pairs = pairs.unionByName(_pairs_by_prefix(_elements_of(df, record, text, signed, crowded, s), s))
    if s.weights == "set":  # a similarity of t needs sizes that differ by a factor of 1/t at most
        pairs = pairs.where(F.least("n_a", "n_b") >= s.threshold * F.greatest("n_a", "n_b") - 1e-9)
    candidates = checkpointed(pairs.distinct())
    wanted = candidates.select(F.col("class_a").alias("class")).union(candidates.select(F.col("class_b"))).distinct()
    sets = _elements_of(df, record, text, signed, wanted, s)
    sets_a, sets_b = (sets.select(F.col("class").alias(f"class_{x}"), F.col("elements").alias(f"elements_{x}"), F.col("weights").alias(f"weights_{x}")) for x in "ab")
    both = candidates.join(sets_a, "class_a").join(sets_b, "class_b")
    if s.weights == "set":
        common = F.size(F.array_intersect("elements_a", "elements_b"))
        measured = both.select("class_a", "class_b", (common / (F.col("n_a") + F.col("n_b") - common)).alias("similarity"))
    else:
        measured = both.select("class_a", "class_b", "elements_a", "weights_a", "elements_b", "weights_b").mapInArrow(_measured, "class_a bigint, class_b bigint, similarity double")
    return Groups(members, measured.where(F.col("similarity") >= s.threshold - 1e-12))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = [b.column(f"{c}_{x}") for x in "ab" for c in ("elements", "weights")]
        found = []
        for i in range(b.num_rows):
            e, v, f, w = (c[i].values.to_numpy(zero_copy_only=False) for c in lists)
            found.append(probability_jaccard(e, v, f, w))
        yield pa.RecordBatch.from_arrays([b.column("class_a"), b.column("class_b"), pa.array(found, pa.float64())], names=["class_a", "class_b", "similarity"])


def duplicate_pairs(groups: Groups, block: int = 1000) -> DataFrame:
    """``(record_a, record_b)``, record_a < record_b: all pairs of linked records.

    Records of different, linked classes all meet, and so do those of one class, whose texts may differ in case, punctuation,
    white space or repeated passages. A class is cut into blocks of about ``block`` records and each pair of blocks is joined
    under a key of its own, so the square of a large class is spread over tasks. Where pairs of copies aren't wanted, ``class_pairs``
    and ``duplicate_groups`` say the same in a row a link and a row a record.
    """
    sizes = groups.members.groupBy("class").agg(F.count("*").alias("size")).where("size > 1")
    several = groups.members.groupBy("record").agg(F.count("*").alias("__c")).where("__c > 1").select("record", F.lit(True).alias("several"))
    blocks = F.coalesce(F.ceil(F.col("size") / block), F.lit(1)).cast("int")
    m = groups.members.join(sizes, "class", "left").join(several, "record", "left").withColumn("blocks", blocks).withColumn("at", F.pmod(F.xxhash64("record"), "blocks").cast("int"))
    m = checkpointed(m)
    every_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))

    cut = m.where("blocks > 1").select("class", "blocks").distinct()
    links = groups.links.select("class_a", "class_b")
    for x in "ab":
        links = links.join(cut.withColumnRenamed("class", f"class_{x}"), f"class_{x}", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn(f"at_{x}", every_block).drop("blocks")
    of = {x: m.select(F.col("class").alias(f"class_{x}"), F.col("at").alias(f"at_{x}"), F.col("record").alias(x)) for x in "ab"}
    linked = links.join(of["a"], ["class_a", "at_a"]).join(of["b"], ["class_b", "at_b"])

    inside = m.where("size > 1")
    left = inside.select("class", "check", F.col("at").alias("at_a"), every_block.alias("at_b"), F.col("record").alias("a"))
    right = inside.select("class", "check", every_block.alias("at_a"), F.col("at").alias("at_b"), F.col("record").alias("b"))
    pairs = linked.select(F.least("a", "b").alias("record_a"), F.greatest("a", "b").alias("record_b")).union(left.join(right, ["class", "check", "at_a", "at_b"]).where("a < b").select("a", "b"))
    pairs = pairs.where("record_a < record_b")
    # A pair can come twice only if one of its records is in several classes: without any, the pairs aren't shuffled once more.
    return pairs if m.where("several").isEmpty() else pairs.distinct()


def class_pairs(groups: Groups) -> DataFrame:
    """``(rep_a, rep_b, similarity)``, rep_a < rep_b: the links between classes, each named by its smallest record; ``duplicate_groups`` has the members."""
    reps = groups.members.groupBy("class").agg(F.min("record").alias("rep"))
    a, b = (reps.select(F.col("class").alias(f"class_{x}"), F.col("rep").alias(x)) for x in "ab")
    return groups.links.join(a, "class_a").join(b, "class_b").select(F.least("a", "b").alias("rep_a"), F.greatest("a", "b").alias("rep_b"), "similarity")


def duplicate_groups(groups: Groups) -> DataFrame:
    """``(record, rep, copies, links)`` of every record: the smallest record of its class, the class's size, and the number of other classes linked to it."""
    m = groups.members
    ends = groups.links.select(F.explode(F.array("class_a", "class_b")).alias("class")).groupBy("class").agg(F.count("*").alias("links"))
    named = m.groupBy("class", "check").agg(F.min("record").alias("rep"), F.count("*").alias("copies")).join(ends, "class", "left")
    return m.join(named, ["class", "check"]).select("record", "rep", "copies", F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))
