"""Pages of repeated keywords, links or tags instead of sentences.

A page's words give a rank-frequency curve, and so do its links, hash tags and markup: each kind is one more word of the curve, that
occurs once for every six of its characters. A curve of less than three words is ended with half an occurrence, so that it falls even where all is one keyword. It is kept as a
spectrum (how many words occur how often), from which SQL windows make the ranks and fit ``ln f = a + slope ln r``. Slope, residual, level (the mean of ln f)
and the share of the language's function words are then set against *same-language prose of comparable
length*: the medians of all pages of the corpus that read as sentences, by language and half-octave of length. A small group's medians are drawn towards those of all languages
at that length, these towards those of all prose, and these towards a stated prior, by the weight of ``shrink`` pages; so nothing switches at a size.

A page of which less than half reads as sentences is flagged if its curve is steeper than the prose's (slope), fits worse (residual) or lies higher (level) by far more than prose varies, or, the more its share of function words falls below
the prose's (divergence), by somewhat more; or if it reads as sentences, but its curve is steeper by as much and fits far worse as well; for such a page every sentence counts once, so that
refrains don't look like keywords, and links that stand beside sentences don't count; unless numbers make up a third of its words (timetables and logs repeat units, not keywords). Vocabulary lists
and glossaries repeat articles, not content words; the curve is that of the content words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.lexicon import LANGUAGES_OF, WORD
from quern.llm.quality import _BULLET, _reads_as_sentences

#: A link: an opening anchor, a scheme or ``www.``, or a host by its syntax (labels, the first with a letter, and a last one of lower-case letters) with its path.
_LINK = re.compile(r"""<a\s[^<>]*>|(?:[a-z][a-z0-9+.-]{0,30}://|www\.)[^\s<>"')\]]+|(?<![\w.@/-])(?=[\w-]*[^\W\d_])[\w-]+(?:\.[\w-]+)*\.[a-z]{2,24}(?![\w-])(?:/[^\s<>"')\]]*)?""")
_HASH = re.compile(r"#\w+")
_TAG = re.compile(r"<[^<>]+>")
#: Stands for each character of a link; no letter, digit or blank.
_GONE = "\ufffc"
_LIKELY = re.compile(r"://|www\.|<a\s|\w\.[a-z]{2}")
#: Characters of a link or tag that weigh as much as a word.
_PER_WORD = 6
#: A page reads as sentences if these hold half of its words, and this share of words, links and tags.
_SENTENCES_HOLD = 1 / 3
_NUMBERED = re.compile(r"\s*\(?\d{1,3}[.):]\s")
_PART = re.compile(r"(?<=[.!?])\s+|\n+")
#: A single function word stands for at most this share of a page's words, so that no keyword passes for one.
_MOST_OF_ONE = 0.15


@dataclass(frozen=True)
class Settings:
    prose: float = 0.5
    min_words: int = 8
    numbers: float = 0.33
    #: Shares of function words, as parts of the prose's: at most this is divergence, from the other on it is like prose.
    divergence: float = 0.5
    alike: float = 0.8
    #: Deviations from the prose's median slope or residual that a page needs, in robust standard deviations: where its function words are like prose's, and where they diverge.
    deviations: float = 6.0
    repeated: float = 2.0
    #: Keywords in the guise of sentences: words that such a page needs, and how much worse its curve must fit besides being steeper.
    min_disguised: int = 30
    disguised: float = 3.0
    #: Pages of the wider group that a group's medians are mixed with.
    shrink: float = 30.0
    #: What stands for prose where a corpus has none: median and deviation of slope, residual and level, and the median share of function words.
    prior: tuple[float, float, float, float, float, float, float] = (-0.4, 0.1, 0.02, 0.03, 0.1, 0.1, 0.42)


#: A line of which links make up more than this share is an entry of a list, whatever its title reads like.
_LINK_LINE = 0.25


def _sentences(text: str) -> int:
    """Words in paragraphs that read as sentences; links count as nothing, marked entries and lines of links stand alone.

    A paragraph ends at a blank line, and at a line that ends like a sentence: what follows is judged by itself.
    """
    total = 0
    block: list[str] = []

    def close() -> int:
        if not block:
            return 0
        t = " ".join(block)
        block.clear()
        found = WORD.findall(t.lower())
        return len(found) if _reads_as_sentences(t, found) else 0

    for x in text.splitlines():
        x = x.strip()
        if not x:
            total += close()
            continue
        if _GONE in x:
            total += close()
            if len(x) - len(x.replace(_GONE, "")) > _LINK_LINE * len(x):
                continue
            x = x.replace(_GONE, "")
        if m := _BULLET.match(x):
            total += close()
            rest = x[m.end() :]
            found = WORD.findall(rest.lower())
            total += len(found) if len(found) > 8 and _reads_as_sentences(rest, found) else 0
            continue
        block.append(x)
        if x[-1:] in ".!?\"”»":
            total += close()
    return total + close()


def measure(text: str) -> tuple:
    """The values of ``_FIELDS`` for a page. ``prose_share`` is of the words, the other shares are of words, links and tags (six characters of these count as a word)."""
    links = 0
    kinds: list[int] = []  # characters of links, hash tags and markup
    rest = text
    for pattern, likely in ((_LINK, _LIKELY.search(text)), (_HASH, "#" in text), (_TAG, "<" in text)):
        found = pattern.findall(rest) if likely else ()
        if found:
            kinds.append(sum(map(len, found)))
            if pattern is not _TAG:
                links += len(found)
            rest = pattern.sub(" " if pattern is _TAG else lambda m: _GONE * len(m[0]), rest)
    other = [-(-c // _PER_WORD) for c in kinds]
    words = WORD.findall(rest.lower())
    n = len(words)
    total = n + sum(other)
    counts = Counter(words)
    mass: dict[str, float] = {}
    numbers = 0
    spectrum: Counter[int] = Counter()
    most = _MOST_OF_ONE * n
    for w, c in counts.items():
        if w in LANGUAGES_OF:
            for lang in LANGUAGES_OF[w]:
                mass[lang] = mass.get(lang, 0.0) + min(c, most)
        else:
            spectrum[c] += 1
            if w[0] in "0123456789":
                numbers += c
    language = min(mass, key=lambda x: (-mass[x], x)) if mass else None
    # The numbers that count a list's entries say nothing about them.
    marks = sum(1 for x in rest.splitlines() if _NUMBERED.match(x)) if numbers else 0
    n1, t1 = max(1, n), max(1, total)
    prose = _sentences(rest)
    curve = total
    if prose >= 0.5 * n1 and prose >= _SENTENCES_HOLD * t1:
        curve = n
        parts = [x for x in _PART.split(rest) if x]
        once = dict.fromkeys(parts)
        if len(once) < len(parts):  # a refrain repeats its lines, not keywords
            words = WORD.findall(" ".join(once).lower())
            curve = len(words)
            spectrum = Counter(Counter(w for w in words if w not in LANGUAGES_OF).values())
    else:
        spectrum.update(other)
    freqs = sorted(spectrum, reverse=True)
    return (language, total, curve, prose / n1, prose / t1, mass[language] / t1 if mass else 0.0, (numbers - marks) / max(1, total - marks), links, sum(other) / t1, freqs, [spectrum[f] for f in freqs])


_FIELDS = (
    ("language", pa.string(), "string"), ("n_words", pa.int32(), "int"), ("curve_words", pa.int32(), "int"), ("prose_share", pa.float64(), "double"), ("sentence_share", pa.float64(), "double"), ("common_share", pa.float64(), "double"),
    ("number_share", pa.float64(), "double"), ("links", pa.int32(), "int"), ("link_share", pa.float64(), "double"), ("freqs", pa.list_(pa.int32()), "array<int>"), ("types", pa.list_(pa.int32()), "array<int>"),
)


def curves(df: DataFrame, page: str = "doc_id", text: str = "text") -> DataFrame:
    """The measures of each page and the fit of its curve: ``(page, copy, …, slope, residual, level)``.

    Null texts give no row, repeated rows one. ``slope``, ``residual`` and ``level`` are 0 for pages without content words, links or tags.
    """
    kind = df.select(page).schema[0].dataType.simpleString()
    inner = df.select(F.col(page).alias("page"), F.col(text).alias("__text")).where(F.col("__text").isNotNull()).withColumn("copy", F.xxhash64("__text"))
    schema = f"page {kind}, copy bigint, " + ", ".join(f"{n} {t}" for n, _, t in _FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [measure(t) for t in b.column("__text").to_pylist()]
            columns = [pa.array([r[i] for r in rows], t) for i, (_, t, _) in enumerate(_FIELDS)]
            yield pa.RecordBatch.from_arrays([b.column("page"), b.column("copy"), *columns], names=["page", "copy", *(n for n, _, _ in _FIELDS)])

    pages = inner.mapInArrow(run, schema).dropDuplicates(["page", "copy"])
    # One row for each step of the curve: `types` words share the frequency `f`, and so the ranks a < r <= b.
    few = (F.size("freqs") > 0) & (F.aggregate("types", F.lit(0), lambda a, x: a + x) < 3)
    end = lambda c, t, x: F.concat(F.col(c).cast(f"array<{t}>"), F.when(few, F.array(F.lit(x).cast(t))).otherwise(F.array().cast(f"array<{t}>")))
    ended = F.arrays_zip(end("freqs", "double", 0.5).alias("freqs"), end("types", "int", 1).alias("types"))
    steps = pages.select("page", "copy", F.explode_outer(ended).alias("s"), *[n for n, _, _ in _FIELDS[:-2]])
    w = Window.partitionBy("page", "copy").orderBy(F.col("s.freqs").desc()).rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.withColumn("c", F.col("s.types").cast("double")).withColumn("b", F.sum("c").over(w)).withColumn("a", F.col("b") - F.col("c"))
    # the mean of ln r over the step, by the integral of ln from a + 1/2 to b + 1/2
    hi, lo = F.col("b") + 0.5, F.col("a") + 0.5
    x = (hi * F.log(hi) - hi - lo * F.log(lo) + lo) / F.col("c")
    y = F.log(F.col("s.freqs").cast("double"))
    steps = steps.select("page", "copy", "c", x.alias("x"), y.alias("y"), *[n for n, _, _ in _FIELDS[:-2]])
    keep = [F.first(n).alias(n) for n, _, _ in _FIELDS[:-2]]
    sums = steps.groupBy("page", "copy").agg(
        F.sum("c").alias("w"), F.sum(F.col("c") * F.col("x")).alias("sx"), F.sum(F.col("c") * F.col("y")).alias("sy"), F.sum(F.col("c") * F.col("x") * F.col("x")).alias("sxx"),
        F.sum(F.col("c") * F.col("x") * F.col("y")).alias("sxy"), F.sum(F.col("c") * F.col("y") * F.col("y")).alias("syy"), F.count("y").alias("steps"), *keep,
    )
    spread = F.col("w") * F.col("sxx") - F.col("sx") * F.col("sx")
    slope = F.when((F.col("steps") >= 2) & (spread > 1e-9), (F.col("w") * F.col("sxy") - F.col("sx") * F.col("sy")) / spread).otherwise(0.0)
    fitted = sums.withColumn("slope", slope)
    error = F.col("syy") - F.col("sy") * F.col("sy") / F.col("w") - F.col("slope") * (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("w"))
    fitted = fitted.withColumn("residual", F.coalesce(F.sqrt(F.greatest(F.lit(0.0), error) / F.col("w")), F.lit(0.0)))
    fitted = fitted.withColumn("level", F.coalesce(F.col("sy") / F.col("w"), F.lit(0.0)))
    return fitted.drop("w", "sx", "sy", "sxx", "sxy", "syy", "steps")


def stuffed_pages(pages: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``pages`` (of ``curves``, best checkpointed) with ``slope_z, residual_z, level_z, common_ratio`` and ``stuffed``.

    The prose of each language and length is described by medians and quartiles, of fixed size however many pages
    there are; languages without prose use that of all, a corpus without prose uses ``s.prior``.
    """
    p = pages.withColumn("size", F.floor(F.log2(F.greatest("curve_words", F.lit(1)).cast("double")) * 2).cast("int"))
    prose = p.where((F.col("prose_share") >= 0.8) & (F.col("n_words") >= 2 * s.min_words))

    def described(*keys: str) -> DataFrame:
        q = lambda c, x: F.percentile_approx(c, x, 2000)
        return prose.groupBy(*keys).agg(
            F.count("*").cast("double").alias("pages"), q("slope", 0.5).alias("slope_mid"), ((q("slope", 0.75) - q("slope", 0.25)) / 1.349).alias("slope_dev"),
            q("residual", 0.5).alias("residual_mid"), ((q("residual", 0.75) - q("residual", 0.25)) / 1.349).alias("residual_dev"), q("level", 0.5).alias("level_mid"), ((q("level", 0.75) - q("level", 0.25)) / 1.349).alias("level_dev"), q("common_share", 0.5).alias("common_mid"),
        )

    values = ["slope_mid", "slope_dev", "residual_mid", "residual_dev", "level_mid", "level_dev", "common_mid"]
    j = p.select("*", *[F.lit(x).alias(v) for v, x in zip(values, s.prior, strict=True)])
    # at most languages x half-octaves rows each
    for level, keys in enumerate(((), ("size",), ("language", "size"))):
        d = F.broadcast(described(*keys).select(*keys, "pages", *[F.col(v).alias(f"{v}_{level}") for v in values]))
        j = j.join(d, list(keys), "left") if keys else j.join(d, F.lit(True), "left")
        for v in values:
            own = F.col(f"{v}_{level}")
            j = j.withColumn(v, F.coalesce((F.col("pages") * own + s.shrink * F.col(v)) / (F.col("pages") + s.shrink), F.col(v)))
        j = j.drop("pages")
    deviation = lambda c, sign: sign * (F.col(c) - F.col(f"{c}_mid")) / F.greatest(F.col(f"{c}_dev"), F.lit(0.02))
    for c, sign in (("slope", -1.0), ("residual", 1.0), ("level", 1.0)):
        j = j.withColumn(f"{c}_z", deviation(c, sign))
    j = j.withColumn("common_ratio", F.coalesce(F.col("common_share") / F.nullif(F.col("common_mid"), F.lit(0.0)), F.lit(1.0)))
    off = F.greatest("slope_z", "residual_z", "level_z")
    near = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("common_ratio") - s.divergence) / (s.alike - s.divergence)))
    unlike = off > s.repeated + near * (s.deviations - s.repeated)
    stuffed = (F.col("sentence_share") < s.prose) & (F.col("n_words") >= s.min_words) & unlike
    disguised = (F.col("curve_words") >= s.min_disguised) & (F.col("slope_z") > s.deviations) & (F.col("residual_z") > s.disguised)
    # Timetables and logs are numbers.
    j = j.withColumn("stuffed", (F.col("number_share") < s.numbers) & (stuffed | disguised))
    return j.select(*pages.columns, "slope_z", "residual_z", "level_z", "common_ratio", "stuffed")
