"""Statistics of a text's writing, from which prose is told apart from lists, tables and junk.

Every text is read once, line by line, in Arrow batches: nothing is shuffled, and a text's cost is
proportional to its length. What is measured:

* word, character, symbol, digit and punctuation ratios, the share of common words;
* *delimiter alignment*: the share of lines that have the same number (or, for blanks, the same
  positions) of one delimiter;
* *indentation periodicity* and *line-length autocorrelation*: the largest autocorrelation of the
  lines' indents and lengths at lags 1 to 6, high where a layout repeats;
* the share of words in paragraphs that read as sentences.

``kind`` is decided from these: ``prose``, ``list``, ``table``, ``junk`` or ``short``. Periodic indents or lengths of lines that
mostly don't end as sentences make a table if lines in the same place of the period are aligned, else a list.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quern.llm.lexicon import ALL_COMMON, WORD
from quern.session import fresh

STATS = (
    ("n_chars", pa.int64()),
    ("n_words", pa.int64()),
    ("n_lines", pa.int64()),
    ("mean_word_len", pa.float64()),
    ("symbol_ratio", pa.float64()),
    ("digit_ratio", pa.float64()),
    ("punct_line_share", pa.float64()),
    ("common_word_share", pa.float64()),
    ("distinct_word_share", pa.float64()),
    ("top_word_share", pa.float64()),
    ("delimiter_alignment", pa.float64()),
    ("cells_per_line", pa.float64()),
    ("indent_period", pa.float64()),
    ("line_autocorr", pa.float64()),
    ("prose_share", pa.float64()),
    ("kind", pa.string()),
)
_SQL_TYPE = {pa.int64(): "bigint", pa.float64(): "double", pa.string(): "string"}

_BULLET = re.compile(r"\s*(?:[-*+•‣▪●–—>#]+|\(?(?:\d{1,3}|[A-Za-z]|[ivxIVX]{1,4})[.):]|\[[ xX]?\])\s+")
_SENTENCE_END = re.compile(r"[.!?…][\"'“”»)\]]*(?=\s|$)")
_ENDS = re.compile(r"[.!?…:][\"'“”»)\]]*$")
_GAP = re.compile(r"(?<=\S) {2,}(?=\S)|^ {2,}(?=\S)")
#: A word with a vowel and at most four other letters in a row.
_SAID = re.compile(r"(?=.*[aeiouy])(?!.*[^aeiouy]{5}).*")
_RULE = re.compile(r"[\s|:+=-]+")
DELIMITERS = ("|", "\t", ";", ",")


def _autocorrelation(values: list[int]) -> tuple[float, int]:
    """The largest autocorrelation at lags 1 to 6 and its lag; 0 for fewer than 4 values or a constant series."""
    if len(values) < 4:
        return 0.0, 1
    x = np.asarray(values, dtype=float)
    x -= x.mean()
    var = float(x @ x)
    if var <= 1e-9:
        return 0.0, 1
    return max((float(x[:-k] @ x[k:]) / var, k) for k in range(1, min(6, len(x) - 2) + 1))


def _alignment(lines: list[str]) -> tuple[float, float, str]:
    """Of the best delimiter: the share of lines with the usual number of it, cells a line, the delimiter."""
    n, best = len(lines), (0.0, 1.0, "")
    if n < 3:
        return best
    for d in DELIMITERS:
        counts = [x.count(d) for x in lines]
        usual, lines_with = Counter(counts).most_common(1)[0]
        if usual:
            words_per_cell = sum(len(c.split()) for x in lines for c in x.split(d)) / (sum(counts) + n)
            if words_per_cell <= 5 and (lines_with / n, usual) > (best[0], best[1] - 1):
                best = (lines_with / n, usual + 1.0, d)
    # columns made with blanks: text begins again and again at the same positions
    starts: Counter[int] = Counter()
    gapped = 0
    for x in lines:
        at = {m.end() for m in _GAP.finditer(x)}
        gapped += bool(at - {len(x) - len(x.lstrip())})  # an indent alone makes no cells
        starts.update(at)
    if gapped >= 0.6 * n:
        columns = {p for p, c in starts.items() if c >= max(2, 0.25 * n)}
        held = sum(1 for x in lines if (at := {m.end() for m in _GAP.finditer(x)}) and at <= columns)
        if held / n > best[0]:
            best = (held / n, len(columns) + 1.0, " ")
    return best


def _aligned_in_turn(lines: list[str], lag: int) -> bool:
    """Whether at least half of the lines are rows of cells, if only every ``lag``-th line is compared."""
    turns = [lines[i::lag] for i in range(lag)]
    return 2 * sum(len(x) for x in turns if (a := _alignment(x))[0] >= 0.8 and a[1] >= 2) >= len(lines)


def _reads_as_sentences(text: str, found: list[str]) -> bool:
    if len(found) < 4:
        return False
    common = sum(w in ALL_COMMON for w in found)
    return common >= 0.1 * len(found) and len(_SENTENCE_END.findall(text)) >= max(1, len(found) / 60)


def _readable(counts: Counter[str]) -> bool:
    """Whether at most 0.3 of the words (numbers aside) mix digits and letters, are very long, or have letters that can't be said."""
    letters = {w: c for w, c in counts.items() if not w.isdigit()}
    unsaid = sum(c for w, c in letters.items() if len(w) > 25 or w.isascii() and (not w.isalpha() or len(w) > 2 and not _SAID.fullmatch(w)))
    return unsaid <= 0.3 * sum(letters.values())


def describe(text: str | None) -> tuple:
    """The values of ``STATS`` for one text; null and blank texts are ``short`` with all counts 0."""
    text = text or ""
    lower = text.lower()
    found = WORD.findall(lower)
    raw_lines = [x.rstrip(" ") for x in text.splitlines() if x.strip()]
    n_chars, n, n_lines = len(text), len(found), len(raw_lines)
    if not raw_lines:
        return (n_chars, 0, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, "short")
    letters = sum(map(len, found))
    blanks = sum(map(str.isspace, text))
    symbols = n_chars - blanks - letters
    digits = sum(len(w) for w in found if w.isdigit())
    ink = max(1, n_chars - blanks)
    counts = Counter(found)
    common = sum(c for w, c in counts.items() if w in ALL_COMMON) / n if n else 0.0
    top = max((c for w, c in counts.items() if w not in ALL_COMMON), default=0) / n if n else 0.0
    distinct = len(counts) / n if n else 0.0
    lines = [x.strip() for x in raw_lines]
    enders = sum(bool(_ENDS.search(x)) for x in lines) / n_lines
    aligned, cells, delimiter = _alignment(raw_lines)
    indents, indent_lag = _autocorrelation([len(x) - len(x.lstrip()) for x in raw_lines])
    lengths, length_lag = _autocorrelation([len(x) for x in raw_lines])

    # Words in paragraphs of sentences. Marked entries stand alone; other lines go on until a blank
    # line, so that sentences broken over lines are read whole.
    prose = entries = 0
    block: list[str] = []

    def close() -> None:
        nonlocal prose
        if block:
            t = " ".join(block)
            w = WORD.findall(t.lower())
            if _reads_as_sentences(t, w):
                prose += len(w)
            block.clear()

    for x in text.splitlines():
        if not x.strip():
            close()
        elif m := _BULLET.match(x):
            rest = x[m.end() :]
            w = WORD.findall(rest.lower())
            if _reads_as_sentences(rest, w) and len(w) > 8:
                close()
                prose += len(w)
            else:
                close()
                entries += 1
        else:
            block.append(x.strip())
    close()
    prose_share = prose / n if n else 0.0

    mean_line = n / n_lines
    per_letter = symbols / ink
    # A layout that repeats and isn't sentences. Lengths that are alike at lag 1 only drift, and of random ones
    # (6 to 14 lines) 3 % reach 0.5 at another lag, under 1 % 0.6.
    repeats = n_lines >= 6 and n >= n_lines and enders <= 0.5 and prose_share < 0.5 and (indents >= 0.5 or lengths >= 0.6 and length_lag > 1)
    # On several lines a long answer may well repeat its words: few are few in number too.
    few = distinct < 0.2 and (n_lines < 3 or len(counts) < 12)
    # Entries without marks, if they are readable and not the same few words again and again.
    listed = (repeats or n_lines >= 3 and mean_line <= 12) and not few and _readable(counts)
    if prose_share >= 0.5 and per_letter < 0.3 and top < 0.34:
        kind = "prose"
    elif n_lines >= 3 and aligned >= 0.6 and cells >= 2 and n >= n_lines and prose_share < 0.5 and (delimiter != "," or mean_line < 40):
        kind = "table"
    elif n_lines >= 4 and entries >= 0.6 * n_lines and mean_line <= 12 and letters <= 25 * n:
        kind = "list"
    elif not listed and ink >= 40 and sum(len(w) for w in text.split() if len(w) > 40) >= 0.5 * ink:
        kind = "junk"
    elif n >= 8 and not listed and (common < 0.08 or top >= 0.34 or few):
        kind = "junk"
    elif ink >= 20 and (per_letter >= 0.45 or n and top >= 0.5 or not n):
        kind = "junk"
    elif n >= 1 and letters / n > 25:
        kind = "junk"
    elif repeats and _aligned_in_turn(raw_lines, indent_lag if indents >= lengths else length_lag):
        kind = "table"
    elif repeats or n_lines >= 4 and mean_line <= 12 and prose_share < 0.5:
        kind = "list"
    elif n >= 8 and per_letter >= 0.25:
        kind = "junk"
    else:
        kind = "short" if n < 8 else "prose"
    return (
        n_chars, n, n_lines, letters / n if n else 0.0, per_letter, digits / ink, enders, common, distinct, top,
        aligned, cells, indents, lengths, prose_share, kind,
    )


#: What comes before and after the answer in each template.
ANSWER = {
    "chatml": ("<|im_start|>assistant\n", "<|im_end|>"),
    "instruct": ("### Response:\n", ""),
    "alpaca": ("### Response:\n", ""),
    "chat": ("\n\nAssistant: ", ""),
}


def answer_of(text: str | None, template: str | None) -> str | None:
    """The part of a formatted conversation after its template's answer marker.

    Where the template is null, unknown or doesn't fit, the marker that comes first in the text
    counts; a text without any is taken whole, null gives null.
    """
    if text is None:
        return None
    known = ANSWER.get((template or "").strip().lower())
    at = text.find(known[0]) if known else -1
    if at < 0:
        found = [(i, x) for x in (*ANSWER.values(), ("\nAssistant:", "")) if (i := text.find(x[0])) >= 0]
        if not found:
            return text
        at, known = min(found)
    rest = text[at + len(known[0]) :]
    if known[1]:
        end = rest.rfind(known[1])
        rest = rest[:end] if end >= 0 else rest
    return rest


def text_statistics(df: DataFrame, text: str = "text", template: str | None = None, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the text by default) and the statistics of ``text`` for every row.

    With ``template`` (a column) only the answer of a formatted conversation is measured. A statistic
    whose name a kept column has gets underscores in front. Rows are neither dropped nor merged: null
    and blank texts are ``short``, repeated rows come out as often as they went in, an empty table
    stays empty.
    """
    kept = list(keep) if keep is not None else [c for c in df.columns if c != text]
    names = [fresh(kept, n) for n, _ in STATS]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema] + [f"{n} {_SQL_TYPE[t]}" for n, (_, t) in zip(names, STATS, strict=True)])
    inner = df.select(*kept, df[text].alias("__text"), *([df[template].alias("__template")] if template else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("__text").to_pylist()
            if template:
                texts = [answer_of(t, k) for t, k in zip(texts, b.column("__template").to_pylist(), strict=True)]
            rows = [describe(t) for t in texts]
            columns = [pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(STATS)]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + columns, names=kept + names)

    return inner.mapInArrow(run, schema)
