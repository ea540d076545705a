"""Statistics of a text's form, for rules and classifiers: one pass over each whole text."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm.common import starts_and_ends, texts

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = b"0123456789"
ENDS = b".,;:?"

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_upper", "n_digits", "n_bangs", "n_ends", "n_chars", "longest_word",
)
TYPE = pa.struct([(name, pa.int64()) for name in COUNTS])
DDL = "struct<" + ",".join(f"{name}:bigint" for name in COUNTS) + ">"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that the text holds twice or more, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    joined, starts, ends = starts_and_ends(words)
    grams = [joined[a:b] for a, b in zip(starts, ends[window - 1 :])]
    if len(set(grams)) == n:
        return 0
    seen = Counter(grams)
    covered = end = 0
    for at, gram in enumerate(grams):
        if seen[gram] > 1:
            covered += at + window - max(at, end)
            end = at + window
    return covered


def statistics(text: bytes) -> tuple[int, ...]:
    words = text.split()
    joined = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    without = lambda some: len(text) - len(text.translate(None, some))
    return (
        len(words),
        len(joined.decode("utf-8", "replace")),
        without(SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(set(words)),
        without(UPPER),
        without(DIGITS),
        text.count(b"!"),
        without(ENDS),
        len(text.decode("utf-8", "replace")),
        max(map(len, words), default=0),
    )


def _statistics(column: pa.Array) -> pa.Array:
    rows = [statistics(text) for text in texts(column)]
    columns = list(zip(*rows, strict=True)) or [[] for _ in COUNTS]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(TYPE))


def text_statistics(text: Column | str) -> Column:
    """A struct of the counts of a text; a null text has none of anything.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word, equal to an
    earlier line), n_repeat_words (in windows of five words that occur again) and further counts of form.
    """
    column = F.col(text) if isinstance(text, str) else text
    return F.arrow_udf(_statistics, DDL)(column.cast("string"))


def ratios(s: str = "s") -> dict[str, Column]:
    """Statistics that don't depend on the length, out of the struct column s; all within a fixed range."""
    c = lambda name: F.col(f"{s}.{name}").cast("double")
    per = lambda a, b: F.try_divide(c(a), F.greatest(c(b), F.lit(1.0)))
    return {
        "log_words": F.log1p(c("n_words")) / 10,
        "mean_word": F.least(per("word_chars", "n_words") / 20, F.lit(2.0)),
        "symbols": F.least(per("n_symbols", "n_words"), F.lit(4.0)),
        "dup_lines": per("n_dup_lines", "n_lines"),
        "repeats": per("n_repeat_words", "n_words"),
        "distinct": per("n_distinct", "n_words"),
        "upper": per("n_upper", "n_chars"),
        "digits": per("n_digits", "n_chars"),
        "bangs": F.least(per("n_bangs", "n_words"), F.lit(4.0)),
        "ends": F.least(per("n_ends", "n_words"), F.lit(4.0)),
        "line_words": F.log1p(per("n_words", "n_lines")) / 10,
        "longest": F.log1p(c("longest_word")) / 10,
    }


def ratio_rows(rows: list[tuple[int, ...]]) -> np.ndarray:
    """The ratios of rows of counts, in the order of ratios()."""
    counts = dict(zip(COUNTS, np.array(rows, float).reshape(-1, len(COUNTS)).T, strict=True))
    per = lambda a, b: counts[a] / np.maximum(counts[b], 1)
    columns = [
        np.log1p(counts["n_words"]) / 10,
        np.minimum(per("word_chars", "n_words") / 20, 2),
        np.minimum(per("n_symbols", "n_words"), 4),
        per("n_dup_lines", "n_lines"),
        per("n_repeat_words", "n_words"),
        per("n_distinct", "n_words"),
        per("n_upper", "n_chars"),
        per("n_digits", "n_chars"),
        np.minimum(per("n_bangs", "n_words"), 4),
        np.minimum(per("n_ends", "n_words"), 4),
        np.log1p(per("n_words", "n_lines")) / 10,
        np.log1p(counts["longest_word"]) / 10,
    ]
    return np.column_stack(columns)
