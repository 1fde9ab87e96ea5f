"""Quality rules: how much of a text repeats itself.

For several lengths n, every window of n words gets a rolling hash in numpy; a character counts as
repeated when its word lies in a window that equals an earlier one, or its line equals an earlier one: first
occurrences don't count, so a header that comes again at the end of a short text costs it once. A text is
rejected when the share of repeated characters passes the limit of any length, or that of lines. (The base rule
on windows of 8 words counts first occurrences, too.)

Defined cases: a null or blank text has no words and zero measures; null, repeated or clashing
other columns are passed through untouched; an empty table gives an empty result. Each text is
measured whole, on its own, in memory proportional to its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import WORD, small_batches

#: The largest share of word characters in windows of n words that the text held before, and in lines
#: that it held before. Longer windows allow less, so that each length can reject a text that all others keep.
WINDOW_LIMITS = {3: 0.30, 4: 0.27, 5: 0.24, 6: 0.22, 7: 0.20, 8: 0.18, 9: 0.165, 10: 0.15}
LINE_LIMIT = 0.30
#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
BASE_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

_WORDS = re.compile(WORD)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "dup_line_chars", "n_repeat_words")


def repeated_words(hashes: np.ndarray, lengths: Iterable[int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each window length, which words lie in a window that occurs twice or more, and which in one that
    occurred before."""
    n = len(hashes)
    none = np.zeros(n, dtype=bool)
    out, rolling, last = {}, hashes.copy(), 1

    def covered(starts: np.ndarray, width: int) -> np.ndarray:
        steps = np.bincount(starts, minlength=n + 1) - np.bincount(starts + width, minlength=n + 1)
        return np.cumsum(steps[:n]) > 0

    for width in sorted(lengths):
        out[width] = (none, none)
        if n <= width:
            continue
        while last < width:  # a window's hash from that of the window one word shorter
            rolling = rolling[: n - last] * _STEP + hashes[last:]
            last += 1
        order = np.argsort(rolling, kind="stable")  # equal windows in order of place
        ranked = rolling[order]
        equal = ranked[1:] == ranked[:-1]
        if equal.any():
            again = order[1:][equal]
            out[width] = (covered(np.union1d(order[:-1][equal], again), width), covered(again, width))
    return out


def measure(text: str | None, widths: tuple[int, ...]) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, dup_line_chars, n_repeat_words, and the
    characters in windows of each width that occurred before."""
    text = text or ""
    words = _WORDS.findall(text)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    seen: set[str] = set()
    dup_lines = dup_chars = 0
    for line in text.split("\n"):
        if not _WORDS.search(line):
            continue
        if line in seen:
            dup_lines += 1
            dup_chars += sum(map(len, _WORDS.findall(line)))
        seen.add(line)
    covered = repeated_words(hashes, {*widths, BASE_WINDOW})
    return (
        len(words), int(sizes.sum()), sum(map(text.count, SYMBOLS)), dup_lines, dup_chars,
        int(covered[BASE_WINDOW][0].sum()), *(int(sizes[covered[w][1]].sum()) for w in widths),
    )


def _fields(window_limits: dict[int, float]) -> list[str]:
    return [*_MEASURES, *(f"dup_chars_{w}" for w in sorted(window_limits))]


def _verdict(m: Column, window_limits: dict[int, float], line_limit: float) -> tuple[Column, Column]:
    """(base_failed, kept) of measures."""
    base = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    clean = m["dup_line_chars"] <= F.lit(line_limit) * m["word_chars"]
    for w in sorted(window_limits):
        clean &= m[f"dup_chars_{w}"] <= F.lit(window_limits[w]) * m["word_chars"]
    return base, ~base & clean


def _measured(texts: pa.Array, fields: list[str], widths: tuple[int, ...]) -> pa.Array:
    found = [dict(zip(fields, measure(t.as_py(), widths), strict=True)) for t in texts]
    return pa.array(found, type=pa.struct([(f, pa.int64()) for f in fields]))


def repetition(
    docs: DataFrame,
    text: str = "text",
    window_limits: dict[int, float] = WINDOW_LIMITS,
    line_limit: float = LINE_LIMIT,
    into: str = "quality",
) -> DataFrame:
    """``docs`` without ``text``, with a struct ``into`` of the measures, ``base_failed`` and ``kept``."""
    small_batches(docs.sparkSession)
    widths, fields = tuple(sorted(window_limits)), _fields(window_limits)
    rest = [c for c in docs.columns if c != text]
    # other columns travel beside the text as one struct, so their names can't clash
    side = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.struct(F.lit(1).alias("none"))
    slim = docs.select(side.alias("side"), F.col(f"`{text}`").alias("text"))
    schema = slim.select("side").schema.add("m", StructType([StructField(f, LongType()) for f in fields]))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("side"), _measured(batch.column("text"), fields, widths)], names=["side", "m"])

    out = slim.mapInArrow(run, schema)
    base, kept = _verdict(F.col("m"), window_limits, line_limit)
    verdict = F.struct("m.*", base.alias("base_failed"), kept.alias("kept"))
    return out.select(*[F.col("side").getField(c).alias(c) for c in rest], verdict.alias(into))


def keep_clean(docs: DataFrame, text: str = "text", window_limits: dict[int, float] = WINDOW_LIMITS, line_limit: float = LINE_LIMIT) -> DataFrame:
    """The rows that pass, with all their columns. Only the text goes to Python, and only its verdict comes back."""
    small_batches(docs.sparkSession)
    widths, fields = tuple(sorted(window_limits)), _fields(window_limits)

    def run(texts: pa.Array) -> pa.Array:
        return _measured(texts, fields, widths)

    measures = F.arrow_udf(run, StructType([StructField(f, LongType()) for f in fields]))
    return docs.where(_verdict(measures(F.col(f"`{text}`")), window_limits, line_limit)[1])
