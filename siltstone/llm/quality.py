"""Quality rules: how much of a text repeats itself.

Words are runs of anything but ASCII white space. Each word gets a number within its text; rolling hashes
over these numbers name every window of n words, for several n at once, and a window that occurred before
in the text marks its words as repeated. The same is done for lines. All work is per row, so there is no
shuffle and no row depends on another.

Null and empty texts have no words and fail the base rules. Repeated rows give repeated results. Columns of
the input are never carried, so their names cannot clash.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.common import small_batches, strings, struct

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
# Percent of a text's word characters that may lie in repeats (after the first occurrence). A passage that stands
# twice and passes the base rule covers at most half of MAX_REPEAT_PERCENT, so limits from there on would never decide.
LIMITS = {5: 15, 7: 14, 10: 10}
LINE_LIMIT = 20
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

_BASE = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    global _powers, _inverses
    if len(_powers) < size:
        size = 1 << size.bit_length()
        for name, value in (("_powers", _BASE), ("_inverses", pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, value, np.uint64)
            factors[0] = 1
            globals()[name] = np.cumprod(factors)
    return _powers, _inverses


def _mixed(ids: np.ndarray) -> np.ndarray:
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Windows:
    """Rolling hashes of one text: any window length from one pass of prefix sums."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        powers, self._inverse = _tables(len(ids) + 1)
        self._sums = np.zeros(len(ids) + 1, np.uint64)
        np.cumsum(_mixed(ids) * powers[: len(ids)], out=self._sums[1:])

    def hashes(self, n: int) -> np.ndarray:
        m = len(self.ids) - n + 1
        return (self._sums[n:] - self._sums[:m]) * self._inverse[:m] if m > 0 else np.zeros(0, np.uint64)


def occurrences(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur more than once, and did it occur before."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    more = again.copy()
    more[order[:-1][same]] = True
    return more, again


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window of n words that begins at a marked start."""
    steps = np.zeros(size + 1, np.int64)
    at = np.flatnonzero(starts)
    steps[at] += 1
    steps[at + n] -= 1
    return np.cumsum(steps[:size]) > 0


def triples(ids: np.ndarray, distinct: int) -> np.ndarray:
    """Exact names of all 3-word windows, without hashing."""
    if len(ids) < 3:
        return np.zeros(0, np.int64)
    pairs = ids[:-1] * distinct + ids[1:]
    if distinct >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    return pairs[:-1] * distinct + ids[2:]


def measure(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_chars, then a coverage per n."""
    words = WORD.findall(text)
    size = len(words)
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, size)
    lengths = np.fromiter(map(len, words), np.int64, size)
    seen: set[str] = set()
    dup_lines = dup_chars = 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += 1
            dup_chars += sum(map(len, WORD.findall(line)))
        elif WORD.search(line):
            seen.add(line)
    windows, coverage, repeated = Windows(ids), [0] * len(LIMITS), 0
    if size >= 3:
        more, _ = occurrences(triples(ids, len(numbers)))
        if more.any():
            repeated = int(covered(more, 3, size).sum())
            # A longer window can repeat only where its 3-word windows do.
            for k, n in enumerate(LIMITS):
                again = occurrences(windows.hashes(n))[1]
                if again.any():
                    coverage[k] = int(lengths[covered(again, n, size)].sum())
    symbols = sum(map(text.count, SYMBOLS))
    return size, int(lengths.sum()), symbols, dup_lines, repeated, dup_chars, *coverage


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars") + tuple(
    f"rep{n}_chars" for n in LIMITS
)


@F.arrow_udf(struct(**dict.fromkeys(FIELDS, T.LongType())))
def measures(column: pa.Array) -> pa.Array:
    rows = [measure(t) for t in strings(column)]
    columns = zip(*rows, strict=True) if rows else [()] * len(FIELDS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(FIELDS))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def excessive(m: Column) -> Column:
    """The verdict on repetition: some kind of repeat covers more characters than its limit."""
    over = 100 * m["dup_line_chars"] > LINE_LIMIT * m["word_chars"]
    for n, limit in LIMITS.items():
        over = over | (100 * m[f"rep{n}_chars"] > limit * m["word_chars"])
    return over


def assess(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, all measures, ``base_failed``, ``kept``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key), measures(F.col(text)).alias("m"))
    m = F.col("m")
    return rows.select(
        key, "m.*", base_failed(m).alias("base_failed"), (~base_failed(m) & ~excessive(m)).alias("kept")
    )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""
    small_batches(docs.sparkSession)
    m = measures(F.col(text))
    return docs.where(F.transform(F.array(m), lambda x: ~base_failed(x) & ~excessive(x))[0])
