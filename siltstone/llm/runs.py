"""Runs: stretches of a text in which the same words come back at a fixed distance.

The dictionary of basic factors gives every stretch of 2^k words of a text a number, equal for equal stretches; the
numbers of one level come from pairs of the level before. Where a stretch comes next is its successor. Successors within
twice the length of a stretch that keep their distance over neighbouring words form arithmetic progressions, and their difference
proposes a period; a proposal is then extended word by word to both sides and counted once. A run of period q and at least
3*q words is always proposed by the level whose length is the first that reaches q: a stretch of that length inside the
run cannot come back earlier than after q words, and does come back then.

A whole batch of texts is one array of words, numbered text by text, so that no stretch has its like in another text; stretches that occur
once leave the dictionary, since longer ones around them occur once as well.

Null and empty texts have no words and no runs. Repeated rows give repeated results. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import small_batches, strings

LEAST_WORDS, LEAST_PERIODS = 24, 3


@dataclass(frozen=True)
class Run:
    """A stretch of words and its smallest period; words are numbered from 0."""

    start: int
    length: int
    period: int


def words_of(text: str) -> list[bytes]:
    """ASCII white space parts words: for bytes, that is what ``split`` does."""
    return text.encode("utf-8", "surrogatepass").split()


def _numbered(left: np.ndarray, right: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of pairs, equal for equal pairs, and which pairs occur at least twice."""
    _, numbers, counts = np.unique(left * bound + right, return_inverse=True, return_counts=True)
    return numbers, counts[numbers] > 1


def _extended(words: np.ndarray, low: int, high: int, start: int, end: int, period: int) -> tuple[int, int]:
    """The widest stretch around ``start`` to ``end``, within ``low`` to ``high``, that keeps the period."""
    step = 64
    while start > low:
        size = min(step, start - low)
        differs = np.flatnonzero(words[start - size : start] != words[start - size + period : start + period])
        if len(differs):
            start -= size - 1 - int(differs[-1])
            break
        start, step = start - size, step * 2
    step = 64
    while end < high:
        size = min(step, high - end)
        differs = np.flatnonzero(words[end : end + size] != words[end - period : end - period + size])
        if len(differs):
            end += int(differs[0])
            break
        end, step = end + size, step * 2
    return start, end


def find_runs(
    words: np.ndarray, ends: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
) -> Iterator[tuple[int, Run]]:
    """(text, run) of all maximal runs of ``least_words`` words and ``least_periods`` (3 or more) periods at least.

    ``words`` are numbers of the words of all texts, ``ends`` where each text ends. Runs come without an order.
    """
    if least_periods < 3:
        raise ValueError("runs of fewer than three periods may be missed")
    total = len(words)
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    text_of = np.repeat(np.arange(len(ends)), ends - starts)
    if not total:
        return
    # One word each; a number holds its text as well.
    at = np.arange(total)
    numbers, repeated = _numbered(text_of.astype(np.int64), words.astype(np.int64), int(words.max()) + 1)
    at, numbers = at[repeated], numbers[repeated]
    number_at = np.full(total, -1, np.int64)
    seen: set[tuple[int, int, int]] = set()
    size = 1
    while len(at):
        order = np.argsort(numbers, kind="stable")  # places rise already
        here, following = at[order[:-1]], at[order[1:]]
        near = (numbers[order[:-1]] == numbers[order[1:]]) & (following - here <= 2 * size)
        here, gap = here[near], (following - here)[near]
        if len(here):
            by_place = np.argsort(here)
            here, gap = here[by_place], gap[by_place]
            # Neighbouring words with one distance: a progression of as many terms as it covers distances.
            breaks = np.flatnonzero((np.diff(here) != 1) | (np.diff(gap) != 0)) + 1
            first = np.concatenate(([0], breaks))
            last = np.concatenate((breaks, [len(here)])) - 1
            covered = here[last] - here[first] + size + gap[first]
            # The whole run is covered if the stretch is as long as the distance; else it may go on.
            exact = gap[first] <= size
            long = covered >= np.maximum(least_words, least_periods * gap[first])
            proposed = np.where(exact, long, covered >= 2 * gap[first])
            for a, b in zip(first[proposed].tolist(), last[proposed].tolist(), strict=True):
                start, period = int(here[a]), int(gap[a])
                end = int(here[b]) + size + period
                text = int(text_of[start])
                start, end = _extended(words, int(starts[text]), int(ends[text]), start, end, period)
                found = (start, end, period)
                if end - start >= max(least_words, least_periods * period) and found not in seen:
                    seen.add(found)
                    yield text, Run(start - int(starts[text]), end - start, period)
        # Twice the length: a stretch and the one behind it, both of which must occur again, within one text.
        number_at[at] = numbers
        inside = at + 2 * size <= ends[text_of[at]]
        at = at[inside]
        behind = number_at[at + size]
        numbers_before, bound = number_at[at], int(numbers.max()) + 1
        both = behind >= 0
        number_at[:] = -1
        at = at[both]
        if not len(at):
            return
        numbers, repeated = _numbered(numbers_before[both], behind[both], bound)
        at, numbers = at[repeated], numbers[repeated]
        size *= 2


def runs_of(texts: list[list[bytes]], **limits: int) -> list[list[Run]]:
    """The runs of each text, given as words, by start and period."""
    known: dict[bytes, int] = {}
    flat = [known.setdefault(w, len(known)) for words in texts for w in words]
    ends = np.cumsum([len(words) for words in texts], dtype=np.int64)
    out: list[list[Run]] = [[] for _ in texts]
    for text, run in find_runs(np.array(flat, np.int64), ends, **limits):
        out[text].append(run)
    return [sorted(runs, key=lambda r: (r.start, r.period)) for runs in out]


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words but those that any run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    for r in runs:
        depth[r.start + r.period] += 1
        depth[r.start + r.length] -= 1
    stays = np.cumsum(depth[:-1]) == 0
    return b" ".join(words[i] for i in np.flatnonzero(stays).tolist())


def find(docs: DataFrame, text: Column | str = "text", name: str = "found", **limits: int) -> DataFrame:
    """``docs`` with one more column: struct of n_words, runs (array of start, length, period) and the collapsed text."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, text: string>")
    def search(column: pa.Array) -> pa.Array:
        texts = [words_of(t) for t in strings(column)]
        found = runs_of(texts, **limits)
        flat = [r for runs in found for r in runs]
        offsets = np.concatenate(([0], np.cumsum([len(runs) for runs in found]))).astype(np.int32)
        names = ["start", "length", "period"]
        items = pa.StructArray.from_arrays([pa.array([getattr(r, n) for r in flat], pa.int64()) for n in names], names=names)
        short = [collapsed(w, r).decode("utf-8", "surrogatepass") for w, r in zip(texts, found, strict=True)]
        return pa.StructArray.from_arrays(
            [
                pa.array([len(w) for w in texts], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), items),
                pa.array(short, pa.string()),
            ],
            names=["n_words", "runs", "text"],
        )

    return docs.withColumn(name, search(F.col(text) if isinstance(text, str) else text))


def densest(runs: Column) -> Column:
    """The run of the most periods, exactly compared; the first and shortest of equals. Null without runs."""

    def better(a: Column, b: Column) -> Column:
        # Products of three-word numbers stay far below 2^63: a text has fewer than 2^31 words.
        left, right = b["length"] * a["period"], a["length"] * b["period"]
        return F.when(left > right, b).otherwise(a)

    # Runs come by start and period, so the first of equals stays.
    return F.aggregate(runs, F.get(runs, F.lit(0)), better)


def digest(runs: Column) -> Column:
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return F.sha2(F.array_join(lines, ""), 256)
