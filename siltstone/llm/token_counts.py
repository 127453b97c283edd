"""Token counts by a two-tier lookup on the map side.

With a piece model, merges never cross the start of a word (a space mark after another character), the end of a word before punctuation, nor a
character that occurs in no longer piece, so a text's count is the sum over its pre-tokens.

A first pass finds the frequent pre-tokens of the corpus: each task keeps a bounded summary of counts, and only those
few rows a task are added up. The model gives the lengths of the ``ENTRIES`` most frequent, and every task gets
them by broadcast as a compact hash table: arrays of hashes, lengths and places in one block of texts, with which a
hit is verified. Other pre-tokens are encoded by the model once per worker and kept in its
cache, which is emptied when full. Beyond the summaries no pre-token is ever shuffled. What the table holds changes no count.

Null and empty texts have no tokens. Repeated rows give repeated results. Only the key and the text are read.
"""

from __future__ import annotations

import re
from collections import Counter as Counts
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from siltstone.llm.common import small_batches, strings

MARK = "▁"
CACHED, CACHED_LENGTH = 400_000, 64
# Pre-tokens in the broadcast table, of at most CACHED_LENGTH characters: 17 MB with their texts at most, two or three as a rule.
ENTRIES = 1 << 16
# Pre-tokens that one task reports, and how many it counts before it drops the rarest.
REPORTED, COUNTED = 1 << 16, 1 << 18
MAX_FILE = 64 << 20


class PieceModel:
    """A model and what can be derived from its pieces alone."""

    def __init__(self, file: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=file)
        model = self.model
        pieces = [
            model.id_to_piece(i)
            for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))
        ]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece crosses the start of a word: counts of words don't add up")
        probe = "ﬁ ①  Á "
        if "".join(model.encode(probe, out_type=str)).startswith(MARK + "fi"):
            raise ValueError("the model normalises texts: counts of words don't add up")
        if any(model.id_to_piece(model.piece_to_id(p)) != p for p in pieces[:100]):
            raise ValueError("the model's pieces can't be looked up")
        joining = sorted({c for p in pieces if len(p) > 1 for c in p} - {MARK})
        inside = "".join(map(re.escape, joining))
        letters = "".join(re.escape(c) for c in joining if c.isalpha())
        others = "".join(re.escape(c) for c in joining if not c.isalpha())
        word = f"[{inside}]+"
        if not any(a.isalpha() and not b.isalpha() for p in pieces for a, b in zip(p, p[1:], strict=False)):
            # No piece goes on behind a word, so punctuation there is a pre-token of its own.
            word = f"(?:[{others}]*[{letters}]+|[{others}]+)"
        self.split = re.compile(f"{MARK}*{word}|{MARK}+|[^{inside}{MARK}]").findall

    def words(self, text: str) -> list[str]:
        """The pre-tokens of a text."""
        return self.split(MARK + text.replace(" ", MARK)) if text else []

    def counts(self, tokens: list[str]) -> list[int]:
        """Tokens of each pre-token, encoded together.

        The model puts a mark before each text, so a leading one is left out. A pre-token without one goes behind a
        character that nothing joins, as a new line is here.
        """
        texts = [t[1:].replace(MARK, " ") if t[0] == MARK else "\n" + t for t in tokens]
        lead = len(self.model.encode("\n"))
        sizes = map(len, self.model.encode(texts, num_threads=1))
        return [1 if t == MARK else n - (t[0] != MARK) * lead for t, n in zip(tokens, sizes, strict=True)]


class LengthTable:
    """Pre-tokens and their lengths in tokens: open addressing over arrays, verified by the text."""

    def __init__(self, hashes: np.ndarray, places: np.ndarray, ends: np.ndarray, lengths: np.ndarray, block: bytes):
        self.hashes, self.places, self.ends, self.lengths, self.block = hashes, places, ends, lengths, block
        self.mask = np.uint64(len(hashes) - 1)

    @classmethod
    def of(cls, tokens: list[str], lengths: list[int]) -> LengthTable:
        texts = [t.encode() for t in tokens]
        size = 1 << max(4, (2 * len(tokens)).bit_length())
        table = cls(
            np.zeros(size, np.uint64),
            np.full(size, -1, np.int32),
            np.cumsum([0, *map(len, texts)], dtype=np.int32),
            np.array(lengths, np.int32),
            b"".join(texts),
        )
        for place, h in enumerate(map(xxh3_64_intdigest, texts)):
            at = h & (size - 1)
            while table.places[at] >= 0:
                at = (at + 1) & (size - 1)
            table.hashes[at], table.places[at] = h, place
        return table

    def parts(self) -> tuple[bytes, ...]:
        return (*(a.tobytes() for a in (self.hashes, self.places, self.ends, self.lengths)), self.block)

    @classmethod
    def from_parts(cls, hashes: bytes, places: bytes, ends: bytes, lengths: bytes, block: bytes) -> LengthTable:
        kinds = (np.uint64, np.int32, np.int32, np.int32)
        return cls(*map(np.frombuffer, (hashes, places, ends, lengths), kinds), block)

    def get(self, tokens: list[str]) -> list[int]:
        """The length of each pre-token, 0 for those that the table lacks."""
        texts = [t.encode() for t in tokens]
        hashes = np.fromiter(map(xxh3_64_intdigest, texts), np.uint64, len(texts))
        out, todo, at = [0] * len(texts), np.arange(len(texts)), hashes & self.mask
        while len(todo):
            place = self.places[at]
            same = (place >= 0) & (self.hashes[at] == hashes[todo])
            for k, p in zip(todo[same].tolist(), place[same].tolist(), strict=True):
                if not out[k] and self.block[self.ends[p] : self.ends[p + 1]] == texts[k]:
                    out[k] = int(self.lengths[p])
            # Equal hashes of other texts lie further on, as does what another hash has pushed along.
            on = place >= 0
            todo, at = todo[on], (at[on] + np.uint64(1)) & self.mask
            left = [not out[k] for k in todo.tolist()]
            todo, at = todo[left], at[left]
        return out


class Counter:
    """Both tiers: the table of frequent pre-tokens, then what this worker has encoded."""

    def __init__(self, model: PieceModel, table: LengthTable):
        self.model, self.table, self.cache = model, table, {}
        # Pre-tokens looked up, and those of them that the table had.
        self.asked = self.answered = 0

    def totals(self, texts: list[str]) -> list[int]:
        """Tokens of each text. The misses of all texts are encoded together."""
        if len(self.cache) > CACHED:
            self.cache.clear()
        words = [self.model.words(t) for t in texts]
        distinct = list(set(chain.from_iterable(words)))
        sizes = dict(zip(distinct, self.table.get(distinct), strict=True))
        rest = [w for w, n in sizes.items() if not n]
        misses = [w for w in rest if w not in self.cache]
        self.cache.update(zip(misses, self.model.counts(misses), strict=True))
        self.asked, self.answered = self.asked + len(distinct), self.answered + len(distinct) - len(rest)
        sizes.update((w, self.cache[w]) for w in rest)
        for w in misses:
            if len(w) > CACHED_LENGTH:
                del self.cache[w]
        return [sum(map(sizes.__getitem__, w)) for w in words]


@lru_cache(maxsize=2)
def _model(file: bytes) -> PieceModel:
    return PieceModel(file)


@lru_cache(maxsize=2)
def _counter(file: bytes, *table: bytes) -> Counter:
    return Counter(_model(file), LengthTable.from_parts(*table))


def frequent_tokens(docs: DataFrame, file: Broadcast, text: str, entries: int) -> list[str]:
    """The most frequent pre-tokens of all texts, by the tasks' summaries; ties by text."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, counts = _model(file.value), Counts()
        for batch in batches:
            for t in strings(batch.column(0)):
                counts.update(model.words(t))
            if len(counts) > COUNTED:
                counts = Counts(dict(counts.most_common(COUNTED // 2)))
        found = [(w, n) for w, n in counts.most_common(REPORTED) if n > 1 and len(w) <= CACHED_LENGTH]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], names=["word", "n"]
        )

    summaries = docs.select(text).mapInArrow(summarise, "word string, n bigint")
    summed = summaries.groupBy("word").agg(F.sum("n").alias("n"))
    return [r.word for r in summed.orderBy(F.desc("n"), "word").limit(entries).select("word").collect()]


def count_tokens(
    docs: DataFrame, path: str, limit: int = 4096, key: str = "doc_id", text: str = "text", entries: int = ENTRIES
) -> DataFrame:
    """One row per document: key, n_bytes, n_tokens, over_limit."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(path, "rb") as f:
        file = f.read(MAX_FILE + 1)
    if len(file) > MAX_FILE:
        raise ValueError(f"{path} is too large for a model")
    shared_file = spark.sparkContext.broadcast(file)
    words = frequent_tokens(docs, shared_file, text, entries)
    table = LengthTable.of(words, PieceModel(file).counts(words))
    shared_table = spark.sparkContext.broadcast(table.parts())

    @F.arrow_udf("bigint")
    def tokens(column: pa.Array) -> pa.Array:
        return pa.array(_counter(shared_file.value, *shared_table.value).totals(strings(column)), pa.int64())

    rows = docs.select(
        F.col(key),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        tokens(F.col(text)).alias("n_tokens"),
    )
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
