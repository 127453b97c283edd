"""Byte-level BPE encoding and decoding.

A pattern splits each text into pre-tokens. The distinct pre-tokens of a batch that are not known yet go into
padded matrices, one per length bucket. In each round every row merges its leftmost pair of least rank; the
ranks of adjacent pairs come from a hash table in numpy, only the two pairs beside a merge are looked up again,
and rows without a pair left leave the matrix. A worker remembers the ids of pre-tokens it has seen, up to a
bound. Pre-tokens beyond the widest bucket (such as a text without a single space) are merged with a heap instead,
since a matrix of one row costs the square of its width.

Null and empty texts have no tokens and decode to nothing. Repeated rows give repeated results. Only named columns
are read and returned.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import small_batches, strings

NONE = np.int32(1 << 30)
WIDTHS = (4, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64, 128, 256)
# Pre-tokens a worker remembers, those longer than this apart.
REMEMBERED, REMEMBERED_LENGTH = 500_000, 64
# A rank file is broadcast; anything larger is no vocabulary.
MAX_FILE = 64 << 20


class PairTable:
    """(left id, right id) to the id of both joined: open addressing over arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 2).bit_length())
        self.mask = np.int64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        self.probes = 0
        at = self._home(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] == -1)
            slots, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.keys[slots], self.values[slots] = keys[placed], values[placed]
            left = np.ones(len(keys), bool)
            left[placed] = False
            keys, values, at = keys[left], values[left], (at[left] + 1) & self.mask
            self.probes += 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right
        out = np.full(keys.shape, NONE, np.int32)
        flat, result = keys.ravel(), out.ravel()
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        at = self._home(flat[todo])
        for _ in range(self.probes):
            there = self.keys[at]
            same = there == flat[todo]
            result[todo[same]] = self.values[at[same]]
            on = ~same & (there != -1)
            if not on.any():
                break
            todo, at = todo[on], (at[on] + 1) & self.mask
        return result.reshape(keys.shape)


class Vocabulary:
    """Ranks of a tokenizer file and everything that encoding needs."""

    def __init__(self, file: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.splitlines()) if a}
        self.id_bytes = {rank: np.int32(rank).tobytes() for rank in self.ranks.values()}
        self.width_of = [next(w for w in WIDTHS if n <= w) for n in range(WIDTHS[-1] + 1)]
        # For decoding: all tokens in one block, and where each begins and ends.
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.block = np.frombuffer(b"".join(tokens), np.uint8)
        self.ends = np.cumsum([len(t) for t in tokens])
        self.sizes = np.diff(self.ends, prepend=0)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        keys, values = [], []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        self.pairs = PairTable(np.array(keys, np.int64), np.array(values, np.int32))

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as 32-bit integers; a word that is a token is that token, as the rank files mean it."""
        out = [b""] * len(words)
        buckets: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            rank = self.ranks.get(word)
            if rank is not None:
                out[k] = self.id_bytes[rank]
            elif len(word) > WIDTHS[-1]:
                out[k] = self.encode_long(word)
            elif word:
                buckets.setdefault(self.width_of[len(word)], []).append(k)
        for width, members in buckets.items():
            for i in range(0, len(members), 8192):
                part = members[i : i + 8192]
                for k, ids in zip(part, self._merge([words[k] for k in part], width), strict=True):
                    out[k] = ids
        return out

    def _merge(self, words: list[bytes], width: int) -> list[bytes]:
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        columns = np.arange(width)
        ids = np.where(columns < lengths[:, None], self.byte_ids[raw], np.int32(-1))
        ranks = self.pairs.get(ids[:, :-1], ids[:, 1:])
        rows, out = np.arange(len(words)), [b""] * len(words)
        while len(rows):
            at = ranks.argmin(axis=1)  # the first of the least
            best = ranks[np.arange(len(rows)), at]
            done = best == NONE
            if done.any():
                sizes = (ids[done] >= 0).sum(axis=1).tolist()
                for row, line, n in zip(rows[done].tolist(), ids[done], sizes, strict=True):
                    out[row] = line[:n].tobytes()
                rows, ids, ranks, at, best = rows[~done], ids[~done], ranks[~done], at[~done], best[~done]
                if not len(rows):
                    break
            # Close the gap behind the merged pair. Every row gets shorter by one, and so does the matrix.
            each = np.arange(len(rows))
            stay = columns[: ids.shape[1] - 1] <= at[:, None]
            ids = np.where(stay, ids[:, :-1], ids[:, 1:])
            ids[each, at] = best
            if ids.shape[1] == 1:
                ranks = np.full(ids.shape, NONE, np.int32)
                continue
            ranks = np.where(stay[:, :-1], ranks[:, :-1], ranks[:, 1:])
            last = ranks.shape[1]
            inner = np.flatnonzero(at < last)
            right = at[inner]
            ranks[inner, right] = self.pairs.get(ids[inner, right], ids[inner, right + 1])
            inner = np.flatnonzero(at > 0)
            left = at[inner] - 1
            ranks[inner, left] = self.pairs.get(ids[inner, left], ids[inner, left + 1])
        return out

    def encode_long(self, word: bytes) -> bytes:
        """The same merges in n log n steps, for words wider than any matrix."""
        parts: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
        following = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap = []

        def offer(i: int) -> None:
            j = following[i]
            if j < len(parts):
                rank = self.ranks.get(parts[i] + parts[j])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, parts[i], parts[j]))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = following[i]
            if parts[i] is not a or j >= len(parts) or parts[j] is not b:
                continue
            parts[i], parts[j] = a + b, None
            following[i] = following[j]
            if following[j] < len(parts):
                before[following[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return b"".join(self.id_bytes[self.ranks[p]] for p in parts if p is not None)


class Splitter:
    """The matches of one pattern, for which splitting on classes of characters comes to the same."""

    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
    OTHER, LETTER, NUMBER, SPACE, SEAM = range(5)

    def __init__(self):
        self.kind = np.zeros(0x110000, np.uint8)
        every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
        for kind, of in ((self.LETTER, r"\p{L}+"), (self.NUMBER, r"\p{N}+"), (self.SPACE, r"\s+")):
            for run in regex.findall(of, every):
                self.kind[[ord(c) for c in run]] = kind

    def _cut(self, text: str, codes: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Whether a match begins at each character."""
        size = len(codes)
        cut = np.ones(size, bool)
        np.not_equal(kind[1:], kind[:-1], out=cut[1:])
        # White space before something else leaves its last character to it, or by itself.
        after = np.flatnonzero(cut[1:] & (kind[:-1] == self.SPACE) & (kind[1:] != self.SEAM)) + 1
        cut[after - 1] = True
        cut[after[codes[after - 1] == 0x20]] = False
        for q in np.flatnonzero(codes == 0x27).tolist():
            if q and (kind[q - 1] == self.OTHER or codes[q - 1] == 0x20):
                continue
            if q + 1 < size and kind[q + 1] == self.LETTER:
                ending = next((e for e in self.ENDINGS if text.startswith(e, q)), None)
                if ending:
                    cut[q + 1] = False
                    if q + len(ending) < size:
                        cut[q + len(ending)] = True
        return cut

    def __call__(self, text: str) -> list[str]:
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        size = len(codes)
        if not size:
            return []
        at = np.flatnonzero(self._cut(text, codes, self.kind[codes])).tolist()
        return [text[a:b] for a, b in zip(at, [*at[1:], size], strict=True)]

    def column(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The matches of all texts in one column, an empty one behind each text, and where those stand."""
        # Texts are split as one, with a character between them that matches nothing and is no part of the column.
        text = "\0".join([*texts, ""])
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kind = self.kind[codes]
        seams = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) - 1
        kind[seams] = self.SEAM
        cut = self._cut(text, codes, kind)
        cut[seams] = True
        starts = np.flatnonzero(cut)
        data = "".join(texts).encode()
        if len(data) + len(texts) == len(codes):
            width = np.ones(len(codes), np.int8)
        else:
            width = 1 + (codes >= 0x80).view(np.int8) + (codes >= 0x800).view(np.int8) + (codes >= 0x10000).view(np.int8)
        width[seams] = 0
        offsets = np.concatenate(([0], np.cumsum(width, dtype=np.int64)))[np.append(starts, len(codes))]
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        return pa.Array.from_buffers(pa.large_string(), len(starts), buffers), np.searchsorted(starts, seams)


class Encoder:
    def __init__(self, file: bytes, pattern: str):
        self.vocabulary = Vocabulary(file)
        self.split = Splitter() if pattern == Splitter.PATTERN else regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text's ids end."""
        known, split = self.known, self.split
        if len(known) > REMEMBERED:
            known.clear()
        words = [split(t) for t in texts]
        new = [w for w in set(chain.from_iterable(words)) if w not in known]
        known.update(zip(new, self.vocabulary.encode_words([w.encode() for w in new]), strict=True))
        parts = [b"".join(map(known.__getitem__, w)) for w in words]
        for w in new:
            if len(w) > REMEMBERED_LENGTH:
                del known[w]
        ends = np.cumsum([len(p) // 4 for p in parts], dtype=np.int64)
        return np.frombuffer(b"".join(parts), np.int32), ends

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in one array, and where each id's bytes end."""
        v = self.vocabulary
        if len(ids) and (ids.min() < 0 or ids.max() >= len(v.sizes) or not v.sizes[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        sizes = v.sizes[ids]
        ends = np.cumsum(sizes)
        shift = v.ends[ids] - ends
        return v.block[np.arange(ends[-1] if len(ids) else 0) + np.repeat(shift, sizes)], ends


@lru_cache(maxsize=2)
def encoder_of(file: bytes, pattern: str) -> Encoder:
    """One per worker and vocabulary."""
    return Encoder(file, pattern)


class Tokenizer:
    """A rank file and a pattern, ready for DataFrames. The file is read on the driver and broadcast."""

    def __init__(self, spark, path: str, pattern: str):
        small_batches(spark)
        with open(path, "rb") as f:
            file = f.read(MAX_FILE + 1)
        if len(file) > MAX_FILE:
            raise ValueError(f"{path} is too large for a rank file")
        self._shared: Broadcast = spark.sparkContext.broadcast(file)
        self._pattern = pattern

    def encode(self, docs: DataFrame, text: str = "text", ids: str = "ids") -> DataFrame:
        """``docs`` with one more column: array of token ids."""
        shared, pattern = self._shared, self._pattern

        @F.arrow_udf("array<int>")
        def encode(column: pa.Array) -> pa.Array:
            flat, ends = encoder_of(shared.value, pattern).encode(strings(column))
            offsets = np.concatenate(([0], ends)).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

        return docs.withColumn(ids, encode(F.col(text)))

    def decode(self, docs: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
        """``docs`` with one more column: the bytes of the ids; null ids give no bytes, unknown ids an error."""
        shared, pattern = self._shared, self._pattern

        @F.arrow_udf("binary")
        def decode(column: pa.Array) -> pa.Array:
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            block, ends = encoder_of(shared.value, pattern).decode(flat)
            counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
            buffers = [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(block.tobytes())]
            return pa.Array.from_buffers(pa.large_binary(), len(column), buffers).cast(pa.binary())

        return docs.withColumn(decoded, decode(F.col(ids)))
