"""Benchmark decontamination: find test passages inside training texts.

The normalised windows of the test items are a hash set that every task holds; training texts stream past it
and are never shuffled. The set is broadcast in blocks of items whose size is measured first, so a test set
of any size passes in several scans of bounded memory instead of one unbounded broadcast. A hash hit
is compared word by word before it counts.

Null and empty texts have no words and no hits; items without words are never found; an item of
fewer words than a window is one window. Repeated rows give repeated results, and several items may share
a window. Only the key and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.common import small_batches, strings, written

WINDOW = 10
# Bytes of item texts in one broadcast block.
BLOCK_BYTES = 16 << 20

_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B))
_TABLE = bytes(
    c if c >= 0x80 or c in _KEEP else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)
SPAN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = {c: c + 32 for c in range(0x41, 0x5B)}


def words(text: str) -> list[bytes]:
    """Lower-cased runs of a-z, 0-9 and everything beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Passages:
    """The windows of test items: hashes for the scan, words for the proof."""

    def __init__(self, items: list[tuple[object, str]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        self.owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words(text or "")]
            n = min(window, len(ids))
            for i in range(len(ids) - n + 1 if n else 0):
                self.owners.setdefault(tuple(ids[i : i + n]), set()).add(str(item))
        rng = np.random.default_rng(7)
        self.values = rng.integers(1, 1 << 63, len(self.number) + 1, np.uint64) | np.uint64(1)
        self.hashes: dict[int, np.ndarray] = {}
        for n in sorted({len(k) for k in self.owners}):
            rows = np.array([k for k in self.owners if len(k) == n], np.int64)
            self.hashes[n] = np.unique(self._rolled(rows.T, n))

    def _rolled(self, columns: np.ndarray, n: int) -> np.ndarray:
        total = np.zeros(columns.shape[1], np.uint64)
        for j in range(n):
            total = total * np.uint64(0x9E3779B97F4A7C15) + self.values[columns[j]]
        return total

    def find(self, found: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie inside an occurrence of a window, and the items it belongs to."""
        size, get = len(found), self.number.get
        hit, owners = np.zeros(size, bool), set()
        ids = np.fromiter(map(get, found, repeat(0)), np.int64, size)
        if not ids.any():
            return hit, owners
        gaps = np.concatenate(([0], np.cumsum(ids == 0)))
        for n, known in self.hashes.items():
            # Only windows whose words all occur in some item are hashed.
            starts = np.flatnonzero(gaps[n:] == gaps[: size - n + 1]) if size >= n else ()
            if not len(starts):
                continue
            rolled = self._rolled(ids[starts + np.arange(n)[:, None]], n)
            near = np.minimum(np.searchsorted(known, rolled), len(known) - 1)
            for i in starts[known[near] == rolled]:
                of = self.owners.get(tuple(ids[i : i + n].tolist()))
                if of:
                    hit[i : i + n] = True
                    owners |= of
        return hit, owners


def blocks(items: DataFrame, key: str, text: str, limit: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The items in blocks of at most ``limit`` bytes (or one item), one block on the driver at a time."""
    block, held = [], 0
    rows = items.where(F.col(text).isNotNull()).select(key, text)
    for row in rows.toLocalIterator():
        if block and held + len(row[1]) > limit:
            yield block
            block, held = [], 0
        block.append((row[0], row[1]))
        held += len(row[1])
    yield block


_ready: dict[str, Passages] = {}


def _passages(name: str, shared: Broadcast, window: int) -> Passages:
    """Built once per worker and block; a worker keeps the last few."""
    if name not in _ready:
        while len(_ready) >= 2:
            _ready.pop(next(iter(_ready)))
        _ready[name] = Passages(shared.value, window)
    return _ready[name]


def _scan(block: list[tuple], window: int, docs: DataFrame, text: str, columns: list) -> tuple[DataFrame, Broadcast]:
    shared = docs.sparkSession.sparkContext.broadcast(block)
    name = uuid.uuid4().hex

    @F.arrow_udf("struct<n_words: bigint, runs: array<bigint>, items: array<string>>")
    def scan(column: pa.Array) -> pa.Array:
        passages = _passages(name, shared, window)
        sizes, runs, items = [], [], []
        for t in strings(column):
            found = words(t)
            hit, owners = passages.find(found)
            sizes.append(len(found))
            # Starts and ends of the hit runs, in words.
            runs.append(np.flatnonzero(np.diff(hit, prepend=False, append=False)).tolist() if owners else [])
            items.append(sorted(owners))
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
            names=["n_words", "runs", "items"],
        )

    return docs.select(*columns, scan(F.col(text)).alias("scan")), shared


@F.arrow_udf(T.ArrayType(T.LongType()))
def _merged(column: pa.Array) -> pa.Array:
    """The union of runs that several blocks of items found in one document."""
    out = []
    for runs in column.to_pylist():
        pairs = sorted((a, b) for r in runs for a, b in zip(r[::2], r[1::2], strict=True))
        flat: list[int] = []
        for a, b in pairs:
            if flat and a <= flat[-1]:
                flat[-1] = max(flat[-1], b)
            else:
                flat += [a, b]
        out.append(flat)
    return pa.array(out, pa.list_(pa.int64()))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: key, n_words, runs (word positions of hits), items (sorted as strings).

    Items of more than one block are scanned for block by block; the rows are written in between, so the driver and
    each worker hold one block at a time, and repeated keys stay apart.
    """
    small_batches(docs.sparkSession)
    parts = blocks(items, item_key, item_text, block_bytes)
    part, following = next(parts), next(parts, None)
    if following is None:
        return _scan(part, window, docs, text, [F.col(key)])[0].select(key, "scan.*")
    rows = docs.select(
        F.col(key).alias("_key"),
        F.col(text).alias("_text"),
        F.array().cast("array<array<bigint>>").alias("_runs"),
        F.array().cast("array<string>").alias("_items"),
    )
    while part is not None:
        found, shared = _scan(part, window, rows, "_text", [F.col(c) for c in rows.columns])
        found = found.select(
            "_key",
            "_text",
            F.array_append("_runs", F.col("scan.runs")).alias("_runs"),
            F.array_union("_items", F.col("scan.items")).alias("_items"),
            F.col("scan.n_words").alias("_n_words"),
        )
        rows = written(found, "scan").drop("_n_words") if following is not None else found
        if following is not None:
            shared.destroy()
        part, following = following, next(parts, None)
    return rows.select(
        F.col("_key").alias(key),
        F.col("_n_words").alias("n_words"),
        _merged("_runs").alias("runs"),
        F.array_sort("_items").alias("items"),
    )


def hit_words(runs: Column) -> Column:
    """Words inside the runs."""
    signed = F.transform(runs, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return F.aggregate(signed, F.lit(0).cast("bigint"), lambda a, x: a + x)


@F.arrow_udf(T.StringType())
def _without(texts: pa.Array, runs: pa.Array) -> pa.Array:
    out = []
    for t, r in zip(texts.to_pylist(), runs.to_pylist(), strict=True):
        if t and r:
            at = [m.span() for m in SPAN.finditer(t.translate(_UPPER))]
            cuts = [(at[a][0], at[b - 1][1]) for a, b in zip(r[::2], r[1::2], strict=True)]
            ends = [0, *(x for c in cuts for x in c), len(t)]
            t = "".join(t[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
        out.append(t)
    return pa.array(out, pa.string())


def decontaminate(docs: DataFrame, items: DataFrame, action: str = "documents", **options) -> DataFrame:
    """``docs`` without the documents that hold a test passage, or (``action="spans"``) without the passages.

    The columns and the number of copies of a kept row stay as they are.
    """
    packed = docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text"))
    found = contamination(packed, items, key="_row", text="_text", **options)
    if action == "documents":
        return found.where(F.size("items") == 0).select("_row.*")
    if action != "spans":
        raise ValueError(f"unknown action: {action}")
    clean = _without(F.col("_row.text"), F.col("runs"))
    return found.withColumn("_clean", clean).select(
        *[F.col("_clean").alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns]
    )
