"""Near duplicates by HyperMinHash.

A document's set is its distinct 5-word shingles. One 64-bit hash per shingle goes into one of ``REGISTERS`` buckets; a
register keeps of the least hash in its bucket only the count of leading zeros and the first bits behind the leading one (6 + 10
bits). Empty registers borrow from others in a fixed random order, the same for all documents.

1. Texts with equal sets collapse into one class; only classes are compared from here on.
2. Bands of registers put classes into buckets. In each bucket all members are compared with one leader, never all with all.
3. A comparison first estimates the similarity from the registers, corrected for registers that agree by chance; what
   may reach the threshold is confirmed on the full sets of both texts.
4. Links are contracted to components. Buckets whose members all ended up in one component are done. In the others
   a second leader per bucket is tried, and then whatever still lies in different components of a bucket is compared exhaustively, in blocks
   that emit links only. Nothing is capped: no pair that shares a bucket is skipped unless it is already connected or its
   estimate rules it out.

Two documents at similarity 0.75 share no bucket with a probability of about 2e-5 (40 bands of 5 registers), and more similar ones
less. The estimate is trusted within five of its standard deviations.

Null and empty texts have no shingles, belong to no class and are linked with nothing; a text of fewer words is one shingle.
Documents without an id get no component and are kept. Rows that share an id count as one document. Only the key and the text are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.common import Scratch, small_batches, strings, struct, written
from siltstone.llm.components import components, relabel

WORDS, THRESHOLD_PERCENT = 5, 75
REGISTERS, BANDS, ROWS = 256, 40, 5
MANTISSA = 10
# A block of a bucket has about so many members, and shingles.
BLOCK, BLOCK_SHINGLES = 128, 100_000
SIGMAS = 5.0

_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_known_words: dict[bytes, int] = {}
_KNOWN = 500_000


def words(text: str) -> list[bytes]:
    """Runs of anything but ASCII white space, A-Z lowered."""
    return text.encode().translate(_LOWER).split()


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all 5-word shingles; of the whole text if it has fewer words."""
    found = words(text)
    if not found:
        return np.zeros(0, np.uint64)
    if len(_known_words) > _KNOWN:
        _known_words.clear()
    numbers = []
    for w in found:
        number = _known_words.get(w)
        if number is None:
            number = _known_words[w] = xxhash.xxh3_64_intdigest(w)
        numbers.append(number)
    ids = np.array(numbers, np.uint64)
    n = min(WORDS, len(ids))
    total = np.full(len(ids) - n + 1, n, np.uint64)
    for k in range(n):
        total = _mixed(total ^ ids[k : len(ids) - n + 1 + k])
    return np.unique(total)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) + np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _layout() -> tuple[np.ndarray, np.ndarray]:
    """For each register the order in which it borrows, and the registers of each band; the same everywhere."""
    rng = np.random.default_rng(20240501)
    order = np.stack([rng.permutation(REGISTERS) for _ in range(REGISTERS)])
    bands = np.concatenate([rng.permutation(REGISTERS) for _ in range(1 + BANDS * ROWS // REGISTERS)])
    return order, bands[: BANDS * ROWS].reshape(BANDS, ROWS)


def registers(shingles: np.ndarray) -> np.ndarray:
    """The compressed registers of a non-empty set of sorted hashes."""
    shift = np.uint64(64 - REGISTERS.bit_length() + 1)
    bucket = (shingles >> shift).astype(np.int64)
    # Sorted by hash, so the first of each bucket is its least.
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    bits = int(shift)
    rest = shingles[first] & np.uint64((1 << bits) - 1)
    length = np.frexp(rest.astype(np.float64))[1]
    zeros = (bits - length).astype(np.uint64)
    # The bits behind the leading one, pushed to the top of the word.
    behind = (rest << (zeros + np.uint64(1))) & np.uint64((1 << bits) - 1)
    value = (zeros << np.uint64(MANTISSA)) | (behind >> np.uint64(bits - MANTISSA))
    out = np.zeros(REGISTERS, np.uint16)
    filled = np.zeros(REGISTERS, bool)
    at = bucket[first]
    out[at], filled[at] = value.astype(np.uint16), True
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = _layout()[0][empty]
        lender = order[np.arange(len(empty)), filled[order].argmax(1)]
        out[empty] = out[lender]
    return out


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """One 64-bit key per band (columns) and sketch (rows)."""
    chosen = sketches[:, _layout()[1]].astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), chosen.shape[:2])
    for k in range(ROWS):
        keys = _mixed(keys ^ (chosen[:, :, k] + np.uint64(1)))
    return keys.view(np.int64) if keys.flags.c_contiguous else np.ascontiguousarray(keys).view(np.int64)


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The probability that registers of unrelated sets of n and m shingles agree.

    Per count of leading zeros, both must have it, and then the same bits behind the leading one.
    """
    total = np.zeros(np.broadcast(n, m).shape)
    for zeros in range(48):
        high, low = 2.0**-zeros, 2.0 ** -(zeros + 1)
        each = []
        for size in (n, m):
            load = np.maximum(size / REGISTERS, 1.0)
            each.append((1 - low) ** load - np.maximum(1 - high, 0.0) ** load)
        total += each[0] * each[1]
    return total / (1 << MANTISSA)


def estimate(agreeing: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity from the number of equal registers, without those that agree by chance."""
    by_chance = chance(n, m)
    return (agreeing / REGISTERS - by_chance) / (1 - by_chance)


def may_link(agreeing: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """False only if the estimate is more than ``SIGMAS`` deviations below the threshold, or sizes alone forbid a link.

    A set of few shingles fills few registers, so its deviation is larger.
    """
    least, most = np.minimum(n, m), np.maximum(n, m)
    t = THRESHOLD_PERCENT / 100
    deviation = np.sqrt(t * (1 - t) * (1 / REGISTERS + 1 / least))
    return (100 * least >= THRESHOLD_PERCENT * most) & (estimate(agreeing, n, m) >= t - SIGMAS * deviation)


@F.arrow_udf(struct(n=T.LongType(), fingerprint=T.BinaryType(), sketch=T.BinaryType()))
def sketches(column: pa.Array) -> pa.Array:
    sizes, prints, out = [], [], []
    for text in strings(column):
        shingles = shingle_set(text)
        sizes.append(len(shingles))
        prints.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
        out.append(registers(shingles).tobytes() if len(shingles) else None)
    columns = [pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(out, pa.binary())]
    return pa.StructArray.from_arrays(columns, names=["n", "fingerprint", "sketch"])


@F.arrow_udf(T.BinaryType())
def _shingle_bytes(column: pa.Array) -> pa.Array:
    return pa.array([shingle_set(text).tobytes() for text in strings(column)], pa.binary())


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


@F.arrow_udf(T.BooleanType())
def _promising(n: pa.Array, a: pa.Array, m: pa.Array, b: pa.Array) -> pa.Array:
    if not len(n):
        return pa.array([], pa.bool_())
    agreeing = (_matrix(a) == _matrix(b)).sum(1)
    return pa.array(may_link(agreeing, n.to_numpy().astype(float), m.to_numpy().astype(float)))


@F.arrow_udf(T.BooleanType())
def _linked(a: pa.Array, b: pa.Array) -> pa.Array:
    """The exact test on full sets. Rows arrive sorted by the first text's document, so its set is kept."""
    out, held, shingles = [], None, None
    for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
        if x != held:
            held, shingles = x, shingle_set(x)
        other = shingle_set(y)
        both = len(np.intersect1d(shingles, other, assume_unique=True))
        out.append(100 * both >= THRESHOLD_PERCENT * (len(shingles) + len(other) - both))
    return pa.array(out, pa.bool_())


class _Search:
    """The state of one run: classes with their sketches, members of buckets, roots of components."""

    def __init__(self, classes: DataFrame, texts: DataFrame, scratch: Scratch):
        self.classes, self.texts, self.scratch = classes, texts, scratch
        self.roots: DataFrame | None = None

    def promising(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose sketches may link them."""
        left = self.classes.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
        right = self.classes.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
        both = pairs.join(right, "b").join(left, "a")
        return both.where(_promising("n_a", "s_a", "n_b", "s_b")).select("a", "b")

    def confirm(self, pairs: DataFrame) -> None:
        """Keep the pairs that their full sets link, and contract them into the components."""
        pairs = self.scratch.written(pairs, "pairs")
        if pairs.isEmpty():
            return
        member = self.texts.select(F.col("id").alias("b"), F.col("text").alias("t_b"))
        leader = self.texts.select(F.col("id").alias("a"), F.col("text").alias("t_a"))
        both = pairs.join(member, "b").join(leader, "a")
        self.add(both.where(_linked("t_a", "t_b")).select("a", "b"))

    def add(self, links: DataFrame) -> None:
        """Contract links into the components."""
        if self.roots is None:
            self.roots = components(links)
            return
        merged = components(relabel(links, self.roots, "a", "b"))
        old = relabel(self.roots, merged, "root")
        new = merged.join(self.roots.select("node"), "node", "left_anti")
        self.roots = written(old.unionByName(new), "roots")

    def open_members(self, members: DataFrame) -> DataFrame:
        """The members, with their components, of buckets that hold more than one component."""
        labelled = members.withColumn("component", F.col("id"))
        if self.roots is not None:
            labelled = relabel(labelled, self.roots, "component")
        labelled = self.scratch.written(labelled, "members")
        apart = labelled.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"))
        apart = self.scratch.written(apart.where("x != y").select("bucket"), "buckets")
        return self.scratch.written(labelled.join(apart, "bucket", "left_semi"), "members")


def _bands(classes: DataFrame) -> DataFrame:
    """(bucket, id): every class in all of its bands."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(_matrix(batch.column(1)))
                ids = np.repeat(batch.column(0).to_numpy(), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], names=["bucket", "id"])

    return classes.select("id", "sketch").mapInArrow(explode, "bucket bigint, id bigint")


def _with_leader(members: DataFrame, scratch: Scratch, order: Column, *more: str) -> DataFrame:
    """Each member with the member of its bucket that comes first in ``order``."""
    first = F.min(F.struct(order.alias("order"), "id", *more)).alias("first")
    leaders = scratch.written(members.groupBy("bucket").agg(first), "leaders")
    return members.join(leaders, "bucket")


def _rest(members: DataFrame, classes: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (a, b) between components that share a bucket, found block by block on the full sets.

    The members of a bucket's largest component are compared with the others only, not among themselves. Blocks of
    members are joined, not members; a pair is compared in the first bucket that it shares, and a block emits at
    most one link for a member and another component.
    """
    sizes = members.groupBy("bucket", "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("bucket").agg(F.max(F.struct("size", "component")).alias("top"))
    ids = members.select("id").distinct()
    full = texts.join(ids, "id", "left_semi").select("id", _shingle_bytes("text").alias("shingles"))
    full = scratch.written(full.join(classes, "id").dropDuplicates(["id"]), "sets")
    placed = members.join(scratch.written(largest, "largest"), "bucket").join(full, "id")
    placed = placed.withColumn("outer", F.col("component") != F.col("top.component"))
    shares = members.join(classes.select("id", "n"), "id").groupBy("bucket")
    shares = shares.agg(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES).alias("blocks"))
    placed = placed.join(scratch.written(shares, "shares"), "bucket")
    row = F.struct("id", "component", "n", "sketch", "outer", "shingles").alias("row")

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        chunk = F.pmod(F.xxhash64("id"), F.ceil("blocks").cast("bigint")).alias("chunk")
        grouped = rows.select("bucket", chunk, row).groupBy("bucket", "chunk").agg(F.collect_list("row").alias(name))
        return grouped.withColumnRenamed("chunk", f"{name}_chunk")

    joined = blocks(placed.where("outer"), "some").join(blocks(placed, "every"), "bucket")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for bucket, some, every in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found += _block_links(bucket, _Block(some), _Block(every))
            columns = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    return joined.select("bucket", "some", "every").mapInArrow(compare, "a bigint, b bigint")


class _Block:
    """Some members of a bucket, as arrays."""

    def __init__(self, rows: list[dict]):
        self.ids = np.array([r["id"] for r in rows], np.int64)
        self.components = np.array([r["component"] for r in rows], np.int64)
        self.outer = np.array([r["outer"] for r in rows], bool)
        self.n = np.array([r["n"] for r in rows], float)
        self.sketches = np.frombuffer(b"".join(r["sketch"] for r in rows), np.uint16).reshape(-1, REGISTERS)
        self.bands = band_keys(self.sketches)
        self.sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]


def _block_links(bucket: int, some: _Block, every: _Block) -> list[tuple[int, int]]:
    found = []
    for i, own in enumerate(some.sets):
        # A pair of two outer members meets twice; once is enough.
        apart = (some.components[i] != every.components) & (~every.outer | (some.ids[i] < every.ids))
        if not apart.any():
            continue
        agreeing = (some.sketches[i] == every.sketches).sum(1)
        near = np.flatnonzero(apart & may_link(agreeing, some.n[i], every.n))
        shared = (some.bands[i] == every.bands[near]).argmax(1)
        near = near[some.bands[i][shared] == bucket]
        if not len(near):
            continue
        others = np.concatenate([every.sets[j] for j in near])
        owner = np.repeat(np.arange(len(near)), [len(every.sets[j]) for j in near])
        at = np.minimum(np.searchsorted(own, others), len(own) - 1)
        both = np.bincount(owner[own[at] == others], minlength=len(near))
        linked = near[100 * both >= THRESHOLD_PERCENT * (some.n[i] + every.n[near] - both)]
        _, first = np.unique(every.components[linked], return_index=True)
        found += [(int(some.ids[i]), int(every.ids[j])) for j in linked[first]]
    return found


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_shingles, component_id (the least key that links reach), kept."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    sketched = written(rows.select("id", sketches("text").alias("s")).select("id", "s.*"), "sketches")
    usable = sketched.where("id IS NOT NULL AND n > 0")
    # Equal sets are one class, named by its least document. A class that most rows share is summed up before it is shuffled.
    shared = usable.groupBy("fingerprint").agg(F.min("id").alias("class"), F.count("*").alias("size"))
    shared = written(shared.where("size > 1").select("fingerprint", "class"), "classes")
    classed = usable.join(shared, "fingerprint", "left").withColumn("class", F.coalesce("class", "id"))
    classes = classed.where(F.col("class") == F.col("id")).dropDuplicates(["id", "fingerprint"])
    scratch = Scratch(docs.sparkSession)
    classes = scratch.written(classes.select("id", "n", "sketch"), "sketches")
    members_all = _bands(classes)
    several = members_all.groupBy("bucket").agg(F.count("*").alias("size"))
    several = scratch.written(several.where("size > 1").select("bucket"), "buckets")
    members = scratch.written(members_all.join(several, "bucket", "left_semi"), "members")
    # Texts move once, and only those of classes that share a bucket with another.
    wanted = members.select("id").distinct()
    texts = rows.where("text IS NOT NULL").join(wanted, "id", "left_semi").dropDuplicates(["id"])
    search = _Search(classes, scratch.written(texts, "texts"), scratch)

    # One order for all buckets: members of a group meet the same leader in many bands.
    led = _with_leader(members, scratch, F.xxhash64("id"))
    pairs = led.where("id != first.id").select(F.col("first.id").alias("a"), F.col("id").alias("b")).distinct()
    search.confirm(search.promising(pairs))
    # Then an order of its own for each bucket, where components still lie apart.
    still = search.open_members(members)
    if not still.isEmpty():
        led = _with_leader(still, scratch, F.xxhash64("id", "bucket"), "component")
        pairs = led.where("component != first.component").select(F.col("first.id").alias("a"), F.col("id").alias("b"))
        search.confirm(search.promising(pairs.distinct()))
        still = search.open_members(still.select("bucket", "id"))
    if not still.isEmpty():
        search.add(_rest(still, classes, search.texts, scratch))
    # The components are tables of their own by now.
    scratch.remove()

    result = sketched.join(shared, "fingerprint", "left").withColumn("component_id", F.coalesce("class", "id"))
    if search.roots is not None:
        result = relabel(result, search.roots, "component_id")
    return result.select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group: all rows of its least key, with all columns."""
    found = near_duplicates(docs, key, text)
    gone = found.where("NOT kept").select(F.col(key).cast("bigint").alias(f"_{uuid.uuid4().hex}"))
    return docs.join(gone, F.col(key).cast("bigint") == F.col(gone.columns[0]), "left_anti")
