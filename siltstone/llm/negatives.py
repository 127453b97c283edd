"""Hard negatives: rows of another label that score nearly as high for an anchor as its positives.

The search for the highest inner products prunes by length and by coordinates. Rows are sorted by length into buckets
(``pack``); a bucket holds its vectors, their labels and, for each coordinate, the order of the rows by that coordinate
of the vector of length one. Blocks of anchors meet the buckets from the longest down (``search``). A row that is to reach a score
of s needs a cosine of s / (length of the anchor * length of the longest row in the bucket) at least: beyond 1, this bucket and all
shorter ones are done with; below, each of the anchor's focus coordinates (its largest) leaves a range of feasible
values, which the sorted lists turn into rows. The rows in all ranges are the candidates, whose scores are computed exactly. The scores
found so far raise s from bucket to bucket. Where the ranges hold most of a bucket, all of it is scored at once.

First each anchor's best rows of its own label are found; each of these opens a window of scores, and the second search
keeps the best rows of other labels in each window. Every anchor meets every bucket unless pruned, so work is that of blocks against
blocks; an anchor's state is a few rows, and a block of anchors is one task's. Scores are exact: in 64-bit floats where these hold
every sum, else in Python's integers (beyond 64 bits they come back as the nearest 64-bit number).

Rows with a null key, label or vector, or with a null or non-finite component, take no part. Shorter vectors count as filled up
with zeros. Ties go to the smaller key. Repeated rows are rows of their own; "other" rows have another key than the anchor.
Only the named columns are read. Empty tables and anchors without positives give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import Scratch, small_batches, written

BUCKET_ROWS = 1024
# Coordinates of an anchor that prune, and the part of a bucket beyond which pruning costs more than it saves.
FOCUS, DENSE = 4, 0.3
# Anchors in a block: few enough for their scores on one bucket to fit in a few megabytes.
ANCHORS = 512
EXACT = float(1 << 53)
LONG = 2**63 - 1
BUCKET = "longest double, ids binary, labels binary, item string, dims int, vectors binary, orders binary"


def usable(rows: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """(key, label, vector, is_anchor) of the rows that take part."""
    whole = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    present = F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()
    return rows.where(present & whole).select(
        F.col(key).cast("bigint").alias("key"),
        F.col(label).cast("bigint").alias("label"),
        whole_numbers(F.col(vector)).alias("vector"),
        F.coalesce("_is_anchor", F.lit(False)).alias("is_anchor"),
    )


def whole_numbers(vector: Column) -> Column:
    """Components in steps of 1/256, as whole numbers of type double."""

    def rounded(x: Column) -> Column:
        # Beyond 2^52 a double has no fraction, and ``floor`` gives 64 bits only.
        y = x.cast("double") * 256
        return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)

    return F.transform(vector, rounded)


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """The vectors as rows of a matrix; shorter ones end in zeros."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), dims))
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _narrow(vectors: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest type that has them."""
    largest = np.abs(vectors).max(initial=0)
    for kind in (np.int8, np.int16, np.int32):
        if largest <= np.iinfo(kind).max:
            return vectors.astype(kind)
    return vectors


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares of very large components stay finite.
    largest = np.abs(vectors).max(axis=1, initial=0, keepdims=True)
    scaled = vectors / np.where(largest > 0, largest, 1)
    lengths = np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    return scaled / np.where(lengths > 0, lengths, 1)


def _lengths(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, initial=0, keepdims=True)
    scaled = vectors / np.where(largest > 0, largest, 1)
    return np.sqrt((scaled * scaled).sum(axis=1)) * largest[:, 0]


def pack(rows: DataFrame, dims: int, parts: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(key, label, vector) as buckets of rows of like length.

    Rows are dealt by length into ranges. Equal lengths are spread by a hash of key and vector, so a vector that stands in many rows
    fills many buckets and not one task.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def bucket(keys, labels, vectors) -> pa.RecordBatch:
            orders = np.argsort(_unit(vectors), axis=0).T.astype(np.uint16 if len(keys) <= 1 << 16 else np.uint32)
            longest = _lengths(vectors).max()
            small = _narrow(vectors)
            values = (
                longest, keys.astype("<i8").tobytes(), labels.astype("<i8").tobytes(), small.dtype.str,
                dims, small.tobytes(), np.ascontiguousarray(orders).tobytes(),
            )
            types = (pa.float64(), pa.binary(), pa.binary(), pa.string(), pa.int32(), pa.binary(), pa.binary())
            arrays = [pa.array([v], t) for v, t in zip(values, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in BUCKET.split(", ")])

        def joined(parts: list[tuple]) -> tuple:
            return tuple(map(np.concatenate, zip(*parts, strict=True)))

        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            held.append((keys, labels, _matrix(batch.column("vector"), dims)))
            if sum(len(k) for k, _, _ in held) >= bucket_rows:
                keys, labels, vectors = joined(held)
                whole = len(keys) // bucket_rows * bucket_rows
                for i in range(0, whole, bucket_rows):
                    yield bucket(keys[i : i + bucket_rows], labels[i : i + bucket_rows], vectors[i : i + bucket_rows])
                held = [(keys[whole:], labels[whole:], vectors[whole:])]
        if any(len(k) for k, _, _ in held):
            yield bucket(*joined(held))

    # Only the order matters here, so squares may overflow to infinity.
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    order = [squares.desc(), F.xxhash64("key", "vector")]
    dealt = rows.repartitionByRange(parts, *order, F.rand(12)).sortWithinPartitions(*order)
    return dealt.select("key", "label", "vector").mapInArrow(packed, BUCKET)


class _Anchors:
    """A block of anchors, the windows of scores each looks at, and the best rows found in each so far."""

    def __init__(self, held: list[dict], dims: int, same_label: bool, k: int, exact: bool):
        self.numbers, self.keys, self.labels = (np.array([a[c] for a in held], np.int64) for c in ("number", "key", "label"))
        self.vectors = np.zeros((len(held), dims))
        for row, a in enumerate(held):
            self.vectors[row, : len(a["vector"])] = a["vector"]
        self.same_label, self.k = same_label, k
        self.lengths, self.unit = _lengths(self.vectors), _unit(self.vectors)
        self.peak = np.abs(self.vectors).max(initial=0)
        self.focus = np.argsort(-np.abs(self.unit), axis=1)[:, :FOCUS]
        # Windows, side by side for each anchor; one that is not there is never met.
        self.width = max((len(a["windows"]) for a in held), default=0)
        shape, kind = (len(held), self.width), object if exact else np.float64
        self.low, self.high = np.full(shape, np.inf, kind), np.full(shape, -np.inf, kind)
        for row, a in enumerate(held):
            for column, w in enumerate(a["windows"]):
                self.low[row, column] = -np.inf if w["low"] is None else w["low"]
                self.high[row, column] = np.inf if w["high"] is None else w["high"]
        # The k best of each window: scores, keys. An empty place has the least score.
        self.scores = np.full((*shape, k), -np.inf, kind)
        self.found = np.zeros((*shape, k), np.int64)

    def needed(self) -> np.ndarray:
        """Per anchor the least score that may still enter one of its windows."""
        return np.maximum(self.low, self.scores[:, :, -1]).min(axis=1, initial=np.inf)

    def meet(self, bucket: _Bucket) -> None:
        need = self.needed().astype(np.float64)
        reach = self.lengths * bucket.longest * (1 + 1e-9)
        alive = (need <= reach) & (need < np.inf)
        dense, prunes = np.flatnonzero(alive & (need <= 0)), np.flatnonzero(alive & (need > 0))
        sparse: list[int] = []
        if len(prunes):
            low, high = self._ranges(bucket, prunes, need[prunes] / reach[prunes])
            shortest = (high - low).argmin(axis=1)
            size = (high - low)[np.arange(len(prunes)), shortest]
            many = size > DENSE * len(bucket.keys)
            dense = np.concatenate((dense, prunes[many]))
            sparse = np.flatnonzero(~many & (size > 0)).tolist()
        if len(dense):
            self._verify(bucket, dense, slice(None))
        for i in sparse:
            focus, best = self.focus[prunes[i]], int(shortest[i])
            candidates = bucket.orders[focus[best], low[i, best] : high[i, best]]
            # The other focus coordinates: a row stays if it lies in their ranges too.
            for c in range(len(focus)):
                if c != best:
                    place = bucket.places[focus[c], candidates]
                    candidates = candidates[(place >= low[i, c]) & (place < high[i, c])]
            if len(candidates):
                self._verify(bucket, prunes[i : i + 1], candidates)

    def _ranges(self, bucket: _Bucket, rows: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each anchor and focus coordinate the range of the sorted list that may reach the cosine."""
        focus = self.focus[rows]
        angle = np.arccos(np.clip(np.take_along_axis(self.unit[rows], focus, axis=1), -1, 1))
        apart = np.arccos(np.clip(cosine, -1, 1))[:, None]
        # With room for rounding.
        least = np.cos(np.minimum(angle + apart, np.pi)) - 1e-7
        most = np.cos(np.maximum(angle - apart, 0)) + 1e-7
        low, high = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
        for c in np.unique(focus).tolist():
            here = np.nonzero(focus == c)
            low[here] = np.searchsorted(bucket.values[c], least[here], "left")
            high[here] = np.searchsorted(bucket.values[c], most[here], "right")
        return low, high

    def _verify(self, bucket: _Bucket, rows: np.ndarray, candidates: np.ndarray | slice) -> None:
        """Exact scores of anchors with candidates; the best stay."""
        vectors, keys, labels = bucket.vectors[candidates], bucket.keys[candidates], bucket.labels[candidates]
        own = self.vectors[rows]
        if self.peak * bucket.peak * own.shape[1] < EXACT:
            scores = own @ vectors.T
        else:
            scores = _integers(own) @ _integers(vectors).T
        fits = (self.labels[rows][:, None] == labels) == self.same_label
        fits &= self.keys[rows][:, None] != keys
        fits &= (scores >= self.needed()[rows][:, None]).astype(bool)
        at, of = np.nonzero(fits)
        if not len(at):
            return
        scores, keys = scores[at, of], keys[of]
        if self.scores.dtype == object and scores.dtype != object:
            scores = _integers(scores)
        for w in range(self.width):
            which = rows[at]
            least, last = self.scores[which, w, -1], self.found[which, w, -1]
            enters = (scores >= self.low[which, w]) & (scores <= self.high[which, w])
            enters &= (scores > least) | ((scores == least) & (keys < last))
            enters = enters.astype(bool)
            if enters.any():
                self._enter(which[enters], w, scores[enters], keys[enters])

    def _enter(self, rows: np.ndarray, w: int, scores: np.ndarray, keys: np.ndarray) -> None:
        """Merge new (row, score, key) into the best of a window."""
        k, touched = self.k, np.unique(rows)
        rows = np.concatenate((rows, np.repeat(touched, k)))
        scores = np.concatenate((scores, self.scores[touched, w].ravel()))
        keys = np.concatenate((keys, self.found[touched, w].ravel()))
        order = np.lexsort((keys, -scores, rows))
        best = np.searchsorted(rows[order], touched)[:, None] + np.arange(k)
        self.scores[touched, w], self.found[touched, w] = scores[order][best], keys[order][best]


def _integers(numbers: np.ndarray) -> np.ndarray:
    """Whole doubles as Python's integers, which have no bound."""
    return np.array([int(x) for x in numbers.ravel()] + [None], object)[:-1].reshape(numbers.shape)


class _Bucket:
    def __init__(self, row: dict):
        self.longest = row["longest"]
        self.keys, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
        shape = len(self.keys), row["dims"]
        self.vectors = np.frombuffer(row["vectors"], row["item"]).reshape(shape).astype(np.float64)
        self.peak = np.abs(self.vectors).max(initial=0)
        orders = np.frombuffer(row["orders"], np.uint16 if shape[0] <= 1 << 16 else np.uint32)
        self.orders = orders.reshape(shape[::-1]).astype(np.int64)

    @cached_property
    def values(self) -> np.ndarray:
        """For each coordinate its values in vectors of length one, sorted."""
        return np.take_along_axis(_unit(self.vectors).T, self.orders, axis=1)

    @cached_property
    def places(self) -> np.ndarray:
        """For each coordinate where a row stands in the sorted list."""
        places = np.empty_like(self.orders)
        np.put_along_axis(places, self.orders, np.arange(self.orders.shape[1])[None, :], axis=1)
        return places


FOUND = "number bigint, window int, rank int, key bigint, score bigint"


def _long(score: float) -> int:
    return max(-LONG - 1, min(LONG, int(score)))


def _met(dims: int, same_label: bool, k: int, exact: bool):
    """Blocks of anchors, each followed by the buckets."""

    def result(state: _Anchors | None) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(5)]
        if state is not None:
            row, window, rank = np.nonzero((state.scores > -np.inf).astype(bool))
            columns = [
                state.numbers[row].tolist(), window.tolist(), (rank + 1).tolist(),
                state.found[row, window, rank].tolist(), list(map(_long, state.scores[row, window, rank].tolist())),
            ]
        types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in FOUND.split(", ")])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, state = None, [], None
        for batch in batches:
            for number in range(len(batch)):
                row = {c: batch.column(c)[number].as_py() for c in ("block", "anchor", "probe")}
                if row["block"] != block:
                    yield result(state)
                    block, held, state = row["block"], [], None
                if row["anchor"] is not None:
                    held.append(row["anchor"])
                elif held:
                    state = state or _Anchors(held, dims, same_label, k, exact)
                    state.meet(_Bucket(row["probe"]))
        yield result(state)

    return meet


def search(anchors: DataFrame, buckets: DataFrame, dims: int, k: int, same_label: bool, blocks: int, exact: bool) -> DataFrame:
    """The ``k`` best rows of each window of each anchor.

    ``anchors``: number (unique), key, label, vector, windows (array of structs low, high; null is no limit). Result: number,
    window (from 0), rank (from 1), key, score. ``exact`` is for scores that 64-bit floats may not hold.
    """
    block = F.pmod(F.xxhash64("number"), F.lit(blocks)).cast("int")
    given = F.struct("number", "key", "label", "vector", "windows").alias("anchor")
    queries = anchors.select(block.alias("block"), F.lit(0.0).alias("after"), given)
    # Every block of anchors meets every bucket, the longest first.
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    probes = buckets.select(each, (1 / (F.col("longest") + 1) + 1).alias("after"), F.struct("*").alias("probe"))
    stream = queries.unionByName(probes, allowMissingColumns=True)
    stream = stream.repartitionById(blocks, "block").sortWithinPartitions("block", "after")
    return stream.select("block", "anchor", "probe").mapInArrow(_met(dims, same_label, k, exact), FOUND)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
) -> DataFrame:
    """For each anchor and each of its best rows of its label, the best of other labels that score 80 to 100 percent of it.

    ``is_anchor`` is a condition on the columns of ``rows``. Result: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.
    """
    spark = rows.sparkSession
    small_batches(spark)
    points = usable(rows.withColumn("_is_anchor", is_anchor), key, label, vector)
    with_sizes = points.agg(
        F.count("*"), F.count_if("is_anchor"), F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", F.abs)))
    )
    count, n_anchors, dims, peak = with_sizes.first()
    dims, peak = max(1, dims or 0), peak or 0.0
    exact = peak * peak * dims >= EXACT
    cores = spark.sparkContext.defaultParallelism
    blocks = max(-(-n_anchors // ANCHORS), min(cores, n_anchors), 1)
    with Scratch(spark) as scratch:
        buckets = scratch.written(pack(points, dims, max(cores, -(-count // (8 * BUCKET_ROWS)))), "buckets")
        anchors = points.where("is_anchor").withColumn("number", F.monotonically_increasing_id())
        anchors = scratch.written(anchors.drop("is_anchor"), "anchors")
        limits = "struct<low: bigint, high: bigint>"
        everything = F.array(F.struct(F.lit(None).alias("low"), F.lit(None).alias("high")).cast(limits))
        best = search(anchors.withColumn("windows", everything), buckets, dims, positives, True, blocks, exact)
        best = scratch.written(best, "positives")
        # 80 * positive <= 100 * negative in whole numbers; nothing lies below a negative score's own 80 percent.
        low = F.expr("score - score div 5").alias("low")
        window = F.struct("rank", F.struct(low, F.col("score").alias("high")).alias("limits"))
        windows = best.where("score >= 0").groupBy(F.col("number").alias("_number")).agg(F.sort_array(F.collect_list(window)).alias("_w"))
        asked = anchors.join(windows, F.col("number") == F.col("_number"))
        asked = asked.withColumn("windows", F.transform("_w", lambda w: w["limits"])).drop("_number", "_w")
        found = scratch.written(search(asked, buckets, dims, negatives, False, blocks, exact), "negatives")
        # Scores fall with the rank, so those of at least 0 come first and a window's number is its positive's rank.
        chosen = best.select(
            F.col("number"), (F.col("rank") - 1).alias("window"), F.col("key").alias("positive_id"), F.col("score").alias("positive_score")
        )
        named = chosen.join(anchors.select("number", F.col("key").alias("anchor_id")), "number")
        mined = named.join(found, ["number", "window"]).select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("key").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
        return written(mined, "hard-negatives")
