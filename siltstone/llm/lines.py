"""Line dedup that can take documents back.

A line's key is the line stripped of ASCII white space with A-Z lowered, as 128 bits of hash. An index holds, as
tables in a folder,

* ``references``: which document holds which key, and in how many rows (needed to take a document back),
* ``counts``: for each key the exact number of documents and the largest of them,
* ``filters``: per shard of keys a cuckoo filter of the keys that repeat often enough to be dropped.

Inserting documents adds references, and keys that reach the threshold enter the filter of their shard; deleting
documents removes references, and keys that fall below it leave the filter. To clean documents, their lines meet the
filters first: most lines are unique, and only those that pass are looked up in the exact table. A shard's filter is
copied to several salts, so a line that a third of all documents hold is spread over tasks; filters come
first in the sorted partitions and lines stream past them, so memory holds one filter and one batch.

A document is an id: rows with one id count once, whether inserted together or later, and a line stays in all rows of the
largest id that holds it. Rows without an id count as one document each; a null id is smaller than any other. Null and empty texts are one empty line, which
never counts. Each change writes a new version of the tables and leaves the former one alone. Other columns
of the input are not read by the index and come back unchanged from ``clean``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.common import small_batches
from siltstone.llm.cuckoo import Cuckoo
from siltstone.session import shared_folder

BLANK = "\t\n\x0b\f\r "
MIN_CHARS, MIN_DOCS = 20, 3
SHARDS, SALTS = 64, 8
_INSERT, _DELETE = 2, 1


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """128 bits for the normalised line; none if it is too short to count."""
    line = line.strip(BLANK)
    return xxhash.xxh3_128_digest(line.encode().lower()) if len(line) >= min_chars else None


def _words(keys: pa.Array) -> np.ndarray:
    """The second half of each key, for the filters; shards use the first."""
    return np.frombuffer(b"".join(keys.to_pylist()), "<u8").reshape(-1, 2)[:, 1].astype(np.uint64)


def key_rows(docs: DataFrame, key: str, text: str, shards: int, min_chars: int) -> DataFrame:
    """(doc, key, shard): each document's distinct keys."""
    small_batches(docs.sparkSession)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys = [], []
            for k, value in enumerate(batch.column(1).to_pylist()):
                own = {line_key(line, min_chars) for line in (value or "").split("\n")} - {None}
                keys += own
                rows += [k] * len(own)
            names = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)[:, 0]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(keys, pa.binary()),
                    pa.array((names % np.uint64(shards)).astype(np.int32)),
                ],
                names=["doc", "key", "shard"],
            )

    kind = docs.schema[key].dataType
    schema = T.StructType().add("doc", kind).add("key", "binary").add("shard", "integer")
    return docs.select(F.col(key).alias("doc"), F.col(text).alias("text")).mapInArrow(explode, schema)


class LineIndex:
    """References, counts and filters of the documents inserted so far."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str | None = None,
        shards: int | None = None,
        min_docs: int = MIN_DOCS,
        min_chars: int = MIN_CHARS,
    ):
        self.spark = spark
        self.folder = folder or f"{shared_folder(spark).rstrip('/')}/lines-{uuid.uuid4().hex}"
        # As many as the session shuffles into, so that a larger corpus has more and not larger filters.
        self.shards = shards or max(SHARDS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.min_docs, self.min_chars = min_docs, min_chars
        self.version = 0

    def _path(self, table: str, version: int | None = None) -> str:
        return f"{self.folder}/v{self.version if version is None else version:06d}/{table}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name))

    def _save(self, version: int, name: str, rows: DataFrame) -> DataFrame:
        rows.write.parquet(self._path(name, version))
        return self.spark.read.parquet(self._path(name, version))

    @staticmethod
    def _counted(references: DataFrame) -> DataFrame:
        # A document has one reference for a key; rows without an id share one, but are a document each.
        documents = F.when(F.col("doc").isNull(), F.col("n_rows")).otherwise(1)
        return references.groupBy("shard", "key").agg(F.sum(documents).alias("n_docs"), F.max("doc").alias("holder"))

    def insert(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> LineIndex:
        new = self.version + 1
        rows = key_rows(docs, key, text, self.shards, self.min_chars)
        rows = rows.groupBy("doc", "key", "shard").agg(F.count("*").alias("n_rows"))
        if self.version:
            rows = rows.join(self.table("references").select("doc", "key"), ["doc", "key"], "left_anti")
        added = self._save(new, "added" if self.version else "references", rows)
        counts = self._counted(added)
        if self.version == 0:
            counts = self._save(new, "counts", counts)
            self._save(new, "filters", self._filters(counts, None, None))
        else:
            before = self.table("counts").withColumn("old", F.col("n_docs"))
            merged = (
                before.unionByName(counts.withColumn("old", F.lit(0).cast("bigint")))
                .groupBy("shard", "key")
                .agg(F.sum("n_docs").alias("n_docs"), F.max("holder").alias("holder"), F.sum("old").alias("old"))
            )
            self._replace(new, merged, self.table("references").unionByName(added))
        self.version = new
        return self

    def delete(self, ids: DataFrame, key: str = "doc_id") -> LineIndex:
        """Take documents back. Ids that were never inserted change nothing."""
        new, references = self.version + 1, self.table("references")
        gone = ids.select(F.col(key).alias("doc_gone")).distinct()
        same = F.col("doc").eqNullSafe(F.col("doc_gone"))
        removed = self._save(new, "removed", references.join(gone, same, "left_semi"))
        left = references.join(gone, same, "left_anti")
        touched = removed.select("key").distinct()
        # Only keys of the deleted documents are counted again.
        again = self._counted(left.join(touched, "key", "left_semi"))
        before = self.table("counts").withColumn("old", F.col("n_docs"))
        changed = before.join(touched, "key", "left_semi").select("shard", "key", "old")
        recounted = changed.join(again, ["shard", "key"], "left").select(
            "shard", "key", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "holder", "old"
        )
        merged = before.join(touched, "key", "left_anti").unionByName(recounted)
        self._replace(new, merged, left)
        self.version = new
        return self

    def _replace(self, new: int, merged: DataFrame, references: DataFrame) -> None:
        merged = self._save(new, "merged", merged)
        counts = self._save(new, "counts", merged.where("n_docs > 0").drop("old"))
        self._save(new, "references", references)
        many, had = F.col("n_docs") >= self.min_docs, F.col("old") >= self.min_docs
        changes = merged.where(many != had).select(
            "shard", "key", F.when(many, _INSERT).otherwise(_DELETE).alias("turn")
        )
        self._save(new, "filters", self._filters(counts, self.table("filters"), changes))

    def _filters(self, counts: DataFrame, old: DataFrame | None, changes: DataFrame | None) -> DataFrame:
        """The filters of all shards: brought up to date where there is room, else built anew from the exact table.

        A shard's filter streams in before its deletions and insertions; memory holds one filter and one batch.
        """
        repeated = counts.where(F.col("n_docs") >= self.min_docs)
        sizes = repeated.groupBy("shard").agg(F.count("*").alias("size"))
        no_key, no_data = F.lit(None).cast("binary").alias("key"), F.lit(None).cast("binary").alias("data")
        every = repeated.join(sizes, "shard").select("shard", "size", F.lit(_INSERT).alias("turn"), "key", no_data)
        if old is None:
            rows = every
        else:
            # A row per shard, so these tables are as short as the number of shards.
            fits = old.join(sizes, "shard", "left").where(F.col("capacity") >= F.coalesce("size", F.lit(0)))
            room = fits.select("shard", F.coalesce("size", F.lit(0)).alias("size"))
            kept = fits.select("shard", F.coalesce("size", F.lit(0)).alias("size"), F.lit(0).alias("turn"), no_key, "data")
            updates = changes.join(room, "shard").select("shard", "size", "turn", "key", no_data)
            rows = kept.unionByName(updates).unionByName(every.join(room, "shard", "left_anti"))

        def maintain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: tuple[int, Cuckoo] | None = None

            def packed(shard: int, filter_: Cuckoo) -> pa.RecordBatch:
                capacity = int(filter_.table.size * 0.8)
                columns = [pa.array([shard], pa.int32()), pa.array([capacity], pa.int64())]
                data = pa.array([filter_.to_bytes()], pa.binary())
                return pa.RecordBatch.from_arrays([*columns, data], names=["shard", "capacity", "data"])

            for batch in batches:
                for shard, turn, part in _runs(batch):
                    if turn == 0:
                        if held:
                            yield packed(*held)
                        held = shard, Cuckoo(data=part.column("data")[0].as_py())
                        continue
                    if held is None or held[0] != shard:
                        if held:
                            yield packed(*held)
                        held = shard, Cuckoo(Cuckoo.bits_for(part.column("size")[0].as_py()))
                    change = held[1].delete if turn == _DELETE else held[1].insert
                    change(_words(part.column("key")))
            if held:
                yield packed(*held)

        ordered = rows.repartition("shard").sortWithinPartitions("shard", "turn")
        return ordered.mapInArrow(maintain, "shard int, capacity bigint, data binary")

    def candidates(self, rows: DataFrame, salts: int = SALTS) -> DataFrame:
        """The (doc, key, shard) rows whose key is in the filter of its shard, or looks so."""
        salt = F.pmod(F.xxhash64("doc", "key"), F.lit(salts)).cast("int")
        lines = rows.select("shard", salt.alias("salt"), F.lit(1).alias("turn"), "doc", "key")
        filters = self.table("filters").select(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("turn"), "data"
        )
        both = lines.unionByName(filters, allowMissingColumns=True)
        names = ["doc", "key", "shard"]

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: tuple[tuple, Cuckoo] | None = None
            for batch in batches:
                for group, turn, part in _runs(batch, ("shard", "salt")):
                    if turn == 0:
                        held = group, Cuckoo(data=part.column("data")[0].as_py())
                    elif held and held[0] == group:
                        passed = held[1].contains(_words(part.column("key")))
                        if passed.any():
                            yield part.select(names).filter(pa.array(passed))

        ordered = both.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "turn")
        return ordered.mapInArrow(probe, rows.select(*names).schema)

    def dropped(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """(doc, keys): the keys that a document loses."""
        near = self.candidates(key_rows(docs, key, text, self.shards, self.min_chars))
        many = self.table("counts").where(F.col("n_docs") >= self.min_docs).select("key", "holder")
        lost = near.join(many, "key").where(~F.col("doc").eqNullSafe(F.col("holder")))
        return lost.groupBy("doc").agg(F.collect_set("key").alias("keys"))

    def clean(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """(row, result): the rows of ``docs`` as structs, with kept text, n_lines and n_dropped."""
        small_batches(self.spark)
        rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("_doc"))
        found = rows.join(self.dropped(docs, key, text), F.col("_doc").eqNullSafe(F.col("doc")), "left")
        return found.select("row", _kept(self.min_chars)(F.col("row")[text], F.col("keys")).alias("result"))


def _runs(batch: pa.RecordBatch, by: tuple[str, ...] = ("shard",)) -> Iterator[tuple]:
    """Slices of a sorted batch with one group and one turn each."""
    if not batch.num_rows:
        return
    columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in (*by, "turn")]
    change = np.zeros(batch.num_rows, bool)
    change[0] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    at = [*np.flatnonzero(change).tolist(), batch.num_rows]
    for a, b in zip(at[:-1], at[1:], strict=True):
        group = tuple(int(c[a]) for c in columns[:-1])
        yield group if len(by) > 1 else group[0], int(columns[-1][a]), batch.slice(a, b - a)


def _kept(min_chars: int):
    @F.arrow_udf("struct<text: string, n_lines: bigint, n_dropped: bigint>")
    def kept(texts: pa.Array, keys: pa.Array) -> pa.Array:
        out, counts, drops = [], [], []
        for text, lost in zip(texts.to_pylist(), keys.to_pylist(), strict=True):
            lines = (text or "").split("\n")
            stay = lines
            if lost:
                lost = set(lost)
                stay = [line for line in lines if line_key(line, min_chars) not in lost]
            out.append("\n".join(stay))
            counts.append(len(lines))
            drops.append(len(lines) - len(stay))
        return pa.StructArray.from_arrays(
            [pa.array(out, pa.string()), pa.array(counts, pa.int64()), pa.array(drops, pa.int64())],
            names=["text", "n_lines", "n_dropped"],
        )

    return kept


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated lines removed, through a fresh index. A null text stays null."""
    cleaned = LineIndex(docs.sparkSession).insert(docs, key, text).clean(docs, key, text)

    def column(name: str) -> Column:
        own = F.col("row")[name]
        return F.when(own.isNotNull(), F.col("result.text")).alias(name) if name == text else own.alias(name)

    return cleaned.select(*map(column, docs.columns))
