"""Documents as flat files of token ids, to be mapped into memory.

A data set is a folder: ``kind=ids`` holds the ids of all documents one after the other as unsigned little-endian
integers (16 bits if the vocabulary allows it, else 32), ``kind=index`` one record of 64-bit numbers per document (key,
whether it has one, first id within the file) and a last one that holds the number of ids, and ``_layout`` a small table of the
files with their bases: how many ids and documents come before a file. Documents stand in ascending order of their keys.

Texts are dealt into ranges of keys; each range is sorted, encoded and becomes one pair of files, and the bases are the prefix
sums over the files' sizes. No task holds more than a batch of a range. The bytes
leave Spark through its text writer, so they reach any file system: a line ends with a zero byte, and each row ends where
the data have one anyway. A file of ids ends with an item of padding, which no document counts.

Null and empty texts have no ids but the end id. A null key is a key that comes first. Rows of one key are ordered by a hash of their texts and
spread over several ranges if they are many; repeated rows are documents of their own. Only the key (an integer) and the
text are read, so other columns cannot clash. An empty table gives an empty data set.
"""

from __future__ import annotations

import json
import os
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, groupby, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import tokenizers
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm.bpe import Splitter
from siltstone.llm.common import small_batches, strings

# Texts that make one pair of files.
TEXT_BYTES, FILE_DOCUMENTS = 32 << 20, 4_000_000
# Pre-tokens a worker remembers and ids that they have, those longer than this apart.
REMEMBERED, REMEMBERED_IDS, REMEMBERED_LENGTH = 500_000, 4_000_000, 64
# Characters of texts that are looked up at once, and new pre-tokens in one call of the library.
GROUP_LENGTH, CALL_WORDS = 2 << 20, 1000
MAX_FILE = 64 << 20
RECORD = np.dtype([("key", "<i8"), ("has_key", "<i8"), ("start", "<i8")])
LINE_END = b"\0"
# Ids that a reading task hands to Spark at once.
READ_IDS = 1 << 20


class Encoder:
    """The ids that the library gives to texts.

    With a byte-level pre-tokenizer of the known pattern a text's ids are those of its pre-tokens. A group of texts is split as one
    column and only its distinct pre-tokens are looked up; the library encodes those that the worker doesn't remember. A text with an
    added token in it, and any other tokenizer, goes to the library as it is.
    """

    def __init__(self, file: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = tokenizers.Tokenizer.from_buffer(file)
        parts = json.loads(file)
        before = parts.get("pre_tokenizer") or {}
        known = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        alone = not any(parts.get(p) for p in ("normalizer", "post_processor", "truncation", "padding"))
        self.split = Splitter() if alone and known.items() <= before.items() else None
        self.added = [t["content"] for t in parts.get("added_tokens") or ()]
        self.item = item_type(max(self.library.get_vocab(with_added_tokens=True).values(), default=0))
        self._remember([], np.zeros(0, self.item), np.zeros(0, np.int64))

    def _remember(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        # Pre-tokens are numbered as they are met; the ids of number n stand from ends[n] to ends[n + 1].
        self.numbers = defaultdict(count(len(words)).__next__, zip(words, range(len(words)), strict=True))
        self.ids, self.ends = ids, np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        # In how many groups of texts each was found.
        self.groups = np.ones(len(words), np.int32)

    def _ids_of(self, numbers: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``numbers[at]`` one after the other, and where each begins and ends."""
        sizes = (self.ends[numbers + 1] - self.ends[numbers])[at]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return self.ids[np.repeat(self.ends[numbers][at] - ends[:-1], sizes) + np.arange(ends[-1])], ends

    def _make_room(self) -> None:
        """Half of the room goes to the pre-tokens found in most groups, two at least; the others are forgotten."""
        often = np.argsort(-self.groups, kind="stable")[: REMEMBERED // 2]
        often = often[np.cumsum(np.diff(self.ends)[often]) <= REMEMBERED_IDS // 2]
        keep = np.zeros(len(self.groups), bool)
        keep[often[self.groups[often] > 1]] = True
        kept = {w: n for w, n in self.numbers.items() if keep[n]}
        numbers = np.array(list(kept.values()), np.int64)
        ids, ends = self._ids_of(numbers, np.arange(len(numbers)))
        self._remember(list(kept), ids, np.diff(ends))

    def _whole(self, text: str) -> np.ndarray:
        found = self.library.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, self.item)

    def _learn(self, words: list[str]) -> None:
        """The ids of the pre-tokens with the next numbers. Short ones share a call, which tells whose each id is."""
        ids, sizes = [self.ids], []
        for long, run in groupby(words, lambda w: len(w) > REMEMBERED_LENGTH):
            if long:
                found = list(map(self._whole, run))
                ids += found
                sizes += map(len, found)
                continue
            while part := list(islice(run, CALL_WORDS)):
                found = self.library.encode(part, is_pretokenized=True, add_special_tokens=False)
                ids.append(np.array(found.ids, self.item))
                sizes += np.bincount(found.word_ids, minlength=len(part)).tolist()
        self.ids = np.concatenate(ids)
        self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(sizes, dtype=np.int64))
        self.groups = np.append(self.groups, np.zeros(len(words), np.int32))

    def _looked_up(self, texts: list[str]) -> list[bytes]:
        if len(self.groups) > REMEMBERED or len(self.ids) > REMEMBERED_IDS:
            self._make_room()
        words, seams = self.split.column(texts)
        words = words.dictionary_encode()
        before = len(self.numbers)
        distinct = words.dictionary.to_numpy(zero_copy_only=False)
        numbers = np.fromiter(map(self.numbers.__getitem__, distinct), np.int64, len(distinct))
        new = list(islice(reversed(self.numbers), len(self.numbers) - before))[::-1]
        self._learn(new)
        self.groups[numbers] += 1
        ids, ends = self._ids_of(numbers, words.indices.to_numpy())
        data, bounds = ids.tobytes(), ends[seams] * self.item.itemsize
        for w in new:
            if len(w) > REMEMBERED_LENGTH:
                del self.numbers[w]
        return [data[a:b] for a, b in pairwise([0, *bounds.tolist()])]

    def __call__(self, texts: list[str]) -> list[bytes]:
        out = [b""] * len(texts)
        group, size = [], 0
        for k, text in enumerate(texts):
            if self.split is None or any(a in text for a in self.added):
                out[k] = self._whole(text).tobytes()
            else:
                group.append(k)
                size += len(text)
            if group and (size >= GROUP_LENGTH or k == len(texts) - 1):
                for k, ids in zip(group, self._looked_up([texts[k] for k in group]), strict=True):
                    out[k] = ids
                group, size = [], 0
        return out


@lru_cache(maxsize=2)
def _encoder(file: bytes) -> Encoder:
    return Encoder(file)


def item_type(largest: int) -> np.dtype:
    return np.dtype("<u2" if largest < 1 << 16 else "<u4")


class _Lines:
    """Cuts a stream of bytes into rows: each ends before a zero byte, which the writer puts back."""

    def __init__(self, kind: str):
        self.kind, self.left, self.n = kind, b"", 0

    def rows(self, data: bytes) -> Iterator[tuple[str, int, bytes]]:
        data = self.left + data
        at = data.rfind(LINE_END)
        self.left = data[at + 1 :]
        if at >= 0:
            self.n += 1
            yield self.kind, self.n, data[:at]


def _laid_out(shared: Broadcast, end: int, item: np.dtype):
    """A sorted range of texts as rows of its two files."""
    kind, size, last_id = item.str, item.itemsize, np.array([end], item).tobytes()

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, index, held, encoder = _Lines("ids"), _Lines("index"), 0, _encoder(shared.value)

        def batch(rows):
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.binary()), strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["kind", "n", "value"])

        for given in batches:
            values = encoder(strings(given.column("text")))
            if encoder.item != item:
                values = [np.frombuffer(v, encoder.item).astype(kind).tobytes() for v in values]
            sizes = np.fromiter(map(len, values), np.int64, len(values)) // size + 1
            records = np.zeros(len(values), RECORD)
            records["key"] = given.column("key").fill_null(0).to_numpy(zero_copy_only=False)
            records["has_key"] = given.column("key").is_valid().to_numpy(zero_copy_only=False)
            records["start"] = held + np.cumsum(sizes) - sizes
            held += int(sizes.sum())
            yield batch([*ids.rows(b"".join([x for v in values for x in (v, last_id)])), *index.rows(records.tobytes())])
        if held:
            last = np.zeros(1, RECORD)
            last["start"] = held
            yield batch([*ids.rows(np.zeros(1, kind).tobytes()), *index.rows(last.tobytes())])

    return lay_out


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end: int = 0,
    key: str = "doc_id",
    text: str = "text",
    text_bytes: int = TEXT_BYTES,
    file_documents: int = FILE_DOCUMENTS,
) -> TokenFiles:
    """Encode documents with a tokenizer file of the library and write the data set ``folder``."""
    spark = docs.sparkSession
    small_batches(spark)
    if docs.schema[key].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"{key} is not an integer")
    with open(tokenizer, "rb") as f:
        file = f.read(MAX_FILE + 1)
    if len(file) > MAX_FILE:
        raise ValueError(f"{tokenizer} is too large for a tokenizer")
    largest = max(tokenizers.Tokenizer.from_buffer(file).get_vocab(with_added_tokens=True).values(), default=0)
    item = item_type(max(end, largest))
    texts = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    held, rows = texts.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    parts = max(spark.sparkContext.defaultParallelism, -(-(held or 0) // text_bytes), -(-rows // file_documents))
    # Many rows of one key are told apart by their texts, and equal ones by a number that a re-run draws again.
    order = [F.col("key"), F.xxhash64("text")]
    ranges = texts.repartitionByRange(parts, *order, F.rand(13)).sortWithinPartitions(*order)
    lay_out = _laid_out(spark.sparkContext.broadcast(file), end, item)
    lines = ranges.mapInArrow(lay_out, "kind string, n bigint, value binary").sortWithinPartitions("kind", "n")
    lines = lines.select("kind", F.col("value").cast("string").alias("value"))
    lines.write.partitionBy("kind").option("lineSep", LINE_END.decode()).text(folder)
    files = TokenFiles(spark, folder)
    files.write_layout(item, end)
    return files


def _base(size: str) -> Column:
    """What the files before one hold: a running total over one row per file."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(size).over(before), F.lit(0))


class TokenFiles:
    """A data set of ``write_tokens``, read by Spark."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        # A mounted folder is mapped into memory; what only Spark can open is handed to the tasks.
        self.mounted = store.getScheme() == "file"

    def files(self, content: bool) -> DataFrame:
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.folder)
        return found.where(F.col("path").contains("/kind=")).select(
            F.regexp_extract("path", r"/part-(\d+)[^/]*$", 1).cast("int").alias("part"),
            F.regexp_extract("path", r"/kind=(\w+)/", 1).alias("kind"),
            "path",
            "length",
            *(["content"] if content else []),
        )

    def write_layout(self, item: np.dtype, end: int) -> None:
        def size(kind: str, unit: int) -> Column:
            return F.floor(F.max(F.when(F.col("kind") == kind, F.col("length"))) / unit) - 1

        def name(kind: str) -> Column:
            return F.max(F.when(F.col("kind") == kind, F.regexp_extract("path", r"([^/]+)$", 1)))

        sizes = self.files(content=False).groupBy("part").agg(
            name("ids").alias("ids_file"),
            name("index").alias("index_file"),
            size("ids", item.itemsize).alias("n_ids"),
            size("index", RECORD.itemsize).alias("n_documents"),
        )
        layout = sizes.select(
            "*",
            _base("n_ids").alias("first_id"),
            _base("n_documents").alias("first_document"),
            F.lit(item.str).alias("item"),
            F.lit(end).alias("end_id"),
        )
        layout.write.parquet(f"{self.folder}/_layout")

    def layout(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/_layout")

    def read(self) -> DataFrame:
        """One row per document, from the files: key, start (ids of all documents before), n_tokens, ids (32 bits each)."""
        small_batches(self.spark)
        layout = self.layout()
        what = "path" if self.mounted else "content"
        files = self.files(content=not self.mounted).select("part", "kind", F.col(what).alias("_data"))
        ids = files.where("kind = 'ids'").select("part", F.col("_data").alias("ids"))
        index = files.where("kind = 'index'").select(F.col("part").alias("_part"), F.col("_data").alias("index"))
        pairs = ids.join(index, F.col("part") == F.col("_part")).join(layout.select("part", "first_id", "item"), "part")
        # One file a task, however small their names are.
        count = max(1, layout.count())
        pairs = pairs.select("part", "ids", "index", "first_id", "item").repartition(count, "part")
        return pairs.mapInArrow(_read, "key bigint, start bigint, n_tokens bigint, ids binary")


def _array(data: str | bytes, item: np.dtype) -> np.ndarray:
    if isinstance(data, str):
        return np.memmap(data.removeprefix("file:"), item, "r")
    return np.frombuffer(data, item)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(len(batch)):
            ids, index, first, item = (batch.column(c)[row].as_py() for c in ("ids", "index", "first_id", "item"))
            ids, index = _array(ids, np.dtype(item)), _array(index, RECORD)
            at, size = 0, len(index) - 1
            while at < size:
                # As many documents as fit, one at least.
                to = int(np.searchsorted(index["start"], index["start"][at] + READ_IDS, "right")) - 1
                to = min(max(to, at + 1), size)
                part = index[at : to + 1]
                starts = np.array(part["start"])
                flat = ids[starts[0] : starts[-1]].astype("<u4")
                offsets = ((starts - starts[0]) * 4).astype(np.int64)
                values = pa.Array.from_buffers(
                    pa.large_binary(), to - at, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())]
                )
                keys = pa.array(np.array(part["key"][:-1]), mask=np.array(part["has_key"][:-1] == 0))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(starts[:-1] + first), pa.array(np.diff(starts)), values.cast(pa.binary())],
                    names=["key", "start", "n_tokens", "ids"],
                )
                at = to


class MappedTokens:
    """A data set in a mounted folder without Spark: ids of any document by its number, nothing loaded."""

    def __init__(self, folder: str):
        rows = sorted(pq.read_table(f"{folder}/_layout").to_pylist(), key=lambda r: r["part"])
        self._first = np.array([r["first_document"] for r in rows] + [0], np.int64)
        self._first[-1] = rows[-1]["first_document"] + rows[-1]["n_documents"] if rows else 0
        self._ids = [np.memmap(f"{folder}/kind=ids/{r['ids_file']}", r["item"], "r") for r in rows]
        self._index = [np.memmap(f"{folder}/kind=index/{r['index_file']}", RECORD, "r") for r in rows]

    def __len__(self) -> int:
        return int(self._first[-1])

    def __getitem__(self, number: int) -> np.ndarray:
        if not 0 <= number < len(self):
            raise IndexError(number)
        part = int(np.searchsorted(self._first, number, "right")) - 1
        at = number - int(self._first[part])
        starts = self._index[part]["start"]
        return self._ids[part][starts[at] : starts[at + 1]]
