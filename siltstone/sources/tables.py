"""Parquet tables with all-or-nothing append and replace.

Each write goes to a directory of its own. The table's content is the list of
directories in its newest manifest, and adding a manifest is the commit. A
lost executor or a failed job therefore leaves the old content in place, a
plan may read the table it is about to replace, and a reader that has started
keeps its files until ``vacuum``.

Who computes new content from a table takes a ``Snapshot`` first, reads from it
and commits on its version; if somebody else has committed since, the commit
raises ``ConcurrentWrite`` and what was written for it is deleted. Appends need no
snapshot: the second writer adds to what the first has committed. A manifest is written under another name and renamed. On HDFS the
rename fails if the version exists; on a local file system this is made sure
of within one process only; an object store would need a conditional put.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import threading
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from siltstone.session import freeing_shuffles

# The change times whose newest values a part keeps, for the watermark.
CHANGE_TIMES = ("created_at", "updated_at")
# Differs between equal states by design, so a digest leaves it out.
UNDIGESTED = "load_timestamp"
_MANIFEST = re.compile(r"[0-9]{12}\.json")
_renaming = threading.Lock()


class ConcurrentWrite(RuntimeError):
    """Somebody else has committed to the table since it was read."""


@dataclass(frozen=True)
class Snapshot:
    """One version of a table: all reads of a computation see the same parts. Version 0 is no table yet."""

    store: TableStore
    table: str
    version: int
    manifest: dict

    @property
    def parts(self) -> list[dict]:
        return self.manifest["parts"]

    @property
    def columns(self) -> list[str]:
        return [f["name"] for f in self.manifest["schema"]["fields"]] if self.version else []

    def rows(self, wanted: Callable[[dict], bool] = lambda part: True) -> DataFrame:
        """The rows of the parts that ``wanted`` chooses."""
        if not self.version:
            raise ValueError(f"no such table: {self.table}")
        return self.store._rows(self.table, self.manifest, [p for p in self.parts if wanted(p)])

    def batch(self, *names: str) -> DataFrame:
        return self.rows(lambda part: part["batch"] in names)

    @property
    def row_count(self) -> int:
        return sum(p["rows"] for p in self.parts)


@dataclass(frozen=True)
class Digest:
    """The rows of a table as a multiset, whatever their order and files: number, sum and exclusive or of row hashes."""

    rows: int
    total: int
    mixed: int

    def __add__(self, other: Digest) -> Digest:
        return Digest(self.rows + other.rows, self.total + other.total, self.mixed ^ other.mixed)


def _row_hash(schema: StructType) -> Column:
    """NULL is told from other values, and a value from the same one in another column; columns go by name."""
    names = sorted(f.name for f in schema if f.name not in (UNDIGESTED, "_label"))
    return F.xxhash64(*[x for n in names for x in (F.col(n).isNull(), F.col(n))])


def _digest_metrics(schema: StructType, where: Column | None = None, tag: str = "") -> list[Column]:
    value = _row_hash(schema) if where is None else F.when(where, _row_hash(schema))
    return [F.sum(value.cast("decimal(38,0)")).cast("string").alias(f"total{tag}"), F.bit_xor(value).alias(f"mixed{tag}")]


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.root).getFileSystem(
            spark._jsc.hadoopConfiguration()
        )

    # -- manifests -------------------------------------------------------

    def _path(self, *parts: str):
        return self._hadoop.Path("/".join((self.root, *parts)))

    def _versions(self, table: str) -> list[int]:
        folder = self._path(table, "_manifest")
        if not self._fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if _MANIFEST.fullmatch(n))

    def _newest(self, table: str) -> int:
        """The version a writer starts from; 0 if there is no table yet."""
        return (self._versions(table) or [0])[-1]

    def _manifest(self, table: str, version: int | None = None) -> dict:
        versions = self._versions(table)
        if not versions:
            raise ValueError(f"no such table: {table}")
        stream = self._fs.open(
            self._path(table, "_manifest", f"{version or versions[-1]:012d}.json")
        )
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _commit(self, table: str, base: int, schema: StructType, parts: list[dict]) -> None:
        """Make ``parts`` the content that follows version ``base``, or raise ``ConcurrentWrite``."""
        target = self._path(table, "_manifest", f"{base + 1:012d}.json")
        draft = self._path(table, "_manifest", f"_{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            body = json.dumps({"schema": schema.jsonValue(), "parts": parts})
            stream.write(bytearray(body, "utf-8"))
        finally:
            stream.close()
        with _renaming:
            if not self._fs.exists(target) and self._fs.rename(draft, target):
                return
        self._fs.delete(draft, False)
        raise ConcurrentWrite(f"{table} has changed since version {base}")

    # -- reading ---------------------------------------------------------

    def exists(self, table: str) -> bool:
        return bool(self._versions(table))

    def snapshot(self, table: str) -> Snapshot:
        """The newest version, to be read and committed on."""
        version = self._newest(table)
        return Snapshot(self, table, version, self._manifest(table, version) if version else {"parts": []})

    def read(self, table: str, batch: str | None = None) -> DataFrame:
        """The table, or the rows of one batch."""
        manifest = self._manifest(table)
        parts = [p for p in manifest["parts"] if batch is None or p["batch"] == batch]
        return self._rows(table, manifest, parts)

    def _rows(self, table: str, manifest: dict, parts: Sequence[dict]) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        paths = [f"{self.root}/{table}/{p['dir']}" for p in parts]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths).select(*schema.names)

    def row_count(self, table: str) -> int:
        """Rows of the table, as counted while they were written; reads no data."""
        return sum(p["rows"] for p in self._manifest(table)["parts"])

    def digest(self, table: str) -> Digest | None:
        """What the table holds, as noted while it was written; reads no data. None if a part has no note of it."""
        found = Digest(0, 0, 0)
        for part in self._manifest(table)["parts"]:
            if part.get("total") is None:
                return None
            found += Digest(part["rows"], int(part["total"]), part["mixed"])
        return found

    def watermark(self, table: str) -> dt.datetime | None:
        """The newest change time in the table, as seen while it was written; reads no data."""
        found = [p[c] for p in self._manifest(table)["parts"] for c in CHANGE_TIMES if p.get(c)]
        return dt.datetime.fromisoformat(max(found)) if found else None

    def batch_start(self, table: str, batch: str) -> dt.datetime | None:
        """Where the window of a batch began when it was first appended."""
        starts = [p.get("after") for p in self._manifest(table)["parts"] if p["batch"] == batch]
        return dt.datetime.fromisoformat(min(starts)) if starts and all(starts) else None

    # -- writing ---------------------------------------------------------

    def _write(self, rows: DataFrame, table: str, folder: str, *partition_by: str) -> None:
        with freeing_shuffles(self.spark):
            rows.write.option("compression", "zstd").partitionBy(*partition_by).parquet(f"{self.root}/{table}/{folder}")

    def _write_part(
        self,
        table: str,
        rows: DataFrame,
        partition_by: Sequence[str],
        batch: str | None = None,
        after: dt.datetime | None = None,
    ) -> dict:
        texts = [f.name for f in rows.schema if f.name in partition_by and f.dataType.simpleString() == "string"]
        if texts:
            raise ValueError(f"folders cannot tell an empty text from NULL: {texts}")
        folder = f"part-{uuid.uuid4().hex}"
        seen = Observation(folder)
        times = [F.max(c).cast("string").alias(c) for c in CHANGE_TIMES if c in rows.columns]
        counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *times, *_digest_metrics(rows.schema))
        self._write(counted, table, folder, *partition_by)
        start = after.isoformat(sep=" ") if after else None
        return {"dir": folder, "batch": batch, "after": start, **seen.get}

    def append(
        self,
        table: str,
        rows: DataFrame,
        batch: str | None = None,
        partition_by: Sequence[str] = (),
        after: dt.datetime | None = None,
    ) -> int:
        """Add rows and keep what is there; nothing is committed for an empty input.

        With ``batch``, repeating a batch replaces its earlier rows instead of
        doubling them. ``after`` is the start of the batch's window, which a
        repeat must begin from again (``batch_start``), or it would replace rows
        that it doesn't hold.
        """
        base, schema, part = self._newest(table), rows.schema, None
        while True:
            manifest = self._manifest(table, base) if base else {"parts": []}
            if base and part is None:
                schema = StructType.fromJson(manifest["schema"])
                rows = align(rows, schema)
            elif base and manifest["schema"] != schema.jsonValue():
                raise ConcurrentWrite(f"the columns of {table} have changed")
            if part is None:
                part = self._write_part(table, rows, partition_by, batch, after)
                if not part["rows"]:
                    return 0
            kept = [p for p in manifest["parts"] if batch is None or p["batch"] != batch]
            try:
                self._commit(table, base, schema, [*kept, part])
                return part["rows"]
            except ConcurrentWrite:
                base = self._newest(table)

    def _commit_new(self, table: str, base: int, schema: StructType, kept: list[dict], new: list[dict]) -> None:
        try:
            self._commit(table, base, schema, [*kept, *[p for p in new if p["rows"]]])
        except ConcurrentWrite:
            for folder in {p["dir"].split("/")[0] for p in new}:
                self._fs.delete(self._path(table, folder), True)
            raise

    def replace(
        self,
        table: str,
        rows: DataFrame,
        partition_by: Sequence[str] = (),
        base: Snapshot | None = None,
        unless_empty: bool = False,
        note: Mapping | None = None,
    ) -> int:
        """Full refresh. An empty result empties the table or, with ``unless_empty``, leaves it untouched.

        With ``base``, only if the table is still as in that snapshot. The row count comes
        from the write itself, so no extra pass finds out whether there is anything to write. ``note`` is kept
        with the part, for who reads the table's manifest.
        """
        version = base.version if base else self._newest(table)
        part = {**self._write_part(table, rows, partition_by), **({"note": note} if note else {})}
        if part["rows"] or not (unless_empty and version):
            self._commit_new(table, version, rows.schema, [], [part])
        return part["rows"]

    def replace_unless_empty(self, table: str, rows: DataFrame, partition_by: Sequence[str] = ()) -> int:
        return self.replace(table, rows, partition_by, unless_empty=True)

    def revise(
        self,
        base: Snapshot,
        keep: Callable[[dict], bool],
        rows: DataFrame,
        labels: Mapping[str, str],
        spans: Sequence[str] = (),
    ) -> dict[str, int]:
        """Replace all parts but those that ``keep`` chooses by ``rows``, in one job and one commit.

        The column ``_label`` of ``rows`` tells the new parts apart; ``labels`` gives the batch of each. A part notes
        its least and greatest value of the columns ``spans``. Gives the number of rows by label.
        """
        table, folder = base.table, f"part-{uuid.uuid4().hex}"
        schema = StructType([f for f in rows.schema if f.name != "_label"])
        seen, metrics = Observation(folder), []
        for i, label in enumerate(labels):
            here = F.col("_label") == label
            metrics += [F.count_if(here).alias(f"rows{i}"), *_digest_metrics(schema, here, str(i))]
            for c in spans:
                values = F.when(here, F.col(c))
                metrics += [F.min(values).cast("string").alias(f"min{i}_{c}"), F.max(values).cast("string").alias(f"max{i}_{c}")]
        self._write(rows.observe(seen, *metrics), table, folder, "_label")
        found = seen.get
        new = [
            {
                "dir": f"{folder}/_label={label}",
                "batch": batch,
                "after": None,
                "rows": found[f"rows{i}"],
                "total": found[f"total{i}"],
                "mixed": found[f"mixed{i}"],
                "spans": {c: [found[f"min{i}_{c}"], found[f"max{i}_{c}"]] for c in spans},
            }
            for i, (label, batch) in enumerate(labels.items())
        ]
        self._commit_new(table, base.version, schema, [p for p in base.parts if keep(p)], new)
        return {label: found[f"rows{i}"] for i, label in enumerate(labels)}

    def replace_batches(self, base: Snapshot, rows: DataFrame, notes: Mapping[int, dict], gone: Sequence[int] = ()) -> int:
        """Write the batches named by the column ``_label`` of ``rows`` in one job; other parts stay in their files.

        What is replaced are the batches in ``notes`` and ``gone``, and parts without a batch. Gives the number of rows
        written, which the footers of the files tell.
        """
        table, folder = base.table, f"part-{uuid.uuid4().hex}"
        path = f"{self.root}/{table}/{folder}"
        schema = StructType([f for f in rows.schema if f.name != "_label"])
        if base.version and base.manifest["schema"] != schema.jsonValue() and base.parts:
            raise ValueError(f"the columns of {table} have changed")
        self._write(rows, table, folder, "_label")
        counted = self.spark.read.schema(rows.schema).parquet(path).groupBy("_label").count().collect()
        new = [
            {"dir": f"{folder}/_label={r[0]}", "batch": str(r[0]), "after": None, "rows": r[1], "note": notes[r[0]]}
            for r in counted
        ]
        out = {None, *map(str, notes), *map(str, gone)}
        self._commit_new(table, base.version, schema, [p for p in base.parts if p["batch"] not in out], new)
        return sum(p["rows"] for p in new)

    def forget(self, old: Snapshot) -> None:
        """Delete the files of a superseded version that the newest has not taken over; only for tables whose writer is their only reader."""
        live = {p["dir"].split("/")[0] for p in self.snapshot(old.table).parts}
        for folder in {p["dir"].split("/")[0] for p in old.parts} - live:
            self._fs.delete(self._path(old.table, folder), True)

    def vacuum(self, table: str, keep: int = 2, min_age_hours: float = 168) -> int:
        """Delete directories that none of the ``keep`` newest manifests lists.

        Young directories stay: a running load may be about to commit them. The
        age must exceed the longest load by far.
        """
        newest = self._versions(table)[-keep:]
        live = {p["dir"].split("/")[0] for v in newest for p in self._manifest(table, v)["parts"]}
        oldest_kept = (time.time() - min_age_hours * 3600) * 1000
        removed = 0
        for status in self._fs.listStatus(self._path(table)):
            name = status.getPath().getName()
            old = status.getModificationTime() < oldest_kept
            if name.startswith("part-") and name not in live and old:
                self._fs.delete(status.getPath(), True)
                removed += 1
        return removed


def align(rows: DataFrame, schema: StructType) -> DataFrame:
    """Match columns to the target by name; absent ones are NULL, unknown ones an error."""
    unknown = set(rows.columns) - set(schema.names)
    if unknown:
        raise ValueError(f"columns not in target: {sorted(unknown)}")
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
