"""From legacy ARC archives to WARC archives, and back to rows.

The converter reads ARC archives of both versions: the first block names the version and with it the fields of the
header line of each record; a record's bytes are taken by their declared length, never searched for the next header.
From these it makes up what a WARC record needs: an identifier (from archive, position and content, so a repeated
run gives the same), the timestamp, the type, and digests of block and payload.

Records whose payload was seen before become revisits of the one with the least key. Only short rows are grouped for that;
the table of repeated digests joins the records as Spark sees fit, and since it is a table of its own, an adaptive
join can split a digest that many records share.

WARC archives are written by Spark's text writer, a record per row, compressed, and cut into files of bounded
size; they are read as whole files and again parsed by declared lengths.

A null or empty payload is an empty payload. Records without a key are never referred to. Equal keys (repeated rows)
are separate records. A malformed header raises an error that names the archive. An empty table gives no records. Only
the named columns are read.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import small_batches, written
from siltstone.session import shared_folder

# The fields of a record's header line, for each version.
ARC_FIELDS = {
    b"1": ("url", "ip", "date", "content_type", "length"),
    b"2": (
        "url", "ip", "date", "content_type", "result_code", "checksum", "location", "offset", "filename", "length",
    ),
}
ARC_NAMES = {
    b"1": b"URL IP-address Archive-date Content-type Archive-length",
    b"2": b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARC_BYTES, WARC_BYTES = 4 << 20, 16 << 20
MIN_REVISIT = 100
KEY_HEADER = b"X-Record-Key"
_KEY = re.compile(rb"\r\n" + KEY_HEADER + rb": ([^\r]*)\r\n")
_LENGTH = re.compile(rb"\r\nContent-Length: ([0-9]+)\r\n", re.IGNORECASE)

RECORDS = (
    "record_id string, record_type string, warc_date string, target_uri string, ip string, content_type string, "
    "record_key string, http_header binary, payload binary, payload_bytes bigint, payload_digest string"
)
READ = (
    "record_id string, record_type string, warc_date string, target_uri string, record_key string, "
    "payload_bytes bigint, payload_digest string, refers_to string, payload binary"
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


# ---------------------------------------------------------------- ARC


def arc_start(name: str, version: bytes, date: str) -> bytes:
    body = version + b" 0 siltstone\n" + ARC_NAMES[version] + b"\n\n"
    head = f"filedesc://{name} 0.0.0.0 {date} text/plain ".encode()
    if version == b"2":
        head += b"200 - - 0 " + name.encode() + b" "
    return head + str(len(body)).encode() + b"\n" + body + b"\n"


def arc_record(version: bytes, url: str, date: str, block: bytes, offset: int, name: str) -> bytes:
    head = f"{url} 0.0.0.0 {date} text/html ".encode()
    if version == b"2":
        head += f"200 - - {offset} {name} ".encode()
    return head + str(len(block)).encode() + b"\n" + block + b"\n"


def pack_arcs(
    pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", date: str = "20240101000000"
) -> DataFrame:
    """Legacy archives (name, content) of web pages, of bounded size; even partitions in version 1, odd ones in version 2."""
    small_batches(pages.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        version = b"12"[part % 2 : part % 2 + 1]
        name = f"part-{part:05d}-{number:05d}.arc"
        content = bytearray(arc_start(name, version, date))
        full = False

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([bytes(content)], pa.binary())], names=["name", "content"]
            )

        for batch in batches:
            for k, u, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                payload = (html or "").encode()
                http = b"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                if k is not None:
                    http += KEY_HEADER + f": {k}\r\n".encode()
                http += b"Content-Length: %d\r\n\r\n" % len(payload)
                address = quote(u or "about:blank", safe="!#$%&'()*+,/:;=?@[]~")
                content += arc_record(version, address, date, http + payload, len(content), name)
                full = True
                if len(content) >= ARC_BYTES:
                    yield out()
                    number, full = number + 1, False
                    name = f"part-{part:05d}-{number:05d}.arc"
                    content = bytearray(arc_start(name, version, date))
        if full:
            yield out()

    return pages.select(F.col(key), F.col(url), F.col(body)).mapInArrow(pack, "name string, content binary")


def arc_records(name: str, content: bytes) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """(header fields, position, block) of each record of an archive, the first being its own description."""
    at, fields = 0, ARC_FIELDS[b"1"]
    while at < len(content):
        if content[at : at + 1] == b"\n":
            at += 1
            continue
        end = content.index(b"\n", at)
        line = content[at:end]
        if at == 0:
            # The first line is as long as its version says, which stands behind it.
            fields = ARC_FIELDS.get(content[end + 1 : end + 2], ())
        values = line.rsplit(b" ", len(fields) - 1)
        if not fields or len(values) != len(fields) or not values[-1].isdigit():
            raise ValueError(f"{name}: no header line at byte {at}")
        header = dict(zip(fields, (v.decode("utf-8", "replace") for v in values), strict=True))
        size = int(values[-1])
        if end + 1 + size > len(content):
            raise ValueError(f"{name}: the record at byte {at} is cut off")
        yield header, at, content[end + 1 : end + 1 + size]
        at = end + 1 + size


def warc_date(arc_date: str) -> str:
    """14 digits, or fewer from older archives, as an ISO timestamp."""
    digits = (arc_date + "00000101000000"[len(arc_date) :])[:14] if arc_date.isdigit() else "19700101000000"
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:]}Z"


def stored_arcs(arcs: DataFrame) -> DataFrame:
    """The archives as a table in the shared folder. All readers then see the same archives, also after a lost executor:
    packed again from rows in another order, they would give records other identifiers.
    """
    spark = arcs.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/arcs-{uuid.uuid4().hex}"
    # Rows are megabytes, so the writer looks at its buffer after each.
    often = {f"parquet.{unit}.size.row.check.min": "1" for unit in ("page", "block")}
    arcs.write.options(**often, **{"parquet.block.size": str(8 * ARC_BYTES)}).parquet(path)
    return spark.read.schema(arcs.schema).parquet(path)


def convert(arcs: DataFrame, with_payload: bool = True) -> DataFrame:
    """ARC archives (name, content) to the fields of WARC records, one row per record (descriptions apart)."""
    small_batches(arcs.sparkSession)
    schema = _arrow(RECORDS)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*(batch.column(c).to_pylist() for c in ("name", "content")), strict=True):
                rows = []
                for header, at, block in arc_records(name, content):
                    if header["url"].startswith("filedesc:"):
                        continue
                    http, payload, kind = b"", block, "resource"
                    if block.startswith(b"HTTP/"):
                        cut = block.find(b"\r\n\r\n")
                        cut = len(block) if cut < 0 else cut + 4
                        http, payload, kind = block[:cut], block[cut:], "response"
                    digest = hashlib.sha256(payload).hexdigest()
                    own = _KEY.search(http)
                    rows.append((
                        f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{at}#{digest}')}>",
                        kind, warc_date(header["date"]), header["url"], header["ip"],
                        "application/http; msgtype=response" if http else header["content_type"],
                        own[1].decode() if own else None, http, payload if with_payload else None, len(payload), digest,
                    ))
                yield _batch(rows, schema)

    return arcs.select("name", "content").mapInArrow(records, RECORDS)


# ---------------------------------------------------------------- WARC


def repeated_payloads(records: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """(digest, first): for payloads that several records share, the one with the least key."""
    first = F.min(F.struct(F.col("key_number"), "record_id", "target_uri", "warc_date")).alias("first")
    light = records.where((F.col("payload_bytes") >= min_bytes) & F.col("key_number").isNotNull())
    grouped = light.groupBy(F.col("payload_digest").alias("digest")).agg(first, F.count("*").alias("n"))
    return written(grouped.where("n > 1").drop("n"), "payloads")


def with_revisits(records: DataFrame, repeated: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    same = (F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") >= min_bytes)
    other = F.col("first").isNotNull() & F.col("key_number").isNotNull()
    other = other & (F.col("key_number") != F.col("first.key_number"))
    return records.join(repeated, same, "left").withColumn("first", F.when(other, F.col("first"))).drop("digest")


def warc_bytes(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def write_warcs(records: DataFrame, path: str, limit: int = WARC_BYTES) -> None:
    """Write records (with ``first`` from ``with_revisits``) to compressed archives of about ``limit`` bytes at most."""
    names = ["record_id", "record_type", "warc_date", "target_uri", "ip", "content_type", "http_header", "payload"]
    columns = [*names, "payload_digest"]
    first = [F.col("first")[c].alias(f"first_{c}") for c in ("key_number", "record_id", "target_uri", "warc_date")]

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, held = 0, limit
        for batch in batches:
            numbers, lines = [], []
            for row in batch.to_pylist():
                revisit = row["first_record_id"] is not None
                block = row["http_header"] + (b"" if revisit else row["payload"])
                fields = [
                    ("WARC-Type", "revisit" if revisit else row["record_type"]),
                    ("WARC-Record-ID", row["record_id"]),
                    ("WARC-Date", row["warc_date"]),
                    ("WARC-Target-URI", row["target_uri"]),
                    ("WARC-IP-Address", row["ip"]),
                    ("Content-Type", row["content_type"]),
                    ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()),
                    ("WARC-Payload-Digest", "sha256:" + row["payload_digest"]),
                ]
                if revisit:
                    fields += [
                        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                        ("WARC-Refers-To", row["first_record_id"]),
                        ("WARC-Refers-To-Target-URI", row["first_target_uri"]),
                        ("WARC-Refers-To-Date", row["first_warc_date"]),
                        ("X-Refers-To-Key", str(row["first_key_number"])),
                    ]
                record = warc_bytes(fields, block)
                if held + len(record) > limit:
                    segment, held = segment + 1, 0
                    info = [
                        ("WARC-Type", "warcinfo"),
                        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, row['record_id'])}>"),
                        ("WARC-Date", row["warc_date"]),
                        ("Content-Type", "application/warc-fields"),
                    ]
                    numbers.append(segment)
                    lines.append(warc_bytes(info, b"software: siltstone\r\nformat: WARC File Format 1.1\r\n")[:-1])
                held += len(record)
                numbers.append(segment)
                lines.append(record[:-1])  # the writer ends each row with a new line
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array(lines, pa.binary())], names=["segment", "value"]
            )

    rows = records.select(*columns, *first).mapInArrow(render, "segment int, value binary")
    text = rows.select("segment", F.col("value").cast("string").alias("value"))
    text.write.partitionBy("segment").option("compression", "gzip").option("lineSep", "\n").text(path)


def warc_records(name: str, content: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """(header fields, block) of each record, by declared length. A block that isn't what its digest says is an error."""
    at = 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        lines = content[at:end].split(b"\r\n")
        if end < 0 or not lines[0].startswith(b"WARC/"):
            raise ValueError(f"{name}: no record at byte {at}")
        header = {k.lower(): v.strip() for k, _, v in (line.partition(b":") for line in lines[1:])}
        size = int(header[b"content-length"])
        block = content[end + 4 : end + 4 + size]
        if len(block) != size:
            raise ValueError(f"{name}: the record at byte {at} is cut off")
        declared = header.get(b"warc-block-digest", b"")
        if declared.startswith(b"sha256:") and declared[7:] != hashlib.sha256(block).hexdigest().encode():
            raise ValueError(f"{name}: the record at byte {at} has another digest")
        yield header, block
        at = end + 4 + size + 4


def read_warcs(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives below ``path``; digest and size of a payload are computed from its bytes."""
    small_batches(spark)
    schema = _arrow(READ)

    def text(value: bytes | None) -> str | None:
        return None if value is None else value.decode()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*(batch.column(c).to_pylist() for c in ("path", "content")), strict=True):
                rows = []
                for header, block in warc_records(name, gzip.decompress(content)):
                    kind = text(header[b"warc-type"])
                    if kind == "warcinfo":
                        continue
                    http, payload = b"", block
                    if header.get(b"content-type", b"").startswith(b"application/http"):
                        cut = block.find(b"\r\n\r\n")
                        cut = len(block) if cut < 0 else cut + 4
                        http, payload = block[:cut], block[cut:]
                    own = _KEY.search(http)
                    if kind == "revisit":
                        # The payload is elsewhere; its size stands in the kept HTTP header.
                        declared = _LENGTH.search(http)
                        size = int(declared[1]) if declared else None
                        digest = text(header[b"warc-payload-digest"]).removeprefix("sha256:")
                    else:
                        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                    rows.append((
                        text(header[b"warc-record-id"]), kind, text(header[b"warc-date"]),
                        text(header.get(b"warc-target-uri")), text(own[1]) if own else None, size, digest,
                        text(header.get(b"x-refers-to-key")), payload if with_payload else None,
                    ))
                yield _batch(rows, schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(parse, READ)


def archive_pages(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Pages through legacy archives and the converter into WARC archives at ``path``, and the records read back."""
    arcs = stored_arcs(pack_arcs(pages, key, url, body))
    number = F.col("record_key").cast("bigint")
    light = convert(arcs, with_payload=False).withColumn("key_number", number)
    records = convert(arcs).withColumn("key_number", number)
    write_warcs(with_revisits(records, repeated_payloads(light)), path)
    return read_warcs(pages.sparkSession, path, with_payload=False)
