"""WARC archives as a PySpark data source, with a writer that turns repeated payloads into revisits.

Reading: the driver plans partitions of whole files up to a size. A task reads the headers of a
record first and compares them with the pushed predicates on the record type and all other header
columns; payloads of records that fail, or that the schema doesn't ask for, are skipped by their
length without being decoded (compressed records by the skip length in their gzip header, where it
is given).

Writing: each task writes files of its own and reports them; the commit lists them in a manifest, so
files of lost or repeated attempts are never read. Folders without a manifest are read file by file.

Defined cases: a null payload is empty; a null header value is left out and reads back as null;
control characters in header values are percent-encoded; an empty table makes an archive without
records. Paths may be anything that Arrow's file systems open, on storage shared by all executors.
"""

from __future__ import annotations

import base64
import hashlib

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import same, small_batches

#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADER_COLUMNS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "date": "WARC-Date",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "content_type": "Content-Type",
    "payload_length": "X-Payload-Length",
}
SCHEMA = ", ".join(f"{c} {'long' if c == 'payload_length' else 'string'}" for c in HEADER_COLUMNS) + ", payload binary"
FILE_BYTES = 64 << 20
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_CONTROL = re.compile(r"[\x00-\x1f\x7f]")
_READ = 4096


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(row: dict) -> bytes:
    """A record with its headers; a revisit keeps the HTTP header and leaves the payload out."""
    payload = row.get("payload") or b""
    http = _HTTP % len(payload)
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + payload
    headers = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": row["record_id"],
        "WARC-Date": row.get("date") or "1970-01-01T00:00:00Z",
        "WARC-Target-URI": row.get("target_uri"),
        "WARC-Refers-To": row.get("refers_to"),
        "WARC-Profile": REVISIT_PROFILE if revisit else None,
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    clean = lambda v: _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", v)
    lines = "".join(f"{k}: {clean(v)}\r\n" for k, v in headers.items() if v is not None)
    return VERSION + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def zipped(record: bytes) -> bytes:
    """The record as a gzip member whose "sl" field holds its compressed and raw lengths."""
    squeeze = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = squeeze.compress(record) + squeeze.flush()
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    total = 10 + 2 + 12 + len(body) + 8
    if max(total, len(record)) >= 1 << 32:
        return b"\x1f\x8b\x08\x00" + bytes(4) + b"\x00\xff" + body + tail
    extra = b"sl" + struct.pack("<HII", 8, total, len(record))
    return b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", len(extra)) + extra + body + tail


# --- reading -----------------------------------------------------------------------------------


def parse_headers(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name; the first line is the version."""
    first, _, rest = head.partition(b"\r\n")
    if not first.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    out: dict[str, str] = {}
    for line in rest.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            out[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def _columns(headers: dict[str, str]) -> dict:
    row = {c: headers.get(h.lower()) for c, h in HEADER_COLUMNS.items()}
    row["payload_digest"] = row["payload_digest"] and row["payload_digest"].removeprefix("sha1:")
    length = row["payload_length"]
    row["payload_length"] = int(length) if length and length.isdigit() else None
    return row


def _payload(block: bytes, headers: dict[str, str]) -> bytes:
    """What follows the HTTP header of an HTTP record; all of any other."""
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _head_of(read, more: bytes = b"") -> tuple[bytes, bytes]:
    """Bytes up to the blank line that ends the headers, and what was read beyond it."""
    seen = more
    while (end := seen.find(b"\r\n\r\n")) < 0:
        got = read(_READ)
        if not got:
            return seen, b""
        seen += got
    return seen[:end], seen[end + 4 :]


def plain_records(file, wants) -> Iterator[tuple[dict, bytes | None]]:
    """Records of an uncompressed archive; ``wants(row)``: None to skip it, else whether to read the payload."""
    size, at = file.size(), 0
    while at < size:
        file.seek(at)
        head, beyond = _head_of(file.read)
        if not head.strip():
            return
        blank = len(head) - len(head.lstrip(b"\r\n"))
        headers = parse_headers(head[blank:])
        length = int(headers["content-length"])
        begins = at + len(head) + 4
        row = _columns(headers)
        asked = wants(row)
        if asked is not None:
            block = None
            if asked:
                block = beyond[:length]
                while len(block) < length:
                    got = file.read(length - len(block))
                    if not got:
                        raise ValueError("the archive ends inside a record")
                    block += got
            yield row, None if block is None else _payload(block, headers)
        at = begins + length + 4


def _skip_length(start: bytes) -> int | None:
    """The member's length from the "sl" field of its gzip header."""
    if len(start) >= 24 and start[3] & 4:
        size = struct.unpack_from("<H", start, 10)[0]
        at = 12
        while at + 4 <= 12 + size:
            n = struct.unpack_from("<H", start, at + 2)[0]
            if start[at : at + 2] == b"sl" and n == 8:
                return struct.unpack_from("<I", start, at + 4)[0]
            at += 4 + n
    return None


def zipped_records(file, wants) -> Iterator[tuple[dict, bytes | None]]:
    """Records of an archive with one gzip member each; inflates no more than is wanted."""
    size, at = file.size(), 0
    while at < size:
        file.seek(at)
        inflate = zlib.decompressobj(31)
        start = file.read(_READ)
        skip = _skip_length(start)
        waiting, taken = start, len(start)

        def inflated(n: int) -> bytes:
            nonlocal waiting, taken
            out = b""
            while not out and not inflate.eof:
                if not waiting:
                    waiting = file.read(1 << 16)
                    taken += len(waiting)
                    if not waiting:
                        raise ValueError("the archive ends inside a record")
                out = inflate.decompress(waiting, n)
                waiting = inflate.unconsumed_tail
            return out

        head, beyond = _head_of(inflated)
        headers = parse_headers(head)
        length = int(headers["content-length"])
        row = _columns(headers)
        asked = wants(row)
        if asked is not None:
            block = None
            if asked:
                parts, have = [beyond], len(beyond)
                while have < length:
                    got = inflated(1 << 20)
                    if not got:
                        raise ValueError("the archive ends inside a record")
                    parts.append(got)
                    have += len(got)
                block = b"".join(parts)[:length]
            yield row, None if block is None else _payload(block, headers)
        if skip is None:  # no skip length: inflate to the member's end to find the next
            while not inflate.eof:
                inflated(1 << 20)
            skip = taken - len(inflate.unused_data)
        at += skip


# --- predicates on headers ---------------------------------------------------------------------

_COMPARE = {
    ds.GreaterThan: lambda v, x: v > x,
    ds.GreaterThanOrEqual: lambda v, x: v >= x,
    ds.LessThan: lambda v, x: v < x,
    ds.LessThanOrEqual: lambda v, x: v <= x,
    ds.EqualTo: lambda v, x: v == x,
    ds.StringStartsWith: lambda v, x: v.startswith(x),
    ds.StringEndsWith: lambda v, x: v.endswith(x),
    ds.StringContains: lambda v, x: x in v,
    ds.In: lambda v, x: v in x,
}


def _predicate(f: ds.Filter) -> tuple | None:
    """(column, kind, value, negated) of a filter on a header column that can be pushed."""
    negated = isinstance(f, ds.Not)
    f = f.child if negated else f
    path = getattr(f, "attribute", ())
    if len(path) != 1 or path[0] not in HEADER_COLUMNS:
        return None
    kind = type(f).__name__
    if isinstance(f, ds.IsNull | ds.IsNotNull | ds.EqualNullSafe):
        return path[0], kind, getattr(f, "value", None), negated
    return (path[0], kind, tuple(f.value) if kind == "In" else f.value, negated) if type(f) in _COMPARE else None


def _holds(row: dict, predicate: tuple) -> bool:
    column, kind, value, negated = predicate
    own = row[column]
    if kind in ("IsNull", "IsNotNull", "EqualNullSafe"):
        found = {"IsNull": own is None, "IsNotNull": own is not None, "EqualNullSafe": own == value}[kind]
        return found != negated
    if own is None or value is None or kind == "In" and None in value:
        return kind == "In" and not negated and own is not None and own in value
    return next(c for k, c in _COMPARE.items() if k.__name__ == kind)(own, value) != negated


# --- the data source ---------------------------------------------------------------------------


@dataclass
class Files(ds.InputPartition):
    names: list[str]


class WarcReader(ds.DataSourceReader):
    def __init__(self, path: str, schema: StructType, bytes_each: int):
        self.path, self.bytes_each = path, bytes_each
        self.names, self.schema = schema.names, schema
        self.predicates: list[tuple] = []

    def pushFilters(self, filters):
        for f in filters:
            found = _predicate(f)
            if found is None:
                yield f
            else:
                self.predicates.append(found)

    def partitions(self):
        store, root = fs.FileSystem.from_uri(self.path)
        listed = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        manifests = [i.path for i in listed if i.base_name.startswith("_manifest-")]
        sizes = {i.path: i.size for i in listed if re.search(r"\.warc(\.gz)?$", i.base_name)}
        if manifests:
            kept = {f"{root.rstrip('/')}/{name}" for m in manifests for name in json.loads(store.open_input_stream(m).readall())}
            sizes = {p: n for p, n in sizes.items() if p in kept}
        out, weight = [Files([])], 0
        for p, n in sorted(sizes.items()):
            if out[-1].names and weight + n > self.bytes_each:
                out.append(Files([]))
                weight = 0
            out[-1].names.append(p)
            weight += n
        return out

    def read(self, partition):
        store, _ = fs.FileSystem.from_uri(self.path)
        payloads = "payload" in self.names

        def wants(row: dict) -> bool | None:
            return payloads if all(_holds(row, p) for p in self.predicates) else None

        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.schema)
        rows, weight = [], 0
        for name in partition.names:
            with store.open_input_file(name) as file:
                records = zipped_records if name.endswith(".gz") else plain_records
                for row, payload in records(file, wants):
                    rows.append(row | {"payload": payload})
                    weight += 500 + len(payload or b"")
                    if weight > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, weight = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


@dataclass
class Written(ds.WriterCommitMessage):
    names: list[str]


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, path: str, compressed: bool, file_bytes: int, overwrite: bool):
        self.path, self.compressed, self.file_bytes, self.overwrite = path, compressed, file_bytes, overwrite

    def write(self, iterator):
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        names, file = [], None
        try:
            for batch in iterator:
                for k in range(batch.num_rows):
                    if file is None or file.tell() >= self.file_bytes:
                        if file:
                            file.close()
                        names.append(f"{uuid.uuid4().hex}.warc" + ".gz" * self.compressed)
                        file = store.open_output_stream(f"{root}/{names[-1]}", compression=None)
                    record = record_bytes(batch.slice(k, 1).to_pylist()[0])
                    file.write(zipped(record) if self.compressed else record)
        finally:
            if file:
                file.close()
        return Written(names)

    def commit(self, messages):
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        old = [i.path for i in store.get_file_info(fs.FileSelector(root)) if i.base_name.startswith("_manifest-")]
        with store.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps([n for m in messages if m for n in m.names]).encode())
        for path in old if self.overwrite else ():
            store.delete_file(path)

    def abort(self, messages):
        """Files without a manifest entry are never read."""


class WarcSource(ds.DataSource):
    """Format ``warc``. Options: ``path``, ``compressed`` (true), ``fileBytes``, ``partitionBytes``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], schema, int(self.options.get("partitionBytes", FILE_BYTES)))

    def writer(self, schema, overwrite):
        packed = self.options.get("compressed", "true").lower() == "true"
        return WarcWriter(self.options["path"], packed, int(self.options.get("fileBytes", FILE_BYTES)), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    small_batches(spark)


def read_warc(spark: SparkSession, path: str, columns: str = SCHEMA) -> DataFrame:
    """Records of an archive; leave ``payload`` out of ``columns`` to skip all payloads."""
    register(spark)
    return spark.read.format("warc").schema(columns).option("path", path).load()


def write_warc(records: DataFrame, path: str, mode: str = "append", **options: str) -> None:
    """Writes rows of record_id, record_type, target_uri, refers_to, date (null allowed) and payload."""
    register(records.sparkSession)
    records.write.format("warc").mode(mode).option("path", path).options(**options).save()


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Records of ``pages`` (page_id, url, html): of equal payloads of at least ``least_bytes``, that with the
    largest page_id is the response and the others revisit it.

    Only digests are grouped; payloads cross one exchange, by page_id. Rows that repeat both page_id
    and payload of the response are responses; a null page_id orders before all others."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = pages.select("page_id", "url", body.alias("payload"))
    own = own.withColumn("digest", F.sha1("payload")).withColumn("n", F.octet_length("payload"))
    small = own.select("page_id", "digest", "n").where(F.col("n") >= least_bytes)
    best = small.groupBy("digest", "n").agg(F.max("page_id").alias("best"))
    later = small.join(best.select(F.col("digest").alias("d"), F.col("n").alias("m"), "best"), (F.col("digest") == F.col("d")) & (F.col("n") == F.col("m")))
    later = later.where(~same(F.col("page_id"), F.col("best"))).select(F.col("page_id").alias("p"), "d", "best").distinct()
    both = own.join(later, same(F.col("page_id"), F.col("p")) & (F.col("digest") == F.col("d")), "left")
    name = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    return both.select(
        name("page_id").alias("record_id"),
        F.when(F.col("best").isNull(), "response").otherwise("revisit").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.when(F.col("best").isNotNull(), name("best")).alias("refers_to"),
        "payload",
    )


def page_of(record_id: str) -> Column:
    """The page_id in a record's name; null for that of a null page_id."""
    return F.nullif(F.regexp_extract(record_id, r"^<urn:x-page:(-?\d*)>$", 1), F.lit("")).cast("long")


def round_trip(pages: DataFrame, path: str, least_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` as an archive at ``path``, reads it back: (page_id, payload_bytes, payload_digest,
    record_type, refers_to). Sizes and digests of responses are those of the payloads read."""
    spark = pages.sparkSession
    write_warc(with_revisits(pages, least_bytes), path)
    headers = ", ".join(c for c in SCHEMA.split(", ") if not c.startswith("payload "))
    responses = read_warc(spark, path).where("record_type = 'response'")
    revisits = read_warc(spark, path, headers).where("record_type = 'revisit'")

    def measured(batches):
        for batch in batches:
            found = [p.as_py() or b"" for p in batch.column("payload")]
            sizes, digests = pa.array([len(p) for p in found], pa.int64()), pa.array(list(map(payload_digest, found)), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("record_id"), sizes, digests], names=["record_id", "payload_length", "payload_digest"])

    read = responses.select("record_id", "payload").mapInArrow(measured, "record_id string, payload_length long, payload_digest string")
    read = read.withColumn("record_type", F.lit("response")).withColumn("refers_to", F.lit(None).cast("string"))
    both = read.unionByName(revisits.select("record_id", "payload_length", "payload_digest", "record_type", "refers_to"))
    return both.select(
        page_of("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        page_of("refers_to").alias("refers_to"),
    )
