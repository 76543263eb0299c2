"""WARC archives as a PySpark Python data source.

Reading plans byte ranges of files (the writer's manifest lists record starts;
archives without one are read a file a task), takes filters on the record type
and the header columns, parses a record's headers first, and passes over the
payload of a record that the filters or the ``payload=false`` option rule out.
Writing goes task by task into files of their own, a gzip member a record; only
a committed job's manifest makes them visible to the reader.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter,
                                    GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan,
                                    LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage)

SCHEMA = ("record_id string, record_type string, target_uri string, date string, payload_digest string, "
          "payload_length long, refers_to string, content_length long, payload binary")
HEADERS = ("record_id", "record_type", "target_uri", "date", "payload_digest", "payload_length", "refers_to", "content_length")
DATE = "2000-01-01T00:00:00Z"
SPLIT_BYTES = 32 << 20
FILE_BYTES = 512 << 20
GZIP_LEVEL, HEAD_BYTES = 1, 1 << 11
BATCH_ROWS, BATCH_BYTES = 500, 16 << 20
#: Fixed by the WARC 1.1 standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def record_bytes(row: dict) -> bytes:
    """One record; header values are kept on a line by percent-encoding controls."""
    body = b"" if row["record_type"] == "revisit" else HTTP + (row["payload"] or b"")
    lines = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["date"] or DATE),
             ("WARC-Target-URI", row["target_uri"]), ("WARC-Payload-Digest", row["payload_digest"]),
             ("X-Payload-Length", row["payload_length"]), ("WARC-Refers-To", row["refers_to"])]
    if row["record_type"] == "revisit":
        lines.append(("WARC-Profile", PROFILE))
    else:
        lines.append(("Content-Type", "application/http; msgtype=response"))
    lines.append(("Content-Length", len(body)))
    text = "".join(f"{k}: {_one_line(str(v))}\r\n" for k, v in lines if v is not None)
    return b"WARC/1.1\r\n" + text.encode() + b"\r\n" + body + b"\r\n\r\n"


def _one_line(value: str) -> str:
    return "".join(quote(c) if ord(c) < 32 or ord(c) == 127 else c for c in value).strip()


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.job = path, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _file_system(self.path)
        fs.create_dir(root, recursive=True)
        files, out = [], None
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None:
                        name = f"part-{uuid.uuid4().hex}.warc.gz"
                        out, at, starts = fs.open_output_stream(f"{root}/{name}", compression=None), 0, [0]
                    data = gzip_member(record_bytes(row))
                    if at - starts[-1] >= SPLIT_BYTES:
                        starts.append(at)
                    out.write(data)
                    at += len(data)
                    if at >= FILE_BYTES:
                        out.close()
                        files.append([name, at, starts])
                        out = None
        finally:
            if out is not None:
                out.close()
                files.append([name, at, starts])
        return Written(files)

    def commit(self, messages: list) -> None:
        fs, root = _file_system(self.path)
        fs.create_dir(root, recursive=True)
        listed = [f for m in messages if m for f in m.files]
        with fs.open_output_stream(f"{root}/_manifest-{self.job}.json") as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages: list) -> None:
        fs, root = _file_system(self.path)
        for m in messages:
            for name, *_ in m.files if m else []:
                fs.delete_file(f"{root}/{name}")


@dataclass
class Range(InputPartition):
    file: str
    start: int
    stop: int


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.filters = path, payload, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            test = header_test(f)
            if test is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self) -> list[Range]:
        fs, root = _file_system(self.path)
        found = {f.base_name: f for f in fs.get_file_info(pa.fs.FileSelector(root))}
        listed = []
        manifests = [n for n in found if n.startswith("_manifest-")]
        for name in sorted(manifests):
            with fs.open_input_stream(f"{root}/{name}") as f:
                listed += json.loads(f.read())
        if not manifests:
            listed = [[n, f.size, [0]] for n, f in sorted(found.items()) if n.endswith((".warc", ".warc.gz"))]
        return [Range(f"{root}/{name}", a, b) for name, size, starts in listed for a, b in zip(starts, [*starts[1:], size])]

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is None:                     # an archive without files
            return
        tests = [header_test(f) for f in self.filters]
        fs, _ = _file_system(self.path)
        rows, held = [], 0
        with fs.open_input_file(partition.file) as raw:
            read = gzip_records if partition.file.endswith(".gz") else records
            for row in read(io.BufferedReader(raw, 1 << 20), partition.start, partition.stop, tests, self.payload):
                rows.append(row)
                held += len(row["payload"] or b"")
                if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
        yield _batch(rows)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"payload_length": pa.int64(), "content_length": pa.int64(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in (*HEADERS, "payload")],
                                      [*HEADERS, "payload"])


_FIELDS = {"warc-record-id": "record_id", "warc-type": "record_type", "warc-target-uri": "target_uri", "warc-date": "date",
           "warc-payload-digest": "payload_digest", "x-payload-length": "payload_length", "warc-refers-to": "refers_to"}


def _parsed(lines: list[bytes]) -> tuple[dict, int, bool]:
    """Header columns, block length, and whether the block is an HTTP response."""
    row, length, http = dict.fromkeys(HEADERS), 0, False
    for line in lines:
        key, _, value = line.decode("utf-8", "replace").partition(":")
        key, value = key.strip().lower(), value.strip()
        if key in _FIELDS:
            row[_FIELDS[key]] = value
        elif key == "content-length":
            length = int(value)
        elif key == "content-type":
            http = value.startswith("application/http")
    row["content_length"] = length
    row["payload_length"] = int(row["payload_length"]) if row["payload_length"] is not None else None
    row["payload"] = None
    return row, length, http


def _payload(body: bytes, http: bool) -> bytes:
    return body.partition(b"\r\n\r\n")[2] if http else body


def records(stream, start: int, stop: int, tests: list[Callable[[dict], bool]], payload: bool) -> Iterator[dict]:
    """The records that begin in [start, stop) of a plain file; a payload is read
    only for a record whose headers pass all tests."""
    stream.seek(start)
    at = start
    while at < stop:
        line = stream.readline()
        if not line:
            return
        at += len(line)
        if not line.strip():                      # between records
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at - len(line)}")
        lines = []
        while (line := stream.readline()).strip():
            lines.append(line)
            at += len(line)
        at += len(line)
        row, length, http = _parsed(lines)
        wanted = all(t(row) for t in tests)
        if payload and wanted:
            row["payload"] = _payload(stream.read(length), http)
        else:
            stream.seek(length, io.SEEK_CUR)
        at += length
        if wanted:
            yield row


def gzip_member(data: bytes) -> bytes:
    """``data`` as one gzip member that tells its own length in the ``sl`` extra
    field (compressed, uncompressed), so a reader can step over it."""
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    lengths = (size, len(data)) if max(size, len(data)) < 1 << 32 else (0, 0)
    return (b"\x1f\x8b\x08\x04\0\0\0\0\x04\xff" + struct.pack("<H2sHII", 12, b"sl", 8, *lengths) + body
            + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


def _member_size(extra: bytes) -> tuple[int, int]:
    """The lengths (compressed, uncompressed) in an ``sl`` extra field, 0 if there is none."""
    while len(extra) >= 4:
        name, n = struct.unpack("<2sH", extra[:4])
        if name == b"sl" and n == 8:
            return struct.unpack("<II", extra[4:12])
        extra = extra[4 + n:]
    return 0, 0


def gzip_records(stream, start: int, stop: int, tests: list[Callable[[dict], bool]], payload: bool) -> Iterator[dict]:
    """The same for a file of gzip members, a record each; a member that
    holds more, or is cut off, is an error.  Only a member's first
    bytes are inflated to see its headers; the rest is stepped over if its
    length is known and the payload unwanted."""
    at = start
    while at < stop:
        stream.seek(at)
        head = stream.read(10)
        if len(head) < 10:
            return
        if head[:3] != b"\x1f\x8b\x08" or head[3] & ~4:
            raise ValueError(f"no plain gzip member at byte {at}")
        extra = stream.read(struct.unpack("<H", stream.read(2))[0]) if head[3] & 4 else b""
        (size, whole), begun = _member_size(extra), 10 + (2 + len(extra) if head[3] & 4 else 0)
        inflate, data, read = zlib.decompressobj(-15), b"", 0

        def more() -> bool:
            nonlocal data, read
            chunk = stream.read(HEAD_BYTES)
            read += len(chunk)
            data += inflate.decompress(chunk)
            return bool(chunk) and not inflate.eof

        while b"\r\n\r\n" not in data and more():
            pass
        top, _, body = data.partition(b"\r\n\r\n")
        row, length, http = _parsed(top.split(b"\r\n")[1:])
        wanted = all(t(row) for t in tests)
        if payload and wanted or not size:
            parts = [body]
            while not inflate.eof and (chunk := stream.read(1 << 16)):
                read += len(chunk)
                parts.append(inflate.decompress(chunk))
            body = b"".join(parts)
            if payload and wanted:
                row["payload"] = _payload(body[:length], http)
            if not inflate.eof or body[length:].strip(b"\r\n"):
                raise ValueError(f"the gzip member at byte {at} is cut off or holds more than one record; a record must be a member")
            size = size or begun + read - len(inflate.unused_data) + 8
        elif whole > len(top) + 4 + length + 4:
            raise ValueError(f"the gzip member at byte {at} holds more than one record; a record must be a member")
        at += size
        if wanted:
            yield row


def header_test(f: Filter) -> Callable[[dict], bool] | None:
    """A test of a record's headers, or None where the filter needs more."""
    if isinstance(f, Not):
        inner = header_test(f.child)
        if inner is None or not hasattr(f.child, "attribute"):
            return None
        if isinstance(f.child, (IsNull, IsNotNull, EqualNullSafe)):
            return lambda r: not inner(r)                   # true or false for nulls, too
        if isinstance(f.child, In) and None in f.child.value:
            return lambda r: False                          # never known to be none of them
        # SQL: a comparison with null is neither true nor false
        return lambda r, c=f.child.attribute[0]: r[c] is not None and not inner(r)
    column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
    if column not in HEADERS:
        return None
    if isinstance(f, IsNull):
        return lambda r: r[column] is None
    if isinstance(f, IsNotNull):
        return lambda r: r[column] is not None
    if isinstance(f, EqualNullSafe):
        return lambda r: r[column] == f.value
    compare = {EqualTo: lambda a, b: a == b, In: lambda a, b: a in b, GreaterThan: lambda a, b: a > b,
               GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b,
               StringStartsWith: str.startswith, StringEndsWith: str.endswith, StringContains: lambda a, b: b in a}.get(type(f))
    return compare and (lambda r: r[column] is not None and compare(r[column], f.value))


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``; option ``payload=false`` reads headers only."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() != "false")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def with_revisits(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 100) -> DataFrame:
    """``pages`` as records of the data source's schema.

    Of equal payloads of at least ``least_bytes`` the one with the smallest id is
    a response (so are repeated rows of that id, and all rows if every id is
    null); the others revisit it.  Null texts have an empty payload, texts may be of any
    length, other columns are not read, and an empty table gives no records.  The first
    id of a payload is found with map-side combining; a payload that very many
    pages share is split by the adaptive join.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url).alias("target_uri"),
                        F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"sha": F.sha2("payload", 256), "payload_length": F.octet_length("payload").cast("long")})
    first = rows.filter(F.col("payload_length") >= least_bytes).groupBy("sha").agg(F.min("id").alias("first"))
    # short payloads never revisit: a key of their own keeps them spread
    key = F.when(F.col("payload_length") >= least_bytes, F.col("sha")).otherwise(F.concat_ws("-", F.lit("short"), F.col("id"), F.xxhash64("target_uri")))
    met = rows.withColumn("key", key).join(first.withColumnRenamed("sha", "key"), "key", "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    return met.select(
        _urn(F.col("id")).alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.lit(DATE).alias("date"), F.concat(F.lit("sha256:"), "sha").alias("payload_digest"), "payload_length",
        F.when(again, _urn(F.col("first"))).alias("refers_to"), F.lit(None).cast("long").alias("content_length"),
        F.when(~again, F.col("payload")).alias("payload"))


def _urn(id_col) -> F.Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(">"))


def page_id(urn: str) -> F.Column:
    """The page id in a record id (null for a page without one)."""
    return F.try_to_number(F.regexp_extract(urn, r"^<urn:x-page:(-?\d+)>$", 1), F.lit("S9999999999999999999")).cast("long")


def register(spark) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_archive(records_: DataFrame, path: str) -> None:
    register(records_.sparkSession)
    records_.write.format("warc").mode("append").save(path)


def read_archive(spark, path: str, payload: bool = True) -> DataFrame:
    """The records of ``path``.  Read anew for each set of filters: Spark 4.1 keeps
    the filters once pushed to a Python reader with its DataFrame."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
