"""WARC archives as a PySpark data source, in both directions.

Writing: every task writes files of gzip members, one per record, that roll at
a target size. A member's header carries its length (subfield ``sl``), so that
a reader can step over it. The driver lists committed files in a manifest;
files of failed attempts are not in it and are never read.

Reading: one partition per file. Of each record only the first bytes are
inflated; record type and headers are parsed and held against the predicates
pushed down. Where they fail, or payloads are not asked for, the reader seeks
behind the member without reading or decoding the rest. Foreign archives work
too: the end of a member without the length subfield is found by inflating it
piece by piece, of which nothing is kept, and plain ``.warc`` files are stepped
over by Content-Length.

Paths are URIs that ``pyarrow.fs`` opens (file, hdfs, s3, gs ...).

Defined results: a null payload of a response is empty; a null URI or date is
left out of the headers and read back as null; an empty table makes an archive
without records. For ``dedup_records``: rows that share the largest id of equal
payloads are all responses, null ids are never the largest.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage

from .common import materialise

SCHEMA = "record_id string, record_type string, target_uri string, date string, payload_digest string, payload_bytes long, refers_to string, payload binary"
FIELDS = [f.split()[0] for f in SCHEMA.split(", ")]
_ARROW = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (f.split() for f in SCHEMA.split(", "))])
FILE_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
#: Bytes read from a file at a time; members that end within them cost no seek.
READ_BYTES = 1 << 18
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open_fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def record_bytes(row: dict) -> bytes:
    """One uncompressed record."""
    payload = row["payload"] or b""
    size = len(payload) if row["payload_bytes"] is None else row["payload_bytes"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if row["record_type"] != "revisit" else b"")
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", row["record_id"]),
        ("WARC-Date", row["date"]),
        ("WARC-Target-URI", row["target_uri"]),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}" if row["payload_digest"] else None),
        ("WARC-Refers-To", row["refers_to"]),
        ("WARC-Profile", PROFILE if row["record_type"] == "revisit" else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n" + head.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member that tells its own length."""
    squeeze = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    size = 12 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = _open_fs(self.path)
        fs.create_dir(folder, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = fs.open_output_stream(f"{folder}/{files[-1]}", compression=None), 0
                data = member(record_bytes(row))
                out.write(data)
                size += len(data)
                if size >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages) -> None:
        fs, folder = _open_fs(self.path)
        fs.create_dir(folder, recursive=True)
        before = [] if self.overwrite else _manifest(fs, folder) or []
        with fs.open_output_stream(f"{folder}/_manifest.json") as out:
            out.write(json.dumps(before + [f for m in messages if m for f in m.files]).encode())

    def abort(self, messages) -> None:
        fs, folder = _open_fs(self.path)
        for m in messages:
            for f in m.files if m else ():
                fs.delete_file(f"{folder}/{f}")


def _manifest(fs, folder: str) -> list | None:
    if fs.get_file_info(f"{folder}/_manifest.json").type.name != "File":
        return None
    with fs.open_input_stream(f"{folder}/_manifest.json") as f:
        return json.loads(f.read())


@dataclass
class WarcFile(InputPartition):
    name: str


class _Bytes:
    """Buffered reading of a file that can go to any place without reading what lies between."""

    def __init__(self, stream):
        self.stream, self.data, self.at, self.base = stream, b"", 0, 0

    def need(self, n: int) -> bool:
        while len(self.data) - self.at < n:
            more = self.stream.read(max(READ_BYTES, n))
            if not more:
                return False
            self.base += self.at
            self.data, self.at = self.data[self.at :] + more, 0
        return True

    def take(self, n: int) -> bytes:
        self.need(n)
        out = self.data[self.at : self.at + n]
        self.at += len(out)
        return out

    def tell(self) -> int:
        return self.base + self.at

    def seek(self, place: int) -> None:
        if self.base <= place <= self.base + len(self.data):
            self.at = place - self.base
        else:
            self.stream.seek(place)
            self.data, self.at, self.base = b"", 0, place


class _Inflated:
    """The deflated stream that starts where ``source`` stands, inflated as far as it is asked for."""

    def __init__(self, source: _Bytes):
        self.source, self.inflate, self.out, self.pending = source, zlib.decompressobj(-15), b"", b""

    def _more(self, most: int) -> bytes:
        if not self.pending and self.source.need(1):
            self.pending = self.source.take(min(1 << 14, len(self.source.data) - self.source.at))
        if not self.pending:
            raise ValueError("a gzip member ends before its data does")
        out = self.inflate.decompress(self.pending, most)
        self.pending = self.inflate.unconsumed_tail
        return out

    def until(self, mark: bytes, start: int = 0) -> int:
        """The place behind the first ``mark`` from ``start`` on, or of the end where there is none."""
        while (at := self.out.find(mark, max(start, 0))) < 0 and not self.inflate.eof:
            self.out += self._more(4096)
        return at + len(mark) if at >= 0 else len(self.out)

    def whole(self) -> bytes:
        parts = [self.out]
        while not self.inflate.eof:
            parts.append(self._more(1 << 20))
        self.out = b"".join(parts)
        return self.out

    def finish(self) -> None:
        """Leave ``source`` behind the data; what was not asked for is not kept."""
        while not self.inflate.eof:
            self._more(1 << 16)
        self.source.seek(self.source.tell() - len(self.inflate.unused_data))


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payloads: bool, verify: bool):
        self.path, self.payloads, self.verify = path.rstrip("/"), payloads, verify
        self.tests: list = []  # (column, kind, value), all to hold

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            known = column in FIELDS and column not in ("payload", "payload_bytes")  # both come after the record's own header
            if known and isinstance(f, EqualTo):
                self.tests.append((column, "in", frozenset([f.value])))
            elif known and isinstance(f, In):
                self.tests.append((column, "in", frozenset(f.value)))
            elif known and isinstance(f, StringStartsWith):
                self.tests.append((column, "prefix", f.value))
            elif known and isinstance(f, IsNotNull):
                self.tests.append((column, "some", None))
            else:
                yield f

    def partitions(self):
        fs, folder = _open_fs(self.path)
        names = _manifest(fs, folder)
        if names is None:
            from pyarrow import fs as kinds

            names = [i.base_name for i in fs.get_file_info(kinds.FileSelector(folder)) if i.base_name.endswith((".warc", ".warc.gz"))]
        return [WarcFile(n) for n in sorted(names)] or [WarcFile("")]

    def _wanted(self, row: dict) -> bool:
        for column, kind, value in self.tests:
            have = row[column]
            if have is None or kind == "in" and have not in value or kind == "prefix" and not have.startswith(value):
                return False
        return True

    def read(self, partition: WarcFile):
        if not partition.name:
            return
        fs, folder = _open_fs(self.path)
        rows, size = [], 0
        with fs.open_input_file(f"{folder}/{partition.name}") as stream:
            source = _Bytes(stream)
            for row in (self._members if partition.name.endswith(".gz") else self._plain)(source):
                rows.append(row)
                size += len(row["payload"] or b"") + 500
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    def _members(self, source: _Bytes):
        while source.need(18):
            start = source.tell()
            head = source.take(10)
            if head[:2] != b"\x1f\x8b":
                raise ValueError("no gzip member where one should start")
            end = None
            if head[3] & 4:
                extra = source.take(struct.unpack("<H", source.take(2))[0])
                if extra[:2] == b"sl":
                    end = start + struct.unpack("<I", extra[4:8])[0]
            for flag in (8, 16):
                if head[3] & flag:
                    while source.take(1) not in (b"\0", b""):
                        pass
            if head[3] & 2:
                source.take(2)
            body = _Inflated(source)
            body.until(b"\r\n\r\n")
            row, at = self._parse(body.out)
            if self._wanted(row):
                if self.payloads and row["record_type"] != "revisit":
                    self._payload(row, body.whole(), at)
                else:
                    body.until(b"\r\n\r\n", at)
                    self._http(row, body.out, at)
                yield row
            if end is None:
                body.finish()
                source.seek(source.tell() + 8)
            else:
                source.seek(end)

    def _plain(self, source: _Bytes):
        while source.need(4):
            n = 1 << 12
            while (end := source.data.find(b"\r\n\r\n", source.at)) < 0:
                if not source.need(n):
                    return
                n *= 2
            start = source.tell()
            text = source.take(end + 4 - source.at)
            row, at = self._parse(text)
            end = start + at + row["_length"] + 4
            if self._wanted(row):
                if self.payloads and row["record_type"] != "revisit":
                    self._payload(row, text + source.take(row["_length"]), at)
                else:
                    n = 1 << 12
                    while b"\r\n\r\n" not in (block := source.data[source.at : source.at + min(n, row["_length"])]) and n < row["_length"] and source.need(min(2 * n, row["_length"])):
                        n *= 2
                    self._http(row, text + block, at)
                yield row
            source.seek(end)

    def _parse(self, text: bytes) -> tuple[dict, int]:
        head, _, _ = text.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record where one should start")
        got = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        row = dict.fromkeys(FIELDS) | {"record_id": got.get("warc-record-id"), "record_type": got.get("warc-type"), "target_uri": got.get("warc-target-uri"), "date": got.get("warc-date"), "refers_to": got.get("warc-refers-to")}
        digest = got.get("warc-payload-digest")
        row["payload_digest"] = digest.partition(":")[2] if digest else None
        row["_length"] = int(got.get("content-length", 0))
        row["_http"] = got.get("content-type", "").startswith("application/http")
        return row, len(head) + 4

    def _http(self, row: dict, text: bytes, at: int) -> int:
        """The start of the payload; sets payload_bytes from the HTTP header."""
        if not row["_http"]:
            row["payload_bytes"] = row["_length"]
            return at
        head, _, _ = text[at:].partition(b"\r\n\r\n")
        for line in head.split(b"\r\n"):
            name, _, value = line.partition(b":")
            if name.lower() == b"content-length":
                row["payload_bytes"] = int(value)
        return at + len(head) + 4

    def _payload(self, row: dict, text: bytes, at: int) -> None:
        start = self._http(row, text, at)
        if not self.payloads or row["record_type"] == "revisit":
            return
        row["payload"] = text[start : at + row["_length"]]
        row["payload_bytes"] = len(row["payload"])
        if self.verify and row["payload_digest"] and row["payload_digest"] != base32_sha1(row["payload"]):
            raise ValueError(f"the payload of {row['record_id']} does not match its digest")


class WarcDataSource(DataSource):
    """``spark.read.format("warc")``; options: path, payloads (true), verify (true)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def _flag(self, name: str) -> bool:
        return str(self.options.get(name, "true")).lower() == "true"

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self._flag("payloads"), self._flag("verify"))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def _base32(hexadecimal):
    """Upper-case base32 of 40 hexadecimal digits, in SQL: eight groups of five bits for each five bytes."""
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    groups = []
    for i in range(4):
        value = F.conv(F.substring(hexadecimal, 10 * i + 1, 10), 16, 10).cast("long")
        groups += [F.substring(F.lit(chars), (F.shiftright(value, 5 * (7 - k)).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1)) for k in range(8)]
    return F.concat(*groups)


def dedup_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, date: str | None = None) -> DataFrame:
    """Rows for ``format("warc")``: of equal payloads of ``min_bytes`` or more, the one with the largest id is the response."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("target_uri"), payload.alias("html"), F.sha1(payload).alias("sha"), F.octet_length(payload).cast("long").alias("payload_bytes"))
    groups = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("sha").agg(F.max("id").alias("largest"), F.count("*").alias("n"))
    groups = materialise(groups.where("n > 1").select(F.col("sha").alias("of"), "largest"), "payloads")
    revisit = F.col("largest").isNotNull() & ~F.col("largest").eqNullSafe(F.col("id"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    return rows.join(groups, F.col("sha") == F.col("of"), "left").select(
        name(F.col("id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.lit(date).cast("string").alias("date"),
        _base32(F.col("sha")).alias("payload_digest"),
        "payload_bytes",
        F.when(revisit, name(F.col("largest"))).alias("refers_to"),
        F.when(~revisit, F.encode("html", "utf-8")).alias("payload"),
    )


def record_page_id(column):
    """The page id in a record id that ``dedup_records`` made."""
    return F.regexp_extract(column, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
