"""BAM as a PySpark data source: ``spark.read.format("bam")`` and ``df.write.format("bam")``.

A partition is a piece of a file, decoded block by block into Arrow batches.
Large files are cut at multiples of ``splitBytes``; a piece holds the records
that start in blocks that begin in it. Its first block is found by its header,
size and checksum, and the first record there by decoding: all of a record's
fields and tags, and those of the records after it, have to fit. The number of
a record in a split file is its virtual offset, else its count. Predicates
on ``flag``-free columns that a record's fixed part decides (tid, pos, mapq,
rname) are pushed down and tested before the rest of the record is decoded.
Paths are URIs that ``pyarrow.fs`` opens; option ``path`` may list several,
separated by commas.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from .. import cigar as cigar_columns
from ..headers import AlignmentHeader
from . import bgzf

# Fixed values of the format.
SEQ_LETTERS = "=ACMGRSVTWYHKDBN"
CIGAR_LETTERS = cigar_columns.LETTERS
TAG_CODES = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f", "d": "d"}

_TAG = pa.struct([("type", pa.string()), ("i", pa.int64()), ("d", pa.float64()), ("s", pa.string()), ("a", pa.list_(pa.float64()))])
_SCHEMA = pa.schema(
    [
        ("qname", pa.string()), ("flag", pa.int32()), ("tid", pa.int32()), ("rname", pa.string()), ("pos", pa.int64()), ("end_pos", pa.int64()), ("mapq", pa.int32()), ("cigar", pa.string()),
        ("cigar_ops", pa.list_(pa.struct([("op", pa.int32()), ("len", pa.int32())]))), ("mate_tid", pa.int32()), ("mate_rname", pa.string()), ("mate_pos", pa.int64()), ("tlen", pa.int64()),
        ("seq", pa.string()), ("qual", pa.string()), ("tags", pa.map_(pa.string(), _TAG)), ("rg", pa.string()), ("file_id", pa.int32()), ("rec_no", pa.int64()),
    ]
)
_PAIRS = [a + b for a in SEQ_LETTERS for b in SEQ_LETTERS]


def _open(uri: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
    return system, path


class _Stream:
    """Whole byte runs from blocks."""

    def __init__(self, source: Iterator[bytes]):
        self.source, self.data, self.at = source, b"", 0

    def take(self, n: int) -> bytes:
        while len(self.data) - self.at < n:
            block = next(self.source, None)
            if block is None:
                return b""
            self.data, self.at = self.data[self.at :] + block, 0
        self.at += n
        return self.data[self.at - n : self.at]

    def number(self) -> int:
        return struct.unpack("<i", self.take(4))[0]


def read_top(stream: _Stream) -> AlignmentHeader:
    if stream.take(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    header = AlignmentHeader.from_text(stream.take(stream.number()).rstrip(b"\0").decode("utf-8", "replace"))
    listed = []
    for _ in range(stream.number()):
        name = stream.take(stream.number())[:-1].decode()
        listed.append((name, stream.number()))
    if header.references != tuple(n for n, _ in listed):
        header.records["SQ"] = [{"SN": n, "LN": m} for n, m in listed]
    return header


def decode_tags(data: bytes) -> list:
    out, at = [], 0
    while at + 3 <= len(data):
        name, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        value = dict.fromkeys(("i", "d", "s", "a"))
        if kind in "ZH":
            end = data.index(b"\0", at)
            value["s"], at = data[at:end].decode("utf-8", "replace"), end + 1
        elif kind == "A":
            value["s"], at = chr(data[at]), at + 1
        elif kind == "B":
            sub, n = chr(data[at]), struct.unpack("<I", data[at + 1 : at + 5])[0]
            code = f"<{n}{TAG_CODES[sub]}"
            value["s"], value["a"] = sub, [float(x) for x in struct.unpack_from(code, data, at + 5)]
            at += 5 + struct.calcsize(code)
        else:
            code = "<" + TAG_CODES[kind]
            got = struct.unpack_from(code, data, at)[0]
            at += struct.calcsize(code)
            if kind in "fd":
                value["d"] = got
            else:
                value["i"], kind = got, "i"
        out.append((name, {"type": kind, **value}))
    return out


def decode(data: bytes, names: tuple[str, ...], file_id: int, rec_no: int) -> dict:
    tid, pos, name_size, mapq, _, n_cigar, flag, size, mate_tid, mate_pos, tlen = struct.unpack_from("<iiBBHHHiiii", data)
    at = 32
    qname = data[at : at + name_size - 1].decode("utf-8", "replace")
    at += name_size
    ops = [(x & 15, x >> 4) for x in struct.unpack_from(f"<{n_cigar}I", data, at)]
    at += 4 * n_cigar
    packed = data[at : at + (size + 1) // 2]
    at += len(packed)
    quals = data[at : at + size]
    tags = decode_tags(data[at + size :])
    span = sum(n for op, n in ops if op in (0, 2, 3, 7, 8))
    name = lambda t: names[t] if t >= 0 else None
    return {
        "qname": qname, "flag": flag, "tid": tid, "rname": name(tid), "pos": pos, "end_pos": pos + max(span, 1), "mapq": mapq,
        "cigar": "".join(f"{n}{CIGAR_LETTERS[op]}" for op, n in ops) or "*", "cigar_ops": [{"op": op, "len": n} for op, n in ops] or None,
        "mate_tid": mate_tid, "mate_rname": name(mate_tid), "mate_pos": mate_pos, "tlen": tlen, "seq": "".join(map(_PAIRS.__getitem__, packed))[:size] or None,
        "qual": None if not size or quals[0] == 255 else bytes(q + 33 for q in quals).decode("latin-1"), "tags": tags, "rg": next((v["s"] for k, v in tags if k == "RG"), None), "file_id": file_id, "rec_no": rec_no,
    }


def _bin(start: int, stop: int) -> int:
    stop -= 1
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if start >> shift == stop >> shift:
            return first + (start >> shift)
    return 0


def encode(row: dict) -> bytes:
    qname = (row["qname"] or "*").encode() + b"\0"
    ops = row["cigar_ops"] or []
    seq, qual = row["seq"] or "", row["qual"]
    letters = {c: i for i, c in enumerate(SEQ_LETTERS)}
    codes = [letters.get(c, 15) for c in seq.upper()] + [0] * (len(seq) % 2)
    packed = bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2]))
    quals = bytes(ord(c) - 33 for c in qual) if qual else b"\xff" * len(seq)
    pos = -1 if row["pos"] is None else row["pos"]
    tags = b""
    for name, v in row["tags"] or []:
        tags += name.encode()
        kind = v["type"]
        if kind == "i":
            code = "i" if -(1 << 31) <= v["i"] < 1 << 31 else "I"
            tags += code.encode() + struct.pack("<" + code, v["i"])
        elif kind in ("f", "d"):
            tags += b"f" + struct.pack("<f", v["d"])
        elif kind == "A":
            tags += b"A" + v["s"].encode()[:1]
        elif kind == "B":
            number = float if v["s"] in "fd" else int
            tags += b"B" + v["s"].encode() + struct.pack("<I", len(v["a"])) + struct.pack(f"<{len(v['a'])}{TAG_CODES[v['s']]}", *map(number, v["a"]))
        else:
            tags += kind.encode() + (v["s"] or "").encode() + b"\0"
    n = lambda v: -1 if v is None else v
    fixed = struct.pack("<iiBBHHHiiii", n(row["tid"]), pos, len(qname), row["mapq"] or 0, _bin(max(pos, 0), max(row["end_pos"] or 1, max(pos, 0) + 1)), len(ops), row["flag"], len(seq), n(row["mate_tid"]), n(row["mate_pos"]), row["tlen"] or 0)
    body = fixed + qname + struct.pack(f"<{len(ops)}I", *(o["len"] << 4 | o["op"] for o in ops)) + packed + quals + tags
    return struct.pack("<i", len(body)) + body


def top_bytes(header: AlignmentHeader) -> bytes:
    text = str(header).encode()
    out = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", header.nreferences)
    for name, length in zip(header.references, header.lengths):
        out += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", length)
    return out


#: Bytes of a file that make a task, and records that have to follow one another for a piece's first to be found.
SPLIT_BYTES = 64 << 20
FOLLOWING = 8


@dataclass
class BamFile(InputPartition):
    uri: str
    file_id: int
    start: int = 0
    stop: int = 0  # 0: the whole file


def _fits(data: bytes, at: int, lengths: list[int]) -> int | None:
    """The end of the record at ``at`` if it can be one; -1 if the data ends too early to tell, None if it is none."""
    if len(data) - at < 36:
        return -1
    size, tid, pos, name_size, _, _, n_cigar, _, n_bases, mate_tid, mate_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    known = lambda t, p: -1 <= t < len(lengths) and -1 <= p <= (lengths[t] if t >= 0 else (1 << 31) - 1)
    if not (known(tid, pos) and known(mate_tid, mate_pos) and name_size > 1 and n_bases >= 0):
        return None
    fixed = 32 + name_size + 4 * n_cigar + (n_bases + 1) // 2 + n_bases
    if not fixed <= size <= 1 << 28:
        return None
    name = data[at + 36 : at + 36 + name_size]
    if len(name) == name_size and (name[-1] or any(not 33 <= c <= 126 for c in name[:-1])):
        return None
    if len(data) < at + 4 + size:
        return -1
    try:
        tags = data[at + 4 + fixed : at + 4 + size]
        if tags and not decode_tags(tags):
            return None
    except (KeyError, ValueError, IndexError, struct.error, UnicodeDecodeError):
        return None
    return at + 4 + size


def _first_record(data: bytes, at: int, lengths: list[int], whole: bool) -> int | None:
    """The first place from ``at`` on where records follow one another; -1 if more data has to tell, None if there is none. ``whole``: nothing comes after the data."""
    for start in range(at, len(data)):
        end, n = start, 0
        while n < FOLLOWING and end < len(data):
            to = _fits(data, end, lengths)
            if to is None or to == -1 and whole:
                n = -1
                break
            if to == -1:
                return -1
            end, n = to, n + 1
        if n == FOLLOWING or n > 0 and whole:
            return start
        if n >= 0 and not whole:
            return -1
    return None


_TESTS = {EqualTo: "eq", GreaterThan: "gt", GreaterThanOrEqual: "ge", LessThan: "lt", LessThanOrEqual: "le"}


class BamReader(DataSourceReader):
    def __init__(self, uris: list[str], split_bytes: int = SPLIT_BYTES):
        self.uris, self.split_bytes = uris, split_bytes
        self.tests: list = []

    def pushFilters(self, filters):
        import operator

        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") else None
            if type(f) in _TESTS and name in ("tid", "pos", "mapq", "flag", "rname"):
                self.tests.append((name, getattr(operator, _TESTS[type(f)]), f.value))
            else:
                yield f

    def partitions(self):
        out = []
        for i, uri in enumerate(self.uris):
            system, path = _open(uri)
            size = system.get_file_info(path).size or 0
            cuts = range(0, size, self.split_bytes) if size > self.split_bytes else [0]
            out += [BamFile(uri, i, a, min(a + self.split_bytes, size) if len(cuts) > 1 else 0) for a in cuts]
        return out

    def _whole(self, f) -> Iterator[tuple[int, bytes]]:
        stream, number = _Stream(bgzf.blocks(f)), 0
        read_top(stream)
        while size := stream.take(4):
            yield number, stream.take(struct.unpack("<i", size)[0])
            number += 1

    def _piece(self, f, start: int, stop: int, lengths: list[int]) -> Iterator[tuple[int, bytes]]:
        """(virtual offset, data) of the records that start in the piece."""
        first = bgzf.first_block(f, start, stop)
        if first is None:
            return
        source = bgzf.placed_blocks(f, first)
        marks: list[tuple[int, int]] = []  # where in the held data each block begins, and its place in the file
        data, at, more = b"", None, True

        def another() -> bool:
            nonlocal data, more
            place, block = next(source, (0, None))
            more = block is not None
            if more:
                marks.append((len(data), place))
                data += block
            return more

        if not first:
            top = _Stream(iter(lambda: another() and data[marks[-1][0] :] or None, None))
            read_top(top)
            at = len(data) - (len(top.data) - top.at)
        while at is None or at == -1:
            if not another() and not data:
                return
            at = _first_record(data, 0, lengths, not more)
            if at is None and (not more or marks[-1][1] >= stop):
                return
        while True:
            while len(data) - at < 4 or len(data) - at < 4 + struct.unpack_from("<i", data, at)[0]:
                if not another():
                    return
            begin, place = next(m for m in reversed(marks) if m[0] <= at)
            if place >= stop:
                return
            size = struct.unpack_from("<i", data, at)[0]
            yield place << 16 | (at - begin), data[at + 4 : at + 4 + size]
            at += 4 + size
            if at > 1 << 20:
                kept = max(i for i, m in enumerate(marks) if m[0] <= at)
                base = marks[kept][0]
                data, at, marks[:] = data[base:], at - base, [(b - base, p) for b, p in marks[kept:]]

    def read(self, partition: BamFile):
        system, path = _open(partition.uri)
        header = read_header(partition.uri)
        names, lengths = header.references, list(header.lengths)
        with system.open_input_file(path) as f:
            rows: list = []
            for rec_no, data in self._piece(f, partition.start, partition.stop, lengths) if partition.stop else self._whole(f):
                if self.tests:
                    tid, pos = struct.unpack_from("<ii", data)
                    fixed = {"tid": tid, "pos": pos, "mapq": data[9], "flag": struct.unpack_from("<H", data, 14)[0], "rname": names[tid] if tid >= 0 else None}
                    if not all(fixed[n] is not None and test(fixed[n], v) for n, test, v in self.tests):
                        continue
                rows.append(decode(data, names, partition.file_id, rec_no))
                if len(rows) == 5000:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


@dataclass
class Files(WriterCommitMessage):
    names: list


class BamWriter(DataSourceArrowWriter):
    """One file per task, in the order of its rows; sort before writing for a sorted file."""

    def __init__(self, path: str, header: str):
        self.path, self.header = path.rstrip("/"), header

    def write(self, iterator) -> Files:
        import uuid

        from pyspark import TaskContext

        system, folder = _open(self.path)
        system.create_dir(folder, recursive=True)
        name, out, held = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.bam", None, b""
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    out = system.open_output_stream(f"{folder}/{name}", compression=None)
                    held = top_bytes(AlignmentHeader.from_text(self.header))
                row["tags"] = list(row["tags"].items()) if isinstance(row["tags"], dict) else row["tags"]
                held += encode(row)
                while len(held) >= bgzf.BLOCK_BYTES:
                    out.write(bgzf.compress_block(held[: bgzf.BLOCK_BYTES]))
                    held = held[bgzf.BLOCK_BYTES :]
        if out is None:
            return Files([])
        out.write(bgzf.compress_block(held) + bgzf.EOF_BLOCK)
        out.close()
        return Files([name])

    def commit(self, messages) -> None:
        """Files of failed attempts, which no message names, are removed."""
        from pyarrow import fs as kinds

        system, folder = _open(self.path)
        kept = {n for m in messages if m for n in m.names}
        if system.get_file_info(folder).type == kinds.FileType.Directory:
            for info in system.get_file_info(kinds.FileSelector(folder)):
                if info.base_name.startswith("part-") and info.base_name not in kept:
                    system.delete_file(info.path)

    def abort(self, messages) -> None:
        system, folder = _open(self.path)
        for m in messages:
            for n in m.names if m else ():
                system.delete_file(f"{folder}/{n}")


class BamDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self):
        from ..schemas import READS

        return READS

    def reader(self, schema) -> BamReader:
        from pyarrow import fs as kinds

        uris: list[str] = []
        for p in self.options["path"].split(","):
            system, path = _open(p)
            if system.get_file_info(path).type == kinds.FileType.Directory:
                uris += [f"{p.rstrip('/')}/{i.base_name}" for i in sorted(system.get_file_info(kinds.FileSelector(path)), key=lambda i: i.base_name) if i.base_name.endswith(".bam")]
            else:
                uris.append(p)
        return BamReader(uris, int(self.options.get("splitBytes", SPLIT_BYTES)))

    def writer(self, schema, overwrite: bool) -> BamWriter:
        return BamWriter(self.options["path"], self.options.get("header", ""))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BamDataSource)


def read(spark: SparkSession, *uris: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    register(spark)
    return spark.read.format("bam").option("splitBytes", split_bytes).load(",".join(uris))


def write(reads: DataFrame, header: AlignmentHeader, path: str) -> None:
    register(reads.sparkSession)
    reads.write.format("bam").option("header", str(header)).mode("append").save(path)


def read_header(uri: str) -> AlignmentHeader:
    system, path = _open(uri)
    with system.open_input_stream(path, compression=None) as f:
        return read_top(_Stream(bgzf.blocks(f)))
