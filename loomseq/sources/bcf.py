"""BCF decoding to VCF text lines, and a data source over it: ``spark.read.format("bcf")`` gives (value, file_id, rec_no) for ``vcf.parse``.

A partition is one file. Contigs and positions of a record come first, so
predicates on ``chrom`` and ``pos`` skip the rest of it.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from ..headers import VariantHeader
from . import bgzf
from .bam import _open, _Stream

# Fixed values of the format: type codes, with their missing and end-of-vector values.
_INTS = {1: ("b", -128, -127), 2: ("h", -32768, -32767), 3: ("i", -(1 << 31), -(1 << 31) + 1)}
_MISSING_FLOAT, _END_FLOAT = 0x7F800001, 0x7F800002
_SCHEMA = pa.schema([("value", pa.string()), ("chrom", pa.string()), ("pos", pa.int64()), ("file_id", pa.int32()), ("rec_no", pa.int64())])


class _Cursor:
    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def head(self) -> tuple[int, int]:
        """(type, length) of a typed value."""
        byte = self.data[self.at]
        self.at += 1
        kind, size = byte & 15, byte >> 4
        if size == 15:
            size = self.values(*self.head())[0]
        return kind, size

    def values(self, kind: int, size: int) -> list | str:
        """Integers and floats with None for missing, cut at the vector's end; characters as text."""
        if kind == 7:
            raw = self.data[self.at : self.at + size]
            self.at += size
            return raw.rstrip(b"\0").decode("utf-8", "replace")
        if kind == 5:
            bits = struct.unpack_from(f"<{size}I", self.data, self.at)
            floats = struct.unpack_from(f"<{size}f", self.data, self.at)
            self.at += 4 * size
            return [None if b == _MISSING_FLOAT else f for b, f in zip(bits, floats) if b != _END_FLOAT]
        if kind in _INTS:
            code, missing, end = _INTS[kind]
            got = struct.unpack_from(f"<{size}{code}", self.data, self.at)
            self.at += struct.calcsize(code) * size
            return [None if v == missing else v for v in got if v != end]
        return []

    def typed(self):
        return self.values(*self.head())


def _number(v) -> str:
    return "." if v is None else f"{v:g}" if isinstance(v, float) else str(v)


def _text(values) -> str:
    return (values or ".") if isinstance(values, str) else ",".join(map(_number, values)) or "."


def dictionaries(text: str) -> tuple[list[str], list[str]]:
    """(strings, contigs) that numbers in records stand for; IDX attributes count where given."""
    strings, contigs = {0: "PASS"}, {}
    seen = {"PASS"}
    from ..headers import _attributes

    for line in text.splitlines():
        for kind in ("FILTER", "INFO", "FORMAT", "contig"):
            if line.startswith(f"##{kind}=<"):
                a = _attributes(line[len(kind) + 4 : -1])
                if kind == "contig":
                    contigs[int(a.get("IDX", len(contigs)))] = a["ID"]
                elif a["ID"] not in seen or "IDX" in a:
                    strings[int(a.get("IDX", len(strings)))] = a["ID"]
                    seen.add(a["ID"])
    listed = lambda d: [d.get(i, ".") for i in range(max(d, default=-1) + 1)]
    return listed(strings), listed(contigs)


def decode(shared: bytes, each: bytes, strings: list[str], contigs: list[str]) -> str:
    """One record as a VCF line."""
    rid, pos, _, qual_bits, counts, fmt = struct.unpack_from("<iiiIII", shared)
    n_allele, n_info, n_fmt, n_sample = counts >> 16, counts & 0xFFFF, fmt >> 24, fmt & 0xFFFFFF
    c = _Cursor(shared, 24)
    name = c.typed()
    alleles = [c.typed() for _ in range(n_allele)]
    filters = c.typed()
    info = []
    for _ in range(n_info):
        key = strings[c.typed()[0]]
        kind, size = c.head()
        info.append(key if size == 0 else f"{key}={_text(c.values(kind, size))}")
    qual = "." if qual_bits == _MISSING_FLOAT else _number(struct.unpack("<f", struct.pack("<I", qual_bits))[0])
    fields = [contigs[rid], str(pos + 1), name or ".", alleles[0] if alleles else ".", ",".join(alleles[1:]) or ".", qual, ";".join(strings[i] for i in filters) or ".", ";".join(info) or "."]
    if n_sample:
        keys, cells = [], [[] for _ in range(n_sample)]
        d = _Cursor(each)
        for _ in range(n_fmt):
            key = strings[d.typed()[0]]
            kind, size = d.head()
            keys.append(key)
            for s in range(n_sample):
                values = d.values(kind, size)
                if key == "GT" and not isinstance(values, str):
                    shown = ["." if v is None or v >> 1 == 0 else str((v >> 1) - 1) for v in values]
                    cells[s].append(shown[0] + "".join(("|" if v is not None and v & 1 else "/") + a for v, a in zip(values[1:], shown[1:])) if shown else ".")
                else:
                    cells[s].append(_text(values))
        fields += [":".join(keys) or ".", *(":".join(x) for x in cells)]
    return "\t".join(fields)


def read_top(stream: _Stream) -> str:
    if stream.take(5)[:3] != b"BCF":
        raise ValueError("not a BCF file")
    return stream.take(stream.number()).rstrip(b"\0").decode("utf-8", "replace")


@dataclass
class BcfFile(InputPartition):
    uri: str
    file_id: int


class BcfReader(DataSourceReader):
    def __init__(self, uris: list[str]):
        self.uris, self.tests = uris, []

    def pushFilters(self, filters):
        import operator

        names = {EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le}
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") else None
            if type(f) in names and column in ("chrom", "pos"):
                self.tests.append((column, names[type(f)], f.value))
            else:
                yield f

    def partitions(self):
        return [BcfFile(u, i) for i, u in enumerate(self.uris)]

    def read(self, partition: BcfFile):
        system, path = _open(partition.uri)
        with system.open_input_stream(path, compression=None, buffer_size=1 << 20) as f:
            stream = _Stream(bgzf.blocks(f))
            strings, contigs = dictionaries(read_top(stream))
            rows, rec_no = [], -1
            while sizes := stream.take(8):
                a, b = struct.unpack("<II", sizes)
                data = stream.take(a + b)
                rec_no += 1
                rid, pos = struct.unpack_from("<ii", data)
                fixed = {"chrom": contigs[rid], "pos": pos + 1}
                if all(test(fixed[n], v) for n, test, v in self.tests):
                    rows.append({"value": decode(data[:a], data[a:], strings, contigs), **fixed, "file_id": partition.file_id, "rec_no": rec_no})
                if len(rows) == 5000:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


class BcfDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bcf"

    def schema(self) -> str:
        return "value string, chrom string, pos bigint, file_id int, rec_no bigint"

    def reader(self, schema) -> BcfReader:
        return BcfReader(self.options["path"].split(","))


def read_header(uri: str) -> VariantHeader:
    system, path = _open(uri)
    with system.open_input_stream(path, compression=None) as f:
        return VariantHeader.from_text(read_top(_Stream(bgzf.blocks(f))))


def read(spark: SparkSession, *uris: str) -> DataFrame:
    """``variants`` of BCF files with the same samples."""
    from . import vcf

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BcfDataSource)
    lines = spark.read.format("bcf").load(",".join(uris)).select("value", "file_id", "rec_no")
    return vcf.parse(lines, read_header(uris[0]), records_only=True)


def record_bytes(shared: bytes, each: bytes) -> bytes:
    return struct.pack("<II", len(shared), len(each)) + shared + each


def iterate(data: bytes) -> Iterator[str]:
    """VCF lines of an uncompressed BCF stream."""
    stream = _Stream(iter([data]))
    strings, contigs = dictionaries(read_top(stream))
    while sizes := stream.take(8):
        a, b = struct.unpack("<II", sizes)
        yield decode(stream.take(a), stream.take(b), strings, contigs)
