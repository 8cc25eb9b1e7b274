"""FASTA and FASTQ as a PySpark data source, reference chunks, and their text."""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schemas import FASTX

#: Bases in a row of a chunked reference.
CHUNK = 1 << 16
_SCHEMA = pa.schema([(n, pa.string()) for n in ("name", "comment", "seq", "qual")])


def records(lines: Iterator[str]) -> Iterator[tuple[str, str | None, str, str | None]]:
    """(name, comment, sequence, quality) of FASTA and FASTQ lines, each possibly over several lines."""
    line = next(lines, None)
    while line is not None:
        line = line.rstrip("\r\n")
        if not line or line[0] not in ">@":
            line = next(lines, None)
            continue
        name, _, comment = line[1:].partition(" ")
        if "\t" in name:
            name, _, comment = line[1:].partition("\t")
        quality = line[0] == "@"
        seq: list[str] = []
        line = next(lines, None)
        while line is not None and line[:1] not in (("+",) if quality else (">", "@")):
            seq.append(line.strip())
            line = next(lines, None)
        bases = "".join(seq)
        if not quality:
            yield name, comment or None, bases, None
            continue
        quals: list[str] = []
        size = 0
        line = next(lines, None)
        while line is not None and (size < len(bases) or not bases and not line.strip()):
            quals.append(line.rstrip("\r\n"))
            size += len(quals[-1])
            line = next(lines, None)
        if size != len(bases):
            raise ValueError(f"sequence and quality of {name!r} differ in length")
        yield name, comment or None, bases, "".join(quals)


#: Bytes of a plain file that make a task.
SPLIT_BYTES = 64 << 20


def lines_between(lines: Iterator[tuple[int, bytes]], start: int, stop: int, four_lines: bool) -> Iterator[str]:
    """Of lines with their places, from the first record that starts at ``start`` or later on, those of records that start before ``stop``.

    A FASTA record starts with ``>``. FASTQ of four lines a record is known by
    its third line and the equal lengths of the second and the fourth: no other
    line with ``@`` has such neighbours.
    """
    if not four_lines:
        inside = False
        for at, line in lines:
            if line[:1] == b">" and at >= start:
                if at >= stop:
                    return
                inside = True
            if inside:
                yield line.decode("utf-8", "replace")
        return
    ahead: list[tuple[int, bytes]] = []
    aligned = False
    for place in lines:
        ahead.append(place)
        if len(ahead) < 4:
            continue
        if not aligned:
            head, seq, plus, qual = (line.rstrip(b"\r\n") for _, line in ahead)
            aligned = ahead[0][0] >= start and head[:1] == b"@" and plus[:1] == b"+" and len(seq) == len(qual)
            if not aligned:
                ahead.pop(0)
                continue
        if ahead[0][0] >= stop:
            return
        yield from (line.decode("utf-8", "replace") for _, line in ahead)
        ahead = []


@dataclass
class FastxFile(InputPartition):
    uri: str
    start: int = 0
    stop: int = 0  # 0: the whole file


class FastxReader(DataSourceReader):
    """Plain FASTA files, and FASTQ files where told that records have four lines, are read in pieces; the others by one task each."""

    def __init__(self, uris: list[str], four_lines: bool = False, split_bytes: int = SPLIT_BYTES):
        self.uris, self.four_lines, self.split_bytes = uris, four_lines, split_bytes

    def partitions(self):
        from .bam import _open

        out = []
        for uri in self.uris:
            system, path = _open(uri)
            size = system.get_file_info(path).size or 0
            if size > self.split_bytes:
                with system.open_input_stream(path, compression=None) as f:
                    mark = f.read(1)
                if mark == b">" or mark == b"@" and self.four_lines:
                    out += [FastxFile(uri, a, min(a + self.split_bytes, size)) for a in range(0, size, self.split_bytes)]
                    continue
            out.append(FastxFile(uri))
        return out

    def _lines(self, f, start: int) -> Iterator[tuple[int, bytes]]:
        """Whole lines from ``start`` on; one that began before is left out."""
        at = max(start - 1, 0)
        f.seek(at)
        raw = io.BufferedReader(_Raw(f), 1 << 20)
        if start:
            at += len(raw.readline())
        for line in raw:
            yield at, line
            at += len(line)

    def _texts(self, partition: FastxFile, f) -> Iterator[str]:
        if partition.stop:
            f.seek(0)
            return lines_between(self._lines(f, partition.start), partition.start, partition.stop, f.read(1) == b"@")
        raw = io.BufferedReader(_Raw(f), 1 << 20)
        if raw.peek(2)[:2] == b"\x1f\x8b":
            raw = gzip.GzipFile(fileobj=raw)
        return io.TextIOWrapper(raw, "utf-8", "replace")

    def read(self, partition: FastxFile):
        from .bam import _open

        system, path = _open(partition.uri)
        with system.open_input_file(path) as f:
            rows, size = [], 0
            for record in records(self._texts(partition, f)):
                rows.append(dict(zip(_SCHEMA.names, record)))
                size += len(record[2])
                if len(rows) >= 10_000 or size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


class _Raw(io.RawIOBase):
    """An Arrow input stream as a raw Python stream."""

    def __init__(self, stream):
        self.stream = stream

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.stream.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


class FastxDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastx"

    def schema(self):
        return FASTX

    def reader(self, schema) -> FastxReader:
        return FastxReader(self.options["path"].split(","), self.options.get("fourLines", "false").lower() == "true", int(self.options.get("splitBytes", SPLIT_BYTES)))


def read(spark: SparkSession, *uris: str, four_lines: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(name, comment, seq, qual) of FASTA or FASTQ files, gzipped or not; qual is null for FASTA. ``four_lines``: FASTQ records are known to have four, so that large files can be split."""
    spark.dataSource.register(FastxDataSource)
    return spark.read.format("fastx").option("fourLines", str(four_lines)).option("splitBytes", split_bytes).load(",".join(uris))


def text(df: DataFrame) -> DataFrame:
    """(value) the records as FASTA or FASTQ text."""
    head = F.concat(F.col("name"), F.coalesce(F.concat(F.lit(" "), F.col("comment")), F.lit("")))
    fastq = F.concat(F.lit("@"), head, F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("qual"))
    return df.select(F.coalesce(fastq, F.concat(F.lit(">"), head, F.lit("\n"), F.col("seq"))).alias("value"))


def quality_array(qual: str = "qual", offset: int = 33) -> Column:
    return F.expr(f"transform(filter(split({qual}, ''), c -> c <> ''), c -> ascii(c) - {offset})")


def contigs(fasta: DataFrame) -> DataFrame:
    """(name, length, md5): a sequence dictionary; the digest is of the upper-case sequence."""
    return fasta.select("name", F.length("seq").cast("bigint").alias("length"), F.md5(F.upper("seq")).alias("md5"))


def dictionary_text(fasta: DataFrame, uri: str | None = None) -> DataFrame:
    """@SQ lines."""
    parts = [F.lit("@SQ"), F.concat(F.lit("SN:"), "name"), F.concat(F.lit("LN:"), F.col("length").cast("string")), F.concat(F.lit("M5:"), "md5")] + ([F.lit(f"UR:{uri}")] if uri else [])
    return contigs(fasta).select(F.concat_ws("\t", *parts).alias("value"))


def chunked(fasta: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``ref_chunks``: (contig, chunk, seq), for joins on contig and position div chunk."""
    at = fasta.where(F.length("seq") > 0).select(F.col("name").alias("contig"), "seq", F.explode(F.expr(f"sequence(0L, cast((length(seq) - 1) div {chunk} as bigint))")).alias("chunk"))
    return at.select("contig", "chunk", F.expr(f"substring(seq, cast(chunk * {chunk} + 1 as int), {chunk})").alias("seq"))


def fetch(chunks: DataFrame, regions: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(contig, start, stop, seq) for each row (contig, start, stop) of ``regions``; beyond the end "", as for empty regions.

    Regions of contigs that the reference lacks are left out.
    """
    known = chunks.select("contig").distinct()
    wanted = regions.join(known, "contig").select("contig", F.greatest("start", F.lit(0)).alias("s"), F.col("stop").alias("e"), "start", "stop").distinct()
    pieces = wanted.where("s < e").withColumn("chunk", F.explode(F.expr(f"sequence(cast(s as bigint) div {chunk}, (cast(e as bigint) - 1) div {chunk})")))
    cut = pieces.join(chunks, ["contig", "chunk"]).select(
        "contig", "start", "stop", "chunk", F.expr(f"substring(seq, cast(greatest(s - chunk * {chunk}, 0) + 1 as int), cast(least(e - chunk * {chunk}, {chunk}) - greatest(s - chunk * {chunk}, 0) as int))").alias("part")
    )
    joined = cut.groupBy("contig", "start", "stop").agg(F.expr("array_join(transform(array_sort(collect_list(struct(chunk, part))), x -> x.part), '')").alias("seq"))
    return wanted.select("contig", "start", "stop").join(joined, ["contig", "start", "stop"], "left").withColumn("seq", F.coalesce("seq", F.lit("")))
