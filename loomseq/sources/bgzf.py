"""Blocked gzip: reading, writing, and telling files apart by their first bytes."""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

# Fixed values of the format.
EOF_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
BLOCK_BYTES = 0xFF00


def compress_block(data: bytes, level: int = 6) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    return struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def compress(data: bytes) -> bytes:
    """A whole file: blocks and the closing empty block."""
    return b"".join(compress_block(data[i : i + BLOCK_BYTES]) for i in range(0, len(data), BLOCK_BYTES)) + EOF_BLOCK


def blocks(stream) -> Iterator[bytes]:
    """The data of each block (or of each gzip member, where blocks do not tell their size)."""
    while head := stream.read(12):
        if len(head) < 12 or head[:2] != b"\x1f\x8b":
            raise ValueError("not a gzip block")
        extra = stream.read(struct.unpack("<H", head[10:12])[0]) if head[3] & 4 else b""
        at, size = 0, None
        while at + 4 <= len(extra):
            n = struct.unpack("<H", extra[at + 2 : at + 4])[0]
            if extra[at : at + 2] == b"BC":
                size = struct.unpack("<H", extra[at + 4 : at + 6])[0] + 1
            at += 4 + n
        if size is None:
            raise ValueError("a gzip member without a block size")
        rest = stream.read(size - 12 - len(extra))
        if len(rest) < size - 12 - len(extra):
            raise ValueError("truncated block")
        data = zlib.decompress(rest[:-8], -15)
        if zlib.crc32(data) != struct.unpack("<I", rest[-8:-4])[0]:
            raise ValueError("a block fails its checksum")
        yield data


def first_block(f, start: int, stop: int) -> int | None:
    """The place of the first block that begins in [start, stop): where a header's size leads to another header or the end, and the data fits its checksum."""
    f.seek(start)
    data, at = f.read(stop - start + (1 << 16) + 64), 0
    while 0 <= (at := data.find(b"\x1f\x8b\x08\x04", at)) < stop - start:
        if data[at + 12 : at + 16] == b"BC\x02\x00" and data[at + 10 : at + 12] == b"\x06\x00":
            end = at + struct.unpack("<H", data[at + 16 : at + 18])[0] + 1
            if data[end : end + 4] in (b"", b"\x1f\x8b\x08\x04"):
                try:
                    next(blocks(io.BytesIO(data[at:end])))
                    return start + at
                except (ValueError, zlib.error):
                    pass
        at += 1
    return None


def placed_blocks(f, at: int) -> Iterator[tuple[int, bytes]]:
    """(place, data) of each block from the one at ``at`` on."""
    f.seek(at)
    told = _Told(f, at)
    place = at
    for data in blocks(told):
        yield place, data
        place = told.at


class _Told:
    """A stream that tells how far it has been read."""

    def __init__(self, stream, at: int):
        self.stream, self.at = stream, at

    def read(self, n: int) -> bytes:
        data = self.stream.read(n)
        self.at += len(data)
        return data


def is_truncated(data_end: bytes) -> bool:
    """True if a file's last bytes are not the closing empty block."""
    return not data_end.endswith(EOF_BLOCK)


def sniff(head: bytes) -> dict[str, str]:
    """category, format and compression of a file from its first bytes (some kilobytes)."""
    compression = "none"
    if head[:2] == b"\x1f\x8b":
        compression = "bgzf" if head[3:4] and head[3] & 4 and b"BC" in head[10:24] else "gzip"
        head = zlib.decompressobj(31).decompress(head)
    kinds = [
        (b"BAM\1", "alignments", "bam"),
        (b"CRAM", "alignments", "cram"),
        (b"BCF\2", "variants", "bcf"),
        (b"##fileformat=VCF", "variants", "vcf"),
        (b"@HD\t", "alignments", "sam"),
        (b"@SQ\t", "alignments", "sam"),
        (b"@RG\t", "alignments", "sam"),
        (b"@PG\t", "alignments", "sam"),
        (b"@CO\t", "alignments", "sam"),
        (b"BAI\1", "index", "bai"),
        (b"CSI\1", "index", "csi"),
        (b"TBI\1", "index", "tbi"),
        (b">", "sequences", "fasta"),
        (b"@", "sequences", "fastq"),
    ]
    for magic, category, name in kinds:
        if head.startswith(magic):
            return {"category": category, "format": name, "compression": compression}
    columns = head.split(b"\n", 1)[0].split(b"\t")
    if len(columns) >= 11 and columns[1].isdigit():
        return {"category": "alignments", "format": "sam", "compression": compression}
    if len(columns) >= 3 and columns[1].isdigit() and columns[2].isdigit():
        return {"category": "regions", "format": "bed", "compression": compression}
    return {"category": "unknown", "format": "unknown", "compression": compression}
