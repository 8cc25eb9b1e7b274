"""Best-fit packing of documents into fixed-length token sequences.

Each document is tokenized, closed with an end id and, where it is longer than
a sequence, cut into full pieces and a shorter last one. Pieces are then placed
by bounded-space online best fit: every task keeps at most ``open_bins`` open
sequences, indexed by one big integer whose bit ``f`` says that a sequence with
``f`` free tokens is open. The lowest set bit at or above a piece's length is
the best fit; when a new sequence would exceed the bound, the fullest closes.

Only piece lengths are shuffled, by a hash, so tasks get alike mixtures of
lengths whatever the order or skew of the input. Tasks pack on their own; the
number of tasks follows the volume of pieces (adaptive coalescing), so the
sequences left open at the end of a task stay a vanishing share.

Defined results: a null text counts as empty and gives the single end id; a
null id is kept; repeated rows are packed once per row; an empty table gives an
empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import in_slices, tokenizer

SEQUENCE_TOKENS = 2048
OPEN_BINS = 4096
#: Sequence numbers of one task; task number times this plus a counter is unique.
PER_TASK = 1 << 40


def tokenized_pieces(docs: DataFrame, vocabulary: str, sequence_tokens: int = SEQUENCE_TOKENS, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and ids (little-endian uint32 bytes) if asked for."""
    end, width = end_id.to_bytes(4, "little"), 4 * sequence_tokens

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(vocabulary).encode
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in in_slices(texts):
                rows: list[list] = [[], [], [], [], [], []]
                flat, bounds = encode(texts[a:b])
                data, bounds = flat.tobytes(), (4 * bounds).tolist()
                for key, first, last in zip(keys[a:b], bounds, bounds[1:]):
                    ids = data[first:last] + end
                    for piece, at in enumerate(range(0, len(ids), width)):
                        part = ids[at : at + width]
                        for column, value in zip(rows, (key, piece, at // 4, len(part) // 4, zlib.crc32(part), part)):
                            column.append(value)
                out = [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), *(pa.array(c, pa.int64()) for c in rows[2:5])]
                yield pa.RecordBatch.from_arrays(out + [pa.array(rows[5], pa.binary())] * with_ids, names=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return source.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


class Bins:
    """Open sequences of one task."""

    def __init__(self, capacity: int, most: int, first: int):
        self.capacity, self.most, self.next = capacity, most, first
        self.mask, self.open, self.by_free = 0, 0, {}

    def _push(self, free: int, sequence: int) -> None:
        self.by_free.setdefault(free, []).append(sequence)
        self.mask |= 1 << free
        self.open += 1

    def _pop(self, free: int) -> int:
        stack = self.by_free[free]
        sequence = stack.pop()
        if not stack:
            self.mask ^= 1 << free
        self.open -= 1
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        """The sequence and the offset there for a piece of this length."""
        fitting = self.mask >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = self._pop(free)
        else:
            free, sequence = self.capacity, self.next
            self.next += 1
            if length < free and self.open >= self.most:
                self._pop((self.mask & -self.mask).bit_length() - 1)  # the fullest closes
        if free > length:
            self._push(free - length, sequence)
        return sequence, self.capacity - free


def place_pieces(pieces: DataFrame, sequence_tokens: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS) -> DataFrame:
    """Adds sequence_id and offset to pieces with a ``length`` of 1 to ``sequence_tokens``."""
    names = pieces.columns
    at = names.index("length")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bins = Bins(sequence_tokens, open_bins, TaskContext.get().partitionId() * PER_TASK)
        for batch in batches:
            placed = [bins.place(n) for n in batch.column(at).to_pylist()]
            more = [pa.array([p[k] for p in placed], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*names, "sequence_id", "offset"])

    order = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = pieces.repartition(order).sortWithinPartitions(order, "doc_id", "piece", "ids_crc32")  # the same order on every attempt
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return dealt.mapInArrow(fill, schema)


def pack_documents(docs: DataFrame, vocabulary: str, sequence_tokens: int = SEQUENCE_TOKENS, end_id: int = 0, open_bins: int = OPEN_BINS, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and place; one row per piece. With ``with_ids`` the pieces carry their token ids."""
    return place_pieces(tokenized_pieces(docs, vocabulary, sequence_tokens, end_id, id_col, text_col, with_ids), sequence_tokens, open_bins)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from ``pack_documents(with_ids=True)``: sequence_id, length, ids (uint32 bytes)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # bounded: one sequence
    joined = F.aggregate(parts, F.lit("").cast("binary"), lambda whole, p: F.concat(whole, p["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
