"""Removal of repeated byte windows by a depth-limited radix sort of suffixes.

A window is a suffix cut at the threshold depth (100 bytes). Sorting all of
them by most-significant-digit passes down to that depth leaves equal groups
that are exactly the repeated windows. The passes here:

1. The first digit of a window is its minimizer: of the 69 strings of 32 bytes
   inside, the one with the least hash. Equal windows have equal minimizers at
   equal places, so windows that share no first digit with another place are
   singletons and leave the sort; and since neighbouring windows share their
   minimizer, one row for each minimizer's place (about 1 byte in 35) stands for
   all of its windows. The row has a second digit, the hash of everything that
   any window on this place can reach (68 bytes before, 100 from it on). Rows are
   sorted by both digits. Places equal in both have all windows equal: all but
   the first are wholly repeated. Places alone under the first digit are done.
2. The first places under each second digit, where one first digit has several,
   sit at the edges of repeats. Only for these the bytes around are fetched, and
   their windows, grouped by first digit and offset, go through passes of eight
   bytes to the full depth, singletons leaving after each pass.

Both passes give spans of bytes; a document's spans are united. Pass 1 streams
in constant memory; copies within an input batch are combined before the
shuffle. A first digit that a sample of the documents shows to be frequent is
dealt out by parts of its second digit too, and all its surroundings go on to
pass 2, which only costs time if they need not: the sample decides where work
is done and not what comes out. Pass 2 holds the distinct surroundings of a
bounded number of places at a time. A first digit with more of them than that
is dealt out once more by whole windows, told apart by 128-bit digests, of which
again a batch sends each only once.

Digits of pass 1 are 64-bit hashes: windows are equal where 128 bits are.

"Earlier" is by (id, start). Defined results: null and empty texts have nothing
to remove; rows with a null id come after all others; rows that share an id
are ordered by their text's hash, and exact repetitions of a row count as the
same place, so that neither removes the other; texts under 100 bytes stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fresh_name, materialise

DEPTH = 100
GRAM = 32
#: Bytes before a minimizer that windows on it can reach; one less than the minimizers of a window.
REACH = DEPTH - GRAM
BLOCK = 1 << 20
#: Places of pass 2 that a task sorts at a time.
PLACES = 20_000
#: One document in so many is sampled for frequent first digits; those found so often count, and at most so many; each is dealt to so many parts.
SAMPLE, FREQUENT, KEPT, PARTS = 64, 16, 100_000, 64

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.frombuffer(np.random.default_rng(20240229).bytes(8 * 256), np.uint64)


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(29))) * _MIX
    x += b
    x ^= x >> np.uint64(32)
    return x


def _sliding(f, h: np.ndarray, width: int) -> np.ndarray:
    """f over each run of ``width`` values."""
    step = 1
    while 2 * step <= width:
        h = f(h[:-step], h[step:])
        step *= 2
    return f(h[: len(h) - (width - step)], h[width - step :]) if width > step else h


def _block_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of minimizers of all windows of ``data``, their hashes, and the hashes of 32-byte strings."""
    h = _BYTES[data]
    for step in (1, 2, 4, 8, 16):
        h = _join(h[:-step], h[step:])
    least = _sliding(np.minimum, h, REACH + 1)
    padded = np.zeros(len(least) + 2 * REACH, np.uint64)
    padded[REACH : REACH + len(least)] = least
    at = np.flatnonzero(_sliding(np.maximum, padded, REACH + 1) == h)
    return at, h[at], h


def places(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, first digit, second digit) of each minimizer of the windows of ``data``."""
    n = len(data)
    if n < DEPTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    whole = np.frombuffer(data, np.uint8)
    found = []
    for start in range(0, n, BLOCK):
        stop = min(start + BLOCK, n)
        low = max(0, start - 2 * DEPTH)
        part = whole[low : stop + 2 * DEPTH]
        if len(part) < DEPTH:
            continue
        at, first, h = _block_places(part)
        inside = (at + low >= start) & (at + low < stop)
        at, first = at[inside], first[inside]
        second = np.zeros(len(at), np.uint64)
        full = (at + low >= REACH) & (at + low + DEPTH <= n)
        a = at[full]
        x = h[a - REACH]
        for shift in (GRAM - REACH, 2 * GRAM - REACH, GRAM - 4, 2 * GRAM - 4, DEPTH - GRAM):
            x = _join(x, h[a + shift])
        second[full] = x
        for i in np.flatnonzero(~full):
            p = int(at[i]) + low
            left, right = min(REACH, p), min(DEPTH, n - p)
            second[i] = xxhash.xxh64_intdigest(data[p - left : p + right], 1000 * left + right)
        found.append((at + low, first, second))
    return tuple(np.concatenate(x) for x in zip(*found))


def united(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of spans; touching spans make one run."""
    if not len(start):
        return start, stop
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    new = np.r_[True, start[1:] > reach[:-1]]
    return start[new], reach[np.r_[new[1:], True]]


_PLACE = "first long, part int, second long, doc long, pos int, stop int"


def _emit(columns, names, types=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


_PLACE_NAMES, _PLACE_TYPES = ["first", "part", "second", "doc", "pos", "stop"], [pa.int64(), pa.int32()] + [pa.int64()] * 2 + [pa.int32()] * 2


def _places_of(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(first, second, doc, pos) of the texts' places, some ``most`` at a time, whatever the size of the batches."""
    parts: list = []

    def told() -> tuple[np.ndarray, ...]:
        pos, first, second = (np.concatenate([p[k] for p in parts]) for k in (0, 1, 2))
        return first, second, np.repeat([p[3] for p in parts], [len(p[0]) for p in parts]), pos

    held = 0
    for batch in batches:
        docs = batch.column(0).to_numpy(zero_copy_only=False)
        for doc, text in zip(docs.tolist(), batch.column(1)):
            found = places((text.as_py() or "").encode("utf-8", "replace"))
            if len(found[0]):
                parts.append((*found, doc))
                held += len(found[0])
            if held > most:
                yield told()
                parts, held = [], 0
    if parts:
        yield told()


def _frequent(docs: DataFrame) -> np.ndarray:
    """First digits that are frequent in a sample of the documents, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, *_ in _places_of(batches, 400_000):
            digits, n = np.unique(first.view(np.int64), return_counts=True)
            yield _emit((digits, n), ["first", "n"], [pa.int64()] * 2)

    counts = docs.where(F.pmod(F.xxhash64("doc"), F.lit(SAMPLE)) == 0).mapInArrow(run, "first long, n long").groupBy("first").agg(F.sum("n").alias("n"))
    rows = counts.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "first").limit(KEPT).toArrow()
    return np.sort(rows["first"].to_numpy())


def _read_places(frequent):
    """Places to sort (stop 0), and spans already known from copies within the batch (stop over 0, spread by a hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _places_of(batches, 400_000):
            yield from _combined(*found, frequent.value)

    return run


def _is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values if len(known) else np.zeros(len(values), bool)


def _combined(first, second, doc, pos, frequent) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((pos, doc, second, first))
    first, second, doc, pos = first[order], second[order], doc[order], pos[order]
    head = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
    lead = np.flatnonzero(head)[np.cumsum(head) - 1]
    again = (doc != doc[lead]) | (pos != pos[lead])
    keep = ~again
    digit = first[keep].view(np.int64)
    part = np.where(_is_in(digit, frequent), 1 + (second[keep] % np.uint64(PARTS)).astype(np.int32), 0).astype(np.int32)
    yield _emit((digit, part, second[keep].view(np.int64), doc[keep], pos[keep].astype(np.int32), np.zeros(keep.sum(), np.int32)), _PLACE_NAMES, _PLACE_TYPES)
    if again.any():
        d, p = doc[again], pos[again]
        order = np.lexsort((p, d))
        d, start = d[order], np.maximum(p[order] - REACH, 0)
        stop = p[order] + DEPTH
        new = np.r_[True, (d[1:] != d[:-1]) | (start[1:] > stop[:-1])]
        ends = np.r_[new[1:], True]
        d, start, stop = d[new], start[new], stop[ends]
        spread = d * np.int64(-7046029254386353131) + start
        yield _emit((spread, np.zeros(len(d), np.int32), np.zeros(len(d), np.int64), d, start.astype(np.int32), stop.astype(np.int32)), _PLACE_NAMES, _PLACE_TYPES)


#: Pass 1's findings: a span [pos, stop) of doc is repeated, or (stop is 0) the place at pos, of this first digit, needs pass 2.
_FOUND = "first long, part int, doc long, pos int, stop int"
_FOUND_NAMES, _FOUND_TYPES = ["first", "part", "doc", "pos", "stop"], [pa.int64(), pa.int32(), pa.int64()] + [pa.int32()] * 2
_SPAN = "doc long, pos int, stop int"
_SPAN_NAMES, _SPAN_TYPES = ["doc", "pos", "stop"], [pa.int64()] + [pa.int32()] * 2


def _sort_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over places sorted by first digit, part, second digit, doc and pos. Holds two rows from one batch to the next.

    A first digit that is dealt to parts counts as having several second digits.
    """
    held = [np.zeros(0, np.int64)] * 5 + [np.zeros(0, bool)]  # first, part, second, doc, pos, told
    for batch in batches:
        stops = batch.column(5).to_numpy(zero_copy_only=False)
        known = stops > 0
        columns = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)]
        if known.any():
            yield _emit((columns[0][known], np.zeros(known.sum(), np.int32), columns[3][known], columns[4][known].astype(np.int32), stops[known]), _FOUND_NAMES, _FOUND_TYPES)
        if known.all():
            continue
        columns = [c[~known] for c in columns]
        first, part, second, doc, pos = (np.r_[h, c] for h, c in zip(held, columns))
        told = np.r_[held[5], np.zeros(len(columns[0]), bool)]
        one = np.r_[True, (first[1:] != first[:-1]) | (part[1:] != part[:-1])]
        two = one | np.r_[True, second[1:] != second[:-1]]
        lead = np.flatnonzero(two)[np.cumsum(two) - 1]
        again = ~two & ((doc != doc[lead]) | (pos != pos[lead]))
        start = np.maximum(pos[again] - REACH, 0)
        group = np.cumsum(one) - 1
        several = np.bincount(group[two], minlength=group[-1] + 1) > 1
        edge = two & ~told & (several[group] | (part > 0))
        yield _emit((first[again], part[again].astype(np.int32), doc[again], start.astype(np.int32), (pos[again] + DEPTH).astype(np.int32)), _FOUND_NAMES, _FOUND_TYPES)
        yield _emit((first[edge], part[edge].astype(np.int32), doc[edge], pos[edge].astype(np.int32), np.zeros(edge.sum(), np.int32)), _FOUND_NAMES, _FOUND_TYPES)
        # Of the last group, which may go on: its first and its last lead stand for all.
        leads = np.flatnonzero(two & (group == group[-1]))
        keep = np.unique(leads[[0, -1]])
        held = [c[keep] for c in (first, part, second, doc, pos)] + [edge[keep] | told[keep]]


_AROUND = "first long, doc long, pos int, size int, around binary"


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around each place: REACH before and DEPTH from it on, zeros beyond the text."""
    for batch in batches:
        for i in range(batch.num_rows):
            doc, text, wanted = (batch.column(k)[i].as_py() for k in range(3))
            data = text.encode("utf-8", "replace")
            padded = bytes(REACH) + data + bytes(DEPTH)
            rows = [(w["first"], doc, w["pos"], len(data), padded[w["pos"] : w["pos"] + REACH + DEPTH]) for w in wanted]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=["first", "doc", "pos", "size", "around"])


def radix_repeats(first: np.ndarray, doc: np.ndarray, pos: np.ndarray, size: np.ndarray, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, offset) of each window that an earlier place of its group has too.

    Places come in the order of (first, doc, pos); ``around`` is a row of bytes
    for each. Windows of one group and offset go through passes of eight bytes.
    """
    m = len(first)
    words = np.lib.stride_tricks.sliding_window_view(around, 8, axis=1)
    group = np.cumsum(np.r_[True, first[1:] != first[:-1]]) - 1
    place, offset = np.repeat(np.arange(m), REACH + 1), np.tile(np.arange(REACH + 1), m)
    start = pos[place] - offset
    valid = (start >= 0) & (start + DEPTH <= size[place])
    place, offset = place[valid], offset[valid]
    same = group[place] * (REACH + 1) + offset  # the number of a window's present group
    for depth in [*range(0, DEPTH - 8, 8), DEPTH - 8]:
        if not len(place):
            break
        digit = np.ascontiguousarray(words[place, REACH - offset + depth]).view(np.uint64)[:, 0]
        order = np.lexsort((digit, same))
        s, d = same[order], digit[order]
        new = np.r_[True, (s[1:] != s[:-1]) | (d[1:] != d[:-1])]
        number = np.cumsum(new) - 1
        more = np.bincount(number)[number] > 1
        place, offset, same = place[order][more], offset[order][more], number[more]
    order = np.lexsort((place, same))
    place, offset, same = place[order], offset[order], same[order]
    head = np.r_[True, same[1:] != same[:-1]] if len(same) else np.zeros(0, bool)
    lead = place[np.flatnonzero(head)[np.cumsum(head) - 1]] if len(same) else place
    later = (doc[place] != doc[lead]) | (pos[place] != pos[lead])
    return place[later], offset[later]


def _sort_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over places with their bytes, sorted by first digit, doc and pos: spans, and places of groups too large to hold (stop 0)."""
    held: list = []
    count = 0

    def spans(group_rows: list) -> pa.RecordBatch:
        first, doc, pos, size = (np.concatenate([g[k] for g in group_rows]) for k in range(4))
        around = np.concatenate([g[4] for g in group_rows])
        place, offset = radix_repeats(first, doc, pos, size, around)
        low, high = np.full(len(first), 1 << 40), np.full(len(first), -1)
        np.minimum.at(low, place, pos[place] - offset)
        np.maximum.at(high, place, pos[place] - offset + DEPTH)  # windows on one place overlap
        hit = high >= 0
        return _emit((doc[hit], low[hit].astype(np.int32), high[hit].astype(np.int32)), _SPAN_NAMES, _SPAN_TYPES)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)]
        around = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(-1, REACH + DEPTH)
        held.append([*rows, around])
        count += batch.num_rows
        if count >= PLACES:
            whole = [np.concatenate([g[k] for g in held]) for k in range(5)]
            last = int(np.searchsorted(whole[0], whole[0][-1], "left"))
            if last:
                yield spans([[c[:last] for c in whole]])
                held = [[c[last:] for c in whole]]
            else:
                held = [whole]
            count = len(held[0][0])
    if held:
        yield spans(held)


_WINDOW = "high long, low long, doc long, start int, stop int"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window on a place by its digest (stop 0), each once in a batch; of windows that a batch has again, spans (stop over 0, spread by a hash)."""
    names, types = ["high", "low", "doc", "start", "stop"], [pa.int64()] * 3 + [pa.int32()] * 2
    for batch in batches:
        digests, docs, starts = [], [], []
        for doc, pos, size, around in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4))):
            low, high = max(0, pos - REACH), min(pos, size - DEPTH)
            digests += [hashlib.blake2b(around[k : k + DEPTH], digest_size=16).digest() for k in range(REACH + low - pos, REACH + high - pos + 1)]
            docs.append((doc, high - low + 1))
            starts.append(np.arange(low, high + 1))
        if not digests:
            continue
        digest = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        doc, start = np.repeat([d for d, _ in docs], [n for _, n in docs]), np.concatenate(starts)
        order = np.lexsort((start, doc, digest[:, 1], digest[:, 0]))
        digest, doc, start = digest[order], doc[order], start[order]
        head = np.r_[True, (digest[1:] != digest[:-1]).any(1)]
        lead = np.flatnonzero(head)[np.cumsum(head) - 1]
        again = (doc != doc[lead]) | (start != start[lead])
        yield _emit((digest[head, 0], digest[head, 1], doc[head], start[head].astype(np.int32), np.zeros(head.sum(), np.int32)), names, types)
        if again.any():
            d, at = doc[again], start[again]
            order = np.lexsort((at, d))
            d, at = d[order], at[order]
            new = np.r_[True, (d[1:] != d[:-1]) | (at[1:] > at[:-1] + DEPTH)]
            d, start, stop = d[new], at[new], at[np.r_[new[1:], True]] + DEPTH
            yield _emit((d * np.int64(-7046029254386353131) + start, np.zeros(len(d), np.int64), d, start.astype(np.int32), stop.astype(np.int32)), names, types)


def _first_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over windows sorted by digest, doc and start: a span for each but the first of equal ones, and the spans that came along."""
    held: list = []
    for batch in batches:
        high, low, doc, start, stop = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
        known = stop > 0
        if known.any():
            yield _emit((doc[known], start[known].astype(np.int32), stop[known].astype(np.int32)), _SPAN_NAMES, _SPAN_TYPES)
        if known.all():
            continue
        rows = [c[~known] for c in (high, low, doc, start)]
        high, low, doc, start = (np.r_[h, c] for h, c in zip(held, rows)) if held else rows
        head = np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]
        lead = np.flatnonzero(head)[np.cumsum(head) - 1]
        again = (doc != doc[lead]) | (start != start[lead])
        yield _emit((doc[again], start[again].astype(np.int32), (start[again] + DEPTH).astype(np.int32)), _SPAN_NAMES, _SPAN_TYPES)
        last = lead[-1]
        held = [c[last : last + 1] for c in (high, low, doc, start)]


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc, spans array<struct<pos,stop>>) for documents (doc long, text) with distinct ids that have repeated windows. Written, so that nothing of the way there is left."""
    scratch = Scratch(docs.sparkSession)
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(docs))
    dealt = docs.mapInArrow(_read_places(frequent), _PLACE).repartition("first", "part").sortWithinPartitions("first", "part", "second", "doc", "pos")
    found = scratch.keep(dealt.mapInArrow(_sort_places, _FOUND), "places")

    edges = found.where("stop = 0")
    per_first = edges.groupBy("first").count().where(F.col("count") > 2 * PLACES).select("first")
    crowded = scratch.keep(per_first, "crowded")
    wanted = edges.groupBy("doc").agg(F.collect_list(F.struct("first", "pos")).alias("wanted"))
    around = scratch.keep(docs.join(wanted, "doc").select("doc", "text", "wanted").mapInArrow(_fetch, _AROUND), "around")
    windows = around.join(crowded, "first", "left_semi").mapInArrow(_windows, _WINDOW)
    by_window = windows.repartition("high").sortWithinPartitions("high", "low", "doc", "start").mapInArrow(_first_windows, _SPAN)
    by_first = around.join(crowded, "first", "left_anti").repartition("first").sortWithinPartitions("first", "doc", "pos").mapInArrow(_sort_windows, _SPAN)
    spans = found.where("stop > 0").select("doc", "pos", "stop").unionByName(by_first).unionByName(by_window)
    out = materialise(spans.groupBy("doc").agg(F.collect_list(F.struct("pos", "stop")).alias("spans")), "spans")
    scratch.close()
    return out


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """Documents as (doc, text) with distinct ids; where ids repeat or miss, also the table that maps ids and texts to them."""
    ids = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if not ids.groupBy("doc").count().where("count > 1 or doc is null").limit(1).count():
        return ids, None
    hashed = ids.withColumn("of_text", F.xxhash64("text"))
    distinct = hashed.select("doc", "of_text").distinct().repartitionByRange(F.col("doc").asc_nulls_last(), "of_text").sortWithinPartitions(F.col("doc").asc_nulls_last(), "of_text")
    numbers = materialise(distinct.withColumn("number", F.monotonically_increasing_id()), "numbers")
    joined = hashed.alias("h").join(numbers.alias("n"), F.expr("h.doc <=> n.doc and h.of_text = n.of_text")).select(F.col("n.number").alias("doc"), "text")
    return joined.dropDuplicates(["doc"]), numbers


def _cut(text: str, spans: list) -> tuple[bytes, list[tuple[int, int]]]:
    data = text.encode("utf-8", "replace")
    start = np.array([s["pos"] for s in spans], np.int64)
    stop = np.minimum(np.array([s["stop"] for s in spans], np.int64), len(data))
    runs = list(zip(*(x.tolist() for x in united(start, stop))))
    kept, at = [], 0
    for a, b in runs:
        kept.append(data[at:a])
        at = b
    return b"".join([*kept, data[at:]]), runs


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            doc, text, spans = (batch.column(k)[i].as_py() for k in range(3))
            kept, runs = _cut(text, spans or [])
            size = len(text.encode("utf-8", "replace"))
            rows.append((doc, size, size - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(),) * 4 + (pa.string(),))] if rows else [pa.array([], t) for t in (pa.int64(),) * 4 + (pa.string(),)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (of the remaining bytes)."""
    ids, numbers = _numbered(docs, id_col, text_col)
    spans = repeated_spans(ids)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    out = ids.join(spans, "doc", "left").select("doc", "text", "spans").mapInArrow(_report, schema)
    if numbers is None:
        return out
    named = out.withColumnRenamed("doc_id", "number").join(numbers, "number")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("of_text"))
    return rows.alias("r").join(named.alias("n"), F.expr("r.doc <=> n.doc and r.of_text = n.of_text")).select(F.col("r.doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _whole_characters(text: str, spans: list) -> str:
    """The text without each character of which every byte is in a span."""
    data = text.encode("utf-8", "replace")
    kept, at = [], 0
    for a, b in _cut(text, spans)[1]:
        while a < len(data) and data[a] & 0xC0 == 0x80:  # into a character: it stays
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if b > a:
            kept.append(data[at:a])
            at = b
    return b"".join([*kept, data[at:]]).decode("utf-8", "replace")


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with repeated windows cut from the text (whole characters only).

    Rows without anything to cut stay as they are, null texts included.
    """
    ids, numbers = _numbered(docs, id_col, text_col)
    spans = repeated_spans(ids)
    names = docs.columns
    at = names.index(text_col)
    doc, of_text, cut = (fresh_name(docs, c) for c in ("doc", "of_text", "spans"))
    if numbers is None:
        joined = docs.join(spans.select(F.col("doc").alias(doc), F.col("spans").alias(cut)), F.col(id_col).cast("long") == F.col(doc), "left").select(*names, cut)
    else:
        named = materialise(numbers.join(spans.withColumnRenamed("doc", "number"), "number").select(F.col("doc").alias(doc), F.col("of_text").alias(of_text), F.col("spans").alias(cut)), "named")
        joined = docs.join(named, F.col(id_col).cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(of_text)), "left").select(*names, cut)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(len(names)).to_pylist()
            texts = [_whole_characters(t, s) if s else t for t, s in zip(batch.column(at).to_pylist(), spans)]
            columns = list(batch.columns[: len(names)])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, docs.schema)
