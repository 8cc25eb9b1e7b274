"""Near duplicates by exact Jaccard similarity of word shingles, 0.8 or more.

No candidate is lost: of two sets whose similarity is at least 4/5, the first
``n - ceil(4n/5) + 1`` shingles of each in any common order share one (prefix
filter), and where the first shared one stands bounds what can still be shared
(positional filter). Shingles come rarest first: those frequent in a sample of
the texts are put last. The sample only orders; it decides no result.

Texts of equal sets are one class. Prefixes go from the texts straight into the
one shuffle to their shingles. Of what meets there, a star is verified from one
class of each shingle to its others: from that which shares the most with all
others, as the text does of which the rest are copies. Shingles all of whose
classes are then connected are done; for the others more stars from other
classes follow where groups are large, and in the end every pair that is not
yet connected. So components are exactly those of all pairs, but large groups
are joined by stars and not pair by pair.

Verification is twofold. Every class has a parity sketch: one bit for each
residue of its shingles' hashes by a power of two of their number, set where an
odd number of shingles falls. The sketches of two sets differ in no more bits
than the sets differ in shingles, so pairs whose sketches differ too much are
dropped without a loss. The full sets are read, from the texts, for what is
left, which is little more than the true pairs.

Defined results: as for SimHash groups (null and empty texts are one class;
fewer words than a shingle make one shingle of all of them). Shingles and
classes are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, materialise, text_or_empty
from .components import connected_components
from .shingles import SEED, shingle_hashes

#: One text in so many is sampled for frequent shingles; those in so many of the sampled texts count as frequent, and at most so many are kept.
SAMPLE, FREQUENT, KEPT = 64, 4, 1_000_000
#: Rounds of further stars, and the pairs for each open row beyond which one is worth while.
ROUNDS, WORTH = 4, 256
#: Classes that a task remembers to send their prefixes only once, and rows to a batch.
REMEMBERED, BATCH = 1_000_000, 200_000
LEAST_BITS = 64


def prefix_length(n: int) -> int:
    return n - -(-4 * n // 5) + 1 if n else 0


def shingle_set(text: str, words_each: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, words_each))


def class_of(have: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(have.tobytes(), SEED)


def parity_sketch(have: np.ndarray) -> bytes:
    """A bit for each residue of the hashes modulo a power of two, at least their number: set if an odd number of them has it."""
    bits = max(LEAST_BITS, 1 << max(len(have) - 1, 0).bit_length())
    return np.packbits(np.bincount((have & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1, bitorder="little").tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded to the shorter: at most the number of hashes that only one of the sets has."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))


def _frequent(texts: DataFrame, words_each: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are frequent in a sample, sorted, and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t.as_py(), words_each).view(np.int64))], names=["h"])

    sample = texts.where(F.pmod(F.xxhash64("th"), F.lit(SAMPLE)) == 0).select("text").mapInArrow(run, "h long")
    rows = sample.groupBy("h").count().where(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "h").limit(KEPT).toArrow().sort_by("h")
    return rows["h"].to_numpy(), rows["count"].to_numpy()


def _could_be(n: Column, pos: Column, n2: Column, pos2: Column) -> Column:
    return 9 * F.least(n - pos, n2 - pos2) >= 4 * (n + n2)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (key, class, n, pos) sorted by key and class those whose key has several classes, each class of a key once."""
    held, told, sent = None, 0, False  # the last key's first row, its last class, and whether that row has been sent: the key may go on
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            columns = [np.r_[h, c] for h, c in zip(held, columns)]
        keys, classes = columns[:2]
        new = np.r_[True, keys[1:] != keys[:-1]]
        before = classes[:-1].copy()
        if held is not None:
            before[0] = told
        out = ~new & np.r_[True, classes[1:] != before]
        first, group = np.flatnonzero(new), np.cumsum(new) - 1
        several = np.bincount(group[out], minlength=len(first)) > 0
        out[first[several]] = True
        if held is not None and sent:
            out[0] = False
        yield pa.RecordBatch.from_arrays([pa.array(c[out]) for c in columns], names=["key", "class", "n", "pos"])
        sent = bool(several[-1]) or (sent and held is not None and len(first) == 1)
        held, told = [c[first[-1] : first[-1] + 1] for c in columns], classes[-1] if first[-1] < len(keys) - 1 or not (held is not None and len(first) == 1) else told


def _screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs (src, dst, n, n2, sketch, sketch2) those whose sketches allow the similarity."""
    for batch in batches:
        n, n2 = (batch.column(k).to_numpy() for k in (2, 3))
        distance = np.fromiter((sketch_distance(a.as_py(), b.as_py()) for a, b in zip(batch.column(4), batch.column(5))), np.int64, batch.num_rows)
        keep = pa.array(9 * distance <= n.astype(np.int64) + n2)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["src", "dst"])


def similar_groups(docs: DataFrame, words_each: int = 5, id_col: str = "doc_id", text_col: str = "text", fingerprint: Callable[[np.ndarray], int] | None = None, links: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(doc_id, th, component_id): th is XXH64 of the text, component_id the smallest doc_id reachable over pairs of similarity 0.8 or more.

    With ``fingerprint`` (of a text's shingle hashes) and ``links`` (edges src,
    dst among distinct fp) texts of equal and of linked fingerprints are linked too.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("th", F.xxhash64("text"))
    frequent = spark.sparkContext.broadcast(_frequent(source, words_each))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(2):
                hashes = shingle_hashes(t.as_py(), words_each)
                have = np.unique(hashes)
                rows.append((class_of(have), len(have), parity_sketch(have), fingerprint(hashes) if fingerprint else 0))
            classes, sizes, sketches, fps = zip(*rows) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(classes, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary()), pa.array(fps, pa.int64())], names=["doc_id", "th", "class", "n", "sketch", "fp"])

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, counts = frequent.value
        seen: set[int] = set()

        def rows(parts: list) -> pa.RecordBatch:
            sizes = [len(p[0]) for p in parts]
            repeated = [np.repeat(np.array([p[k] for p in parts], t), sizes) for k, t in ((1, np.uint64), (2, np.int32))]
            pos = np.concatenate([np.arange(s, dtype=np.int32) for s in sizes])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[0] for p in parts]).view(np.int64)), pa.array(repeated[0].view(np.int64)), pa.array(repeated[1]), pa.array(pos)], names=["key", "class", "n", "pos"])

        for batch in batches:
            parts: list = []
            held = 0
            for t in batch.column(0):
                have = shingle_set(t.as_py(), words_each)
                of = class_of(have)
                if not len(have) or of in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(of)
                times = np.zeros(len(have), np.int64)
                if len(often):
                    signed = have.view(np.int64)
                    at = np.minimum(np.searchsorted(often, signed), len(often) - 1)
                    times = np.where(often[at] == signed, counts[at], 0)
                parts.append((have[np.lexsort((have, times))[: prefix_length(len(have))]], of, len(have)))
                held += len(parts[-1][0])
                if held >= BATCH:
                    yield rows(parts)
                    parts, held = [], 0
            if parts:
                yield rows(parts)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 200) for i in range(0, whole.num_rows, 200)):
                rows = [shingle_set(t.as_py(), words_each).view(np.int64) for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int64()))], names=["class", "shingles"])

    found = scratch.keep(source.select("doc_id", "th", "text").mapInArrow(name, "doc_id long, th long, class long, n int, sketch binary, fp long"), "found")
    classes = scratch.keep(found.groupBy("class").agg(F.min("doc_id").alias("least"), F.min("th").alias("th"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    linked = None
    if fingerprint and links:
        named = scratch.keep(found.select("fp", "class").distinct(), "named")
        first = scratch.keep(named.groupBy("fp").agg(F.min("class").alias("first")), "first")
        near = scratch.keep(links(first.select("fp")), "near")
        side = lambda a, b: first.select(F.col("fp").alias(a), F.col("first").alias(b))
        across = near.join(side("src", "a"), "src").join(side("dst", "b"), "dst").select("a", "b")
        same = named.join(first, "fp").select(F.col("first").alias("a"), F.col("class").alias("b"))
        linked = scratch.keep(across.unionByName(same).where("a <> b").select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct(), "linked")
        scratch.release(named, first, near)
    dealt = source.select("text").mapInArrow(prefixes, "key long, class long, n int, pos int").repartition("key").sortWithinPartitions("key", "class")
    held = scratch.keep(dealt.mapInArrow(_shared, "key long, class long, n int, pos int"), "shared")

    def verified(pairs: DataFrame) -> DataFrame:
        """Of pairs (src, dst) those of similarity 0.8 or more."""
        pairs = scratch.keep(pairs.distinct(), "pairs")
        side = lambda a, n, sketch: classes.select(F.col("class").alias(a), F.col("n").alias(n), F.col("sketch").alias(sketch))
        met = pairs.join(side("src", "n", "sketch"), "src").join(side("dst", "n2", "sketch2"), "dst")
        close = scratch.keep(met.select("src", "dst", "n", "n2", "sketch", "sketch2").mapInArrow(_screen, "src long, dst long"), "close")
        scratch.release(pairs)
        wanted = scratch.keep(close.select(F.explode(F.array("src", "dst")).alias("class")).distinct().join(classes.select("class", "th"), "class"), "wanted")
        shingles = source.select("th", "text").join(wanted, "th").select("class", "text").mapInArrow(sets, "class long, shingles array<long>")
        known = scratch.keep(shingles.groupBy("class").agg(F.first("shingles").alias("shingles")), "shingles")
        both = close.join(known.select(F.col("class").alias("src"), F.col("shingles").alias("a")), "src").join(known.select(F.col("class").alias("dst"), F.col("shingles").alias("b")), "dst")
        enough = 9 * F.size(F.array_intersect("a", "b")) >= 4 * (F.size("a") + F.size("b"))
        out = scratch.keep(both.where(enough).select("src", "dst"), "similar")
        scratch.release(close, wanted, known)
        return out

    met = scratch.keep(held.groupBy("key").agg(F.count("*").alias("m")), "meetings")
    weights = scratch.keep(held.join(met, "key").groupBy("class").agg(F.sum("m").alias("weight")), "weights")
    weighted = scratch.keep(held.join(weights, "class"), "weighted")
    leads = scratch.keep(weighted.groupBy("key").agg(F.max_by(F.struct("class", "n", "pos"), F.struct("weight", "class")).alias("lead")), "leads")
    stars = held.join(leads, "key").where((F.col("class") != F.col("lead.class")) & _could_be(F.col("n"), F.col("pos"), F.col("lead.n"), F.col("lead.pos")))
    edges = verified(stars.select(F.least("class", "lead.class").alias("src"), F.greatest("class", "lead.class").alias("dst")))
    if linked is not None:
        edges = edges.unionByName(linked)
    scratch.release(met, weights, weighted, leads)
    before = [held]
    for turn in range(ROUNDS + 1):
        groups = connected_components(edges)
        now = scratch.keep(held.join(groups.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class")), "held")
        scratch.release(*before)
        mixed = scratch.keep(now.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min_by("class", F.xxhash64("class", "key", F.lit(turn))).alias("lead")).where("low < high").select("key", "lead"), "mixed")
        held = scratch.keep(now.join(mixed, "key").select("key", "class", "n", "pos", "lead", "component"), "open")
        scratch.release(now, mixed)
        before = [held]
        parts = held.groupBy("key", "component").count().groupBy("key").agg(F.sum("count").alias("all"), F.sum(F.col("count") * F.col("count")).alias("own"))
        rows, pairs = parts.agg(F.sum("all"), F.sum((F.col("all") * F.col("all") - F.col("own")) / 2)).first()
        if not rows:
            break
        last = turn == ROUNDS or pairs <= WORTH * rows
        other = held.select("key", F.col("class").alias("dst"), F.col("n").alias("n2"), F.col("pos").alias("pos2"), F.col("component").alias("component2"))
        side = held if last else held.where(F.col("class") == F.col("lead"))
        apart = F.col("component") < F.col("component2") if last else F.col("component") != F.col("component2")
        met = side.join(other, "key").where(apart & _could_be(F.col("n"), F.col("pos"), F.col("n2"), F.col("pos2")))
        edges = edges.unionByName(verified(met.select(F.least("class", "dst").alias("src"), F.greatest("class", "dst").alias("dst"))))
        held = held.select("key", "class", "n", "pos")
        if last:
            groups = connected_components(edges)
            break
    members = groups.join(classes.select(F.col("class").alias("node"), "least"), "node")
    of_group = members.groupBy("component").agg(F.min("least").alias("of_group"))
    linked = scratch.keep(members.join(of_group, "component").select(F.col("node").alias("class"), "of_group"), "linked")
    named = scratch.keep(classes.select("class", "least").join(linked, "class", "left").select("class", F.coalesce("of_group", "least").alias("component_id")), "named")
    out = materialise(found.select("doc_id", "th", "class").join(named, "class").select("doc_id", "th", "component_id"), "groups")
    scratch.close()
    return out
