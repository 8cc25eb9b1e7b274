"""SimHash near-duplicate groups over deletion-variant signatures.

A document's fingerprint takes a majority vote, bit by bit, over the XXH64
hashes of its word shingles. Two fingerprints of 64 bits that differ in at most
``radius`` bits (2 or 3) are cut into two segments: one of the segments differs
in at most one bit. So every distinct fingerprint is indexed under each of its
segments with each one bit wildcarded (64 keys of 31 bits), fingerprints under
equal keys meet by one shuffle, and their full distance is verified there. Each
bucket gives a spanning star for each of its linked sets - never all pairs -
and components of the union of the stars are components of all links.

Exact copies share a fingerprint and meet as one row; only fingerprints, never
texts, are shuffled, and a bucket streams through one task in bounded memory
(eight bytes for each distinct fingerprint that shares 31 bits).

Defined results: null or empty text has fingerprint zero and is linked like any
other; fewer words than a shingle make one shingle of all of them; repeated
rows are linked to each other; a null id belongs to the group of its text but
is never its smallest; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fresh_name, materialise, text_or_empty
from .components import connected_components
from .jaccard import similar_groups
from .shingles import shingle_hashes

SHINGLE_WORDS = 3
RADIUS = 3


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as a signed integer."""
    votes = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 65536):
        part = hashes[a : a + 65536]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(text: str, words_each: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint as a signed integer."""
    return majority(shingle_hashes(text, words_each))


def fingerprints(docs: DataFrame, words_each: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, fp long), one row per row of ``docs``; th is XXH64 of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py() or "", words_each) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], names=["doc_id", "th", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_or_empty(text_col)).alias("th"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, th long, fp long")


def linked_sets(fps: np.ndarray, radius: int) -> Iterator[np.ndarray]:
    """The sets, of two or more, that links within the radius connect among distinct fingerprints."""
    left = fps
    while len(left) > 1:
        waiting, left, found = [left[0]], left[1:], [left[:1]]
        while waiting and len(left):
            near = np.bitwise_count(left ^ waiting.pop()) <= radius
            if near.any():
                found.append(left[near])
                waiting.extend(found[-1])
                left = left[~near]
        if len(found) > 1:
            yield np.concatenate(found)


def _bucket_stars(radius: int):
    """Over rows (key, fp) sorted by key: an edge from the smallest of each linked set to each other member."""

    def stars(keys: np.ndarray, fps: np.ndarray, out: list) -> None:
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        wild = (keys >> 32) & 31
        segment = np.where(keys >> 37 == 0, fps, fps >> 32)
        ones = np.add.reduceat((segment >> wild) & 1, starts)
        # Members that agree on the wildcarded bit too meet under every wildcard of the segment: the first does for all.
        for a, n in zip(*(x[(sizes > 1) & ((wild[starts] == 0) | ((ones > 0) & (ones < sizes)))].tolist() for x in (starts, sizes))):
            for linked in linked_sets(fps[a : a + n], radius):
                least = linked.min()
                out.append((np.full(len(linked) - 1, least), linked[linked != least]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []  # the last key's rows, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, fps = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            out: list = []
            if held and held[0][0][0] != keys[0]:
                stars(*map(np.concatenate, zip(*held)), out)
                held = []
            last = int(np.searchsorted(keys, keys[-1], "left"))
            if last:
                stars(*map(np.concatenate, zip(*held, (keys[:last], fps[:last]))), out)
                held = []
            held.append((keys[last:], fps[last:]))
            yield _edges(out)
        out = []
        if held:
            stars(*map(np.concatenate, zip(*held)), out)
        yield _edges(out)

    def _edges(out: list) -> pa.RecordBatch:
        src, dst = (np.concatenate([p[i] for p in out]) if out else np.zeros(0, np.int64) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])

    return run


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(src, dst): edges that connect exactly what links within the radius connect. ``distinct`` has distinct ``fp``."""
    if not 0 <= radius <= 3:
        raise ValueError("two segments serve a radius of at most 3")
    keyed = distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v"))
    segment = F.expr("shiftrightunsigned(fp, 32 * (v div 32)) & 4294967295L")
    key = F.expr("shiftleft(cast(v as long), 32)").bitwiseOR(segment.bitwiseAND(F.expr("~shiftleft(1L, cast(v % 32 as int))")))
    dealt = keyed.select(key.alias("key"), "fp").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_bucket_stars(radius), "src long, dst long").distinct()


def near_duplicates(docs: DataFrame, words_each: int = SHINGLE_WORDS, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, th (XXH64 of the text), fp, component_id (the smallest doc_id reachable, itself included)."""
    found = materialise(fingerprints(docs, words_each, id_col, text_col), "fingerprints")
    nodes = materialise(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    groups = connected_components(fingerprint_links(nodes, radius))
    members = groups.join(nodes, groups["node"] == nodes["fp"]).select("fp", "component", "least")
    least = members.groupBy("component").agg(F.min("least").alias("of_group"))
    linked = materialise(members.join(least, "component").select("fp", "of_group"), "linked")
    named = materialise(nodes.join(linked, "fp", "left").select("fp", F.coalesce("of_group", "least").alias("component_id")), "named")
    return found.join(named, "fp").select("doc_id", "th", "fp", "component_id")


def drop_copies(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows that ``groups`` (doc_id, th, component_id) names as copies of a smaller id; of rows that repeat an id and a text, one.

    A copy goes by its id and its text (th, XXH64), so that another text under
    the same id stays. Rows without an id cannot be named as anyone's copy and stay.
    """
    th, row = fresh_name(docs, "th"), fresh_name(docs, "row")
    scratch = Scratch(docs.sparkSession)
    groups = scratch.keep(groups.where("doc_id is not null").select("doc_id", "th", "component_id"), "groups")
    gone = materialise(groups.where("doc_id <> component_id").select(F.col("doc_id").alias(id_col), F.col("th").alias(th)).distinct(), "gone")
    repeated = groups.groupBy("doc_id").count().where("count > 1").limit(1).count()
    scratch.close()
    kept = docs.withColumn(th, F.xxhash64(text_or_empty(text_col))).join(gone, [id_col, th], "left_anti").select(*docs.columns)
    if repeated:
        kept = kept.withColumn(row, F.when(F.col(id_col).isNull(), F.monotonically_increasing_id())).dropDuplicates([id_col, text_col, row]).drop(row)
    return kept


def keep_one(docs: DataFrame, words_each: int = SHINGLE_WORDS, radius: int = RADIUS, similarity: bool = False, both: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the document of the smallest id of each group; see ``drop_copies``.

    Groups are those of fingerprints within ``radius`` or, with ``similarity``,
    of a Jaccard similarity of 0.8 or more between shingle sets, which no radius
    that can be indexed reaches (``jaccard``); with ``both`` those of either link.
    """
    if both:
        groups = similar_groups(docs, words_each, id_col, text_col, majority, lambda nodes: fingerprint_links(nodes, radius))
    elif similarity:
        groups = similar_groups(docs, words_each, id_col, text_col)
    else:
        groups = near_duplicates(docs, words_each, radius, id_col, text_col)
    return drop_copies(docs, groups, id_col, text_col)
