"""Benchmark decontamination: item-sized windows of documents that are near copies of benchmark items.

For a benchmark item of L words every window of L words of a document counts.
Each gets a 64-bit SimHash of its shingles, as each item has; fingerprints
within ``radius`` bits agree in at least one of ``radius`` + 1 blocks, on which
windows and items of one length are joined by equality, and all pairs within
the radius are verified by the exact weighted Jaccard similarity of the
shingles, where a shingle weighs as often as it occurs.

Two things spare most windows their fingerprint, and neither loses a match. A
window and an item, of m and n shingles, can only reach the similarity s with
at least s (m + n) / (1 + s) shingles in common; so places whose shingle is one
of any item's are marked first, for the lengths of those items, and windows of a
length with fewer places marked for it are left out - whatever item they may
resemble and in whatever order its words come. And of windows that slide over
one another only those count that begin at a place marked for their length, and
the document's last: sliding on from an unmarked place gives no shared shingle
away.

The whole path is DataFrame functions. Documents are not shuffled: positions
are generated, hashed and held against the items' shingles in one stage of
generated code, with the distinct shingles of each length broadcast if they
number no more than ``BROADCAST_SHINGLES`` (about 30 bytes each) and joined by
shuffle otherwise; the same holds for the documents with enough marked places,
whose words are read again. Windows keep their words and are fingerprinted where
they are cut; shingles are made again only for pairs within the radius.

The radius of 24 is five standard deviations beyond the distance that a
similarity of 0.8 gives (9.7 of 64 bits, deviation 2.9).

Words are lower-cased and separated by ASCII white space; shingles have five
words, or all of an item with fewer; a document of fewer words than an item is
one window. Defined results: null and empty texts match nothing; rows that
share an id are matched on their own and reported under it; rows that repeat an
id and a text are reported once; a null id is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, Scratch, materialise

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 24
BROADCAST_SHINGLES = 1_000_000
BROADCAST_DOCUMENTS = 100_000


def words_of(text: Column) -> Column:
    """The lower-cased words; none for null and blank texts."""
    bare = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, ASCII_SPACE))


def _hash(words: Column, at: Column, k: int) -> Column:
    return F.xxhash64(*(F.get(words, at + j) for j in range(k)))


def shingles_of(words: Column, k: Column) -> Column:
    """The shingles of ``k`` words as strings, repeats included."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - k + 1, F.lit(1))), lambda i: F.concat_ws(" ", F.slice(words, i, k)))


def simhash_of(shingles: Column) -> Column:
    """64 majority bits over the shingles' hashes."""
    hashes = F.transform(shingles, lambda s: F.xxhash64(s))
    bit = lambda b: F.when(2 * F.size(F.filter(hashes, lambda h: F.shiftrightunsigned(h, 0).bitwiseAND(F.lit(1 << b if b < 63 else -(1 << 63))) != 0)) > F.size(hashes), F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0))
    out = bit(0)
    for b in range(1, 64):
        out = out.bitwiseOR(bit(b))
    return out


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Multiset Jaccard similarity of two arrays of strings."""
    count = lambda xs, s: F.size(F.filter(xs, lambda x: x == s))
    shared = F.aggregate(F.array_distinct(a), F.lit(0), lambda n, s: n + F.least(count(a, s), count(b, s)))
    return shared / (F.size(a) + F.size(b) - shared)


def _within(small: DataFrame, most: int) -> DataFrame:
    """A written table, to be broadcast if it has no more than ``most`` rows."""
    return F.broadcast(small) if small.limit(most + 1).count() <= most else small


def _starts(at: str, last: str, n: str, least: str) -> Column:
    """Starts of windows of ``n`` shingles with ``least`` marked places or more: marked places up to ``last``, and ``last``."""
    marked = f"transform(filter(sequence(0, size({at}) - {least}), i -> {at}[i] <= {last} and {at}[i + {least} - 1] < {at}[i] + {n}), i -> {at}[i])"
    final = f"if(size(filter({at}, p -> p >= {last})) >= {least}, array({last}), array())"
    return F.expr(f"if(size({at}) >= {least}, array_distinct(concat({marked}, {final})), array())")


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and item that it holds a near copy of: doc_id, of_text (xxhash64 of the text), item_id, n_windows, start_word, similarity (of the best window)."""
    scratch = Scratch(docs.sparkSession)
    items = benchmark.select(F.col(item_col).alias("item_id"), words_of(F.col(item_text_col)).alias("item_words")).where(F.size("item_words") > 0).distinct()
    items = items.withColumn("length", F.size("item_words")).withColumn("k", F.least("length", F.lit(SHINGLE_WORDS)))
    items = items.withColumn("item_shingles", shingles_of(F.col("item_words"), F.col("k"))).withColumn("item_fp", simhash_of(F.col("item_shingles")))
    items = scratch.keep(items.withColumn("number", F.monotonically_increasing_id()), "items")

    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("of_text"), text.alias("text"))
    split = source.select("doc_id", "of_text", words_of(F.col("text")).alias("words"))
    marked = None
    for k in [r.k for r in items.select("k").distinct().collect()]:  # 1 to 5
        at = items.where(F.col("k") == k).select("item_words", "length", F.explode(F.sequence(F.lit(0), F.size("item_words") - k)).alias("q"))
        wanted = scratch.keep(at.select(_hash(F.col("item_words"), F.col("q"), k).alias("h"), "length").distinct(), "shingles")
        placed = split.where(F.size("words") >= k).select("doc_id", "of_text", "words", F.size("words").alias("n_words"), F.explode(F.sequence(F.lit(0), F.size("words") - k)).alias("p"))
        placed = placed.select("doc_id", "of_text", "n_words", "p", _hash(F.col("words"), F.col("p"), k).alias("h"))
        met = placed.join(_within(wanted, BROADCAST_SHINGLES), "h").select("doc_id", "of_text", "n_words", F.lit(k).alias("k"), "length", "p")
        marked = met if marked is None else marked.unionByName(met)
    if marked is None:
        return source.select("doc_id", "of_text", F.lit(None).cast(benchmark.schema[item_col].dataType).alias("item_id"), F.lit(0).cast("long").alias("n_windows"), F.lit(0).alias("start_word"), F.lit(0.0).alias("similarity")).where("false")

    at = marked.groupBy("doc_id", "of_text", "k", "length").agg(F.first("n_words").alias("n_words"), F.sort_array(F.collect_set("p")).alias("at"))
    per_length = at.withColumns({"n": F.col("length") - F.col("k") + 1, "last": F.greatest(F.col("n_words") - F.col("length"), F.lit(0))})
    size = F.least(F.col("n"), F.col("n_words") - F.col("k") + 1)
    per_length = per_length.withColumn("least", F.greatest(F.ceil(F.lit(similarity) * (size + F.col("n")) / F.lit(1 + similarity) - 1e-9).cast("int"), F.lit(1)))
    placed = per_length.select("doc_id", "of_text", "k", "length", _starts("at", "last", "n", "least").alias("starts")).where(F.size("starts") > 0)
    placed = scratch.keep(placed.groupBy("doc_id", "of_text").agg(F.collect_list(F.struct("k", "length", "starts")).alias("lengths")), "placed")

    wanted = _within(placed.withColumnsRenamed({"doc_id": "w_id", "of_text": "w_text"}), BROADCAST_DOCUMENTS)
    again = source.join(wanted, F.expr("doc_id <=> w_id and of_text = w_text")).select("doc_id", "of_text", words_of(F.col("text")).alias("words"), "lengths")
    windows = again.select("doc_id", "of_text", "words", F.explode("lengths").alias("l")).select("doc_id", "of_text", "words", "l.k", "l.length", F.explode("l.starts").alias("start_word"))
    # Shingles come out of a generator, so that they are made once and not for each bit.
    windows = windows.select("doc_id", "of_text", "k", "length", "start_word", F.slice("words", F.col("start_word") + 1, F.col("length")).alias("words"))
    windows = windows.select("*", F.explode(F.array(shingles_of(F.col("words"), F.col("k")))).alias("shingles"))
    windows = scratch.keep(windows.withColumn("fp", simhash_of(F.col("shingles"))).drop("shingles").withColumn("window", F.monotonically_increasing_id()), "windows")

    blocks = radius + 1
    edges = [64 * b // blocks for b in range(blocks + 1)]
    masks = [((1 << edges[b + 1]) - (1 << edges[b])) for b in range(blocks)]
    signed = lambda mask: F.lit(mask - (1 << 64) if mask >> 63 else mask)

    def in_blocks(fp: str) -> Column:
        return F.explode(F.array(*(F.struct(F.lit(b).alias("block"), F.col(fp).bitwiseAND(signed(m)).alias("bits")) for b, m in enumerate(masks)))).alias("b")

    left = windows.select("window", "length", "fp", in_blocks("fp")).select("window", "length", "fp", "b.block", "b.bits")
    right = items.select("number", "length", "item_fp", in_blocks("item_fp")).select("number", "length", "item_fp", "b.block", "b.bits")
    met = left.join(right, ["length", "block", "bits"])
    apart = F.col("fp").bitwiseXOR(F.col("item_fp"))
    first = F.coalesce(*(F.when(apart.bitwiseAND(signed(m)) == 0, F.lit(b)) for b, m in enumerate(masks)))  # of the blocks that agree only the first tells the pair
    near = met.where((F.bit_count(apart) <= radius) & (F.col("block") == first)).select("window", "number")
    pairs = windows.join(near, "window").join(items.select("number", "item_id", "item_shingles"), "number").select("*", F.explode(F.array(shingles_of(F.col("words"), F.col("k")))).alias("shingles"))
    scored = pairs.withColumn("similarity", weighted_jaccard(F.col("shingles"), F.col("item_shingles"))).where(F.col("similarity") >= similarity)
    best = F.min_by(F.col("start_word"), F.struct(-F.col("similarity"), F.col("start_word")))
    out = materialise(scored.groupBy("doc_id", "of_text", "item_id").agg(F.count_distinct("start_word").alias("n_windows"), best.alias("start_word"), F.max("similarity").alias("similarity")), "leaks")
    scratch.close()
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs``, all columns, without the documents that hold a near copy of an item."""
    found = leaks(docs, benchmark, id_col=id_col, text_col=text_col, **options).select("doc_id", "of_text").distinct()
    same = F.col(f"d.{id_col}").cast("long").eqNullSafe(F.col("l.doc_id")) & (F.xxhash64(F.coalesce(F.col(f"d.{text_col}"), F.lit(""))) == F.col("l.of_text"))
    return docs.alias("d").join(found.alias("l"), same, "left_anti").select(*docs.columns)
