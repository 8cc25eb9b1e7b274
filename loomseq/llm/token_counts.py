"""Token counts through a digest cache.

A text's normalised content (runs of ASCII white space are one space, none at
the ends - neither changes the count under a tokenizer that cuts at white space
and drops it; for all other tokenizers the text stands as it is) has a digest,
and so has the tokenizer file. Counts already stored under both digests are
taken from the cache; of the rest, each distinct content is encoded once, on
the executors, and appended to the cache. Documents then pick up their counts
by an equality join on the digest.

Distinct contents are taken with a map-side combine before the shuffle, and
the final join is between two plain exchanges, which adaptive execution splits
where one content makes up a large share of all rows.

Defined results: null text counts as empty (0 tokens); a null id is kept;
repeated rows are counted once per row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE
from .tokens import _cuts_at_space, in_slices, tokenizer


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the tokenizer file: another version, another digest."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def _count(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(vocabulary).encode
        for batch in batches:
            texts = batch.column(1)
            counts = [n for a, b in in_slices(texts) for n in np.diff(encode(texts[a:b])[1]).tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["content_digest", "n_tokens"])

    return run


def token_counts(docs: DataFrame, vocabulary: str, cache: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens. ``cache`` is a Parquet path that this call appends to."""
    spark = docs.sparkSession
    version = tokenizer_digest(vocabulary)
    text = F.coalesce(F.col(text_col), F.lit(""))
    by_word = vocabulary.endswith(".json") and _cuts_at_space(vocabulary)
    content = F.trim(F.regexp_replace(text, ASCII_SPACE, " ")) if by_word else text
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), content.alias("content"))
    keyed = keyed.withColumn("content_digest", F.unhex(F.sha2("content", 256)))

    misses = keyed.select("content_digest", "content").dropDuplicates(["content_digest"])
    try:
        stored = spark.read.parquet(cache).where(F.col("tokenizer_digest") == version).select("content_digest", "n_tokens")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        stored = None
    if stored is not None:
        misses = misses.join(stored, "content_digest", "left_anti")
    fresh = misses.mapInArrow(_count(vocabulary), "content_digest binary, n_tokens long")
    fresh.withColumn("tokenizer_digest", F.lit(version)).write.mode("append").parquet(cache)

    counts = spark.read.parquet(cache).where(F.col("tokenizer_digest") == version).select("content_digest", "n_tokens")
    if stored is not None:  # two writers may have stored the same content
        counts = counts.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))
    return keyed.drop("content").join(counts, "content_digest").drop("content_digest")
