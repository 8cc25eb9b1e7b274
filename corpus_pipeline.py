"""A corpus pipeline of five stages over ``documents``.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; what it returns is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomseq.llm.common import materialise, table
from loomseq.llm.decontaminate import clean_documents
from loomseq.llm.packing import pack_documents
from loomseq.llm.quality import keep_good
from loomseq.llm.queries import vocabulary
from loomseq.llm.simhash import keep_one
from loomseq.llm.suffix_dedup import cut_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays.

    Near are texts whose SimHash fingerprints of five-word shingles differ in
    three bits or fewer. Fingerprints miss most pairs whose sets of shingles
    have a Jaccard similarity of 0.8 or more; these are linked besides, exactly.
    """
    return keep_one(docs, words_each=5, both=True)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 100 bytes that also start earlier are cut; documents that this empties go."""
    cut = cut_repeats(docs).where(F.col("text").isNull() | (F.trim("text") != ""))
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that still hold a near copy of a benchmark item go."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces placed in sequences of 2048 tokens."""
    return pack_documents(docs, vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express none of the stages but by recursion over all pairs; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
