"""The registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import licenses, url_filter
from .common import shared_folder, shared_path, table


def vocabulary() -> str:
    """The tokenizer file of the queries; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import dedup_report

    return dedup_report(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache stays in the shared folder: a later call encodes only texts that no earlier one has seen."""
    from .token_counts import token_counts

    counts = token_counts(table(spark, sf_dir, "documents"), vocabulary(), f"{shared_folder(spark)}/token-cache")
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import license_scan

    return license_scan(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_report

    return quality_report(table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import warc

    warc.register(spark)
    archive = shared_path(spark, "warc")
    warc.dedup_records(table(spark, sf_dir, "pages")).write.format("warc").mode("append").save(archive)
    records = spark.read.format("warc").load(archive)
    return records.select(
        warc.record_page_id(F.col("record_id")).alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("long"), F.col("payload_bytes")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        warc.record_page_id(F.col("refers_to")).alias("refers_to"),
    )


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("of_text")


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's labelled outcome is that of the document of the same id: bad if of low quality or toxic. Labels that lack one of the two do not count."""
    from .url_filter import judge_urls

    labels = table(spark, sf_dir, "labels").where("quality is not null and toxic is not null").select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return judge_urls(table(spark, sf_dir, "pages"), labels).drop("bad_bound")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat_template import formatted_chunks, read_back

    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return read_back(formatted_chunks(rows.unionByName(probe)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_suffix_array_dedup,
        op3_token_counts,
        op4_license_scans,
        op5_quality_rules,
        op6_simhash_near_dedup,
        op7_warc,
        op8_benchmark_decontamination,
        op9_url_filters,
        op10_chat_formatting,
    )
}

#: DuckDB SQL for those that SQL can express over whole tables in reasonable time.
ORACLE_SQL: dict[str, str] = {"op4_license_scans": licenses.oracle_sql(), "op9_url_filters": url_filter.oracle_sql()}
