"""BED, GTF, GFF3 and plain tab-separated rows, and pileup text, by column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Rows of text files that are neither empty nor comments (``#``)."""
    return spark.read.text(list(paths)).where((F.col("value") != "") & ~F.col("value").startswith("#"))


def header(spark: SparkSession, *paths: str) -> list[str]:
    """The comment lines."""
    return [r["value"] for r in spark.read.text(list(paths)).where(F.col("value").startswith("#")).collect()]


def _fields(rows: DataFrame) -> DataFrame:
    return rows.select(F.split("value", "\t").alias("f"))


def tuples(rows: DataFrame) -> DataFrame:
    """(fields array<string>)."""
    return rows.select(F.split("value", "\t").alias("fields"))


def bed(rows: DataFrame) -> DataFrame:
    """BED of 3 to 12 columns; rows with fewer than three are left out, track and browser lines too."""
    f = lambda i: F.get("f", F.lit(i))
    kept = _fields(rows.where(~F.col("value").rlike("^(track|browser)\\b"))).where(F.size("f") >= 3)
    return kept.select(
        f(0).alias("contig"), f(1).cast("bigint").alias("start"), f(2).cast("bigint").alias("stop"), f(3).alias("name"), f(4).try_cast("double").alias("score"), f(5).alias("strand"),
        f(6).try_cast("bigint").alias("thick_start"), f(7).try_cast("bigint").alias("thick_stop"), f(8).alias("item_rgb"), f(9).try_cast("int").alias("block_count"), f(10).alias("block_sizes"), f(11).alias("block_starts"),
    )


def _nine(rows: DataFrame, attributes: Column) -> DataFrame:
    f = lambda i: F.get("f", F.lit(i))
    dot = lambda c: F.nullif(c, F.lit("."))
    return _fields(rows).where(F.size("f") >= 9).select(
        f(0).alias("contig"), f(1).alias("source"), f(2).alias("feature"), (f(3).cast("bigint") - 1).alias("start"), f(4).cast("bigint").alias("stop"),
        dot(f(5)).try_cast("double").alias("score"), dot(f(6)).alias("strand"), dot(f(7)).alias("frame"), attributes.alias("attributes"),
    )


def gtf(rows: DataFrame) -> DataFrame:
    """GTF; starts become 0-based; of repeated attributes the last counts."""
    pairs = "transform(regexp_extract_all(get(f, 8), '\\\\s*([^\\\\s;]+)\\\\s+(\"[^\"]*\"|[^;]*)', 0), t -> trim(t))"
    entries = f"transform({pairs}, t -> named_struct('key', substring_index(t, ' ', 1), 'value', trim(BOTH '\"' FROM trim(substring(t, length(substring_index(t, ' ', 1)) + 1)))))"
    return _nine(rows, _last_wins(entries))


def gff3(rows: DataFrame) -> DataFrame:
    """GFF3; attributes are ``key=value`` parts, percent-decoded."""
    entries = "transform(filter(split(get(f, 8), ';'), t -> instr(t, '=') > 1), t -> named_struct('key', trim(substring_index(t, '=', 1)), 'value', try_url_decode(replace(trim(substring(t, instr(t, '=') + 1)), '+', '%2B'))))"
    return _nine(rows, _last_wins(entries))


def _last_wins(entries: str) -> Column:
    return F.expr(f"aggregate({entries}, cast(map() as map<string,string>), (m, e) -> map_concat(map_filter(m, (k, v) -> k <> e.key), map(e.key, e.value)))")


def inverted(features: DataFrame, contigs: DataFrame) -> DataFrame:
    """Minus-strand features in coordinates from their contig's other end; ``contigs`` is (name, length)."""
    joined = features.join(contigs.select(F.col("name").alias("contig"), "length"), "contig")
    minus = F.col("strand") == "-"
    return joined.withColumns({"start": F.when(minus, F.col("length") - F.col("stop")).otherwise(F.col("start")), "stop": F.when(minus, F.col("length") - F.col("start")).otherwise(F.col("stop"))}).drop("length")


def gtf_text(features: DataFrame) -> DataFrame:
    """(value) GTF lines."""
    attributes = F.expr("array_join(transform(map_entries(attributes), e -> concat(e.key, ' \"', e.value, '\";')), ' ')")
    dot = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    return features.select(F.concat_ws("\t", "contig", dot("source"), dot("feature"), (F.col("start") + 1).cast("string"), F.col("stop").cast("string"), dot("score"), dot("strand"), dot("frame"), attributes).alias("value"))


def pileup_text(rows: DataFrame) -> DataFrame:
    """Consensus pileup text: ten columns for a substitution, and thirteen, with ``*`` for the reference base, for an indel."""
    f = lambda i: F.get("f", F.lit(i))
    indel = f(2) == "*"
    when = lambda i: F.when(indel, f(i))
    return _fields(rows).select(
        f(0).alias("chromosome"), (f(1).cast("bigint") - 1).alias("pos"), f(2).alias("reference_base"), f(3).alias("genotype"), f(4).try_cast("int").alias("consensus_quality"), f(5).try_cast("int").alias("snp_quality"),
        f(6).try_cast("int").alias("mapping_quality"), f(7).try_cast("int").alias("coverage"), F.when(~indel, f(8)).alias("read_bases"), F.when(~indel, f(9)).alias("base_qualities"),
        when(8).alias("first_allele"), when(9).alias("second_allele"), when(10).try_cast("int").alias("reads_first"), when(11).try_cast("int").alias("reads_second"), when(12).try_cast("int").alias("reads_diff"),
    )
