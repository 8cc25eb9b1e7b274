"""Records as they land: file streams of SAM and VCF text, with the columns of the batch readers.

The formats know no event time; counters are complete or by key, with no late data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import flags
from ..headers import AlignmentHeader, VariantHeader
from ..sources import sam, vcf


def _lines(spark: SparkSession, folder: str, files_per_trigger: int) -> DataFrame:
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
    return lines.withColumn("file_id", F.lit(0)).withColumn("rec_no", F.lit(None).cast("bigint"))


def read_sam(spark: SparkSession, folder: str, header: AlignmentHeader, files_per_trigger: int = 16) -> DataFrame:
    """A stream of ``reads`` from SAM files that appear in a folder."""
    return sam.parse(_lines(spark, folder, files_per_trigger), header)


def read_vcf(spark: SparkSession, folder: str, header: VariantHeader, files_per_trigger: int = 16) -> DataFrame:
    """A stream of ``variants`` from VCF files that appear in a folder."""
    return vcf.parse(_lines(spark, folder, files_per_trigger), header)


def running_counts(reads: DataFrame) -> DataFrame:
    """(rname, n, mapped, duplicates), updated as reads come: state is one row per contig."""
    return reads.groupBy(F.coalesce("rname", F.lit("*")).alias("rname")).agg(F.count("*").alias("n"), F.count_if(flags.lacks(4)).alias("mapped"), F.count_if(flags.has(0x400)).alias("duplicates"))


def land(stream: DataFrame, path: str, checkpoint: str, by: str = "rname"):
    """Writes a stream as Parquet by contig, with exactly-once commits; returns the running query."""
    return stream.writeStream.format("parquet").partitionBy(by).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
