"""Records laid out by place in Parquet: what an index file is for.

Rows lie in order of contig and start, in files of ranges and row groups of a
few megabytes, whose footers hold the least and greatest start and stop. The
predicate of an overlap is on just these columns, so a fetch reads the few row
groups that can hold the region; nothing beside the files is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a row group: the piece that a fetch reads or leaves.
GROUP_BYTES = 8 << 20


def write(df: DataFrame, path: str, contig: str = "rname", start: str = "pos", files: int | None = None) -> None:
    """``df`` by contig and start; of reads, variants or intervals alike."""
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, contig, start).sortWithinPartitions(contig, start).write.option("parquet.block.size", GROUP_BYTES).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table, for ``reads.fetch``, ``variants.fetch`` or ``regions.overlaps``, whose tests go down to the scan."""
    return spark.read.parquet(path)
