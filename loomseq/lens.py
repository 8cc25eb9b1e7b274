"""Sequencing tables over the plain test tables: the same rows in Spark, through this library's own parsers, and in SQL.

``lineitem`` rows become SAM lines (with CIGARs of five shapes, tags, sequences
and qualities from digests), ``supplier`` and ``part`` rows regions, ``orders``
rows VCF lines with the genotypes of three samples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .headers import AlignmentHeader, VariantHeader
from .plans.settings import scratch_path
from .sources import sam, vcf

CONTIG_LENGTH = 21000
HEADER = AlignmentHeader.from_text(
    "@HD\tVN:1.6\n" + "".join(f"@SQ\tSN:chr{i}\tLN:{CONTIG_LENGTH}\n" for i in range(1, 6)) + "".join(f"@RG\tID:rg{i}\tSM:s{i % 2}\tLB:lib{i // 2}\n" for i in range(4))
)
VCF_HEADER = VariantHeader.from_text(
    "##fileformat=VCFv4.2\n##INFO=<ID=DP,Number=1,Type=Integer,Description=\"Depth\">\n##INFO=<ID=DB,Number=0,Type=Flag,Description=\"Known\">\n"
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">\n##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Depth">\n##FILTER=<ID=q10,Description="low">\n'
    + "".join(f"##contig=<ID=chr{i},length=100000000>\n" for i in range(1, 6))
    + "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ta\tb\tc"
)

# The same text serves Spark SQL and DuckDB.
READS_SQL = """
select *, case k when 0 then qlen || 'M' when 1 then a || 'M2D' || b || 'M' when 2 then '3S' || (qlen - 3) || 'M' when 3 then a || 'M2I' || (b - 2) || 'M' else a || 'M50N' || b || 'M' end as cigar,
  case k when 0 then qlen when 1 then qlen + 2 when 2 then qlen - 3 when 3 then qlen - 2 else qlen + 50 end as span,
  substr(translate(md5(qname || '-' || cast(l_linenumber as varchar(10))) || md5('s' || qname), '0123456789abcdef', 'ACGTACGTACGTTGCA'), 1, qlen) as seq,
  substr(translate(md5('q' || qname || '-' || cast(l_linenumber as varchar(10))) || md5('r' || qname), '0123456789abcdef', '#%+05:?BDFGHIJ;2'), 1, qlen) as qual
from (
  select ((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 100 + cast(l_quantity as int) as rec_no, l_linenumber, 'q' || cast(l_orderkey as varchar(20)) as qname, cast(l_suppkey % 5 as int) as tid, 'chr' || cast(l_suppkey % 5 + 1 as varchar(2)) as rname,
    (l_partkey * 37 + l_linenumber * 11) % 20000 as pos, cast(l_quantity as int) + 10 as qlen, (cast(l_quantity as int) + 10) - cast(floor((l_quantity + 10) / 2) as int) as b, cast(floor((l_quantity + 10) / 2) as int) as a,
    l_linenumber % 5 as k, cast(round(l_discount * 600) as int) as mapq, 'rg' || cast(l_partkey % 4 as varchar(2)) as rg, cast(round(l_tax * 100) as int) as nm,
    (l_suppkey + case when l_orderkey % 4 = 0 then 1 else 0 end) % 5 as mate_tid, (l_partkey * 37 + 200) % 20000 as mate_pos,
    1 + case when l_orderkey % 3 = 0 then 2 else 0 end + case when l_partkey % 50 = 0 then 4 else 0 end + case when l_orderkey % 41 = 0 then 8 else 0 end + case when l_linestatus = 'O' then 16 else 0 end
      + case when l_linenumber % 2 = 1 then 64 else 128 end + case when l_linenumber > 5 then 256 else 0 end + case when l_quantity = 50 then 512 else 0 end + case when l_returnflag = 'R' then 1024 else 0 end as flag,
    case when l_linenumber % 3 = 0 then l_partkey % 700 - 100 else 0 end as tlen
  from lineitem
) x
"""

VARIANTS_SQL = """
select o_orderkey as rec_no, 'chr' || cast(o_custkey % 5 + 1 as varchar(2)) as chrom, o_orderkey * 3 + 1 as pos, case when o_orderkey % 7 = 0 then 'rs' || cast(o_orderkey as varchar(20)) end as id,
  substr('ACGT', cast(o_custkey % 4 as int) + 1, 1) || case when o_orderkey % 11 = 0 then 'GT' else '' end as ref,
  substr('CGTA', cast(o_custkey % 4 as int) + 1, 1) || case when o_orderkey % 13 = 0 then 'TTA' when o_orderkey % 11 = 0 then 'G' else '' end || case when o_orderkey % 17 = 0 then ',' || substr('GTAC', cast(o_custkey % 4 as int) + 1, 1) else '' end as alt,
  floor(o_totalprice / 10) / 100e0 as qual, case o_orderstatus when 'O' then 'PASS' when 'F' then 'q10' else '.' end as filter, cast(o_custkey % 60 as int) as dp, o_orderkey % 5 = 0 as db,
  cast(o_orderkey % 3 as int) as g1, cast(o_custkey % 4 as int) as g2, cast((o_orderkey + o_custkey) % 3 as int) as g3
from orders
"""

REGIONS_SQL = "select s_suppkey as region_id, 'chr' || cast(s_suppkey % 5 + 1 as varchar(2)) as contig, (s_suppkey * 700) % 20000 as start, (s_suppkey * 700) % 20000 + 500 as stop, s_acctbal as score from supplier"


def _table(spark: SparkSession, sf_dir: str, name: str) -> None:
    """The table as a view. Its one small file makes one task, so its few plain columns are dealt to all cores before text is made of them."""
    spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(spark.sparkContext.defaultParallelism).createOrReplaceTempView(name)


def sam_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value, file_id, rec_no): SAM record lines."""
    _table(spark, sf_dir, "lineitem")
    rows = spark.sql(READS_SQL)
    text = lambda c: F.col(c).cast("string")
    fields = [text("qname"), text("flag"), text("rname"), (F.col("pos") + 1).cast("string"), text("mapq"), text("cigar"), F.concat(F.lit("chr"), (F.col("mate_tid") + 1).cast("string")), (F.col("mate_pos") + 1).cast("string"), text("tlen"), text("seq"), text("qual"), F.concat(F.lit("RG:Z:"), "rg"), F.concat(F.lit("NM:i:"), text("nm"))]
    return rows.select(F.concat_ws("\t", *fields).alias("value"), F.lit(0).alias("file_id"), F.col("rec_no").cast("bigint").alias("rec_no"))


_landed: dict[tuple[str, str], str] = {}


def land(spark: SparkSession, sf_dir: str) -> None:
    """Write reads and variants once as Parquet, laid out by contig and place; from then on ``reads`` and ``variants`` read that."""
    for name, df, place in (("reads", reads(spark, sf_dir), ["rname", "pos"]), ("variants", variants(spark, sf_dir), ["chrom", "pos"])):
        path = scratch_path(spark, name)
        df.repartitionByRange(spark.sparkContext.defaultParallelism, *place).sortWithinPartitions(*place).write.parquet(path)
        _landed[name, sf_dir] = path


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    if ("reads", sf_dir) in _landed:
        return spark.read.parquet(_landed["reads", sf_dir])
    return sam.parse(sam_lines(spark, sf_dir), HEADER, records_only=True)


def vcf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value, file_id, rec_no): VCF record lines."""
    _table(spark, sf_dir, "orders")
    rows = spark.sql(VARIANTS_SQL)
    gt = lambda c: F.when(F.col(c) == 0, "0/0").when(F.col(c) == 1, "0/1").when(F.col(c) == 2, "1|1").otherwise("./.")
    cell = lambda c, d: F.concat(gt(c), F.lit(":"), (F.col("dp") % d).cast("string"))
    info = F.concat(F.lit("DP="), F.col("dp").cast("string"), F.when(F.col("db"), ";DB").otherwise(""))
    fields = [F.col("chrom"), F.col("pos").cast("string"), F.coalesce("id", F.lit(".")), F.col("ref"), F.col("alt"), F.col("qual").cast("string"), F.col("filter"), info, F.lit("GT:DP"), cell("g1", 10), cell("g2", 20), cell("g3", 30)]
    return rows.select(F.concat_ws("\t", *fields).alias("value"), F.lit(0).alias("file_id"), F.col("rec_no").cast("bigint").alias("rec_no"))


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    if ("variants", sf_dir) in _landed:
        return spark.read.parquet(_landed["variants", sf_dir])
    return vcf.parse(vcf_lines(spark, sf_dir), VCF_HEADER, records_only=True)


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(region_id, contig, start, stop, score)."""
    _table(spark, sf_dir, "supplier")
    return spark.sql(REGIONS_SQL)


def contigs(spark: SparkSession) -> DataFrame:
    return HEADER.contigs(spark)
