"""SAM text: lines to ``reads`` and back, by column expressions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import cigar
from ..headers import AlignmentHeader
from ..plans.settings import fields_once, for_parsed_text


def read_header(spark: SparkSession, path: str) -> AlignmentHeader:
    """The header of a SAM file, or of several (the first with a given line wins)."""
    order = {k: i for i, k in enumerate(("@HD", "@SQ", "@RG", "@PG", "@CO"))}
    got = spark.read.text(path).where(F.col("value").startswith("@")).collect()
    texts = list(dict.fromkeys(r["value"] for r in got))
    return AlignmentHeader.from_text("\n".join(sorted(texts, key=lambda t: order.get(t[:3], 9))))


def _tag(text: str) -> str:
    """SQL: TAG:TYPE:VALUE as a map entry of the tag's name and typed value."""
    kind, value = f"substring({text}, 4, 1)", f"substring({text}, 6)"
    return (
        f"named_struct('key', left({text}, 2), 'value', named_struct('type', if({kind} in ('c','C','s','S','I'), 'i', {kind}),"
        f" 'i', if({kind} in ('i','c','C','s','S','I'), try_cast({value} as bigint), null),"
        f" 'd', if({kind} in ('f','d'), try_cast({value} as double), null),"
        f" 's', if({kind} in ('A','Z','H'), {value}, if({kind} = 'B', left({value}, 1), null)),"
        f" 'a', if({kind} = 'B', transform(filter(split(substring({value}, 3), ','), x -> x <> ''), x -> try_cast(x as double)), null)))"
    )


def parse(lines: DataFrame, header: AlignmentHeader, records_only: bool = False) -> DataFrame:
    """``reads`` from lines (value, file_id, rec_no); header and blank lines are left out
    (``records_only``: there are none, and lines that are costly to make are made once).

    Positions become 0-based, ``*`` null, ``=`` the read's own contig, and
    contigs get their number in the header (-1 for none).
    """
    spark = lines.sparkSession
    for_parsed_text(spark)
    known = header.contigs(spark).select(F.col("name"), F.col("tid"))
    numbers = F.create_map(*(F.lit(x) for i, n in enumerate(header.references) for x in (n, i))) if 0 < header.nreferences <= 2000 else None
    f = lambda i: F.get(F.col("f"), F.lit(i))
    star = lambda c: F.nullif(c, F.lit("*"))
    kept = lines if records_only else lines.where((F.col("value") != "") & ~F.col("value").startswith("@"))
    rows = kept.select("file_id", "rec_no", fields_once(F.col("value")).alias("f"))
    out = rows.select(
        f(0).alias("qname"),
        f(1).cast("int").alias("flag"),
        star(f(2)).alias("rname"),
        (f(3).cast("bigint") - 1).alias("pos"),
        f(4).cast("int").alias("mapq"),
        f(5).alias("cigar"),
        cigar.parse("get(f, 5)").alias("cigar_ops"),
        F.when(f(6) == "=", star(f(2))).otherwise(star(f(6))).alias("mate_rname"),
        (f(7).cast("bigint") - 1).alias("mate_pos"),
        f(8).cast("bigint").alias("tlen"),
        star(f(9)).alias("seq"),
        star(f(10)).alias("qual"),
        F.expr(f"map_from_entries(transform(filter(slice(f, 12, greatest(size(f) - 11, 0)), t -> length(t) >= 5), t -> {_tag('t')}))").alias("tags"),
        "file_id",
        "rec_no",
    )
    if numbers is not None:
        number = lambda c: F.coalesce(F.try_element_at(numbers, F.col(c)), F.lit(-1))
        out = out.withColumn("tid", F.when(F.col("rname").isNull(), -1).otherwise(number("rname"))).withColumn("mate_tid", F.when(F.col("mate_rname").isNull(), -1).otherwise(number("mate_rname")))
    else:
        for name, tid in (("rname", "tid"), ("mate_rname", "mate_tid")):
            side = known.select(F.col("name").alias(f"_{name}"), F.col("tid").alias(tid))
            out = out.join(side, F.col(name) == F.col(f"_{name}"), "left").drop(f"_{name}").withColumn(tid, F.coalesce(tid, F.lit(-1)))
    return out.select(
        "qname", "flag", "tid", "rname", "pos", cigar.end_pos().alias("end_pos"), "mapq", "cigar", "cigar_ops", "mate_tid", "mate_rname", "mate_pos", "tlen", "seq", "qual",
        "tags", F.expr("try_element_at(tags, 'RG').s").alias("rg"), "file_id", "rec_no",
    )


def read(spark: SparkSession, *paths: str, header: AlignmentHeader | None = None) -> DataFrame:
    """``reads`` from SAM files (plain or compressed); files are numbered in the order given."""
    parts = [spark.read.text(p).withColumn("file_id", F.lit(i)).withColumn("rec_no", F.monotonically_increasing_id()) for i, p in enumerate(paths)]
    lines = parts[0]
    for p in parts[1:]:
        lines = lines.unionByName(p)
    return parse(lines, header or read_header(spark, list(paths)))


def lines(reads: DataFrame, *more: Column) -> DataFrame:
    """SAM text lines (value) of reads, in the order of their rows, after the columns ``more``; tags in the order of their map."""
    number = "if(e.value.d = cast(e.value.d as bigint) and abs(e.value.d) < 1e15, cast(cast(e.value.d as bigint) as string), cast(e.value.d as string))"
    whole = "if(x = cast(x as bigint), cast(cast(x as bigint) as string), cast(x as string))"
    tags = (
        "transform(map_entries(coalesce(tags, map())), e -> concat_ws(':', e.key, e.value.type, case when e.value.type = 'i' then cast(e.value.i as string)"
        f" when e.value.type in ('f','d') then {number} when e.value.type = 'B' then concat_ws(',', e.value.s, array_join(transform(e.value.a, x -> {whole}), ',')) else e.value.s end))"
    )
    star = lambda c: F.coalesce(F.col(c), F.lit("*"))
    mate = F.when(F.col("mate_rname").isNull(), "*").when(F.col("mate_rname") == F.col("rname"), "=").otherwise(F.col("mate_rname"))
    fields = [star("qname"), "flag", star("rname"), F.col("pos") + 1, "mapq", star("cigar"), mate, F.col("mate_pos") + 1, "tlen", star("seq"), star("qual")]
    return reads.select(*more, F.concat_ws("\t", *(c.cast("string") if isinstance(c, Column) else F.col(c).cast("string") for c in fields), F.expr(tags)).alias("value"))


def write(reads: DataFrame, header: AlignmentHeader, path: str) -> None:
    """A folder of SAM parts: the header in one, the records in the order of ``reads``' partitions."""
    spark = reads.sparkSession
    top = spark.createDataFrame([(str(header).rstrip("\n"),)], "value string").coalesce(1)
    top.union(lines(reads)).write.text(path)

