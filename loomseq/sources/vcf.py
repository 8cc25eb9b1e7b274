"""VCF text: lines to ``variants`` and back, typed by the header, by column expressions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..headers import Field, VariantHeader
from ..plans.settings import fields_once, for_parsed_text


def read_header(spark: SparkSession, *paths: str) -> VariantHeader:
    rows = spark.read.text(list(paths)).where(F.col("value").startswith("#")).collect()
    return VariantHeader.from_text("\n".join(dict.fromkeys(r["value"] for r in rows)))


def genotype(text: str) -> str:
    """SQL: the GT text as struct(alleles, phased); phased if every separator is ``|``; missing alleles null."""
    return (
        f"if({text} is null or {text} = '', null, named_struct('alleles', transform(split({text}, '[/|]'), a -> try_cast(a as int)),"
        f" 'phased', instr({text}, '/') = 0 and instr({text}, '|') > 0))"
    )


def parse(lines: DataFrame, header: VariantHeader, samples: list[str] | None = None, records_only: bool = False) -> DataFrame:
    """``variants`` from lines (value, file_id, rec_no).

    ``samples``: only these, an empty list none. ``start`` is 0-based, ``stop``
    is start plus the length of REF, or INFO/END. ``.`` is null (an empty array
    for ALT and FILTER); flags in INFO have an empty value.
    """
    for_parsed_text(lines.sparkSession)
    f = lambda i: F.get("f", F.lit(i))
    dot = lambda c: F.nullif(c, F.lit("."))
    many = lambda c, by: F.when(dot(c).isNull(), F.array().cast("array<string>")).otherwise(F.split(c, by))
    info = (
        "map_from_entries(transform(filter(split(get(f, 7), ';'), t -> t <> '' and t <> '.'),"
        " t -> named_struct('key', substring_index(t, '=', 1), 'value', if(instr(t, '=') > 0, substring(t, instr(t, '=') + 1), ''))))"
    )
    names = header.samples if samples is None else [s for s in header.samples if s in samples]
    if samples is not None and set(samples) - set(header.samples):
        raise ValueError(f"no samples {sorted(set(samples) - set(header.samples))}")
    cells = [
        f"named_struct('name', '{n}', 'gt', {genotype(f'get(split(get(f, {9 + header.samples.index(n)}), chr(58)), array_position(split(get(f, 8), chr(58)), {chr(39)}GT{chr(39)}) - 1)')},"
        f" 'fields', map_from_arrays(slice(split(get(f, 8), ':'), 1, size(split(get(f, {9 + header.samples.index(n)}), ':'))), split(get(f, {9 + header.samples.index(n)}), ':')))"
        for n in names
    ]
    numbers = {c: i for i, c in enumerate(header.contigs)}
    rid = F.try_element_at(F.create_map(*(F.lit(x) for kv in numbers.items() for x in kv)), f(0)) if numbers else F.lit(None).cast("int")
    kept = lines if records_only else lines.where((F.col("value") != "") & ~F.col("value").startswith("#"))
    rows = kept.select("file_id", "rec_no", fields_once(F.col("value")).alias("f"))
    end = F.expr("try_cast(try_element_at(info, 'END') as bigint)")
    out = rows.select(
        rid.alias("rid"), f(0).alias("chrom"), f(1).cast("bigint").alias("pos"), (f(1).cast("bigint") - 1).alias("start"), dot(f(2)).alias("id"), f(3).alias("ref"), many(f(4), ",").alias("alts"),
        dot(f(5)).cast("double").alias("qual"), many(f(6), ";").alias("filters"), F.expr(info).alias("info"), F.when(f(8).isNull(), F.array().cast("array<string>")).otherwise(F.split(f(8), ":")).alias("format"),
        F.expr(f"if(size(f) > 9, array({', '.join(cells)}), array())" if cells else "array()").cast("array<struct<name:string,gt:struct<alleles:array<int>,phased:boolean>,fields:map<string,string>>>").alias("samples"), "file_id", "rec_no",
    )
    return out.withColumn("stop", F.coalesce(end, F.col("start") + F.length("ref"))).select(
        "rid", "chrom", "pos", "start", "stop", "id", "ref", "alts", "qual", "filters", "info", "format", "samples", "file_id", "rec_no"
    )


def read(spark: SparkSession, *paths: str, samples: list[str] | None = None) -> DataFrame:
    """``variants`` of VCF files (plain or gzipped) with the same samples, numbered in the order given."""
    header = read_header(spark, *paths)
    out = None
    for i, p in enumerate(paths):
        lines = spark.read.text(p).withColumn("file_id", F.lit(i)).withColumn("rec_no", F.monotonically_increasing_id())
        part = parse(lines, read_header(spark, p) if len(paths) > 1 else header, samples)
        out = part if out is None else out.unionByName(part)
    return out


def typed(value: Column, declared: Field) -> Column:
    """An INFO or FORMAT text as its declared type: scalar for Number=1, boolean for flags, else an array; ``.`` null."""
    kind = {"Integer": "bigint", "Float": "double"}.get(declared.type, "string")
    if declared.type == "Flag":
        return value.isNotNull()
    one = lambda v: F.nullif(v, F.lit(".")).try_cast(kind)
    return one(value) if declared.scalar else F.transform(F.split(value, ","), one)


def info(name: str, header: VariantHeader) -> Column:
    return typed(F.expr(f"try_element_at(info, '{name}')"), header.info.get(name) or Field(name, ".", "String"))


def genotypes(variants: DataFrame) -> DataFrame:
    """Long form: one row per site and sample."""
    rest = [c for c in variants.columns if c not in ("samples", "format")]
    return variants.select(*rest, F.posexplode("samples").alias("sample_no", "s")).select(*rest, "sample_no", F.col("s.name").alias("sample"), F.col("s.gt").alias("gt"), F.col("s.fields").alias("fields"))


def gt_text(gt: str) -> str:
    """SQL: GT text of a genotype struct."""
    return f"array_join(transform({gt}.alleles, a -> coalesce(cast(a as string), '.')), if({gt}.phased, '|', '/'))"


def lines(variants: DataFrame, *more: Column) -> DataFrame:
    """(..., value) VCF record lines after the columns ``more``; INFO in the order of its map."""
    dot = lambda c: F.coalesce(c, F.lit("."))
    joined = lambda c, by: F.when(F.size(c) > 0, F.array_join(c, by)).otherwise(".")
    info_text = F.expr("if(size(info) > 0, array_join(transform(map_entries(info), e -> if(e.value = '', e.key, concat(e.key, '=', e.value))), ';'), '.')")
    qual = F.expr("case when qual is null then '.' when qual = cast(qual as bigint) then cast(cast(qual as bigint) as string) else cast(qual as string) end")
    cell = f"array_join(transform(format, k -> if(k = 'GT' and s.gt is not null, {gt_text('s.gt')}, coalesce(try_element_at(s.fields, k), '.'))), ':')"
    fields = ["chrom", F.col("pos").cast("string"), dot(F.col("id")), "ref", joined("alts", ","), qual, joined("filters", ";"), info_text]
    sample = F.when(F.size("samples") > 0, F.concat(F.array_join("format", ":"), F.lit("\t"), F.expr(f"array_join(transform(samples, s -> {cell}), '\t')")))
    return variants.select(*more, F.concat_ws("\t", *fields, sample).alias("value"))


def validation(lines_: DataFrame) -> DataFrame:
    """Lines (value, rec_no) with the problems each has, by the rules of the format: (rec_no, errors array<string>)."""
    f = lambda i: F.get("f", F.lit(i))
    rows = lines_.where((F.col("value") != "") & ~F.col("value").startswith("#")).select("rec_no", F.split("value", "\t").alias("f"))
    tests = {
        "BADLY_FORMATTED_COLUMNS": F.size("f") < 8,
        "POS_NOT_NUMERICAL": f(1).try_cast("bigint").isNull(),
        "UNKNOWN_CHAR_IN_REF": ~f(3).rlike("^[ACGTNacgtn]+$"),
        "V40_BAD_ALLELE": ~f(4).rlike(r"^(\.|\*|<[^<>]+>|[ACGTNacgtn]+|[^,]*[\[\]][^,]*)(,(\*|<[^<>]+>|[ACGTNacgtn]+|[^,]*[\[\]][^,]*))*$"),
        "QUAL_NOT_NUMERICAL": (f(5) != ".") & f(5).try_cast("double").isNull(),
        "FORMAT_WITHOUT_SAMPLES": F.size("f") == 9,
        "BAD_NUMBER_OF_COLUMNS_IN_SAMPLE": F.expr("exists(slice(f, 10, greatest(size(f) - 9, 0)), s -> size(split(s, ':')) > size(split(get(f, 8), ':')))"),
    }
    return rows.select("rec_no", F.filter(F.array(*(F.when(F.coalesce(t, F.lit(False)), n) for n, t in tests.items())), lambda e: e.isNotNull()).alias("errors"))
