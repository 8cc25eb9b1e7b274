"""Filters, fetches and edits of reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import cigar, flags, regions
from ..plans.alignment_expr import compile_filter
from ..schemas import TAG


def tag(name: str) -> Column:
    """A tag's typed value: struct(type, i, d, s, a); null where the read has none."""
    return F.expr(f"try_element_at(tags, '{name}')")


def tag_text(name: str) -> Column:
    """A tag's value as text."""
    return F.expr(f"coalesce(try_element_at(tags, '{name}').s, cast(try_element_at(tags, '{name}').i as string), cast(try_element_at(tags, '{name}').d as string))")


def set_tag(reads: DataFrame, name: str, value: Column | None, kind: str = "Z") -> DataFrame:
    """Set a tag to a column's value, rows where it is null and ``None`` lose the tag. ``kind``: i, f, A or Z."""
    rest = F.map_filter("tags", lambda k, v: k != name)
    if value is None:
        return reads.withColumn("tags", rest)
    part = {"i": "i", "f": "d"}.get(kind, "s")
    fields = [F.lit(kind).alias("type")] + [(value if p == part else F.lit(None)).cast(t).alias(p) for p, t in (("i", "bigint"), ("d", "double"), ("s", "string"), ("a", "array<double>"))]
    return reads.withColumn("tags", F.when(value.isNull(), rest).otherwise(F.map_concat(rest, F.create_map(F.lit(name), F.struct(*fields)))))


def fetch(reads: DataFrame, region: str | None = None, contig: str | None = None, start: int | None = None, stop: int | None = None, until_eof: bool = False, max_span: int | None = None, lengths: dict[str, int] | None = None) -> DataFrame:
    """Reads that overlap a region; with none the placed reads, with ``until_eof`` all."""
    r = regions.parse_region(region, contig, start, stop, lengths=lengths)
    if r.contig is None:
        return reads if until_eof else reads.where("tid >= 0")
    if r.contig == "*":
        return reads.where("tid < 0")
    return reads.where(regions.overlaps(r, max_span=max_span))


def fetch_many(reads: DataFrame, targets: DataFrame) -> DataFrame:
    """Reads that overlap any of (contig, start, stop), each once."""
    merged = regions.merge_intervals(targets).select(F.col("contig").alias("_c"), F.col("start").alias("_s"), F.col("stop").alias("_e"))
    return regions.interval_join(reads, merged, ("rname", "pos", "end_pos"), ("_c", "_s", "_e"), "left_semi")


def fetch_pairs(reads: DataFrame, targets: DataFrame) -> DataFrame:
    """Reads that overlap a target or whose mate does, by name."""
    names = fetch_many(reads, targets).select("qname").distinct()
    return reads.join(names, "qname", "left_semi")


def head(reads: DataFrame, n: int) -> DataFrame:
    """The first n records in input order."""
    return reads.orderBy("file_id", "rec_no").limit(n)


def select_records(reads: DataFrame, which: DataFrame) -> DataFrame:
    """The records (file_id, rec_no) that ``which`` lists."""
    return reads.join(which.select("file_id", "rec_no").distinct(), ["file_id", "rec_no"], "left_semi")


# Two 32-bit hashes, in arithmetic on 64-bit columns: the name's polynomial hash by 31, and an integer mix of shifts.
_MASK = "4294967295L"


def name_hash(name: str = "qname") -> Column:
    return F.expr(f"aggregate(filter(split({name}, ''), c -> c <> ''), 0L, (h, c) -> (h * 31 + ascii(c)) & {_MASK})")


def mixed(value: Column) -> Column:
    step = lambda x: x.bitwiseAND(F.expr(_MASK))
    left = lambda x, n: step(F.shiftleft(x, n))
    inverse = lambda x: step(F.bitwise_not(x))
    x = step(value)
    x = step(x + inverse(left(x, 15)))
    x = x.bitwiseXOR(F.shiftright(x, 10))
    x = step(x + left(x, 3))
    x = x.bitwiseXOR(F.shiftright(x, 6))
    x = step(x + inverse(left(x, 11)))
    return x.bitwiseXOR(F.shiftright(x, 16))


def subsample(reads: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """A share of templates, chosen by name: mates stay together, and the same call chooses the same."""
    seeded = mixed(F.lit(seed).cast("bigint")) if seed else F.lit(0).cast("bigint")
    return reads.where(mixed(name_hash().bitwiseXOR(seeded)).bitwiseAND(F.lit(0xFFFFFF)) / float(1 << 24) < fraction)


def view(
    reads: DataFrame,
    expr: str | None = None,
    min_mapq: int = 0,
    min_qlen: int = 0,
    require: int | str = 0,
    exclude: int | str = 0,
    exclude_all: int | str = 0,
    require_any: int | str = 0,
    targets: DataFrame | None = None,
    fraction: float | None = None,
    seed: int = 0,
    read_groups: list[str] | None = None,
    without_group: bool = True,
    tag_filter: tuple[str, list[str] | None] | None = None,
    names: list[str] | DataFrame | None = None,
    library: str | None = None,
    header_groups: DataFrame | None = None,
    where: Column | None = None,
    invert: bool = False,
) -> DataFrame:
    """The record filter chain; ``invert`` gives the complement.

    ``require``: all of the bits; ``exclude``: none; ``exclude_all``: not all;
    ``require_any``: one at least. Reads without a read group pass a group filter
    unless ``without_group`` is False. ``tag_filter`` is a tag and, maybe, its
    values. ``library`` needs ``header_groups`` (id, library).
    """
    test = F.lit(True)
    if expr:
        test &= compile_filter(expr)
    if min_mapq:
        test &= F.col("mapq") >= min_mapq
    if min_qlen:
        test &= F.coalesce(cigar.read_length(), F.lit(0)) >= min_qlen
    for value, f in ((require, lambda m: flags.has(m)), (exclude, lambda m: flags.lacks(m)), (exclude_all, lambda m: ~flags.has(m)), (require_any, lambda m: ~flags.lacks(m))):
        if value:
            test &= f(flags.parse(value))
    if read_groups is not None:
        known = F.col("rg").isin(read_groups)
        test &= F.coalesce(known, F.lit(without_group))
    if tag_filter:
        name, values = tag_filter
        test &= tag(name).isNotNull() if values is None else F.coalesce(tag_text(name).isin(values), F.lit(False))
    if isinstance(names, list):
        test &= F.col("qname").isin(names)
    if where is not None:
        test &= where
    row = reads.withColumn("_pass", F.coalesce(test, F.lit(False)))
    if library is not None:
        groups = header_groups.where(F.col("library") == library).select(F.col("id").alias("_rg"), F.lit(True).alias("_in"))
        row = row.join(groups, F.col("rg") == F.col("_rg"), "left").withColumn("_pass", F.col("_pass") & F.coalesce("_in", F.lit(False))).drop("_rg", "_in")
    if fraction is not None:
        chosen = subsample(row.withColumn("_k", F.lit(1)), fraction, seed) if not invert else None
        if chosen is not None:
            row = chosen.drop("_k")
        else:
            seeded = mixed(F.lit(seed).cast("bigint")) if seed else F.lit(0).cast("bigint")
            row = row.withColumn("_pass", F.col("_pass") & (mixed(name_hash().bitwiseXOR(seeded)).bitwiseAND(F.lit(0xFFFFFF)) / float(1 << 24) < fraction))
    if isinstance(names, DataFrame):
        marked = names.select(F.col(names.columns[0]).alias("_n")).distinct().withColumn("_in", F.lit(True))
        row = row.join(marked, F.col("qname") == F.col("_n"), "left").withColumn("_pass", F.col("_pass") & F.coalesce("_in", F.lit(False))).drop("_n", "_in")
    if targets is not None and not invert:
        return fetch_many(row.where("_pass").drop("_pass"), targets)
    if targets is not None:
        inside = fetch_many(row.where("_pass"), targets).select("file_id", "rec_no")
        return row.join(inside, ["file_id", "rec_no"], "left_anti").drop("_pass").select(*reads.columns)
    return row.where(~F.col("_pass") if invert else F.col("_pass")).select(*reads.columns)


def edit_flags(reads: DataFrame, add: int | str = 0, remove: int | str = 0) -> DataFrame:
    return reads.withColumn("flag", F.col("flag").bitwiseOR(F.lit(flags.parse(add))).bitwiseAND(F.lit(~flags.parse(remove))))


def edit_tags(reads: DataFrame, drop: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    if keep is not None:
        return reads.withColumn("tags", F.map_filter("tags", lambda k, v: k.isin(keep)))
    return reads.withColumn("tags", F.map_filter("tags", lambda k, v: ~k.isin(drop or [])))


def unmap(reads: DataFrame, test: Column) -> DataFrame:
    """Reads that fail a test written as unmapped ones, the rest as they are."""
    off = ~test
    return reads.withColumns(
        {
            "flag": F.when(off, F.col("flag").bitwiseOR(F.lit(4)).bitwiseAND(F.lit(~2))).otherwise(F.col("flag")),
            "mapq": F.when(off, 0).otherwise(F.col("mapq")),
            "cigar": F.when(off, "*").otherwise(F.col("cigar")),
            "cigar_ops": F.when(~off, F.col("cigar_ops")),
        }
    )


def sanitize(reads: DataFrame) -> DataFrame:
    """Flags and fields that contradict one another put right: unmapped reads lose mapping, unpaired ones pairing."""
    f = F.col("flag")
    unmapped = flags.has(4) | F.col("rname").isNull()
    flag = F.when(unmapped, f.bitwiseOR(F.lit(4)).bitwiseAND(F.lit(~(2 | 0x100 | 0x800)))).otherwise(f)
    flag = F.when(flags.lacks(1), flag.bitwiseAND(F.lit(~(2 | 8 | 0x20 | 0x40 | 0x80)))).otherwise(flag)
    return reads.withColumns({"flag": flag, "mapq": F.when(unmapped, 0).otherwise(F.col("mapq")), "cigar": F.when(unmapped, "*").otherwise(F.col("cigar")), "cigar_ops": F.when(~unmapped, F.col("cigar_ops"))})


def add_read_group(reads: DataFrame, group: str, only_missing: bool = False) -> DataFrame:
    """Every read in the group; with ``only_missing`` those without one."""
    value = F.coalesce("rg", F.lit(group)) if only_missing else F.lit(group)
    return set_tag(reads, "RG", value).withColumn("rg", value)


def with_library(reads: DataFrame, header_groups: DataFrame) -> DataFrame:
    """Adds library and sample by read group; header tables are small and their size is that of the header."""
    groups = header_groups.select(F.col("id").alias("_rg"), "library", "sample")
    return reads.join(groups, F.col("rg") == F.col("_rg"), "left").drop("_rg")


def complement(seq: str | Column = "seq") -> Column:
    """Reverse complement, ambiguity letters included, case kept."""
    return F.reverse(F.translate(seq, "ACGTUMRWSYKVHDBNacgtumrwsykvhdbn", "TGCAAKYWSRMBDHVNtgcaakywsrmbdhvn"))


def forward_sequence() -> Column:
    """The sequence as it came off the machine."""
    return F.when(flags.has(0x10), complement("seq")).otherwise(F.col("seq"))


def forward_qualities() -> Column:
    return F.when(flags.has(0x10), F.reverse("qual")).otherwise(F.col("qual"))


def reset(reads: DataFrame, keep_tags: list[str] | None = None, keep_groups: bool = True) -> DataFrame:
    """Unaligned primary reads, as they came off the machine."""
    keep = [*(keep_tags or []), *(["RG"] if keep_groups else [])]
    primary = reads.where(flags.lacks(0x900))
    f = F.col("flag").bitwiseAND(F.lit(1 | 0x40 | 0x80 | 0x200)).bitwiseOR(F.lit(4)).bitwiseOR(F.when(flags.has(1), 8).otherwise(0))
    null = lambda t: F.lit(None).cast(t)
    return primary.withColumns(
        {
            "seq": forward_sequence(), "qual": forward_qualities(), "flag": f, "tid": F.lit(-1), "rname": null("string"), "pos": F.lit(-1).cast("bigint"), "end_pos": F.lit(0).cast("bigint"), "mapq": F.lit(0), "cigar": F.lit("*"),
            "cigar_ops": null("array<struct<op:int,len:int>>"), "mate_tid": F.lit(-1), "mate_rname": null("string"), "mate_pos": F.lit(-1).cast("bigint"), "tlen": F.lit(0).cast("bigint"), "tags": F.map_filter("tags", lambda k, v: k.isin(keep)),
        }
    )


def fastq(reads: DataFrame, exclude: int = 0x900, suffix: bool = True, tags: list[str] | None = None) -> DataFrame:
    """(name, comment, seq, qual, part): part is 1, 2 or 0 by the read's place in its pair, ``s`` for those alone in theirs."""
    kept = reads.where(flags.lacks(exclude))
    part = F.when(flags.has(0x40) & flags.lacks(0x80), "1").when(flags.has(0x80) & flags.lacks(0x40), "2").otherwise("0")
    comment = F.nullif(F.concat_ws("\t", *(F.when(tag(t).isNotNull(), F.concat(F.lit(f"{t}:"), tag(t)["type"], F.lit(":"), tag_text(t))) for t in tags or [])), F.lit(""))
    rows = kept.select("qname", part.alias("p"), comment.alias("comment"), forward_sequence().alias("seq"), F.coalesce(forward_qualities(), F.rpad(F.lit(""), 0, "B")).alias("qual"))
    from pyspark.sql import Window

    pairs = F.count_if(F.col("p") != "0").over(Window.partitionBy("qname"))
    out = rows.withColumn("part", F.when((F.col("p") != "0") & (pairs == 1), "s").otherwise(F.col("p")))
    name = F.when(F.col("p") != "0", F.concat("qname", F.lit("/"), "p")).otherwise(F.col("qname")) if suffix else F.col("qname")
    return out.select(name.alias("name"), "comment", "seq", "qual", "part")


def from_fastq(*files: DataFrame, group: str | None = None) -> DataFrame:
    """Unaligned reads of one file, or of two whose records pair by name (a ``/1`` or ``/2`` at the end left out)."""
    out = None
    for i, df in enumerate(files):
        flag = 4 if len(files) == 1 else 4 | 1 | 8 | (0x40 if i == 0 else 0x80)
        rows = df.select(
            F.regexp_replace("name", "/[12]$", "").alias("qname"), F.lit(flag).alias("flag"), F.lit(-1).alias("tid"), F.lit(None).cast("string").alias("rname"), F.lit(-1).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("end_pos"),
            F.lit(0).alias("mapq"), F.lit("*").alias("cigar"), F.lit(None).cast("array<struct<op:int,len:int>>").alias("cigar_ops"), F.lit(-1).alias("mate_tid"), F.lit(None).cast("string").alias("mate_rname"), F.lit(-1).cast("bigint").alias("mate_pos"),
            F.lit(0).cast("bigint").alias("tlen"), "seq", "qual", F.create_map().cast(f"map<string,{TAG}>").alias("tags"), F.lit(None).cast("string").alias("rg"), F.lit(i).alias("file_id"), F.monotonically_increasing_id().alias("rec_no"),
        )
        out = rows if out is None else out.unionByName(rows)
    return add_read_group(out, group) if group else out


def split(reads: DataFrame, path: str, by: str = "RG") -> None:
    """SAM lines in one folder per value of a tag; reads without it under ``none``."""
    from ..sources import sam

    key = F.coalesce(F.col("rg") if by == "RG" else tag_text(by), F.lit("none"))
    sam.lines(reads, key.alias(by)).write.partitionBy(by).text(path)


def with_long_names(reads: DataFrame) -> DataFrame:
    """Adds the fields under their long names, and the derived lengths and ends under their old short ones."""
    long = {"query_name": "qname", "reference_id": "tid", "reference_name": "rname", "reference_start": "pos", "mapping_quality": "mapq", "cigarstring": "cigar", "next_reference_id": "mate_tid", "next_reference_start": "mate_pos", "template_length": "tlen", "query_sequence": "seq", "query_qualities_str": "qual"}
    short = {"mrnm": F.col("mate_tid"), "mpos": F.col("mate_pos"), "isize": F.col("tlen"), "aend": cigar.reference_end(), "alen": cigar.reference_length(), "rlen": F.length("seq").cast("bigint"), "qstart": cigar.query_alignment_start(), "qend": cigar.query_alignment_end()}
    return reads.withColumns({n: F.col(c) for n, c in long.items()} | short | {"qlen": short["qend"] - short["qstart"]})


def mates(reads: DataFrame) -> DataFrame:
    """Each paired primary read with its mate: the read's columns and ``mate_*`` of the other of the pair (file_id, rec_no, pos, ...)."""
    primary = reads.where(flags.lacks(0x900) & flags.has(1))
    side = primary.select(F.col("qname").alias("_q"), (F.col("flag").bitwiseAND(F.lit(0xC0))).alias("_p"), F.struct("file_id", "rec_no", "flag", "rname", "pos", "end_pos", "mapq", "cigar", "seq", "qual").alias("mate"))
    return primary.join(side, (F.col("qname") == F.col("_q")) & (F.col("flag").bitwiseAND(F.lit(0xC0)) + F.col("_p") == 0xC0) & (F.col("flag").bitwiseAND(F.lit(0xC0)) != F.col("_p"))).drop("_q", "_p")


def apply(reads: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Hook for steps of one's own."""
    return reads.transform(fn)
