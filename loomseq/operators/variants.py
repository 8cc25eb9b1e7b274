"""Operators on variants: selection, set operations, normal forms, statistics, comparison."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import regions
from ..headers import VariantHeader
from ..plans.variant_expr import TYPES, compile_expression
from ..sources.vcf import genotype

ALLELES = "filter(flatten(transform(samples, s -> coalesce(s.gt.alleles, array()))), a -> a is not null)"


def variant_types() -> Column:
    """The type of each alternate allele; ``ref`` alone where there is none."""
    return F.expr(TYPES)


def allele_counts(df: DataFrame) -> DataFrame:
    """Adds ac (array, one per alternate allele), an and af, counted from the genotypes."""
    an = F.expr(f"cast(size({ALLELES}) as bigint)")
    ac = F.expr(f"transform(if(size(alts) = 0, array(), sequence(1, size(alts))), k -> cast(size(filter({ALLELES}, a -> a = k)) as bigint))")
    return df.withColumns({"an": an, "ac": ac}).withColumn("af", F.transform("ac", lambda c: F.try_divide(c.cast("double"), F.col("an"))))


def genotype_class(gt: Column) -> Column:
    """HOM_RR, HET_RA, HOM_AA, HET_AA, HAPL_R, HAPL_A or UNKN."""
    a = gt["alleles"]
    missing = gt.isNull() | F.exists(a, lambda x: x.isNull())
    ref = F.exists(a, lambda x: x == 0)
    one = F.size(F.array_distinct(a)) == 1
    return F.when(missing, "UNKN").when(F.size(a) == 1, F.when(ref, "HAPL_R").otherwise("HAPL_A")).when(one, F.when(ref, "HOM_RR").otherwise("HOM_AA")).when(ref, "HET_RA").otherwise("HET_AA")


def subset_samples(df: DataFrame, names: list[str], exclude: bool = False) -> DataFrame:
    """Only these samples, in this order (or all but these)."""
    if exclude:
        return df.withColumn("samples", F.filter("samples", lambda s: ~s["name"].isin(names)))
    wanted = F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")
    return df.withColumn("samples", F.filter(F.transform(wanted, lambda n: F.get(F.filter(F.col("samples"), lambda s: s["name"] == n), F.lit(0))), lambda s: s.isNotNull()))


def in_regions(df: DataFrame, targets: DataFrame, mode: int = 1, negate: bool = False) -> DataFrame:
    """Variants of regions (contig, start, stop), each once. Mode 0: POS inside; 1: the record overlaps; 2: the variant proper does."""
    start, stop = {0: ("start", "start + 1"), 1: ("start", "stop"), 2: ("start + trimmed", "greatest(stop, start + trimmed + 1)")}[mode]
    shared = "coalesce(array_max(filter(sequence(0, length(ref) - 1), i -> forall(alts, a -> left(a, i) = left(ref, i) and length(a) > i))), 0)" if mode == 2 else "0"
    rows = df.withColumn("trimmed", F.expr(shared)).withColumns({"_s": F.expr(start), "_e": F.expr(stop)})
    merged = regions.merge_intervals(targets).select(F.col("contig").alias("_c"), F.col("start").alias("_rs"), F.col("stop").alias("_re"))
    return regions.interval_join(rows, merged, ("chrom", "_s", "_e"), ("_c", "_rs", "_re"), "left_anti" if negate else "left_semi").select(*df.columns)


def fetch(df: DataFrame, region: str | None = None, contig: str | None = None, start: int | None = None, stop: int | None = None) -> DataFrame:
    return df.where(regions.overlaps(regions.parse_region(region, contig, start, stop), "chrom", "start", "stop"))


def select(
    df: DataFrame,
    header: VariantHeader,
    include: str | None = None,
    exclude: str | None = None,
    min_alleles: int | None = None,
    max_alleles: int | None = None,
    known: bool | None = None,
    types: list[str] | None = None,
    exclude_types: list[str] | None = None,
    min_ac: int | None = None,
    max_ac: int | None = None,
    min_af: float | None = None,
    max_af: float | None = None,
    allele: str = "nref",
    genotype_is: str | None = None,
    phased: bool | None = None,
    private: list[str] | None = None,
    uncalled: bool | None = None,
    filters: list[str] | None = None,
    sets: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Selectors of sites. ``allele``: nref, alt1, minor, major or nonmajor, for counts and frequencies (none where no allele is called: dropped)."""
    test = F.lit(True)
    if include:
        test &= compile_expression(include, header, sets)[0]
    if exclude:
        test &= ~compile_expression(exclude, header, sets)[0]
    n = F.size("alts") + 1
    test &= (n >= min_alleles) if min_alleles is not None else F.lit(True)
    test &= (n <= max_alleles) if max_alleles is not None else F.lit(True)
    if known is not None:
        test &= F.col("id").isNotNull() if known else F.col("id").isNull()
    if types:
        test &= F.arrays_overlap(variant_types(), F.array(*map(F.lit, types)))
    if exclude_types:
        test &= ~F.arrays_overlap(variant_types(), F.array(*map(F.lit, exclude_types)))
    if any(v is not None for v in (min_ac, max_ac, min_af, max_af)):
        counts = F.expr(f"transform(sequence(0, size(alts)), k -> size(filter({ALLELES}, a -> a = k)))")
        total = F.expr(f"size({ALLELES})")
        alt = total - F.get(counts, F.lit(0))
        ranked = F.reverse(F.array_sort(counts))
        count = {"nref": alt, "alt1": F.coalesce(F.get(counts, F.lit(1)), F.lit(0)), "major": F.get(ranked, F.lit(0)), "minor": F.coalesce(F.get(ranked, F.lit(1)), F.lit(0)), "nonmajor": total - F.get(ranked, F.lit(0))}[allele]
        share = F.try_divide(count.cast("double"), total)
        for bound, value, low in ((min_ac, count, True), (max_ac, count, False), (min_af, share, True), (max_af, share, False)):
            if bound is not None:
                test &= F.coalesce(value >= bound if low else value <= bound, F.lit(False))
    if genotype_is:
        negate, kind = genotype_is.startswith("^"), genotype_is.lstrip("^")
        classes = {"hom": ["HOM_RR", "HOM_AA"], "het": ["HET_RA", "HET_AA"], "miss": ["UNKN"]}[kind]
        has = F.exists("samples", lambda s: genotype_class(s["gt"]).isin(classes))
        test &= ~has if negate else has
    if phased is not None:
        all_phased = F.forall("samples", lambda s: F.coalesce(s["gt"]["phased"], F.lit(False)))
        test &= all_phased if phased else ~all_phased
    if private is not None:
        carries = lambda s: F.exists(F.coalesce(s["gt"]["alleles"], F.array().cast("array<int>")), lambda a: a > 0)
        test &= F.exists("samples", lambda s: s["name"].isin(private) & carries(s)) & ~F.exists("samples", lambda s: ~s["name"].isin(private) & carries(s))
    if uncalled is not None:
        none = F.expr(f"size({ALLELES}) = 0")
        test &= none if uncalled else ~none
    if filters is not None:
        wanted = F.array(*map(F.lit, [f for f in filters if f != "."])).cast("array<string>")
        test &= F.arrays_overlap("filters", wanted) | (F.lit("." in filters) & (F.size("filters") == 0))
    return df.where(F.coalesce(test, F.lit(False)))


def soft_filter(df: DataFrame, header: VariantHeader, name: str, include: str | None = None, exclude: str | None = None, add: bool = False, reset: bool = False) -> DataFrame:
    """Failing sites get the filter (added to theirs with ``add``), passing ones PASS where they have none (or anyway, with ``reset``)."""
    site = compile_expression(include or exclude, header)[0]
    good = site if include else ~site
    failed = F.array_union(F.array_remove("filters", "PASS"), F.array(F.lit(name))) if add else F.array(F.lit(name))
    passed = F.array(F.lit("PASS"))
    return df.withColumn("filters", F.when(~good, failed).when((F.size("filters") == 0) | F.lit(reset), passed).otherwise(F.col("filters")))


def set_genotypes(df: DataFrame, header: VariantHeader, include: str | None = None, exclude: str | None = None, to: str = ".") -> DataFrame:
    """Genotypes of samples that fail become missing (``.``) or reference (``0``)."""
    site, samples = compile_expression(include or exclude, header)
    truth = samples if samples is not None else F.transform("samples", lambda s: site)
    value = F.lit(None).cast("int") if to == "." else F.lit(0)
    reset = lambda s: s.withField("gt", F.when(s["gt"].isNotNull(), F.struct(F.transform(s["gt"]["alleles"], lambda a: value).alias("alleles"), s["gt"]["phased"].alias("phased"))))
    return df.withColumn("samples", F.zip_with("samples", truth, lambda s, t: F.when(t if include else ~t, s).otherwise(reset(s))))


def snp_gap(df: DataFrame, gap: int, name: str = "SnpGap") -> DataFrame:
    """SNPs within ``gap`` bases of an indel get the filter."""
    indel, snp = F.array_contains(variant_types(), "indel"), F.array_contains(variant_types(), "snp")
    rows = df.withColumns({"_snp": snp, "_indel": indel, "_end": F.col("start") + F.length("ref")})
    near = rows.where("_indel").select(F.col("chrom").alias("_c"), (F.col("start") - gap + 1).alias("_rs"), (F.col("_end") + gap).alias("_re"))
    spans = regions.merge_intervals(near, "_c", "_rs", "_re").select(F.col("contig").alias("_c"), F.col("start").alias("_rs"), F.col("stop").alias("_re"))
    close = regions.interval_join(rows.where("_snp and not _indel"), spans, ("chrom", "start", "_end"), ("_c", "_rs", "_re"), "left_semi").select(F.col("file_id").alias("_f"), F.col("rec_no").alias("_n")).withColumn("_hit", F.lit(True))
    out = df.join(close, (F.col("file_id") == F.col("_f")) & (F.col("rec_no") == F.col("_n")), "left")
    return out.withColumn("filters", F.when(F.col("_hit"), F.array_union(F.array_remove("filters", "PASS"), F.array(F.lit(name)))).otherwise(F.col("filters"))).select(*df.columns)


def indel_gap(df: DataFrame, gap: int, name: str = "IndelGap") -> DataFrame:
    """Of indels in a cluster (each within ``gap`` of the next) all but the best, by quality, then alternate count, then order, get the filter."""
    rows = df.where(F.array_contains(variant_types(), "indel"))
    w = Window.partitionBy("chrom").orderBy("start", "file_id", "rec_no")
    reach = F.max(F.col("start") + F.length("ref")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    cluster = rows.withColumn("_new", F.when(reach.isNull() | (F.col("start") >= reach + gap), 1).otherwise(0)).withColumn("_cluster", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    carried = F.expr(f"size(filter({ALLELES}, a -> a > 0))")
    best = Window.partitionBy("chrom", "_cluster").orderBy(F.col("qual").desc_nulls_last(), carried.desc(), "start", "rec_no")
    lost = cluster.withColumn("_rank", F.row_number().over(best)).where("_rank > 1").select(F.col("file_id").alias("_f"), F.col("rec_no").alias("_n")).withColumn("_hit", F.lit(True))
    out = df.join(lost, (F.col("file_id") == F.col("_f")) & (F.col("rec_no") == F.col("_n")), "left")
    return out.withColumn("filters", F.when(F.col("_hit"), F.array_union(F.array_remove("filters", "PASS"), F.array(F.lit(name)))).otherwise(F.col("filters"))).select(*df.columns)


def sort_variants(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("rid").asc_nulls_last(), "chrom", "pos", "ref", F.array_join("alts", ","), "file_id", "rec_no")


def site_key(collapse: str = "none") -> list[Column]:
    """What makes two records the same: ``none`` position and alleles, ``some``/``all`` position, ``both`` position and kind, ``id`` the identifier, ``snps``/``indels`` position for these, alleles for others."""
    at = [F.col("chrom"), F.col("pos")]
    exact = F.concat_ws("|", F.upper("ref"), F.array_join(F.array_sort(F.transform("alts", lambda a: F.upper(a))), ","))
    kind = F.element_at(variant_types(), 1)
    if collapse == "none":
        return [*at, exact]
    if collapse in ("some", "all", "any"):
        return at
    if collapse == "both":
        return [*at, F.when(kind.isin("snp", "mnp"), "snp").otherwise(kind)]
    if collapse in ("snps", "indels"):
        wanted = kind == collapse[:-1]
        return [*at, F.when(wanted, kind).otherwise(exact)]
    if collapse == "id":
        return [F.coalesce("id", F.concat_ws(":", "chrom", F.col("pos").cast("string"), exact))]
    raise ValueError(f"no collapse mode {collapse!r}")


def intersect(tables: list[DataFrame], collapse: str = "none") -> DataFrame:
    """(key columns k0.., mask, n): of every record key the files (a bit each) that have it."""
    out = None
    for i, t in enumerate(tables):
        keyed = t.select(*(c.alias(f"k{j}") for j, c in enumerate(site_key(collapse))), F.lit(1 << i).cast("bigint").alias("bit"))
        out = keyed if out is None else out.unionByName(keyed)
    keys = [c for c in out.columns if c != "bit"]
    return out.groupBy(*keys).agg(F.bit_or("bit").alias("mask")).withColumn("n", F.bit_count("mask"))


def isec(tables: list[DataFrame], n_files: str | None = None, complement: bool = False, write: int = 0, collapse: str = "none") -> DataFrame:
    """Records of table ``write`` whose key is in ``=n``, ``+n`` (at least), ``-n`` (at most) or exactly the ``~mask`` of files; with ``complement`` in none of the others."""
    found = intersect(tables, collapse)
    if complement:
        test = F.col("mask") == (1 << write)
    else:
        rule = n_files or f"+{len(tables)}"
        sign, value = rule[0], rule[1:]
        if sign == "~":
            test = F.col("mask") == sum(1 << i for i, bit in enumerate(value) if bit == "1")
        else:
            test = {"=": F.col("n") == int(value), "+": F.col("n") >= int(value), "-": F.col("n") <= int(value)}[sign]
    keyed = tables[write].withColumns({f"k{j}": c for j, c in enumerate(site_key(collapse))})
    return keyed.join(found.where(test), [c for c in found.columns if c.startswith("k")], "left_semi").select(*tables[write].columns)


def concat(tables: list[DataFrame], remove_duplicates: str | None = None, overlaps: bool = False) -> DataFrame:
    """Tables one after the other; ``overlaps`` sorts them into one order; ``remove_duplicates`` (a collapse mode) keeps the first record of each key."""
    out = None
    for i, t in enumerate(tables):
        t = t.withColumn("file_id", F.lit(i))
        out = t if out is None else out.unionByName(t)
    if remove_duplicates:
        out = deduplicate(out, remove_duplicates)
    return sort_variants(out) if overlaps else out


def deduplicate(df: DataFrame, collapse: str = "none") -> DataFrame:
    """The first record of each key, in input order."""
    w = Window.partitionBy(*site_key(collapse)).orderBy("file_id", "rec_no")
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def _by_number(header: VariantHeader, kind: str) -> dict[str, str]:
    return {n: f.number for n, f in (header.info if kind == "info" else header.formats).items() if f.number in ("A", "R", "G")}


def _pick(numbers: dict[str, str], keys: str, old: str, chosen: str) -> str:
    """SQL over a map of texts: values of Number A, R and G fields reduced to alleles ``chosen`` (an array of old numbers, 0 first)."""
    listed = {n: ", ".join(f"'{k}'" for k, v in numbers.items() if v == n) or "''" for n in "ARG"}
    part = "get(split(v, ','), {i})"
    a = f"array_join(transform(slice({chosen}, 2, size({chosen}) - 1), k -> coalesce({part.format(i='k - 1')}, '.')), ',')"
    r = f"array_join(transform({chosen}, k -> coalesce({part.format(i='k')}, '.')), ',')"
    pairs = f"flatten(transform({chosen}, b -> transform(filter({chosen}, a -> array_position({chosen}, a) <= array_position({chosen}, b)), a -> cast(greatest(a, b) * (greatest(a, b) + 1) / 2 as int) + least(a, b))))"
    haploid = f"size(split(v, ',')) <= size({old}) + 1 and size({old}) > 1"
    g = f"if({haploid}, {r}, array_join(transform({pairs}, k -> coalesce({part.format(i='k')}, '.')), ','))"
    return f"transform_values({keys}, (k0, v) -> case when v = '.' then v when k0 in ({listed['A']}) then {a} when k0 in ({listed['R']}) then {r} when k0 in ({listed['G']}) then {g} else v end)"


def keep_alleles(df: DataFrame, header: VariantHeader, chosen: str) -> DataFrame:
    """Records with only the alleles that SQL ``chosen`` lists (old numbers, 0 first); others in genotypes become missing, and A, R and G fields follow."""
    rows = df.withColumn("_keep", F.expr(chosen)).withColumn("_old", F.col("alts"))
    gt = "if(s.gt is null, null, named_struct('alleles', transform(s.gt.alleles, a -> nullif(cast(array_position(_keep, a) as int) - 1, -1)), 'phased', s.gt.phased))"
    fields = _pick(_by_number(header, "formats"), "s.fields", "_old", "_keep")
    return rows.withColumns(
        {
            "alts": F.expr("transform(slice(_keep, 2, size(_keep) - 1), k -> alts[k - 1])"),
            "info": F.expr(_pick(_by_number(header, "info"), "info", "_old", "_keep")),
            "samples": F.expr(f"transform(samples, s -> named_struct('name', s.name, 'gt', {gt}, 'fields', {fields}))"),
        }
    ).drop("_keep", "_old")


def trim_alleles(df: DataFrame, header: VariantHeader) -> DataFrame:
    """Alternate alleles that no genotype has are removed."""
    return keep_alleles(df, header, f"concat(array(0), filter(if(size(alts) = 0, array(), sequence(1, size(alts))), k -> array_contains({ALLELES}, k)))")


def split_multiallelic(df: DataFrame, header: VariantHeader) -> DataFrame:
    """A record for each alternate allele; other alternates in genotypes become reference, and A, R and G fields follow."""
    many = df.where("size(alts) > 1").select("*", F.explode(F.sequence(F.lit(1), F.size("alts"))).alias("_k"))
    parts = keep_alleles(many, header, "array(0, _k)")
    old = "get(split(try_element_at(s.fields, 'GT'), '[/|]'), i)"
    gt = f"if(s.gt is null, null, named_struct('alleles', transform(s.gt.alleles, (a, i) -> if(a is null and try_cast({old} as int) is not null, 0, a)), 'phased', s.gt.phased))"
    parts = parts.withColumn("samples", F.expr(f"transform(samples, s -> named_struct('name', s.name, 'gt', {gt}, 'fields', s.fields))")).drop("_k")
    return df.where("size(alts) <= 1").unionByName(parts.select(*df.columns))


def _in_order(*names: str) -> Column:
    """The records of a place as an array of structs in input order; maps do not compare, so only the order does."""
    before = lambda a, b, c, then: F.when(a[c] < b[c], -1).when(a[c] > b[c], 1).otherwise(then)
    return F.array_sort(F.collect_list(F.struct("file_id", "rec_no", *names)), lambda a, b: before(a, b, "file_id", before(a, b, "rec_no", F.lit(0))))


def join_biallelic(df: DataFrame, collapse: str = "both") -> DataFrame:
    """Records of one place (and kind) as one: references extended to the longest, alternates joined, genotypes renumbered; INFO of the first."""
    rows = df.withColumn("_kind", site_key(collapse)[-1] if collapse == "both" else F.lit(""))
    sites = rows.groupBy("chrom", "pos", "_kind").agg(
        F.max_by("ref", F.length("ref")).alias("_ref"), _in_order("ref", "alts", "id", "qual", "filters", "info", "format", "samples", "rid").alias("_r")
    )
    longest = "transform(x.alts, a -> concat(a, substring(_ref, length(x.ref) + 1)))"
    alts = F.expr(f"array_distinct(flatten(transform(_r, x -> {longest})))")
    out = sites.withColumn("alts", alts)
    numbers = f"transform({longest}, a -> cast(array_position(alts, a) as int))"
    one = "get(filter(x.samples, t -> t.name = s.name), 0).gt"
    merged = (
        "transform(_r[0].samples, s -> named_struct('name', s.name, 'gt', if(s.gt is null, null, named_struct('alleles', transform(s.gt.alleles, (a0, i) ->"
        f" aggregate(transform(_r, x -> get({one}.alleles, i) ), named_struct('n', 0, 'v', cast(null as int)), (acc, a) -> named_struct('n', acc.n + 1, 'v', case when a is null then acc.v when a = 0 then coalesce(acc.v, 0) else get(transform(_r, x -> {numbers}), acc.n)[a - 1] end), acc -> acc.v)), 'phased', s.gt.phased)), 'fields', s.fields))"
    )
    return out.select(
        F.expr("_r[0].rid").alias("rid"), "chrom", "pos", (F.col("pos") - 1).alias("start"), (F.col("pos") - 1 + F.length("_ref")).alias("stop"), F.expr("nullif(array_join(array_distinct(filter(transform(_r, x -> x.id), i -> i is not null)), ';'), '')").alias("id"), F.col("_ref").alias("ref"), "alts",
        F.expr("array_max(transform(_r, x -> x.qual))").alias("qual"), F.expr("array_distinct(flatten(transform(_r, x -> x.filters)))").alias("filters"), F.expr("_r[0].info").alias("info"), F.expr("_r[0].format").alias("format"), F.expr(merged).alias("samples"),
        F.expr("_r[0].file_id").alias("file_id"), F.expr("_r[0].rec_no").alias("rec_no"),
    )


def atomize(df: DataFrame) -> DataFrame:
    """(chrom, pos, ref, alt, file_id, rec_no, allele): multi-base substitutions as one row per base that differs; other alleles as they are."""
    one = df.select("chrom", "pos", "ref", F.posexplode("alts").alias("i", "alt"), "file_id", "rec_no")
    mnp = (F.length("ref") == F.length("alt")) & (F.length("ref") > 1)
    parts = F.when(mnp, F.expr("transform(filter(sequence(1, length(ref)), k -> substring(ref, k, 1) <> substring(alt, k, 1)), k -> named_struct('pos', pos + k - 1, 'ref', substring(ref, k, 1), 'alt', substring(alt, k, 1)))")).otherwise(F.array(F.struct("pos", "ref", "alt")))
    return one.select("chrom", F.explode(parts).alias("p"), (F.col("i") + 1).alias("allele"), "file_id", "rec_no").select("chrom", "p.pos", "p.ref", "p.alt", "allele", "file_id", "rec_no")


def left_align(df: DataFrame, ref_chunks: DataFrame, window: int = 1000) -> DataFrame:
    """Adds norm_pos, norm_ref, norm_alts: indels trimmed and moved left as far as the reference lets them, and ``ref_ok``.

    ``window`` bases of the reference before each record are joined by chunk;
    the move itself is a loop over bases and runs in Arrow batches. Records that
    reach the window's edge go on from there with a window of four times that,
    until none does.
    """
    from ..llm.common import materialise

    keys = ["file_id", "rec_no"]
    now = df.select(*keys, "chrom", "pos", "ref", "alts")
    done = None
    while True:
        moved = materialise(_moved(now, ref_chunks, window), "left-aligned")
        ended = moved.where("not _m.edge")
        done = ended if done is None else done.unionByName(ended)
        now = moved.where("_m.edge").select(*keys, "chrom", "_m.pos", "_m.ref", "_m.alts")
        if now.isEmpty():
            break
        window *= 4
    out = df.join(done.select(*keys, "_m"), keys)
    return out.select(*df.columns, F.col("_m.pos").alias("norm_pos"), F.col("_m.ref").alias("norm_ref"), F.col("_m.alts").alias("norm_alts"), F.col("_m.ref_ok").alias("ref_ok"))


def _moved(df: DataFrame, ref_chunks: DataFrame, window: int) -> DataFrame:
    """(file_id, rec_no, chrom, _m): alleles moved left over up to ``window`` bases, and whether the window's edge stopped them."""
    from ..sources.fastx import CHUNK

    @F.pandas_udf("pos bigint, ref string, alts array<string>, ref_ok boolean, edge boolean")
    def moved(pos: pd.Series, ref: pd.Series, alts: pd.Series, before: pd.Series, at: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_shift_left(*v) for v in zip(pos, ref, alts, before, at)], columns=["pos", "ref", "alts", "ref_ok", "edge"])

    start = F.col("pos") - 1
    need = df.withColumn("_low", F.greatest(start - window, F.lit(0))).withColumn("_high", start + F.length("ref"))
    chunks = need.select("file_id", "rec_no", "chrom", "_low", "_high", F.explode(F.expr(f"sequence(cast(_low as bigint) div {CHUNK}, (_high - 1) div {CHUNK})")).alias("_chunk"))
    joined = chunks.join(ref_chunks.select(F.col("contig").alias("chrom"), F.col("chunk").alias("_chunk"), F.col("seq").alias("_seq")), ["chrom", "_chunk"], "left")
    part = F.expr(f"substring(coalesce(_seq, ''), cast(greatest(_low - _chunk * {CHUNK}, 0) + 1 as int), cast(least(_high - _chunk * {CHUNK}, {CHUNK}) - greatest(_low - _chunk * {CHUNK}, 0) as int))")
    keys = ["file_id", "rec_no"]
    around = joined.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_chunk", part.alias("s")))), lambda x: x["s"]), "").alias("_around"), F.first("_low").alias("_at"))
    return df.join(around, keys).select(*keys, "chrom", moved("pos", "ref", "alts", "_around", "_at").alias("_m"))


def shift_left(pos: int, ref: str, alts, around: str, at: int) -> tuple:
    """(pos, ref, alts, ref_ok): alleles trimmed on the right, extended on the left, then trimmed on the left."""
    return _shift_left(pos, ref, alts, around, at)[:4]


def _shift_left(pos: int, ref: str, alts, around: str, at: int) -> tuple:
    """As ``shift_left``, and whether alleles that could move on, or might, stand at ``at`` where the contig goes on."""
    start = pos - 1
    here = around[start - at : start - at + len(ref)].upper()
    ok = here == ref.upper()
    alleles = [ref, *(list(alts) if alts is not None else [])]
    if not ok or len(alleles) < 2 or any(not a or set(a.upper()) - set("ACGTN") for a in alleles):
        return pos, ref, alleles[1:], ok, False
    if any(a.upper() == ref.upper() for a in alleles[1:]):
        return pos, ref, alleles[1:], ok, False  # would move for ever
    while len({a[-1].upper() for a in alleles}) == 1:
        if min(map(len, alleles)) == 1:
            if start <= at:
                if at > 0:
                    return start + 1, alleles[0], alleles[1:], ok, True
                break
            start -= 1
            alleles = [around[start - at] + a for a in alleles]
        alleles = [a[:-1] for a in alleles]
    while min(map(len, alleles)) > 1 and len({a[0].upper() for a in alleles}) == 1:
        alleles = [a[1:] for a in alleles]
        start += 1
    return start + 1, alleles[0], alleles[1:], ok, False


def merge(tables: list[DataFrame], headers: list[VariantHeader], info_rules: dict[str, str] | None = None, missing_to_ref: bool = False) -> DataFrame:
    """One record per place and kind over all files: alleles united, genotypes renumbered, samples side by side (missing where a file lacks the place).

    QUAL is the largest, ID and FILTER the union; INFO follows ``info_rules``
    (sum, avg, min, max, join; else the first file's).
    """
    names = [s for h in headers for s in h.samples]
    if len(set(names)) < len(names):
        raise ValueError("sample names repeat between files")
    both = None
    for i, t in enumerate(tables):
        t = t.withColumn("file_id", F.lit(i)).withColumn("rid", F.col("rid").cast("int"))
        both = t if both is None else both.unionByName(t)
    kind = F.element_at(variant_types(), 1)
    rows = both.withColumn("_kind", F.when(kind.isin("snp", "mnp", "ref"), "snp").otherwise(kind))
    sites = rows.groupBy("chrom", "pos", "_kind").agg(F.max_by("ref", F.length("ref")).alias("_ref"), _in_order("ref", "alts", "id", "qual", "filters", "info", "samples", "rid").alias("_r"))
    longest = "transform(x.alts, a -> concat(a, substring(_ref, length(x.ref) + 1)))"
    out = sites.withColumn("alts", F.expr(f"array_distinct(flatten(transform(_r, x -> {longest})))"))
    numbers = f"concat(array(0), transform({longest}, a -> cast(array_position(alts, a) as int)))"
    present = (
        f"flatten(transform(_r, x -> transform(x.samples, s -> named_struct('name', s.name, 'gt', if(s.gt is null, null, named_struct('alleles', transform(s.gt.alleles, a -> if(a is null, null, ({numbers})[a])), 'phased', s.gt.phased)), 'fields', s.fields))))"
    )
    fill = "0, 0" if missing_to_ref else "cast(null as int), cast(null as int)"
    listed = ", ".join(f"'{n}'" for n in names)
    samples = f"transform(array({listed}), n -> coalesce(get(filter(_p, s -> s.name = n), 0), named_struct('name', n, 'gt', named_struct('alleles', array({fill}), 'phased', false), 'fields', map('GT', '{'0/0' if missing_to_ref else './.'}'))))"
    rules = info_rules or {}
    value = lambda k: f"filter(transform(_r, x -> try_element_at(x.info, '{k}')), v -> v is not null and v <> '.')"
    as_number = lambda k: f"transform({value(k)}, v -> try_cast(v as double))"
    shown = lambda e: f"({e})"
    reduced = {"sum": lambda k: f"aggregate({as_number(k)}, 0.0D, (a, v) -> a + v)", "avg": lambda k: f"try_divide(aggregate({as_number(k)}, 0.0D, (a, v) -> a + v), size({value(k)}))", "min": lambda k: f"array_min({as_number(k)})", "max": lambda k: f"array_max({as_number(k)})"}
    text = lambda e: f"(case when {e} = cast({e} as bigint) then cast(cast({e} as bigint) as string) else cast({e} as string) end)"
    pairs = [f"if(size({value(k)}) = 0, map(), map('{k}', " + (f"array_join({value(k)}, ',')" if rule == "join" else text(shown(reduced[rule](k)))) + "))" for k, rule in rules.items()]
    ruled = ", ".join(f"'{k}'" for k in rules) or "''"
    info = F.expr("map_concat(" + ", ".join([f"map_filter(_r[0].info, (k, v) -> k not in ({ruled}))", *pairs]) + ")" if pairs else "_r[0].info")
    return out.withColumn("_p", F.expr(present)).select(
        F.expr("_r[0].rid").alias("rid"), "chrom", "pos", (F.col("pos") - 1).alias("start"), (F.col("pos") - 1 + F.length("_ref")).alias("stop"), F.expr("nullif(array_join(array_distinct(filter(transform(_r, x -> x.id), i -> i is not null)), ';'), '')").alias("id"), F.col("_ref").alias("ref"), "alts",
        F.expr("array_max(transform(_r, x -> x.qual))").alias("qual"), F.expr("array_distinct(flatten(transform(_r, x -> x.filters)))").alias("filters"), info.alias("info"), F.array(F.lit("GT")).alias("format"), F.expr(samples).alias("samples"),
        F.lit(0).alias("file_id"), F.monotonically_increasing_id().alias("rec_no"),
    )


def annotate_from_variants(df: DataFrame, source: DataFrame, info: list[str], copy_id: bool = False, match: str = "none", mark: str | None = None) -> DataFrame:
    """INFO (and ID) of records with the same key; ``mark`` flags matched ones (``-name``: those without a match)."""
    keys = site_key(match)
    right = source.select(*(c.alias(f"_k{j}") for j, c in enumerate(keys)), F.col("id").alias("_id"), F.map_filter("info", lambda k, v: k.isin(info)).alias("_info")).dropDuplicates([f"_k{j}" for j in range(len(keys))])
    left = df.withColumns({f"k{j}": c for j, c in enumerate(keys)})
    test = F.lit(True)
    for j in range(len(keys)):
        test &= F.col(f"k{j}") == F.col(f"_k{j}")
    out = left.join(right, test, "left")
    found = F.col("_k0").isNotNull()
    merged = F.when(found, F.map_concat(F.map_filter("info", lambda k, v: ~F.map_contains_key("_info", k)), F.col("_info"))).otherwise(F.col("info"))
    if mark:
        name = mark.lstrip("+-")
        merged = F.when(~found if mark[0] == "-" else found, F.map_concat(F.map_filter(merged, lambda k, v: k != name), F.create_map(F.lit(name), F.lit("")))).otherwise(merged)
    out = out.withColumn("info", merged)
    if copy_id:
        out = out.withColumn("id", F.coalesce("_id", "id"))
    return out.select(*df.columns)


def annotate_from_intervals(df: DataFrame, source: DataFrame, column: str, tag: str, rule: str = "first", min_overlap: float = 0.0) -> DataFrame:
    """``tag`` in INFO from a column of overlapping intervals (contig, start, stop): first, append, unique, sum, avg, min or max of theirs.

    ``min_overlap``: least share of the record that an interval has to cover.
    """
    side = source.select(F.col("contig").alias("_c"), F.col("start").alias("_s"), F.col("stop").alias("_e"), F.col(column).cast("string").alias("_v"))
    pairs = regions.interval_join(df.select("file_id", "rec_no", "chrom", "start", "stop"), side, ("chrom", "start", "stop"), ("_c", "_s", "_e"))
    if min_overlap:
        pairs = pairs.where((F.least("stop", "_e") - F.greatest("start", "_s")) >= min_overlap * (F.col("stop") - F.col("start")))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_s", "_e", "_v"))), lambda x: x["_v"])
    number = F.col("_v").try_cast("double")
    value = {"first": F.min_by("_v", F.struct("_s", "_e")), "append": F.array_join(listed, ","), "unique": F.array_join(F.array_distinct(listed), ","), "sum": F.sum(number), "avg": F.avg(number), "min": F.min(number), "max": F.max(number)}[rule].cast("string")
    notes = pairs.groupBy("file_id", "rec_no").agg(value.alias("_note"))
    out = df.join(notes, ["file_id", "rec_no"], "left")
    return out.withColumn("info", F.when(F.col("_note").isNotNull(), F.map_concat(F.map_filter("info", lambda k, v: k != tag), F.create_map(F.lit(tag), F.col("_note")))).otherwise(F.col("info"))).select(*df.columns)


def remove_annotations(df: DataFrame, info: list[str] | None = None, fmt: list[str] | None = None, ids: bool = False, qual: bool = False, filters: bool = False, keep: bool = False) -> DataFrame:
    """INFO and FORMAT fields taken out (or, with ``keep``, all others); ``info=['*']`` takes all."""
    out = df
    if info is not None:
        out = out.withColumn("info", F.map_filter("info", lambda k, v: k.isin(info) if keep else (F.lit("*" not in info) & ~k.isin(info))))
    if fmt is not None:
        kept = lambda k: (k == "GT") | (k.isin(fmt) if keep else ~k.isin(fmt))
        out = out.withColumns({"format": F.filter("format", kept), "samples": F.transform("samples", lambda s: s.withField("fields", F.map_filter(s["fields"], lambda k, v: kept(k))))})
    if ids:
        out = out.withColumn("id", F.lit(None).cast("string"))
    if qual:
        out = out.withColumn("qual", F.lit(None).cast("double"))
    return out.withColumn("filters", F.array().cast("array<string>")) if filters else out


def rename_chromosomes(df: DataFrame, names: dict[str, str]) -> DataFrame:
    if not names:
        return df
    return df.withColumn("chrom", F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), F.col("chrom")), F.col("chrom")))


def _summary(df: DataFrame) -> DataFrame:
    kinds = variant_types()
    has = lambda k: F.array_contains(kinds, k)
    pairs = F.expr("filter(transform(alts, a -> concat(upper(ref), upper(a))), p -> length(p) = 2)")
    ts = F.size(F.filter(pairs, lambda p: p.isin("AG", "GA", "CT", "TC")))
    numbers = {
        "number of records": F.count("*"),
        "number of no-ALTs": F.count_if(F.size("alts") == 0),
        "number of SNPs": F.count_if(has("snp")),
        "number of MNPs": F.count_if(has("mnp")),
        "number of indels": F.count_if(has("indel")),
        "number of others": F.count_if(has("other") | has("bnd") | has("overlap")),
        "number of multiallelic sites": F.count_if(F.size("alts") > 1),
        "number of multiallelic SNP sites": F.count_if((F.size("alts") > 1) & has("snp") & ~has("indel")),
        "transitions": F.sum(ts),
        "transversions": F.sum(F.size(pairs) - ts),
    }
    row = df.agg(*(F.coalesce(v, F.lit(0)).cast("bigint").alias(f"v{i}") for i, v in enumerate(numbers.values())))
    return row.select(F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(f"v{i}").alias("value")) for i, n in enumerate(numbers)))).alias("r")).select("r.*")


def statistics(df: DataFrame, section: str = "SN") -> DataFrame:
    """One section of variant statistics: SN (summary), ST (substitutions), IDD (indel lengths), AF (counts by frequency), QUAL, DP, PSC (per sample), HWE (genotypes by frequency)."""
    if section == "SN":
        return _summary(df)
    if section == "ST":
        pairs = df.select("ref", F.explode("alts").alias("a")).where((F.length("ref") == 1) & (F.length("a") == 1) & F.col("a").rlike("^[ACGTacgt]$"))
        return pairs.groupBy(F.concat_ws(">", F.upper("ref"), F.upper("a")).alias("substitution")).agg(F.count("*").alias("n"))
    if section == "IDD":
        rows = df.select(F.length("ref").alias("r"), F.explode("alts").alias("a")).where(F.col("a").rlike("^[ACGTNacgtn]+$"))
        return rows.where(F.length("a") != F.col("r")).groupBy((F.length("a") - F.col("r")).cast("bigint").alias("length")).agg(F.count("*").alias("n"))
    if section == "AF":
        rows = allele_counts(df).select(F.explode("af").alias("af")).where("af is not null")
        return rows.groupBy((F.floor(F.col("af") * 100) / 100).alias("af")).agg(F.count("*").alias("n"))
    if section == "QUAL":
        return df.groupBy(F.floor("qual").alias("qual")).agg(F.count_if(F.array_contains(variant_types(), "snp")).alias("snps"), F.count_if(F.array_contains(variant_types(), "indel")).alias("indels"))
    if section == "DP":
        return df.groupBy(F.expr("try_cast(try_element_at(info, 'DP') as bigint)").alias("dp")).agg(F.count("*").alias("n")).where("dp is not null")
    long = df.select(variant_types().alias("t"), F.explode("samples").alias("s")).select("t", F.col("s.name").alias("sample"), genotype_class(F.col("s.gt")).alias("g"), F.expr("try_cast(try_element_at(s.fields, 'DP') as double)").alias("dp"))
    if section == "PSC":
        n = lambda *k: F.count_if(F.col("g").isin(*k))
        return long.groupBy("sample").agg(n("HOM_RR").alias("ref_hom"), n("HOM_AA").alias("nonref_hom"), n("HET_RA", "HET_AA").alias("hets"), F.count_if(F.col("g").isin("HET_RA", "HET_AA", "HOM_AA") & F.array_contains("t", "indel")).alias("indels"), n("UNKN").alias("missing"), n("HAPL_R").alias("hap_ref"), n("HAPL_A").alias("hap_alt"), F.avg("dp").alias("mean_depth"))
    if section == "HWE":
        rows = allele_counts(df).where("size(alts) = 1 and an > 0").select((F.floor(F.get("af", F.lit(0)) * 20) / 20).alias("af"), F.expr("size(filter(samples, s -> size(array_distinct(s.gt.alleles)) = 2)) / size(samples)").alias("het"))
        return rows.groupBy("af").agg(F.count("*").alias("n"), F.avg("het").alias("het_rate"))
    raise ValueError(f"no section {section!r}")


def concordance(a: DataFrame, b: DataFrame) -> DataFrame:
    """(sample, match, mismatch, non_reference_discordance) of the samples that both tables have, at sites with the same key."""
    long = lambda d, x: d.select(*(c.alias(f"k{j}") for j, c in enumerate(site_key())), F.explode("samples").alias("s")).select("k0", "k1", "k2", F.col("s.name").alias("sample"), F.array_sort("s.gt.alleles").alias(x))
    both = long(a, "a").join(long(b, "b"), ["k0", "k1", "k2", "sample"]).where("not exists(a, x -> x is null) and not exists(b, x -> x is null)")
    same = F.col("a") == F.col("b")
    plain = F.forall("a", lambda x: x == 0) & same
    return both.groupBy("sample").agg(F.count_if(same).alias("match"), F.count_if(~same).alias("mismatch"), F.count_if(same & ~plain).alias("_nonref")).withColumn("non_reference_discordance", F.try_divide(100.0 * F.col("mismatch"), F.col("mismatch") + F.col("_nonref"))).drop("_nonref")


def compare_samples(df: DataFrame, other: DataFrame | None = None, error: float = 0.0, top: int | None = None) -> DataFrame:
    """(a, b, discordance, sites, matches, hwe): genotypes of every pair of samples compared at their common sites.

    Discordance is the number of sites that differ, or with an ``error`` rate the
    log-likelihood of the differences; ``hwe`` the mean of minus the log of the
    chance that both match. ``top``: only the best so many for each sample.
    """
    dosage = F.expr("aggregate(gt.alleles, 0, (a, x) -> a + if(x > 0, 1, 0))")
    from ..sources.vcf import genotypes

    def long(d: DataFrame, name: str) -> DataFrame:
        rows = genotypes(d.where("size(alts) = 1")).where("gt is not null and not exists(gt.alleles, x -> x is null) and size(gt.alleles) = 2")
        return rows.select("chrom", "pos", "ref", F.get("alts", F.lit(0)).alias("alt"), F.col("sample").alias(name), dosage.alias(f"d{name}"))

    a = long(df, "a")
    b = long(df if other is None else other, "b")
    site = ["chrom", "pos", "ref", "alt"]
    freq = a.groupBy(*site).agg((F.sum("da") / (2.0 * F.count("*"))).alias("p"))
    pairs = a.join(b, site).join(freq, site)
    if other is None:
        pairs = pairs.where("a < b")
    match = F.col("da") == F.col("db")
    p = F.least(F.greatest("p", F.lit(1e-6)), F.lit(1 - 1e-6))
    chance = F.when(F.col("da") == 0, F.pow(1 - p, 2)).when(F.col("da") == 1, 2 * p * (1 - p)).otherwise(F.pow(p, 2))
    cost = F.when(match, 0.0).otherwise(1.0 if error <= 0 else -F.log(F.lit(error)) * F.abs(F.col("da") - F.col("db")))
    out = pairs.groupBy("a", "b").agg(F.sum(cost).alias("discordance"), F.count("*").alias("sites"), F.count_if(match).alias("matches"), F.avg(F.when(match, -F.log(chance))).alias("hwe"))
    if top is None:
        return out
    w = Window.partitionBy("a").orderBy(F.try_divide("discordance", "sites"), "b")
    return out.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= top).drop("_n")


def gvcf_blocks(df: DataFrame, edges: list[int]) -> DataFrame:
    """(chrom, start, stop, min_dp, level): runs of adjacent reference sites of one depth level; ``edges`` are the levels' lower bounds."""
    dp = F.expr("try_cast(try_element_at(info, 'DP') as bigint)")
    level = F.lit(-1)
    for i, e in enumerate(edges):
        level = F.when(dp >= e, i).otherwise(level)
    rows = df.where("size(alts) = 0 or forall(alts, a -> a like '<%')").select("chrom", "start", F.greatest("stop", F.col("start") + 1).alias("stop"), dp.alias("dp"), level.alias("level")).where("level >= 0")
    w = Window.partitionBy("chrom").orderBy("start")
    new = F.when((F.lag("stop").over(w) == F.col("start")) & (F.lag("level").over(w) == F.col("level")), 0).otherwise(1)
    marked = rows.withColumn("_new", new).withColumn("_b", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("chrom", "_b", "level").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("dp").alias("min_dp")).drop("_b")


def expand_gvcf(df: DataFrame, ref_chunks: DataFrame) -> DataFrame:
    """(chrom, pos, ref, end): reference blocks as one row per position, with its base."""
    from ..sources.fastx import CHUNK

    rows = df.where("size(alts) = 0 or forall(alts, a -> a like '<%')").select("chrom", F.explode(F.sequence("start", F.greatest(F.col("stop") - 1, F.col("start")))).alias("p")).withColumn("chunk", (F.col("p") / CHUNK).cast("bigint"))
    joined = rows.join(ref_chunks.withColumnRenamed("contig", "chrom"), ["chrom", "chunk"], "left")
    return joined.select("chrom", (F.col("p") + 1).alias("pos"), F.coalesce(F.substring("seq", (F.col("p") % CHUNK + 1).cast("int"), F.lit(1)), F.lit("N")).alias("ref"))


def from_table(rows: DataFrame, sample: str = "SAMPLE") -> DataFrame:
    """Variants of a table (id, chrom, pos, ref, genotype letters such as ``AG``): alleles and genotype from the letters."""
    letters = F.filter(F.split(F.upper("genotype"), ""), lambda c: c.isin("A", "C", "G", "T"))
    out = rows.select("id", "chrom", F.col("pos").cast("bigint").alias("pos"), F.upper("ref").alias("ref"), letters.alias("l"))
    alts = F.array_distinct(F.filter("l", lambda c: c != F.col("ref")))
    out = out.withColumn("alts", alts)
    text = F.when(F.size("l") == 0, "./.").otherwise(F.array_join(F.transform("l", lambda c: F.coalesce(F.nullif(F.array_position("alts", c), F.lit(0)), F.lit(0)).cast("string")), "/"))
    out = out.withColumn("_gt", text)
    gt = F.expr(genotype("_gt"))
    return out.select(
        F.lit(None).cast("int").alias("rid"), "chrom", "pos", (F.col("pos") - 1).alias("start"), (F.col("pos") - 1 + F.length("ref")).alias("stop"), "id", "ref", "alts", F.lit(None).cast("double").alias("qual"), F.array().cast("array<string>").alias("filters"), F.create_map().cast("map<string,string>").alias("info"),
        F.array(F.lit("GT")).alias("format"), F.array(F.struct(F.lit(sample).alias("name"), gt.alias("gt"), F.create_map(F.lit("GT"), F.col("_gt")).alias("fields"))).alias("samples"), F.lit(0).alias("file_id"), F.monotonically_increasing_id().alias("rec_no"),
    )
