"""Depth and coverage by difference arrays, and aggregates of reads."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import cigar, flags, regions

#: Width of the pieces in which running depths are summed, as a power of two.
TILE_SHIFT = 20


def covered_blocks(reads: DataFrame, deletions: bool = False, skips: bool = False) -> DataFrame:
    """(rname, start, stop) of each aligned block, and of deletions and skips where asked for."""
    keep = ",".join(map(str, [0, 7, 8, *([2] if deletions else []), *([3] if skips else [])]))
    blocks = F.expr(f"transform(filter({cigar.placed()}, o -> o.op in ({keep}) and o.len > 0), o -> named_struct('start', o.ref, 'stop', o.ref + o.len))")
    return reads.where("cigar_ops is not null and tid >= 0").select("rname", "file_id", F.explode(blocks).alias("b")).select("rname", "file_id", "b.start", "b.stop")


def runs(intervals: DataFrame, by: tuple[str, ...] = ("rname",)) -> DataFrame:
    """(by..., start, stop, depth): runs of equal positive depth over intervals (by..., start, stop).

    Each interval is two steps, +1 at its start and -1 at its stop; steps at one
    place are combined before the shuffle. Running sums are taken within tiles,
    to which the sum of all steps before is carried: so no task holds a contig.
    """
    keys = list(by)
    steps = intervals.select(*keys, F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("step")), F.struct(F.col("stop").alias("at"), F.lit(-1).alias("step")))).alias("s"))
    steps = steps.groupBy(*keys, F.col("s.at").alias("at")).agg(F.sum("s.step").alias("step")).where("step <> 0").withColumn("tile", F.shiftright("at", TILE_SHIFT))
    over = Window.partitionBy(*keys).orderBy("tile")
    tiles = steps.groupBy(*keys, "tile").agg(F.sum("step").alias("net"), F.min("at").alias("first"))
    tiles = tiles.select(*keys, "tile", F.coalesce(F.sum("net").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("carry"), F.lead("first").over(over).alias("after"))
    inside = Window.partitionBy(*keys, "tile").orderBy("at")
    out = steps.join(tiles, [*keys, "tile"]).select(
        *keys, F.col("at").alias("start"), F.coalesce(F.lead("at").over(inside), F.col("after")).alias("stop"), (F.col("carry") + F.sum("step").over(inside.rowsBetween(Window.unboundedPreceding, 0))).alias("depth")
    )
    return out.where("depth > 0 and stop is not null")


def filtered(reads: DataFrame, min_mapq: int = 0, exclude: int = flags.EXCLUDED, require: int = 0, min_length: int = 0) -> DataFrame:
    test = flags.lacks(exclude) & (F.col("mapq") >= min_mapq)
    if require:
        test &= flags.has(require)
    if min_length:
        test &= F.coalesce(cigar.query_length(), F.lit(0)) >= min_length
    return reads.where(test)


def _bases(reads: DataFrame, deletions: bool) -> DataFrame:
    """One row per base of a read on the reference: rname, pos, base, q; a deletion has the quality of the base before it."""
    ops = "(0,7,8,2)" if deletions else "(0,7,8)"
    each = F.expr(
        f"flatten(transform(filter({cigar.placed()}, o -> o.op in {ops} and o.len > 0), o -> transform(sequence(0, o.len - 1), k ->"
        " named_struct('pos', o.ref + k, 'q', if(o.op = 2, greatest(o.query - 1, 0L), o.query + k), 'gap', o.op = 2))))"
    )
    rows = reads.where("cigar_ops is not null and tid >= 0").select("rname", "file_id", "rec_no", "qname", "seq", "qual", F.explode(each).alias("b"))
    at = F.col("b.q").cast("int") + 1
    return rows.select("rname", "file_id", "rec_no", "qname", "b.pos", F.when(~F.col("b.gap"), F.substring("seq", at, F.lit(1))).alias("base"), (F.ascii(F.substring("qual", at, F.lit(1))) - 33).alias("q"))


def depth(reads: DataFrame, min_mapq: int = 0, min_baseq: int = 0, exclude: int = flags.EXCLUDED, require: int = 0, deletions: bool = False, overlaps_once: bool = False, min_length: int = 0) -> DataFrame:
    """(rname, pos, file_id, depth) of positions with depth. ``overlaps_once``: mates that overlap count once."""
    kept = filtered(reads, min_mapq, exclude, require, min_length)
    if min_baseq or overlaps_once:
        bases = _bases(kept, deletions)
        if min_baseq:
            bases = bases.where(F.coalesce(F.col("q"), F.lit(0)) >= min_baseq)
        if overlaps_once:
            bases = bases.select("rname", "pos", "file_id", "qname").distinct()
        return bases.groupBy("rname", "pos", "file_id").agg(F.count("*").alias("depth"))
    spread = runs(covered_blocks(kept, deletions), ("rname", "file_id"))
    return spread.select("rname", F.explode(F.sequence("start", F.col("stop") - 1)).alias("pos"), "file_id", "depth")


def depth_table(reads: DataFrame, n_files: int, contigs: DataFrame | None = None, absent: bool = False, **options) -> DataFrame:
    """One row per position, a column per file (d0, d1, ...); with ``contigs`` also positions without depth, of contigs without reads only if ``absent``."""
    wide = depth(reads, **options).groupBy("rname", "pos").agg(*(F.sum(F.when(F.col("file_id") == i, F.col("depth"))).alias(f"d{i}") for i in range(n_files)))
    columns = [F.coalesce(f"d{i}", F.lit(0)).alias(f"d{i}") for i in range(n_files)]
    if contigs is None:
        return wide.select("rname", "pos", *columns)
    every = contigs.select(F.col("name").alias("rname"), "length")
    if not absent:
        every = every.join(reads.where("tid >= 0").select("rname").distinct(), "rname", "left_semi")
    grid = every.where("length > 0").select("rname", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1)).alias("pos"))
    return grid.join(wide, ["rname", "pos"], "left").select("rname", "pos", *columns)


def count(reads: DataFrame, region: str | None = None, callback: str | Column = "nofilter", **where) -> int:
    """Reads of a region; callback ``all`` leaves out unmapped, secondary, failed and duplicate ones."""
    from .reads import fetch

    rows = fetch(reads, region, until_eof=region is None and not where, **where)
    if isinstance(callback, Column):
        rows = rows.where(callback)
    elif callback == "all":
        rows = rows.where(flags.lacks(flags.EXCLUDED))
    return rows.count()


def count_coverage(reads: DataFrame, contig: str, start: int, stop: int, quality_threshold: int = 15, callback: str | Column = "all", length: int | None = None) -> DataFrame:
    """(pos, a, c, g, t) for every position of the interval: upper-case aligned bases of the quality or more."""
    stop = min(stop, length) if length is not None else stop
    if start >= stop:
        raise ValueError("an interval of no size")
    rows = reads.where(regions.overlaps(regions.Region(contig, start, stop)))
    if isinstance(callback, Column):
        rows = rows.where(callback)
    elif callback == "all":
        rows = rows.where(flags.lacks(flags.EXCLUDED))
    bases = _bases(rows, False).where((F.col("pos") >= start) & (F.col("pos") < stop))
    if quality_threshold:
        bases = bases.where(F.col("q") >= quality_threshold)
    counts = bases.groupBy("pos").agg(*(F.count_if(F.col("base") == b.upper()).alias(b) for b in "acgt"))
    grid = reads.sparkSession.range(start, stop).select(F.col("id").alias("pos"))
    return grid.join(counts, "pos", "left").select("pos", *(F.coalesce(b, F.lit(0)).alias(b) for b in "acgt"))


def find_introns(reads: DataFrame) -> DataFrame:
    """(rname, start, stop, n): skipped regions and the reads that skip them."""
    rows = reads.where("cigar_ops is not null").select("rname", F.explode(cigar.introns()).alias("i"))
    return rows.groupBy("rname", F.col("i.start").alias("start"), F.col("i.stop").alias("stop")).agg(F.count("*").alias("n"))


def index_statistics(reads: DataFrame, contigs: DataFrame) -> DataFrame:
    """(name, length, mapped, unmapped) per contig, and ``*`` for unplaced reads."""
    placed = reads.where("tid >= 0").groupBy("rname").agg(F.count_if(flags.lacks(4)).alias("mapped"), F.count_if(flags.has(4)).alias("unmapped"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    listed = contigs.join(placed, F.col("name") == F.col("rname"), "left").select("name", "length", zero("mapped"), zero("unmapped"))
    rest = reads.agg(F.count_if(F.col("tid") < 0).alias("unmapped")).select(F.lit("*").alias("name"), F.lit(0).cast("bigint").alias("length"), F.lit(0).cast("bigint").alias("mapped"), "unmapped")
    return listed.unionByName(rest)


def flagstat(reads: DataFrame) -> DataFrame:
    """(qc, counter..., percentages): one row each for reads that pass and that fail quality control."""
    has, lacks = flags.has, flags.lacks
    primary, mapped = lacks(0x900), lacks(4)
    pair = primary & has(1)
    both = pair & mapped & lacks(8)
    counters = {
        "total": F.lit(True),
        "primary": primary,
        "secondary": has(0x100),
        "supplementary": has(0x800) & lacks(0x100),
        "duplicates": has(0x400),
        "primary_duplicates": primary & has(0x400),
        "mapped": mapped,
        "primary_mapped": primary & mapped,
        "paired": pair,
        "read1": pair & has(0x40),
        "read2": pair & has(0x80),
        "properly_paired": pair & has(2) & mapped,
        "both_mapped": both,
        "singletons": pair & mapped & has(8),
        "mate_elsewhere": both & (F.col("mate_tid") != F.col("tid")),
        "mate_elsewhere_mapq5": both & (F.col("mate_tid") != F.col("tid")) & (F.col("mapq") >= 5),
    }
    failed = has(0x200)
    rows = reads.agg(*(F.count_if(t & (failed if qc == "fail" else ~failed)).alias(f"{qc}_{n}") for qc in ("pass", "fail") for n, t in counters.items()))
    both_rows = rows.select(F.explode(F.array(*(F.struct(F.lit(qc).alias("qc"), *(F.col(f"{qc}_{n}").alias(n) for n in counters)) for qc in ("pass", "fail")))).alias("r")).select("r.*")
    share = lambda a, b: F.when(F.col(b) > 0, F.format_string("%.2f%%", (F.col(a).cast("float") / F.col(b).cast("float")).cast("double") * 100)).otherwise("N/A")
    return both_rows.withColumns({"mapped_share": share("mapped", "total"), "primary_mapped_share": share("primary_mapped", "primary"), "properly_paired_share": share("properly_paired", "paired"), "singletons_share": share("singletons", "paired")})


def aligned_quality() -> Column:
    """The sum of the qualities of a read's aligned bases; null without qualities."""
    aligned = f"array_join(transform(filter({cigar.placed()}, o -> o.op in (0,7,8)), o -> substring(qual, cast(o.query as int) + 1, o.len)), '')"
    return F.expr(f"aggregate(filter(split({aligned}, ''), c -> c <> ''), 0L, (a, c) -> a + ascii(c) - 33)")


def coverage(reads: DataFrame, contigs: DataFrame, min_mapq: int = 0, min_baseq: int = 0, exclude: int = flags.EXCLUDED, region: regions.Region | None = None) -> DataFrame:
    """(rname, startpos, endpos, numreads, covbases, coverage, meandepth, meanbaseq, meanmapq) per contig, or of one region."""
    kept = filtered(reads.where("tid >= 0"), min_mapq, exclude)
    span = contigs.select(F.col("name").alias("rname"), F.lit(0).cast("bigint").alias("lo"), F.col("length").alias("hi"))
    if region is not None:
        kept = kept.where(regions.overlaps(region))
        span = span.where(F.col("rname") == region.contig).select("rname", F.lit(region.start).cast("bigint").alias("lo"), F.least(F.col("hi"), F.lit(region.stop)).alias("hi"))
    n = kept.groupBy("rname").agg(F.count("*").alias("numreads"), F.avg("mapq").alias("meanmapq"))
    if region is None and not min_baseq:
        # Whole reads: sums of each, and the stretches that any block covers; no row for a base.
        width = F.col("stop") - F.col("start")
        by_depth = runs(covered_blocks(kept)).groupBy("rname").agg(F.sum(width).alias("covbases"), F.sum(width * F.col("depth")).alias("bases"))
        by_read = kept.groupBy("rname").agg(F.sum(aligned_quality()).alias("q"))
        by_contig = by_depth.join(by_read, "rname", "left")
    else:
        bases = _bases(kept, False)
        if region is not None:
            bases = bases.where((F.col("pos") >= region.start) & (F.col("pos") < region.stop))
        good = bases.where(F.coalesce(F.col("q"), F.lit(0)) >= min_baseq)
        by_pos = good.groupBy("rname", "pos").agg(F.count("*").alias("d"), F.sum("q").alias("q"))
        by_contig = by_pos.groupBy("rname").agg(F.count("*").alias("covbases"), F.sum("d").alias("bases"), F.sum("q").alias("q"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    size = F.col("hi") - F.col("lo")
    return span.join(n, "rname", "left").join(by_contig, "rname", "left").select(
        "rname", (F.col("lo") + 1).alias("startpos"), F.col("hi").alias("endpos"), zero("numreads").cast("bigint").alias("numreads"), zero("covbases").cast("bigint").alias("covbases"),
        F.try_divide(100.0 * zero("covbases"), size).alias("coverage"), F.try_divide(zero("bases").cast("double"), size).alias("meandepth"), F.coalesce(F.try_divide(F.col("q").cast("double"), F.col("bases")), F.lit(0.0)).alias("meanbaseq"), zero("meanmapq").alias("meanmapq"),
    )


def coverage_histogram(reads: DataFrame, contig: str, length: int, n_bins: int = 50, **options) -> DataFrame:
    """(bin, start, stop, covered): positions covered in each of ``n_bins`` equal parts of a contig."""
    width = max(1, -(-length // n_bins))
    spread = runs(covered_blocks(filtered(reads.where(F.col("rname") == contig), **options)))
    at = spread.select(F.explode(F.sequence("start", F.col("stop") - 1)).alias("pos"))
    counted = at.groupBy(F.floor(F.col("pos") / width).alias("bin")).agg(F.count("*").alias("covered"))
    grid = reads.sparkSession.range(-(-length // width)).select(F.col("id").alias("bin"))
    return grid.join(counted, "bin", "left").select("bin", (F.col("bin") * width).alias("start"), F.least((F.col("bin") + 1) * width, F.lit(length)).alias("stop"), F.coalesce("covered", F.lit(0)).alias("covered"))


def bed_coverage(reads: DataFrame, bed: DataFrame, min_mapq: int = 0, exclude: int = flags.EXCLUDED, depth_at_least: int | None = None, skip_gaps: bool = False) -> DataFrame:
    """``bed`` (contig, start, stop, ...) with bases (summed depth), reads, and positions of the given depth or more.

    Deletions and skips count towards the sum, unless ``skip_gaps`` or a depth is asked for.
    """
    kept = filtered(reads, min_mapq, exclude)
    gaps = not skip_gaps and depth_at_least is None
    rows = bed.withColumn("_bed", F.monotonically_increasing_id())
    names = bed.columns
    spread = runs(covered_blocks(kept, gaps, gaps)).withColumnsRenamed({"start": "_s", "stop": "_e", "rname": "_c"})
    near = regions.interval_join(rows, spread, ("contig", "start", "stop"), ("_c", "_s", "_e"))
    shared = F.least("stop", "_e") - F.greatest("start", "_s")
    sums = near.groupBy("_bed").agg(F.sum(shared * F.col("depth")).alias("bases"), F.sum(F.when(F.col("depth") >= (depth_at_least or 0), shared).otherwise(0)).alias("deep"))
    spans = kept.where("tid >= 0").select(F.col("rname").alias("_c"), F.col("pos").alias("_s"), F.col("end_pos").alias("_e"))
    hits = regions.interval_join(rows, spans, ("contig", "start", "stop"), ("_c", "_s", "_e")).groupBy("_bed").agg(F.count("*").alias("reads"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return rows.join(sums, "_bed", "left").join(hits, "_bed", "left").select(*names, zero("bases"), zero("reads"), zero("deep"))


def summary_numbers(reads: DataFrame) -> DataFrame:
    """(name, value): the summary section of read statistics."""
    has, lacks = flags.has, flags.lacks
    primary, mapped = lacks(0x900), lacks(4)
    paired = primary & has(1)
    length = F.coalesce(F.length("seq"), F.lit(0)).cast("bigint")
    cigar_bases = F.coalesce(F.expr("aggregate(cigar_ops, 0L, (a, o) -> a + if(o.op in (0,1,7,8), o.len, 0))"), F.lit(0))
    nm = F.coalesce(F.expr("try_element_at(tags, 'NM').i"), F.lit(0))
    isize = F.abs("tlen")
    first_of_pair = paired & mapped & lacks(8) & (F.col("mate_tid") == F.col("tid")) & (F.col("tlen") > 0)
    total = lambda test, value: F.sum(F.when(test, value).otherwise(0))
    numbers = {
        "raw total sequences": F.count_if(primary),
        "filtered sequences": F.lit(0),
        "1st fragments": F.count_if(primary & (lacks(1) | has(0x40))),
        "last fragments": F.count_if(paired & has(0x80)),
        "reads mapped": F.count_if(primary & mapped),
        "reads mapped and paired": F.count_if(paired & mapped & lacks(8)),
        "reads unmapped": F.count_if(primary & has(4)),
        "reads properly paired": F.count_if(paired & mapped & has(2)),
        "reads paired": F.count_if(paired),
        "reads duplicated": F.count_if(primary & has(0x400)),
        "reads MQ0": F.count_if(primary & mapped & (F.col("mapq") == 0)),
        "reads QC failed": F.count_if(primary & has(0x200)),
        "non-primary alignments": F.count_if(has(0x100)),
        "supplementary alignments": F.count_if(has(0x800)),
        "total length": total(primary, length),
        "total first fragment length": total(primary & (lacks(1) | has(0x40)), length),
        "total last fragment length": total(paired & has(0x80), length),
        "bases mapped": total(primary & mapped, length),
        "bases mapped (cigar)": total(primary & mapped, cigar_bases),
        "bases duplicated": total(primary & has(0x400), length),
        "mismatches": total(primary & mapped, nm),
        "maximum length": F.max(F.when(primary, length)),
        "insert size pairs": F.count_if(first_of_pair),
        "insert size total": total(first_of_pair, isize),
        "pairs on different chromosomes": F.count_if(paired & mapped & lacks(8) & (F.col("mate_tid") != F.col("tid")) & has(0x40)),
    }
    row = reads.agg(*(v.cast("bigint").alias(f"v{i}") for i, v in enumerate(numbers.values())))
    return row.select(F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.coalesce(F.col(f"v{i}"), F.lit(0)).alias("value")) for i, n in enumerate(numbers)))).alias("r")).select("r.*")


def histogram(reads: DataFrame, what: str) -> DataFrame:
    """(value, n) of primary reads: ``length``, ``mapq``, ``gc`` (percent), ``insert``, ``indel`` (signed length, with insertions positive)."""
    primary = reads.where(flags.lacks(0x900))
    if what == "indel":
        rows = primary.where("cigar_ops is not null").select(F.explode(F.expr("transform(filter(cigar_ops, o -> o.op in (1,2)), o -> if(o.op = 1, o.len, -o.len))")).alias("value"))
    elif what == "insert":
        rows = primary.where(flags.has(1) & flags.lacks(12) & (F.col("mate_tid") == F.col("tid")) & (F.col("tlen") > 0)).select(F.col("tlen").alias("value"))
    elif what == "gc":
        gc = F.length(F.regexp_replace("seq", "[^GCgc]", ""))
        rows = primary.where(F.length("seq") > 0).select(F.floor(100.0 * gc / F.length("seq")).alias("value"))
    else:
        rows = primary.select({"length": F.length("seq"), "mapq": F.col("mapq")}[what].alias("value")).where("value is not null")
    return rows.groupBy(F.col("value").cast("bigint").alias("value")).agg(F.count("*").alias("n"))


def by_cycle(reads: DataFrame) -> DataFrame:
    """(fragment, cycle, a, c, g, t, n, mean_quality) over primary reads in machine order."""
    from .reads import forward_qualities, forward_sequence

    rows = reads.where(flags.lacks(0x900) & F.col("seq").isNotNull()).select(F.when(flags.has(0x80), 2).otherwise(1).alias("fragment"), F.upper(forward_sequence()).alias("s"), forward_qualities().alias("q"))
    at = rows.select("fragment", F.explode(F.sequence(F.lit(1), F.length("s"))).alias("cycle"), "s", "q")
    base = F.substring("s", F.col("cycle"), F.lit(1))
    return at.groupBy("fragment", "cycle").agg(*(F.count_if(base == b.upper()).alias(b) for b in "acgtn"), F.avg(F.ascii(F.substring("q", F.col("cycle"), F.lit(1))) - 33).alias("mean_quality"))


def quality_by_cycle(reads: DataFrame) -> DataFrame:
    """(fragment, cycle, quality, n) of primary reads in machine order."""
    from .reads import forward_qualities

    rows = reads.where(flags.lacks(0x900) & F.col("qual").isNotNull()).select(F.when(flags.has(0x80), 2).otherwise(1).alias("fragment"), forward_qualities().alias("q"))
    at = rows.select("fragment", F.posexplode(F.expr("filter(split(q, ''), c -> c <> '')")).alias("at", "c"))
    return at.groupBy("fragment", (F.col("at") + 1).alias("cycle"), (F.ascii("c") - 33).alias("quality")).agg(F.count("*").alias("n"))


def coverage_distribution(reads: DataFrame, **options) -> DataFrame:
    """(depth, positions): how many positions have each depth, from runs of equal depth."""
    return runs(covered_blocks(filtered(reads, **options))).groupBy("depth").agg(F.sum(F.col("stop") - F.col("start")).alias("positions"))


def indels_by_cycle(reads: DataFrame) -> DataFrame:
    """(fragment, cycle, insertions, deletions) of primary reads: insertions at their first base, deletions at the base before, in machine order."""
    each = F.expr(f"transform(filter({cigar.placed()}, o -> o.op in (1, 2)), o -> named_struct('op', o.op, 'at', case when o.op = 1 and flag & 16 = 0 then o.query when o.op = 1 then length(seq) - o.query - o.len when flag & 16 = 0 then o.query - 1 else length(seq) - o.query - 1 end))")
    rows = reads.where(flags.lacks(0x900) & F.col("cigar_ops").isNotNull() & F.col("seq").isNotNull()).select(F.when(flags.has(0x80), 2).otherwise(1).alias("fragment"), F.explode(each).alias("i")).where("i.at >= 0")
    return rows.groupBy("fragment", (F.col("i.at") + 1).cast("bigint").alias("cycle")).agg(F.count_if(F.col("i.op") == 1).alias("insertions"), F.count_if(F.col("i.op") == 2).alias("deletions"))


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (rg, three residues, n) each batch's count and products by group."""
    for batch in batches:
        groups, at = np.unique(np.array(batch.column(0).to_pylist(), object), return_inverse=True)
        order = np.argsort(at, kind="stable")
        starts = np.searchsorted(at[order], np.arange(len(groups)))
        columns = [batch.column(k).to_numpy().astype(np.int64)[order] for k in (1, 2, 3)]
        parts = [[_product(part) for part in np.split(c, starts[1:])] if len(groups) else [] for c in columns]
        n = np.add.reduceat(batch.column(4).to_numpy().astype(np.int64)[order], starts) if len(groups) else []
        yield pa.RecordBatch.from_arrays([pa.array(groups.tolist(), pa.string()), *(pa.array(p, pa.int64()) for p in parts), pa.array(n, pa.int64())], names=["rg", "names", "bases", "qualities", "n"])


#: The modulus of order-free products.
PRIME = (1 << 31) - 1


def _product(values: np.ndarray) -> int:
    while len(values) > 1:
        odd, values = values[len(values) & ~1 :], values[: len(values) & ~1]
        values = np.r_[values[::2] * values[1::2] % PRIME, odd]
    return int(values[0]) if len(values) else 1


def checksum(reads: DataFrame) -> DataFrame:
    """(rg, n, names, bases, qualities): digests that do not depend on the order of primary reads, of each read group.

    Products of CRC-32 values modulo 2^31 - 1 (0 and the modulus count as 1). A
    batch gives one row for each of its read groups; batches' rows are combined
    by the same function within 256 parts of a group, and the parts then.
    """
    from .reads import forward_qualities, forward_sequence

    rows = reads.where(flags.lacks(0x900)).select(F.coalesce("rg", F.lit("-")).alias("rg"), F.col("qname").alias("names"), F.coalesce(forward_sequence(), F.lit("")).alias("bases"), F.coalesce(forward_qualities(), F.lit("")).alias("qualities"))
    residue = lambda c: F.when(F.crc32(F.encode(c, "utf-8")) % PRIME == 0, 1).otherwise(F.crc32(F.encode(c, "utf-8")) % PRIME).alias(c)
    names = ["names", "bases", "qualities"]
    schema = "rg string, names long, bases long, qualities long, n long"
    partial = rows.select("rg", *(residue(c) for c in names), F.lit(1).cast("bigint").alias("n")).mapInArrow(_products, schema)
    in_parts = partial.repartition("rg", F.pmod(F.xxhash64(*names), F.lit(256))).mapInArrow(_products, schema)
    return in_parts.repartition("rg").sortWithinPartitions("rg").mapInArrow(_merged, schema).select("rg", "n", *names)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each group of a whole partition; groups are read groups, few and small."""
    found: dict[str, list[int]] = {}
    for batch in batches:
        for rg, *values, n in zip(*(c.to_pylist() for c in batch.columns)):
            have = found.setdefault(rg, [1, 1, 1, 0])
            found[rg] = [a * b % PRIME for a, b in zip(have, values)] + [have[3] + n]
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), *(pa.array([v[k] for v in found.values()], pa.int64()) for k in range(4))], names=["rg", "names", "bases", "qualities", "n"])


def flagstat_text(reads: DataFrame) -> DataFrame:
    """(line_no, value): flag statistics as text, passed and failed reads side by side."""
    # The counters' wording in the report.
    wording = [
        ("total", "in total (QC-passed reads + QC-failed reads)"), ("primary", "primary"), ("secondary", "secondary"), ("supplementary", "supplementary"), ("duplicates", "duplicates"), ("primary_duplicates", "primary duplicates"),
        ("mapped", "mapped"), ("primary_mapped", "primary mapped"), ("paired", "paired in sequencing"), ("read1", "read1"), ("read2", "read2"), ("properly_paired", "properly paired"),
        ("both_mapped", "with itself and mate mapped"), ("singletons", "singletons"), ("mate_elsewhere", "with mate mapped to a different chr"), ("mate_elsewhere_mapq5", "with mate mapped to a different chr (mapQ>=5)"),
    ]
    shares = {"mapped": "mapped_share", "primary_mapped": "primary_mapped_share", "properly_paired": "properly_paired_share", "singletons": "singletons_share"}
    both = flagstat(reads)
    names = [c for c in both.columns if c != "qc"]
    of = lambda c, qc: F.max(F.when(F.col("qc") == qc, F.col(c))).alias(f"{qc}_{c}")
    wide = both.groupBy().agg(*(of(c, qc) for c in names for qc in ("pass", "fail")))
    share = lambda c: F.concat(F.lit(" ("), F.col(f"pass_{c}"), F.lit(" : "), F.col(f"fail_{c}"), F.lit(")"))
    line = lambda c, text: F.concat(F.col(f"pass_{c}").cast("string"), F.lit(" + "), F.col(f"fail_{c}").cast("string"), F.lit(f" {text}"), share(shares[c]) if c in shares else F.lit(""))
    return wide.select(F.posexplode(F.array(*(line(c, text) for c, text in wording))).alias("line_no", "value"))
