"""Pileups: reads exploded over reference positions, and what is made of each column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import cigar, flags, regions
from ..sources.fastx import CHUNK
from .reads import mixed, name_hash


def pileup_bases(reads: DataFrame, stepper: str = "default", ignore_overlaps: bool = True, ignore_orphans: bool = True, flag_filter: int = flags.EXCLUDED, flag_require: int = 0, min_mapq: int = 0, where: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per read and reference position that it spans.

    Columns: rname, tid, pos, file_id, rec_no, qname, flag, mapq, query (null in
    deletions and skips), query_or_next, base, q, is_del, is_refskip, indel (length
    of the insertion, or less that of the deletion, that follows), insert (its
    bases), is_head, is_tail. Stepper ``all`` leaves out ``flag_filter``,
    ``nofilter`` only unmapped reads, ``default`` orphans too if told so;
    ``flag_require`` asks for any of its bits, ``keep`` for more columns of the reads.
    """
    test = flags.lacks(4) & F.col("cigar_ops").isNotNull() & (F.col("mapq") >= min_mapq)
    if stepper in ("all", "default"):
        test &= flags.lacks(flag_filter)
    if flag_require:
        test &= ~flags.lacks(flag_require)
    if stepper == "default" and ignore_orphans:
        test &= flags.lacks(1) | flags.has(2)
    if where is not None:
        test &= where
    mates = ignore_overlaps and stepper == "default"
    kept = _with_overlaps(reads.where(test)) if mates else reads.where(test)
    ops = f"filter({cigar.placed()}, o -> o.len > 0 and o.op not in (5))"
    # Of each operation: what follows it, insertions (and padding between) or deletions run together.
    follow = (
        "transform(x, (o, i) -> named_struct('o', o, 'ins', aggregate(slice(x, i + 2, size(x)), named_struct('n', 0, 'on', true), (a, p) -> named_struct('n', a.n + if(a.on and p.op = 1, p.len, 0), 'on', a.on and p.op in (1, 6)), a -> a.n),"
        " 'del', aggregate(slice(x, i + 2, size(x)), named_struct('n', 0, 'on', true), (a, p) -> named_struct('n', a.n + if(a.on and p.op = 2, p.len, 0), 'on', a.on and p.op = 2), a -> a.n)))"
    )
    more = [*keep, *(["_may", "_over"] if mates else [])]
    placed = kept.select(*more, "rname", "tid", "file_id", "rec_no", "qname", "flag", "mapq", "seq", "qual", "pos", F.expr(f"{cigar._sum('cigar_ops', cigar.REF)}").alias("span"), F.expr(ops).alias("x"))
    each = F.expr(
        f"flatten(transform(filter({follow}, w -> w.o.op in {cigar.REF}), w -> transform(sequence(0, w.o.len - 1), k -> named_struct('pos', w.o.ref + k, 'query', if(w.o.op in (2,3), null, w.o.query + k),"
        " 'next', if(w.o.op in (2,3), w.o.query, w.o.query + k), 'is_del', w.o.op in (2,3), 'is_refskip', w.o.op = 3, 'indel', if(k = w.o.len - 1, if(w.ins > 0, w.ins, -w.del), 0)))))"
    )
    rows = placed.select(*more, "rname", "tid", "file_id", "rec_no", "qname", "flag", "mapq", "seq", "qual", F.col("pos").alias("first"), "span", F.explode(each).alias("b"))
    at = F.col("b.query").cast("int") + 1
    out = rows.select(
        *more, *([F.col("first").alias("_first")] if mates else []), "rname", "tid", F.col("b.pos").alias("pos"), "file_id", "rec_no", "qname", "flag", "mapq", F.col("b.query").alias("query"), F.col("b.next").alias("query_or_next"), F.substring("seq", at, F.lit(1)).alias("base"),
        (F.ascii(F.substring("qual", F.col("b.next").cast("int") + 1, F.lit(1))) - 33).alias("q"), F.col("b.is_del").alias("is_del"), F.col("b.is_refskip").alias("is_refskip"), F.col("b.indel").cast("int").alias("indel"),
        F.when(F.col("b.indel") > 0, F.expr("substring(seq, cast(b.next as int) + 2 - if(b.is_del, 1, 0), b.indel)")).alias("insert"), (F.col("b.pos") == F.col("first")).alias("is_head"), (F.col("b.pos") == F.col("first") + F.col("span") - 1).alias("is_tail"),
    )
    if not mates:
        return out
    # Only bases of templates whose reads overlap are brought together by position.
    return out.where("not _over").drop("_may", "_over", "_first").unionByName(one_per_template(out.where("_over")).drop("_over"))


def _with_overlaps(reads: DataFrame) -> DataFrame:
    """Adds _may (the read may have its qualities mended against its mate's) and _over (reads of its template that may, overlap), by one shuffle of reads."""
    far = (F.abs("tlen") >= 2 * F.length("seq")) & (F.col("mate_pos") >= F.col("end_pos"))
    may = flags.lacks(8) & flags.has(2) & ((F.col("mate_tid") < 0) | (F.col("mate_tid") == F.col("tid"))) & ~F.coalesce(far, F.lit(False))
    w = Window.partitionBy("file_id", "rname", "qname")
    n, low, high = F.count_if("_may").over(w), F.min(F.when(F.col("_may"), F.col("end_pos"))).over(w), F.max(F.when(F.col("_may"), F.col("pos"))).over(w)
    return reads.withColumn("_may", may).withColumn("_over", F.col("_may") & ((n > 2) | ((n == 2) & (high < low))))


def one_per_template(bases: DataFrame) -> DataFrame:
    """Qualities where two mates cover a position, the first being that which starts first.

    Where their bases agree one has the sum (200 at most) and the other none,
    else the better keeps four fifths; which one, where it could be either, the
    name's hash says. A base beside a deletion keeps four fifths or none.
    """
    w = Window.partitionBy("file_id", "rname", "qname", "pos")
    order = w.orderBy("_first", "rec_no")
    pair = (F.count("*").over(w) == 2) & F.min("_may").over(w)
    other = lambda c: F.coalesce(F.lead(c).over(order), F.lag(c).over(order))
    first = F.row_number().over(order) == 1
    keep = (mixed(name_hash()).bitwiseAND(F.lit(1)) == 1) == first
    marked = bases.withColumns({"_pair": pair, "_base": other("base"), "_q": other("q"), "_keep": keep, "_del": other("is_del"), "_skip": other("is_refskip")})
    less = F.floor(F.col("q") * 0.8).cast("int")
    q = (
        F.when(~F.col("_pair") | F.col("is_del") | F.coalesce("_skip", F.lit(True)), F.col("q"))
        .when(F.col("_del"), F.when(F.col("_keep"), less).otherwise(0))
        .when(F.col("base") == F.col("_base"), F.when(F.col("_keep"), F.least(F.col("q") + F.col("_q"), F.lit(200))).otherwise(0))
        .when((F.col("q") > F.col("_q")) | ((F.col("q") == F.col("_q")) & F.col("_keep")), less)
        .otherwise(0)
    )
    return marked.withColumn("q", q).drop("_pair", "_base", "_q", "_keep", "_del", "_skip", "_may", "_first")


def in_region(bases: DataFrame, region: regions.Region) -> DataFrame:
    return bases.where((F.col("rname") == region.contig) & (F.col("pos") >= region.start) & (F.col("pos") < region.stop))


def columns(bases: DataFrame, min_base_quality: int = 13) -> DataFrame:
    """(rname, pos, n, aligned, names, queries, bases, qualities, mapqs): a row per column, lists in input order; n counts before the quality filter."""
    good = F.col("is_del") | (F.coalesce(F.col("q"), F.lit(0)) >= min_base_quality)
    row = F.struct("file_id", "rec_no", "qname", "query", "base", "q", "mapq")
    rows = F.array_sort(F.collect_list(F.when(good, row)))
    listed = bases.groupBy("rname", "pos").agg(F.count("*").alias("n"), F.count_if(good).alias("aligned"), rows.alias("r"))
    part = lambda c: F.transform("r", lambda x: x[c])
    return listed.select("rname", "pos", "n", "aligned", part("qname").alias("names"), part("query").alias("queries"), part("base").alias("bases"), part("q").alias("qualities"), part("mapq").alias("mapqs"))


def mpileup(bases: DataFrame, ref_chunks: DataFrame | None = None, min_base_quality: int = 13) -> DataFrame:
    """(rname, pos, ref, depth, bases, quals): text columns; ``.`` and ``,`` for matches where a reference is given."""
    rows = bases.where(F.col("is_del") | (F.coalesce(F.col("q"), F.lit(0)) >= min_base_quality))
    if ref_chunks is not None:
        rows = rows.withColumn("_chunk", (F.col("pos") / CHUNK).cast("bigint")).join(ref_chunks.select(F.col("contig").alias("rname"), F.col("chunk").alias("_chunk"), F.col("seq").alias("_ref")), ["rname", "_chunk"], "left")
        ref = F.substring("_ref", (F.col("pos") % CHUNK + 1).cast("int"), F.lit(1))
        gone = F.when(F.col("indel") < 0, F.expr(f"substring(_ref, cast(pos % {CHUNK} as int) + 2, -indel)"))
        rows = rows.withColumns({"ref": F.coalesce(ref, F.lit("N")), "_gone": F.rpad(F.coalesce(gone, F.lit("")), F.greatest(-F.col("indel"), F.lit(0)), F.lit("N"))}).drop("_ref", "_chunk")
    else:
        rows = rows.withColumns({"ref": F.lit("N"), "_gone": F.expr("repeat('N', greatest(-indel, 0))")})
    reverse = flags.has(0x10)
    case = lambda c: F.when(reverse, F.lower(c)).otherwise(F.upper(c))
    base = F.when(F.col("is_refskip"), F.when(reverse, "<").otherwise(">")).when(F.col("is_del"), "*").when((F.upper("base") == F.upper("ref")) | (F.col("base") == "="), F.when(reverse, ",").otherwise(".")).otherwise(case(F.col("base")))
    indel = F.when(F.col("indel") > 0, F.concat(F.lit("+"), F.col("indel").cast("string"), case(F.col("insert")))).when(F.col("indel") < 0, F.concat(F.col("indel").cast("string"), case(F.col("_gone")))).otherwise("")
    text = F.concat(F.when(F.col("is_head"), F.concat(F.lit("^"), F.char(F.least(F.col("mapq"), F.lit(93)) + 33))).otherwise(""), base, indel, F.when(F.col("is_tail"), "$").otherwise(""))
    quality = F.char(F.least(F.greatest(F.coalesce(F.col("q"), F.lit(0)), F.lit(0)), F.lit(93)) + 33)
    cells = F.array_sort(F.collect_list(F.struct("file_id", "rec_no", text.alias("t"), quality.alias("q"))))
    out = rows.groupBy("rname", "pos", "ref").agg(F.count("*").alias("depth"), cells.alias("c"))
    joined = lambda k: F.array_join(F.transform("c", lambda x: x[k]), "")
    return out.select("rname", "pos", "ref", "depth", joined("t").alias("bases"), joined("q").alias("quals"))


# What each ambiguity letter stands for.
AMBIGUITY = {"A": "A", "C": "C", "G": "G", "T": "T", "M": "AC", "R": "AG", "W": "AT", "S": "CG", "Y": "CT", "K": "GT", "V": "ACG", "H": "ACT", "D": "AGT", "B": "CGT", "N": "ACGT"}


def simple_consensus(bases: DataFrame, call_fraction: float = 0.75, het_fraction: float = 0.15, min_depth: int = 1, min_base_quality: int = 0, ambiguous: bool = True, times: str | None = None) -> DataFrame:
    """(rname, pos, base, depth, share): the weighted majority of each column.

    A pure base weighs 8 and an ambiguity letter its bases' shares of it; two
    bases that together reach the call's fraction, the second at least
    ``het_fraction`` of the first, give their ambiguity letter; a gap may win as ``*``.
    A row counts as often as its column ``times`` says, where one is named.
    """
    rows = bases.where(~F.col("is_refskip") & (F.col("is_del") | (F.coalesce(F.col("q"), F.lit(0)) >= min_base_quality)))
    letter = F.when(F.col("is_del"), "*").otherwise(F.upper("base"))
    weight = lambda b: sum((F.when(letter == k, 8.0 / len(v)).otherwise(0.0) for k, v in AMBIGUITY.items() if b in v), F.lit(0.0))
    n = F.col(times).cast("bigint") if times else F.lit(1)
    sums = rows.groupBy("rname", "pos").agg((F.sum(n) if times else F.count("*")).alias("depth"), *(F.sum(n * weight(b)).alias(b) for b in "ACGT"), F.sum(n * F.when(letter == "*", 8.0).otherwise(0.0)).alias("gap"))
    ranked = F.reverse(F.array_sort(F.array(*(F.struct(F.col(c).alias("w"), F.lit(b).alias("b")) for b, c in (("A", "A"), ("C", "C"), ("G", "G"), ("T", "T"), ("*", "gap"))))))
    total = F.col("A") + F.col("C") + F.col("G") + F.col("T") + F.col("gap")
    out = sums.withColumns({"_r": ranked, "_t": total})
    one, two = F.element_at("_r", 1), F.element_at("_r", 2)
    pair = {"".join(sorted(v)): k for k, v in AMBIGUITY.items() if len(v) == 2}
    het = F.lit("N")
    for bases_, code in pair.items():
        het = F.when(F.array_join(F.array_sort(F.array(one["b"], two["b"])), "") == bases_, code).otherwise(het)
    is_het = F.lit(ambiguous) & (two["w"] >= het_fraction * one["w"]) & (two["w"] > 0) & (one["b"] != "*") & (two["b"] != "*")
    share = F.try_divide(F.when(is_het, one["w"] + two["w"]).otherwise(one["w"]), F.col("_t"))
    called = F.when((F.col("depth") < min_depth) | F.coalesce(share < call_fraction, F.lit(True)), "N").when(is_het, het).otherwise(one["b"])
    return out.select("rname", "pos", called.alias("base"), "depth", share.alias("share"))


def consensus_sequence(called: DataFrame, contigs: DataFrame, show_gaps: bool = False) -> DataFrame:
    """(name, seq): called bases over each contig's length, N where there is none; in pieces of a chunk, then joined."""
    kept = called if show_gaps else called.withColumn("base", F.when(F.col("base") == "*", "").otherwise(F.col("base")))
    grid = contigs.select(F.col("name").alias("rname"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1)).alias("pos"))
    full = grid.join(kept.select("rname", "pos", "base"), ["rname", "pos"], "left").select("rname", "pos", F.coalesce("base", F.lit("N")).alias("base"))
    pieces = full.groupBy("rname", (F.col("pos") / CHUNK).cast("bigint").alias("chunk")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "base"))), lambda x: x["base"]), "").alias("s"))
    return pieces.groupBy("rname").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "s"))), lambda x: x["s"]), "").alias("seq")).withColumnRenamed("rname", "name")


def reference_bases(reads: DataFrame) -> DataFrame:
    """(rname, pos, base, n): the reference as MD tags and sequences tell it, the most told base of each position."""
    from ..functions.md import reference_sequence

    rows = reads.where("cigar_ops is not null and try_element_at(tags, 'MD') is not null and seq is not null").select("rname", "pos", "cigar_ops", reference_sequence(F.col("seq"), F.col("cigar"), F.expr("try_element_at(tags, 'MD').s")).alias("r"))
    at = F.expr(f"flatten(transform(filter({cigar.placed()}, o -> o.op in (0,2,7,8) and o.len > 0), o -> transform(sequence(0, o.len - 1), k -> o.ref + k)))")
    told = rows.select("rname", F.explode(F.arrays_zip(at.alias("p"), F.filter(F.split("r", ""), lambda c: c != "").alias("b"))).alias("z")).select("rname", F.col("z.p").alias("pos"), F.upper(F.col("z.b")).alias("base"))
    counted = told.where("pos is not null and base is not null").groupBy("rname", "pos", "base").agg(F.count("*").alias("n"))
    return counted.groupBy("rname", "pos").agg(F.max_by("base", F.struct("n", "base")).alias("base"), F.sum("n").alias("n"))
