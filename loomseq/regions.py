"""Genomic regions: text to coordinates, coordinates to predicates, and interval plans.

Coordinates are 0-based and half open throughout; only region text is 1-based
and inclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_POS = (1 << 31) - 1
#: Bin width of interval joins, as a power of two: the indexing unit of the binning scheme.
BIN_SHIFT = 14


@dataclass(frozen=True)
class Region:
    """contig None: everything; ``*``: unplaced reads."""

    contig: str | None = None
    start: int = 0
    stop: int = MAX_POS


def parse_region(region: str | None = None, contig: str | None = None, start: int | None = None, stop: int | None = None, *, reference: str | None = None, end: int | None = None, lengths: dict[str, int] | None = None) -> Region:
    """A region from text (``chr``, ``chr:10``, ``chr:10-20``, ``*``, ``.``; thousands separators accepted) or from parts.

    Names may hold colons where ``lengths`` knows the whole text as a name.
    Raises ValueError on conflicts, negative or reversed coordinates, and names
    that ``lengths`` lacks.
    """
    if reference is not None:
        if contig is not None:
            raise ValueError("contig and reference are the same parameter")
        contig = reference
    if end is not None:
        if stop is not None:
            raise ValueError("stop and end are the same parameter")
        stop = end
    if region is not None:
        if contig is not None or start is not None or stop is not None:
            raise ValueError("give a region or its parts, not both")
        if region == ".":
            return Region()
        name, colon, span = region.rpartition(":")
        if region == "*" or not colon or (lengths is not None and region in lengths):
            contig = region
        else:
            low, dash, high = span.replace(",", "").partition("-")
            if not low.isdigit() and not (low == "" and dash) or (high and not high.isdigit()):
                if lengths is not None:
                    raise ValueError(f"invalid region {region!r}")
                contig = region
            else:
                contig = name
                start = int(low) - 1 if low else 0
                stop = int(high) if high else None
    if contig is None:
        if start is not None or stop is not None:
            raise ValueError("start and stop need a contig")
        return Region()
    if lengths is not None and contig not in lengths and contig != "*":
        raise ValueError(f"invalid contig {contig!r}")
    start = 0 if start is None else start
    stop = MAX_POS if stop is None else stop
    if start > stop:
        raise ValueError(f"invalid coordinates: start {start} > stop {stop}")
    if not 0 <= start <= MAX_POS:
        raise ValueError(f"start {start} out of range")
    if not 0 <= stop <= MAX_POS:
        raise ValueError(f"stop {stop} out of range")
    return Region(contig, start, stop)


def overlaps(region: Region, contig: str = "rname", start: str = "pos", stop: str = "end_pos", max_span: int | None = None) -> Column:
    """The predicate of rows that overlap; with ``max_span`` also a lower bound on the start, which prunes sorted files."""
    if region.contig is None:
        return F.lit(True)
    if region.contig == "*":
        return F.col(contig).isNull() | (F.col(contig) == "*")
    test = (F.col(contig) == region.contig) & (F.col(start) < region.stop) & (F.col(stop) > region.start)
    if max_span is not None:
        test &= F.col(start) > region.start - max_span
    return test


def reg2bin(start: str = "pos", stop: str = "end_pos", min_shift: int = 14, levels: int = 5) -> Column:
    """The smallest bin that holds [start, stop) in the hierarchical binning scheme."""
    last = f"({stop} - 1)"
    out, shift, first = "0", min_shift + 3 * (levels - 1), 1
    for _ in range(levels):  # from the widest bins to the narrowest
        out = f"if({start} >> {shift} = {last} >> {shift}, {first} + ({start} >> {shift}), {out})"
        first, shift = (first << 3) + 1, shift - 3
    return F.expr(out).cast("int")


def bins(start: str, stop: str, shift: int = BIN_SHIFT) -> Column:
    """All bins of one width that [start, stop) touches; an empty interval touches the bin of its start."""
    return F.expr(f"sequence(cast({start} as bigint) >> {shift}, (greatest(cast({stop} as bigint), cast({start} as bigint) + 1) - 1) >> {shift})")


def interval_join(left: DataFrame, right: DataFrame, left_on: tuple[str, str, str], right_on: tuple[str, str, str], how: str = "inner", shift: int = BIN_SHIFT) -> DataFrame:
    """Rows of both sides whose (contig, start, stop) overlap, by an equality join on bins.

    A pair that meets in several bins is taken in the later of the sides' first
    bins, so no distinct is needed. ``how``: inner, left_outer, left_semi,
    left_anti. For these, rows of ``left`` that lie in one bin, which is nearly
    all where reads are short, pass a plain semi or anti join; only those that
    lie across bins are numbered and brought together again.
    """
    lc, ls, le = left_on
    rc, rs, re_ = right_on
    b = right.withColumn("_bin", F.explode(bins(rs, re_, shift))).alias("b")
    meet = (
        (F.col(f"a.{lc}") == F.col(f"b.{rc}"))
        & (F.col("a._bin") == F.col("b._bin"))
        & (F.col(f"a.{ls}") < F.col(f"b.{re_}"))
        & (F.col(f"b.{rs}") < F.col(f"a.{le}"))
        & (F.col("a._bin") == F.greatest(F.shiftright(F.col(f"a.{ls}"), shift), F.shiftright(F.col(f"b.{rs}"), shift)))
    )
    if how in ("inner", "left_outer"):
        a = left.withColumn("_bin", F.explode(bins(ls, le, shift))).alias("a")
        pairs = a.join(b, meet).select("a.*", *[F.col(f"b.{c}").alias(c) for c in right.columns]).drop("_bin")
        if how == "inner":
            return pairs
        lone = interval_join(left, right, left_on, right_on, "left_anti", shift)
        return pairs.unionByName(lone.select("*", *[F.lit(None).cast(t).alias(c) for c, t in right.dtypes]))
    first = F.shiftright(F.col(ls).cast("bigint"), shift)
    last = F.shiftright(F.greatest(F.col(le).cast("bigint"), F.col(ls).cast("bigint") + 1) - 1, shift)
    in_one = F.coalesce(first == last, F.lit(True))
    narrow = left.where(in_one).withColumn("_bin", first).alias("a").join(b, meet, how).select("a.*").drop("_bin")
    wide = left.where(~in_one).withColumn("_row", F.monotonically_increasing_id()).withColumn("_bin", F.explode(bins(ls, le, shift))).alias("a")
    if how == "left_semi":
        return narrow.unionByName(wide.join(b, meet, how).select("a.*").dropDuplicates(["_row"]).drop("_row", "_bin"))
    hits = wide.join(b.select(F.col("_bin"), *(F.col(c) for c in (rc, rs, re_)), F.lit(1).alias("_hit")).alias("b"), meet, "left_outer")
    lone = hits.groupBy("a._row").agg(F.max("b._hit").alias("_hit"), F.first(F.struct(*(F.col(f"a.{c}").alias(c) for c in left.columns))).alias("_s")).where("_hit is null").select("_s.*")
    return narrow.unionByName(lone)


def merge_intervals(df: DataFrame, contig: str = "contig", start: str = "start", stop: str = "stop", distance: int = 0) -> DataFrame:
    """Islands of intervals that overlap or lie within ``distance``: contig, start, stop, n."""
    w = Window.partitionBy(contig).orderBy(start, stop)
    reach = F.max(stop).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col(start) > reach + distance), 1).otherwise(0)
    marked = df.select(F.col(contig), F.col(start), F.col(stop)).withColumn("_new", new)
    grouped = marked.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy(contig, "_island").agg(F.min(start).alias("start"), F.max(stop).alias("stop"), F.count("*").alias("n")).select(F.col(contig).alias("contig"), "start", "stop", "n")


def intersect_intervals(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pieces that both merged sets cover."""
    pairs = interval_join(merge_intervals(a).select("contig", "start", "stop"), merge_intervals(b).select(F.col("contig").alias("c2"), F.col("start").alias("s2"), F.col("stop").alias("e2")), ("contig", "start", "stop"), ("c2", "s2", "e2"))
    return pairs.select("contig", F.greatest("start", "s2").alias("start"), F.least("stop", "e2").alias("stop"))


def subtract_intervals(a: DataFrame, b: DataFrame) -> DataFrame:
    """What of the merged set ``a`` the set ``b`` leaves: by a sweep over both sets' ends."""
    ends = lambda d, who: d.select("contig", F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("step")), F.struct(F.col("stop").alias("at"), F.lit(-1).alias("step")))).alias("e")).select("contig", "e.at", *[(F.col("e.step") if w == who else F.lit(0)).alias(w) for w in ("a", "b")])
    both = ends(merge_intervals(a), "a").unionByName(ends(merge_intervals(b), "b")).groupBy("contig", "at").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    w = Window.partitionBy("contig").orderBy("at")
    run = both.select("contig", F.col("at").alias("start"), F.lead("at").over(w).alias("stop"), F.sum("a").over(w).alias("in_a"), F.sum("b").over(w).alias("in_b"))
    return merge_intervals(run.where("in_a > 0 and in_b = 0 and stop is not null")).select("contig", "start", "stop")
