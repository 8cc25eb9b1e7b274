"""Orders of reads, duplicates, mates, merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import cigar, flags


def coordinate_key() -> list[Column]:
    """Contig (unplaced last), position, strand, input order."""
    return [F.when(F.col("tid") < 0, (1 << 31) - 1).otherwise(F.col("tid")), F.col("pos"), flags.has(0x10), F.col("file_id"), F.col("rec_no")]


def natural_key(name: str = "qname") -> Column:
    """Text that sorts as names do naturally: runs of digits by value, leading zeros not counted."""
    return F.expr(
        f"array_join(transform(regexp_extract_all({name}, '[0-9]+|[^0-9]+', 0), r -> if(r rlike '^[0-9]',"
        " concat('0', lpad(cast(length(ltrim('0', r)) as string), 4, '0'), ltrim('0', r)), r)), '')"
    )


def _place_in_template() -> Column:
    f = F.col("flag")
    return F.shiftleft(f.bitwiseAND(F.lit(0xC0)), 8).bitwiseOR(F.shiftleft(f.bitwiseAND(F.lit(0x100)), 3)).bitwiseOR(F.shiftright(f.bitwiseAND(F.lit(0x800)), 5))


def sort_key(by: str = "coordinate", tag: str | None = None, then: str = "coordinate") -> list[Column]:
    """Columns whose ascending order, nulls first, is ``coordinate``, ``name`` (natural), ``ascii`` (by code), ``tag`` (missing first, then ``then``) or ``template`` (by the template's two ends)."""
    name = {"name": [natural_key(), F.col("qname")], "ascii": [F.col("qname")]}
    if by == "coordinate":
        return coordinate_key()
    if by in name:
        return [*name[by], _place_in_template(), F.col("file_id"), F.col("rec_no")]
    if by == "tag":
        v = F.expr(f"try_element_at(tags, '{tag}')")
        kind = F.when(v.isNull(), 0).when(v["type"] == "A", 1).when(v["i"].isNotNull() | v["d"].isNotNull(), 2).otherwise(3)
        value = F.coalesce(v["i"].cast("double"), v["d"])
        return [kind, value, v["s"], *(coordinate_key() if then == "coordinate" else [natural_key(), _place_in_template()])]
    if by == "template":
        big = F.lit((1 << 31) - 1)
        tid = F.when(flags.has(4), big).otherwise(F.col("tid"))
        mate = F.when(flags.lacks(1) | flags.has(8), big).otherwise(F.col("mate_tid"))
        at = F.when(flags.has(0x10), cigar.unclipped_end()).otherwise(cigar.unclipped_start())
        ours, theirs = F.struct(tid.alias("t"), at.alias("p"), flags.has(0x10).alias("r")), F.struct(mate.alias("t"), F.col("mate_pos").alias("p"), flags.has(0x20).alias("r"))
        return [F.least(ours, theirs), F.greatest(ours, theirs), F.coalesce("rg", F.lit("")), natural_key(), ours > theirs, F.col("file_id"), F.col("rec_no")]
    raise ValueError(f"no order {by!r}")


def sort_reads(reads: DataFrame, by: str = "coordinate", tag: str | None = None, then: str = "coordinate") -> DataFrame:
    """Reads in the order of ``sort_key``."""
    return reads.orderBy(*sort_key(by, tag, then))


#: Pieces that a total rank is taken in, and sampled keys for each.
PIECES, SAMPLED = 64, 32


def _literal(value, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType) and value is not None:
        return F.struct(*(_literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields)))
    return F.lit(value).cast(kind)


def ranked(df: DataFrame, keys: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with each row's place, from 1, in the ascending order of ``keys``, nulls first.

    Keys chosen by their hash give the edges of pieces; rows are numbered within
    pieces and moved by the sizes of the pieces before, so no task holds all of
    them. The edges are values: a recomputed piece is the same piece.
    """
    # The key comes out of a generator: otherwise each comparison with an edge would make it anew.
    keyed = df.select("*", F.explode(F.array(F.struct(*(k.alias(f"k{i}") for i, k in enumerate(keys))))).alias("_key"))
    sample = keyed.select("_key").orderBy(F.xxhash64("_key")).limit(PIECES * SAMPLED).orderBy("_key").collect()
    edges = [_literal(r["_key"], keyed.schema["_key"].dataType) for r in sample[SAMPLED::SAMPLED]]
    piece = F.size(F.filter(F.array(*edges), lambda e: e <= F.col("_key"))) if edges else F.lit(0)
    pieced = keyed.withColumn("_piece", piece)
    before, at = [0] * (len(edges) + 1), 0
    for p, n in sorted(tuple(r) for r in pieced.groupBy("_piece").count().collect()):
        before[p], at = at, at + n
    offset = F.get(F.array(*(F.lit(n).cast("bigint") for n in before)), F.col("_piece"))
    return pieced.withColumn(name, offset + F.row_number().over(Window.partitionBy("_piece").orderBy("_key"))).drop("_key", "_piece")


def minimiser_sort(reads: DataFrame, k: int = 20) -> DataFrame:
    """Placed reads by coordinate, then the others by their smallest k-mer hash, so that like sequences lie together."""
    kmer = F.expr(f"array_min(transform(sequence(1, greatest(length(seq) - {k - 1}, 1)), i -> xxhash64(substring(seq, i, {k}))))")
    return reads.orderBy(*coordinate_key()[:1], F.when(F.col("tid") >= 0, F.col("pos")), F.when(F.col("tid") < 0, kmer), "file_id", "rec_no")


def collate(reads: DataFrame) -> DataFrame:
    """Reads of a name together, in no order otherwise: one shuffle by the name's hash."""
    return reads.repartition("qname").sortWithinPartitions("qname", _place_in_template())


def merge(*tables: DataFrame, by: str = "coordinate") -> DataFrame:
    """Tables as one, files renumbered, sorted."""
    out = None
    for i, t in enumerate(tables):
        t = t.withColumn("file_id", F.lit(i))
        out = t if out is None else out.unionByName(t)
    return sort_reads(out, by)


def concat(*tables: DataFrame) -> DataFrame:
    """Tables one after the other: ``file_id`` gives the order."""
    out = None
    for i, t in enumerate(tables):
        t = t.withColumn("file_id", F.lit(i))
        out = t if out is None else out.unionByName(t)
    return out


def base_score(floor: int = 15) -> Column:
    """Sum of a read's qualities of ``floor`` or more."""
    return F.expr(f"coalesce(aggregate(filter(split(qual, ''), c -> c <> ''), 0L, (a, c) -> a + if(ascii(c) - 33 >= {floor}, ascii(c) - 33, 0)), 0L)")


def mark_duplicates(reads: DataFrame, barcode: str | None = None, by_group: bool = False, remove: bool = False, supplementary: bool = False, clear: bool = False, include_fails: bool = False) -> DataFrame:
    """Sets the duplicate bit.

    Pairs of a file with equal contigs, unclipped five-prime ends and
    orientations are duplicates of the one that passes quality control, has the
    largest sum of qualities, and the smallest name. A read whose mate is
    unmapped or missing is one of any pair that shares its end, else of the best
    such read. Secondary, supplementary and unmapped reads take no part, nor,
    but with ``include_fails``, those that fail quality control. With
    ``supplementary`` all of a duplicate template's reads are marked; ``clear``
    takes older marks away first.
    """
    end = F.when(flags.has(0x10), cigar.unclipped_end()).otherwise(cigar.unclipped_start())
    bc = F.expr(f"try_element_at(tags, '{barcode}').s") if barcode else F.lit(None).cast("string")
    rg = F.col("rg") if by_group else F.lit(None).cast("string")
    takes_part = flags.lacks(0x904 if include_fails else 0xB04) & (F.col("tid") >= 0)
    ends = reads.where(takes_part).select(
        "file_id", "qname", bc.alias("_bc"), rg.alias("_rg"), F.struct(F.col("tid").alias("t"), end.alias("p"), flags.has(0x10).alias("r")).alias("e"), base_score().alias("s"), flags.has(0x200).alias("bad"), (flags.has(1) & flags.lacks(8)).alias("pair")
    )
    templates = ends.groupBy("file_id", "qname", "_bc", "_rg").agg(F.min("e").alias("e1"), F.max("e").alias("e2"), F.count("*").alias("n"), F.sum("s").alias("s"), F.max("bad").alias("bad"), F.min("pair").alias("pair"))
    templates = templates.withColumn("is_pair", F.col("pair") & (F.col("n") == 2))
    place = ["file_id", "_bc", "_rg"]
    rank = F.struct("bad", (-F.col("s")).alias("s"), "qname")
    # The best of a place is the least of a struct, so hot places are combined before their shuffle; the rest are found by a join.
    same = lambda keys: F.expr(" and ".join(f"a.{c} <=> b.{c}" for c in keys))

    def beaten(rows: DataFrame, keys: list[str]) -> DataFrame:
        best = rows.groupBy(*keys).agg(F.min(rank).alias("best"), F.count("*").alias("m")).where("m > 1").drop("m")
        return rows.alias("a").join(best.alias("b"), same(keys)).where(F.col("a.qname") != F.col("b.best.qname")).select("a.file_id", "a.qname")

    pairs, singles = templates.where("is_pair"), templates.where("not is_pair")
    taken = pairs.select(*place, F.explode(F.array("e1", "e2")).alias("e1")).distinct()
    beside_pair = singles.alias("a").join(taken.alias("b"), same([*place, "e1"]), "left_semi").select("file_id", "qname")
    marks = beaten(pairs, [*place, "e1", "e2"]).unionByName(beside_pair).unionByName(beaten(singles, [*place, "e1"]))
    marks = marks.select(F.col("file_id").alias("_f"), F.col("qname").alias("_q")).distinct().withColumn("_dup", F.lit(True))
    out = reads.join(marks, (F.col("file_id") == F.col("_f")) & (F.col("qname") == F.col("_q")), "left").drop("_f", "_q")
    mark = F.coalesce("_dup", F.lit(False)) & (F.lit(True) if supplementary else takes_part)
    old = F.col("flag").bitwiseAND(F.lit(~0x400)) if clear else F.col("flag")
    out = out.withColumn("flag", F.when(mark, old.bitwiseOR(F.lit(0x400))).otherwise(old)).drop("_dup")
    return out.where(flags.lacks(0x400)) if remove else out


def optical_duplicates(reads: DataFrame, distance: int = 100, pattern: str = r"^([^:]+(?::[^:]+)*?):(\d+):(\d+):(\d+)(?:[#/ ].*)?$") -> DataFrame:
    """(qname) of marked duplicates that lie within ``distance`` (in x and y) of another read of their tile and place: by cells of that size, joined with their neighbours."""
    part = lambda i: F.regexp_extract("qname", pattern, i)
    end = F.when(flags.has(0x10), cigar.unclipped_end()).otherwise(cigar.unclipped_start())
    at = reads.where(flags.lacks(0x904)).where(part(2) != "").select("qname", (flags.has(0x400)).alias("dup"), F.concat_ws(":", part(1), part(2)).alias("tile"), part(3).cast("long").alias("x"), part(4).cast("long").alias("y"), "tid", end.alias("p"), flags.has(0x10).alias("r"))
    cell = lambda c: F.floor(F.col(c) / distance)
    a = at.where("dup").withColumn("cx", F.explode(F.expr(f"sequence(cast(floor(x / {distance}) as bigint) - 1, cast(floor(x / {distance}) as bigint) + 1)"))).withColumn("cy", F.explode(F.expr(f"sequence(cast(floor(y / {distance}) as bigint) - 1, cast(floor(y / {distance}) as bigint) + 1)")))
    b = at.select(F.col("qname").alias("_q"), "tile", F.col("x").alias("_x"), F.col("y").alias("_y"), "tid", "p", "r", cell("x").alias("cx"), cell("y").alias("cy"))
    near = a.join(b, ["tile", "tid", "p", "r", "cx", "cy"]).where((F.col("qname") != F.col("_q")) & (F.abs(F.col("x") - F.col("_x")) <= distance) & (F.abs(F.col("y") - F.col("_y")) <= distance))
    return near.select("qname").distinct()


def remove_duplicates_by_place(reads: DataFrame, single_end: bool = False) -> DataFrame:
    """The older way: of reads (or first mates) with equal contig, start, strand (and insert size) the one of the best mapping quality stays."""
    primary = flags.lacks(0x904)
    keys = ["tid", "pos", flags.has(0x10), *([] if single_end else [F.col("tlen")])]
    best = Window.partitionBy(*keys).orderBy(F.desc("mapq"), "file_id", "rec_no")
    lead = reads.where(primary & (F.lit(single_end) | (F.col("tlen") > 0))).select("qname", F.row_number().over(best).alias("n"))
    gone = lead.where("n > 1").select("qname").distinct()
    return reads.join(gone, "qname", "left_anti")


def fix_mates(reads: DataFrame, add_cigar: bool = True, add_score: bool = False, proper_pairs: bool = True) -> DataFrame:
    """Mate fields, mate bits, template length and the tags MQ, MC (and ms) from the mate itself, by name.

    A template length counts from the leftmost start to the rightmost end, its
    sign positive for the leftmost read. The proper-pair bit needs both mapped to
    one contig, opposite strands and the forward read first.
    """
    from .reads import set_tag

    primary = flags.lacks(0x900) & flags.has(1)
    part = F.col("flag").bitwiseAND(F.lit(0xC0))
    fields = {"_flag": F.col("flag"), "_tid": F.col("tid"), "_rname": F.col("rname"), "_pos": F.col("pos"), "_end": F.col("end_pos"), "_mapq": F.col("mapq"), "_cigar": F.col("cigar"), "_score": base_score()}
    # A name that repeats a place in its pair has its first record there for a mate.
    first = F.min_by(F.struct(*(c.alias(n) for n, c in fields.items())), F.struct("file_id", "rec_no")).alias("m")
    side = reads.where(primary).groupBy(F.col("qname").alias("_q"), part.alias("_p")).agg(first).select("_q", "_p", "m.*")
    joined = reads.join(side, (F.col("qname") == F.col("_q")) & primary & (part + F.col("_p") == 0xC0) & (part != F.col("_p")), "left")
    has_mate = F.col("_q").isNotNull()
    mine, theirs = flags.lacks(4), flags.lacks(4, "_flag")
    both = mine & theirs & (F.col("tid") == F.col("_tid"))
    span = F.greatest("end_pos", "_end") - F.least("pos", "_pos")
    leftmost = (F.col("pos") < F.col("_pos")) | ((F.col("pos") == F.col("_pos")) & (part == 0x40))
    # An unmapped read takes its mapped mate's place.
    place = lambda own, other: F.when(has_mate & ~mine & theirs, F.col(other)).otherwise(F.col(own))
    mate_at = lambda own, other: F.when(has_mate & mine & ~theirs, F.col(own)).otherwise(F.col(other))
    flag = F.col("flag").bitwiseAND(F.lit(~(2 | 8 | 0x20)))
    flag = flag.bitwiseOR(F.when(flags.has(4, "_flag"), 8).otherwise(0)).bitwiseOR(F.when(flags.has(0x10, "_flag"), 0x20).otherwise(0))
    strands = flags.has(0x10) != flags.has(0x10, "_flag")
    forward_first = F.when(flags.has(0x10), F.col("_pos") <= F.col("end_pos")).otherwise(F.col("pos") <= F.col("_end"))
    proper = both & strands & forward_first & (flags.has(2) if not proper_pairs else F.lit(True))
    flag = flag.bitwiseOR(F.when(proper, 2).otherwise(0))
    out = joined.withColumns(
        {
            "flag": F.when(has_mate, flag).otherwise(F.col("flag")),
            "tid": place("tid", "_tid"), "rname": place("rname", "_rname"), "pos": place("pos", "_pos"), "end_pos": F.when(has_mate & ~mine & theirs, F.col("_pos") + 1).otherwise(F.col("end_pos")),
            "mate_tid": F.when(has_mate, mate_at("tid", "_tid")).otherwise(F.col("mate_tid")), "mate_rname": F.when(has_mate, mate_at("rname", "_rname")).otherwise(F.col("mate_rname")), "mate_pos": F.when(has_mate, mate_at("pos", "_pos")).otherwise(F.col("mate_pos")),
            "tlen": F.when(has_mate & both, F.when(leftmost, span).otherwise(-span)).when(has_mate, 0).otherwise(F.col("tlen")),
        }
    )
    out = set_tag(out, "MQ", F.when(has_mate & theirs, F.col("_mapq")).otherwise(F.expr("try_element_at(tags, 'MQ').i")), "i")
    if add_cigar:
        out = set_tag(out, "MC", F.when(has_mate, F.coalesce("_cigar", F.lit("*"))).otherwise(F.expr("try_element_at(tags, 'MC').s")))
    if add_score:
        out = set_tag(out, "ms", F.when(has_mate, F.col("_score")).otherwise(F.expr("try_element_at(tags, 'ms').i")), "i")
    return out.select(*reads.columns)
