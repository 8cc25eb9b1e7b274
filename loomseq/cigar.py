"""CIGAR arithmetic as column expressions over ``array<struct<op,len>>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the SAM format: operation letters by number.
LETTERS = "MIDNSHP=XB"
REF, QUERY, ALIGNED = "(0,2,3,7,8)", "(0,1,4,7,8)", "(0,7,8)"


def parse(cigar: str = "cigar") -> Column:
    """The operations of CIGAR text; null for ``*`` and null."""
    return F.expr(
        f"if({cigar} is null or {cigar} = '*', null, transform(regexp_extract_all({cigar}, '([0-9]+)([MIDNSHP=XB])', 0),"
        f" s -> named_struct('op', instr('{LETTERS}', right(s, 1)) - 1, 'len', cast(left(s, length(s) - 1) as int))))"
    )


def text(ops: str = "cigar_ops") -> Column:
    return F.expr(f"coalesce(array_join(transform({ops}, o -> concat(cast(o.len as string), substring('{LETTERS}', o.op + 1, 1))), ''), '*')")


def _sum(ops: str, which: str) -> str:
    return f"aggregate({ops}, 0L, (a, o) -> a + if(o.op in {which}, o.len, 0))"


def reference_length(ops: str = "cigar_ops") -> Column:
    return F.expr(_sum(ops, REF))


def query_length(ops: str = "cigar_ops") -> Column:
    """Bases of the read in SEQ by its CIGAR (no hard clips)."""
    return F.expr(_sum(ops, QUERY))


def read_length(ops: str = "cigar_ops") -> Column:
    """Bases of the read, hard clips included."""
    return F.expr(_sum(ops, "(0,1,4,5,7,8)"))


def end_pos(pos: str = "pos", ops: str = "cigar_ops") -> Column:
    """One past the last aligned base, and at least one past ``pos``."""
    return F.expr(f"{pos} + greatest(coalesce({_sum(ops, REF)}, 0L), 1L)")


def reference_end(pos: str = "pos", ops: str = "cigar_ops", flag: str = "flag") -> Column:
    """One past the last aligned base; null for unmapped reads and reads without CIGAR."""
    return F.expr(f"if({flag} & 4 <> 0 or {ops} is null or size({ops}) = 0, null, {pos} + {_sum(ops, REF)})")


def placed(pos: str = "pos", ops: str = "cigar_ops", padded: bool = False) -> str:
    """SQL: the operations with the reference and query position at which each starts.

    ``padded`` makes P advance the query as I and S do, as pairs of positions have it.
    """
    query = "(0,1,4,6,7,8)" if padded else QUERY
    return (
        f"aggregate({ops}, named_struct('r', cast({pos} as bigint), 'q', 0L, 'x', cast(array() as array<struct<op:int,len:int,ref:bigint,query:bigint>>)),"
        f" (a, o) -> named_struct('r', a.r + if(o.op in {REF}, o.len, 0), 'q', a.q + if(o.op in {query}, o.len, 0),"
        f" 'x', array_append(a.x, named_struct('op', o.op, 'len', o.len, 'ref', a.r, 'query', a.q))), a -> a.x)"
    )


def blocks(pos: str = "pos", ops: str = "cigar_ops") -> Column:
    """Gapless aligned blocks (start, stop), query offset included; not merged across insertions."""
    return F.expr(f"transform(filter({placed(pos, ops)}, o -> o.op in {ALIGNED}), o -> named_struct('start', o.ref, 'stop', o.ref + o.len, 'query', o.query))")


def introns(pos: str = "pos", ops: str = "cigar_ops") -> Column:
    """(start, stop) of each N operation."""
    return F.expr(f"transform(filter({placed(pos, ops)}, o -> o.op = 3), o -> named_struct('start', o.ref, 'stop', o.ref + o.len))")


def overlap(start: int | str, stop: int | str, pos: str = "pos", ops: str = "cigar_ops") -> Column:
    """Aligned bases inside [start, stop); null without CIGAR."""
    return F.expr(f"aggregate(filter({placed(pos, ops)}, o -> o.op in {ALIGNED}), 0L, (a, o) -> a + greatest(0L, least(cast({stop} as bigint), o.ref + o.len) - greatest(cast({start} as bigint), o.ref)))")


def reference_positions(pos: str = "pos", ops: str = "cigar_ops", full_length: bool = False) -> Column:
    """Reference positions of aligned bases; with ``full_length`` nulls for soft-clipped and inserted bases too."""
    keep = "(0,1,4,7,8)" if full_length else ALIGNED
    return F.expr(f"flatten(transform(filter({placed(pos, ops)}, o -> o.op in {keep} and o.len > 0), o -> transform(sequence(0, o.len - 1), k -> if(o.op in {ALIGNED}, o.ref + k, null))))")


def aligned_pairs(pos: str = "pos", ops: str = "cigar_ops", matches_only: bool = False) -> Column:
    """(query, ref, op) for every base of read or reference; null on the side that has none."""
    keep = ALIGNED if matches_only else "(0,1,2,3,4,6,7,8)"
    return F.expr(
        f"flatten(transform(filter({placed(pos, ops, padded=True)}, o -> o.op in {keep} and o.len > 0), o -> transform(sequence(0, o.len - 1), k ->"
        f" named_struct('query', if(o.op in (2,3), null, o.query + k), 'ref', if(o.op in (1,4,6), null, o.ref + k), 'op', o.op))))"
    )


def leading_clip(ops: str = "cigar_ops", letters: str = "(4)") -> str:
    """SQL: bases clipped at the start; soft ones only unless ``letters`` says otherwise."""
    return f"aggregate({ops}, named_struct('n', 0L, 'on', true), (a, o) -> named_struct('n', a.n + if(a.on and o.op in {letters}, o.len, 0), 'on', a.on and o.op in (4,5)), a -> a.n)"


def trailing_clip(ops: str = "cigar_ops", letters: str = "(4)") -> str:
    return leading_clip(f"reverse({ops})", letters)


def query_alignment_start(ops: str = "cigar_ops") -> Column:
    return F.expr(leading_clip(ops))


def query_alignment_end(ops: str = "cigar_ops", seq: str = "seq") -> Column:
    return F.expr(f"coalesce(cast(length(nullif({seq}, '*')) as bigint), {_sum(ops, QUERY)}) - {trailing_clip(ops)}")


def unclipped_start(pos: str = "pos", ops: str = "cigar_ops") -> Column:
    return F.expr(f"{pos} - coalesce({leading_clip(ops, '(4,5)')}, 0L)")


def unclipped_end(pos: str = "pos", ops: str = "cigar_ops") -> Column:
    """Position of the last base, clipped ones included (one past)."""
    return F.expr(f"{pos} + coalesce({_sum(ops, REF)}, 0L) + coalesce({trailing_clip(ops, '(4,5)')}, 0L)")


def stats(ops: str = "cigar_ops", nm: str = "0") -> Column:
    """(bases, blocks): eleven counts each, by operation number, the last of bases the NM tag."""
    bases = ", ".join(f"{_sum(ops, f'({k})')}" for k in range(10))
    blocks_ = ", ".join(f"cast(size(filter({ops}, o -> o.op = {k})) as bigint)" for k in range(10))
    return F.expr(f"named_struct('bases', array({bases}, cast(coalesce({nm}, 0) as bigint)), 'blocks', array({blocks_}, cast(if({nm} is null, 0, 1) as bigint)))")
