"""MD tags, base modifications, and other string automata that have no column form: Arrow functions over pure Python kernels."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CIGAR = re.compile(r"(\d+)([MIDNSHP=XB])")
_MD = re.compile(r"(\d+)|\^([A-Za-z]+)|([A-Za-z])")


def reference_of(seq: str | None, cigar: str | None, md: str | None) -> str | None:
    """The reference under a read's M, D, = and X operations: matches upper case, mismatches lower; null where a part is missing or they contradict one another."""
    if not seq or not cigar or md is None or cigar == "*":
        return None
    aligned: list[str | None] = []  # the read's bases in M, =, X; None for a deleted base
    at = 0
    for n, op in ((int(n), op) for n, op in _CIGAR.findall(cigar)):
        if op in "M=X":
            aligned.extend(seq[at : at + n])
            at += n
        elif op in "IS":
            at += n
        elif op == "D":
            aligned.extend([None] * n)
    out: list[str] = []
    k = 0
    for number, deleted, base in _MD.findall(md):
        if number:
            run = aligned[k : k + int(number)]
            if None in run or len(run) < int(number):
                return None
            out += [b.upper() for b in run]
            k += int(number)
        elif deleted:
            out += deleted.upper()
            k += len(deleted)
        else:
            out.append(base.lower())
            k += 1
    return "".join(out) if k == len(aligned) else None


def reference_length(md: str = "md") -> Column:
    """Reference bases that an MD text tells of: its runs, its mismatches and its deletions."""
    return F.expr(f"aggregate(regexp_extract_all({md}, '[0-9]+', 0), 0L, (a, n) -> a + cast(n as bigint)) + length(regexp_replace({md}, '[^A-Za-z]', ''))")


@F.pandas_udf(T.StringType())
def reference_sequence(seq: pd.Series, cigar: pd.Series, md: pd.Series) -> pd.Series:
    return pd.Series([reference_of(*v) for v in zip(seq, cigar, md)], dtype=object)


def mismatches_of(seq: str | None, cigar: str | None, reference: str | None) -> dict:
    """NM and MD of a read against the reference bases under it (M, D, =, X operations)."""
    if not seq or not cigar or reference is None:
        return {"nm": None, "md": None}
    nm, run, md, at, k = 0, 0, "", 0, 0
    for n, op in ((int(n), op) for n, op in _CIGAR.findall(cigar)):
        if op in "M=X":
            for i in range(n):
                ref, base = reference[k + i].upper() if k + i < len(reference) else "N", seq[at + i].upper()
                if base == ref and ref != "N" or base == "=":
                    run += 1
                else:
                    md, run, nm = f"{md}{run}{ref}", 0, nm + 1
            at, k = at + n, k + n
        elif op == "D":
            md, run, nm, k = f"{md}{run}^{reference[k : k + n].upper()}", 0, nm + n, k + n
        elif op == "I":
            nm, at = nm + n, at + n
        elif op == "S":
            at += n
    return {"nm": nm, "md": f"{md}{run}"}


@F.pandas_udf(T.StructType([T.StructField("nm", T.IntegerType()), T.StructField("md", T.StringType())]))
def mismatches(seq: pd.Series, cigar: pd.Series, reference: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([mismatches_of(*v) for v in zip(seq, cigar, reference)], columns=["nm", "md"])


_MODIFICATION = T.ArrayType(T.StructType([T.StructField(n, t) for n, t in (("base", T.StringType()), ("strand", T.IntegerType()), ("code", T.StringType()), ("pos", T.IntegerType()), ("qual", T.IntegerType()))]))
_COMPLEMENT = str.maketrans("ACGTUN", "TGCAAN")


def modifications_of(seq: str | None, mm: str | None, ml: list | None, reverse: bool) -> list[dict]:
    """Modified bases of the MM and ML tags: (base, strand, code, pos in SEQ, quality or -1)."""
    if not seq or not mm:
        return []
    original = seq.translate(_COMPLEMENT)[::-1] if reverse else seq
    out: list[dict] = []
    quals = iter(ml or [])
    for part in filter(None, mm.split(";")):
        m = re.match(r"([ACGTUN])([+-])([a-z]+|\d+)([.?]?)(.*)", part)
        if not m:
            raise ValueError(f"malformed modifications {part!r}")
        base, strand, codes, _, rest = m.groups()
        codes = [codes] if codes.isdigit() else list(codes)
        at = [i for i, b in enumerate(original) if base == "N" or b == base]
        k = -1
        for skip in (int(x) for x in rest.split(",") if x):
            k += skip + 1
            if k >= len(at):
                raise ValueError("modifications beyond the sequence")
            pos = len(seq) - 1 - at[k] if reverse else at[k]
            for code in codes:
                out.append({"base": base, "strand": 1 if (strand == "-") != reverse else 0, "code": code, "pos": pos, "qual": int(next(quals, -1))})
    return sorted(out, key=lambda r: (r["base"], r["strand"], r["code"], r["pos"]))


@F.pandas_udf(_MODIFICATION)
def modified_bases(seq: pd.Series, mm: pd.Series, ml: pd.Series, reverse: pd.Series) -> pd.Series:
    return pd.Series([modifications_of(s, m, None if q is None else list(q), bool(r)) for s, m, q, r in zip(seq, mm, ml, reverse)], dtype=object)


def base_modifications(reads):
    """(file_id, rec_no, qname, base, strand, code, pos, qual) of reads with MM (or Mm) tags."""
    mm = F.expr("coalesce(try_element_at(tags, 'MM').s, try_element_at(tags, 'Mm').s)")
    ml = F.expr("coalesce(try_element_at(tags, 'ML').a, try_element_at(tags, 'Ml').a)")
    rows = reads.where(mm.isNotNull() & F.col("seq").isNotNull()).select("file_id", "rec_no", "qname", F.explode(modified_bases("seq", mm, ml, F.col("flag").bitwiseAND(F.lit(16)) != 0)).alias("m"))
    return rows.select("file_id", "rec_no", "qname", "m.*")
