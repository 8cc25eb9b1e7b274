"""Format strings for variants, compiled to a column of text.

``%CHROM %POS %POS0 %END %END0 %ID %REF %ALT %QUAL %FILTER %INFO %INFO/x
%TYPE %LINE %N_ALT %FIRST_ALT %IS_TS`` per site; between brackets, once for each
sample, also ``%SAMPLE %GT %TGT %IUPACGT`` and any FORMAT field; ``{i}`` after a
field takes one of its values. ``\\n`` and ``\\t`` stand for line end and tab.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..headers import VariantHeader
from ..operators.pileup import AMBIGUITY
from .variant_expr import TYPES, compile_expression

_FIELD = re.compile(r"%(?:INFO/([A-Za-z_][\w.]*)|FORMAT/([A-Za-z_][\w.]*)|([A-Za-z_][\w.]*))(?:\{(\d+)\})?")
_QUAL = "case when qual is null then '.' when qual = cast(qual as bigint) then cast(cast(qual as bigint) as string) else cast(qual as string) end"
_SITE = {
    "CHROM": "chrom",
    "POS": "cast(pos as string)",
    "POS0": "cast(pos - 1 as string)",
    "END": "cast(stop as string)",
    "END0": "cast(stop - 1 as string)",
    "ID": "coalesce(id, '.')",
    "REF": "ref",
    "ALT": "if(size(alts) = 0, '.', array_join(alts, ','))",
    "FIRST_ALT": "coalesce(get(alts, 0), '.')",
    "QUAL": _QUAL,
    "FILTER": "if(size(filters) = 0, '.', array_join(filters, ';'))",
    "INFO": "if(size(info) > 0, array_join(transform(map_entries(info), e -> if(e.value = '', e.key, concat(e.key, '=', e.value))), ';'), '.')",
    "TYPE": f"array_join(array_distinct({TYPES}), ',')",
    "N_ALT": "cast(size(alts) as string)",
    "IS_TS": "if(exists(alts, a -> concat(upper(ref), upper(a)) in ('AG','GA','CT','TC')), '1', '0')",
}
_GT = "array_join(transform(s.gt.alleles, a -> coalesce(cast(a as string), '.')), if(s.gt.phased, '|', '/'))"
_TGT = "array_join(transform(s.gt.alleles, a -> if(a is null, '.', if(a = 0, ref, alts[a - 1]))), if(s.gt.phased, '|', '/'))"


def _iupac() -> str:
    """SQL: two alleles as one ambiguity letter, ``.`` where there is none."""
    bases = "array_sort(array_distinct(transform(s.gt.alleles, a -> if(a is null, '.', upper(if(a = 0, ref, alts[a - 1]))))))"
    cases = " ".join(f"when {bases} = array({', '.join(repr(b) for b in sorted(v))}) then '{k}'" for k, v in AMBIGUITY.items() if len(v) <= 2)
    return f"case {cases} else '.' end"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\n", "\n").replace("\\t", "\t").replace("\\", "\\\\").replace("'", "\\'") + "'"


def _field(match: re.Match, in_sample: bool) -> str:
    info, fmt, name, index = match.groups()
    part = (lambda v: f"coalesce(get(split({v}, ','), {index}), '.')") if index is not None else (lambda v: v)
    if info:
        return part(f"coalesce(nullif(try_element_at(info, '{info}'), ''), if(map_contains_key(info, '{info}'), '1', '.'))")
    if in_sample:
        if fmt or name not in (*_SITE, "SAMPLE", "GT", "TGT", "IUPACGT"):
            return part(f"coalesce(try_element_at(s.fields, '{fmt or name}'), '.')")
        if name in ("SAMPLE", "GT", "TGT", "IUPACGT"):
            return {"SAMPLE": "s.name", "GT": f"coalesce({_GT}, '.')", "TGT": f"coalesce({_TGT}, '.')", "IUPACGT": _iupac()}[name]
    if name not in _SITE:
        raise ValueError(f"unknown field %{name}")
    return part(_SITE[name])


def _texts(pattern: str, in_sample: bool) -> list[str]:
    out, at = [], 0
    for m in _FIELD.finditer(pattern):
        if m.start() > at:
            out.append(_quoted(pattern[at : m.start()]))
        out.append(_field(m, in_sample))
        at = m.end()
    if at < len(pattern):
        out.append(_quoted(pattern[at:]))
    return out


def compile_format(pattern: str, samples: str = "samples") -> Column:
    """The text of each site."""
    parts: list[str] = []
    for i, piece in enumerate(re.split(r"\[([^\]]*)\]", pattern)):
        if i % 2:
            inner = _texts(piece, True)
            parts.append(f"array_join(transform({samples}, s -> concat({', '.join(inner)})), '')")
        else:
            parts += _texts(piece, False)
    return F.expr(f"concat({', '.join(parts)})") if parts else F.lit("")


def query(df: DataFrame, pattern: str, header: VariantHeader, include: str | None = None, exclude: str | None = None) -> DataFrame:
    """(value) the text of each site that passes; samples that fail are left out of the brackets."""
    if not (include or exclude):
        return df.select(compile_format(pattern).alias("value"))
    site, samples = compile_expression(include or exclude, header)
    kept = df.where(site if include else ~site)
    if samples is None:
        return kept.select(compile_format(pattern).alias("value"))
    truth = samples if include else F.transform(samples, lambda t: ~t)
    passing = F.transform(F.filter(F.arrays_zip(F.col("samples").alias("s"), truth.alias("t")), lambda z: z["t"]), lambda z: z["s"])
    return kept.withColumn("samples", passing).select(compile_format(pattern).alias("value"))
