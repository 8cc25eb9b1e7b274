"""The variant filter language, compiled to columns over ``variants``.

A value is one per site or one per sample, and each may be a vector. Compared
vectors match if any pair of their elements does. ``&&`` and ``||`` work on
sites, ``&`` and ``|`` on samples: with ``||`` every sample passes where one
does, with ``|`` only those that do themselves. A missing value equals only a
missing value, differs only from a present one, and is neither more nor less
than anything. Numbers are compared in single precision unless one is beyond
2^24.

``compile_expression`` gives (site, samples): whether the site passes, and per
sample whether it does (null for expressions on the site alone).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..headers import VariantHeader

_TOKEN = re.compile(
    r"\s*(?:(\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+)|(\"[^\"]*\"|'[^']*')|(@[\w./-]+)|(\|\||&&|==|=|!=|!~|<=|>=|[-+*/%&|<>~(),])|([A-Za-z_][\w.]*(?:/[A-Za-z_][\w.]*)?)(\[[^\]]*\])?)"
)


class ExpressionError(ValueError):
    pass


@dataclass
class Value:
    """``sql``: an array of numbers, texts or booleans, per site; or, where ``per_sample``, an array of these arrays."""

    sql: str
    kind: str  # n number, s text, b truth (an array of one), f filter set
    per_sample: bool = False


#: Scalar truth of a site and, where there is one, array of truths of samples.
@dataclass
class Truth:
    site: str
    samples: str | None = None


_SITE = {
    "CHROM": ("array(chrom)", "s"),
    "POS": ("array(cast(pos as double))", "n"),
    "REF": ("array(ref)", "s"),
    "ALT": ("alts", "s"),
    "ID": ("array(id)", "s"),
    "QUAL": ("array(qual)", "n"),
    "FILTER": ("filters", "f"),
    "N_ALT": ("array(cast(size(alts) as double))", "n"),
    "N_SAMPLES": ("array(cast(size(samples) as double))", "n"),
}
_MISSING_GT = "(s.gt is null or exists(s.gt.alleles, a -> a is null))"
_ALLELES = "filter(flatten(transform(samples, s -> coalesce(s.gt.alleles, array()))), a -> a is not null)"
_AN = f"coalesce(try_cast(try_element_at(info, 'AN') as double), cast(size({_ALLELES}) as double))"
_AC = (
    "if(map_contains_key(info, 'AC'), transform(split(info['AC'], ','), x -> try_cast(x as double)),"
    f" transform(sequence(1, greatest(size(alts), 1)), k -> if(size(alts) = 0, null, cast(size(filter({_ALLELES}, a -> a = k)) as double))))"
)
_COMPUTED = {
    "AN": f"array({_AN})",
    "AC": _AC,
    "AF": f"if(map_contains_key(info, 'AF'), transform(split(info['AF'], ','), x -> try_cast(x as double)), transform({_AC}, c -> try_divide(c, {_AN})))",
    "MAC": f"transform({_AC}, c -> least(c, {_AN} - c))",
    "MAF": f"transform({_AC}, c -> least(try_divide(c, {_AN}), 1 - try_divide(c, {_AN})))",
    "N_MISSING": f"array(cast(size(filter(samples, s -> {_MISSING_GT})) as double))",
    "F_MISSING": f"array(try_divide(cast(size(filter(samples, s -> {_MISSING_GT})) as double), size(samples)))",
    "ILEN": "transform(alts, a -> if(a rlike '^[ACGTNacgtn]+$' and length(a) <> length(ref), cast(length(a) - length(ref) as double), null))",
}


def allele_type(ref: str, alt: str) -> str:
    """SQL: ref, snp, mnp, indel, bnd, overlap or other for one alternate allele."""
    return (
        f"case when {alt} is null or {alt} in ('.', '<*>', '<X>', '<NON_REF>') or upper({alt}) = upper({ref}) then 'ref' when {alt} = '*' then 'overlap' when {alt} rlike '[\\\\[\\\\]]' or {alt} rlike '^\\\\.|\\\\.$' then 'bnd'"
        f" when {alt} like '<%' then if({alt} rlike '^<(DEL|INS|DUP)', 'indel', 'other') when length({ref}) = length({alt}) then"
        f" if(size(filter(sequence(1, length({ref})), i -> upper(substring({ref}, i, 1)) <> upper(substring({alt}, i, 1)))) = 1, 'snp', 'mnp')"
        f" when {alt} rlike '^[ACGTNacgtn]+$' and {ref} rlike '^[ACGTNacgtn]+$' then 'indel' else 'other' end"
    )


TYPES = f"if(size(alts) = 0, array('ref'), transform(alts, a -> {allele_type('ref', 'a')}))"


class _Parser:
    def __init__(self, text: str, header: VariantHeader, sets: dict[str, list[str]]):
        self.header, self.sets, self.tokens, self.at = header, sets, [], 0
        at = 0
        while text[at:].strip():
            m = _TOKEN.match(text, at)
            if not m or m.end() == at:
                raise ExpressionError(f"cannot read {text[at:]!r}")
            number, string, file, sign, name, index = m.groups()
            self.tokens.append(("number", number, None) if number else ("string", string[1:-1], None) if string is not None else ("set", file[1:], None) if file else ("sign", sign, None) if sign else ("name", name, index))
            at = m.end()

    def accept(self, *signs: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "sign" and self.tokens[self.at][1] in signs:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def expect(self, sign: str) -> None:
        if not self.accept(sign):
            raise ExpressionError(f"{sign!r} expected")

    def whole(self) -> Truth:
        value = _truth(self.either())
        if self.at < len(self.tokens):
            raise ExpressionError(f"unexpected {self.tokens[self.at][1]!r}")
        return value

    def either(self):
        left = self.both()
        while sign := self.accept("||", "|"):
            left = _combine(sign, _truth(left), _truth(self.both()))
        return left

    def both(self):
        left = self.compared()
        while sign := self.accept("&&", "&"):
            right = self.compared()
            if sign == "&" and isinstance(left, Value) and isinstance(right, Value) and left.kind == right.kind == "n":
                left = _arithmetic("&", left, right)
            else:
                left = _combine(sign, _truth(left), _truth(right))
        return left

    def compared(self):
        left = self.sum()
        if sign := self.accept("==", "=", "!=", "!~", "~", "<=", ">=", "<", ">"):
            return _compare("=" if sign == "==" else sign, left, self.sum(), self.sets)
        return left

    def sum(self):
        left = self.product()
        while sign := self.accept("+", "-"):
            left = _arithmetic(sign, left, self.product())
        return left

    def product(self):
        left = self.atom()
        while sign := self.accept("*", "/", "%"):
            left = _arithmetic(sign, left, self.atom())
        return left

    def atom(self):
        if self.accept("("):
            value = self.either()
            self.expect(")")
            return value
        if self.accept("-"):
            return _arithmetic("-", Value("array(0.0D)", "n"), self.atom())
        if self.at >= len(self.tokens):
            raise ExpressionError("the expression ends early")
        kind, text, index = self.tokens[self.at]
        self.at += 1
        if kind == "number":
            return Value(f"array({float(text)!r}D)", "n")
        if kind == "string":
            return Value("array(cast(null as string))" if text == "." else f"array({_quoted(text)})", "s")
        if kind == "set":
            return Value(text, "set")
        if kind == "name":
            if index is None and self.accept("("):
                args = []
                while not self.accept(")"):
                    args.append(self.either())
                    self.accept(",")
                return _call(text, args)
            return self._variable(text, index)
        raise ExpressionError(f"unexpected {text!r}")

    def _variable(self, name: str, index: str | None) -> Value:
        where, _, field = name.rpartition("/")
        where = where.upper()
        if not where and field == "TYPE":
            return Value(TYPES, "s")
        if not where and field in _SITE:
            sql, kind = _SITE[field]
            return _indexed(Value(sql, kind), index)
        if field == "GT" and where != "INFO":
            return Value(_genotype_classes(), "gt", True)
        if where in ("FMT", "FORMAT") or (not where and field not in self.header.info and field in self.header.formats and field not in _COMPUTED):
            declared = self.header.formats.get(field)
            cast = "double" if declared and declared.type in ("Integer", "Float") else "string"
            one = f"transform(split(coalesce(try_element_at(s.fields, '{field}'), '.'), ','), x -> {'try_cast(nullif(x, chr(46)) as double)' if cast == 'double' else 'nullif(x, chr(46))'})"
            return _indexed(Value(f"transform(samples, s -> {one})", "n" if cast == "double" else "s", True), index)
        if not where and field in _COMPUTED:
            return _indexed(Value(_COMPUTED[field], "n"), index)
        declared = self.header.info.get(field)
        if declared is None and where != "INFO":
            raise ExpressionError(f"unknown name {name!r}")
        if declared is not None and declared.type == "Flag":
            return Value(f"array(if(map_contains_key(info, '{field}'), 1.0D, 0.0D))", "n")
        text = f"split(coalesce(try_element_at(info, '{field}'), '.'), ',')"
        if declared is not None and declared.type in ("Integer", "Float"):
            return _indexed(Value(f"transform({text}, x -> try_cast(nullif(x, '.') as double))", "n"), index)
        return _indexed(Value(f"transform({text}, x -> nullif(x, '.'))", "s"), index)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _indexed(value: Value, index: str | None) -> Value:
    """``[i]`` an element (0-based), ``[*]`` all; for sample fields ``[s:i]`` of one sample."""
    if not index or index == "[*]":
        return value
    first, colon, second = index[1:-1].partition(":")
    if value.per_sample:
        sample, element = (first, second) if colon else (first, "*")
        sql = value.sql
        if sample not in ("*", ""):
            if sample == "" or not sample.isdigit():
                raise ExpressionError(f"index {index!r}")
            sql = f"array(get({sql}, {int(sample)}))"
            if element not in ("*", ""):
                return Value(f"array(get(get({sql}, 0), {int(element)}))", value.kind)
            return Value(f"coalesce(get({sql}, 0), array())", value.kind)
        if element in ("*", ""):
            return value
        return Value(f"transform({sql}, v -> array(get(v, {int(element)})))", value.kind, True)
    return Value(f"array(get({value.sql}, {int(first)}))", value.kind)


def _genotype_classes() -> str:
    """Per sample: GT text and the classes it belongs to (mis, ref, alt, hom, het, hap, and RR RA AA aA R A)."""
    text = "array_join(transform(s.gt.alleles, a -> coalesce(cast(a as string), '.')), if(s.gt.phased, '|', '/'))"
    plain = "array_join(transform(s.gt.alleles, a -> coalesce(cast(a as string), '.')), '/')"
    n, d = "size(s.gt.alleles)", "size(array_distinct(s.gt.alleles))"
    alts = "exists(s.gt.alleles, a -> a > 0)"
    classes = [
        f"if({_MISSING_GT}, array('mis', './.', '.'), array())",
        f"if(not {_MISSING_GT} and {n} = 1, array('hap', if({alts}, 'A', 'R')), array())",
        f"if(not {_MISSING_GT} and {n} > 1 and {d} = 1, array('hom', if({alts}, 'AA', 'RR')), array())",
        f"if(not {_MISSING_GT} and {n} > 1 and {d} > 1, array('het', if(array_contains(s.gt.alleles, 0), 'RA', 'aA')), array())",
        f"if(not {_MISSING_GT} and {alts}, array('alt'), if(not {_MISSING_GT}, array('ref'), array()))",
    ]
    return f"transform(samples, s -> concat(if(s.gt is null, array('mis'), array({text}, {plain})), {', '.join(classes)}))"


def _lift(value: Value) -> str:
    """SQL of a value per sample."""
    return value.sql if value.per_sample else f"transform(samples, s_ -> {value.sql})"


def _pairwise(a: Value, b: Value, element: str) -> Value | tuple[str, bool]:
    """Elementwise arithmetic: by element for equal lengths, a single element with each of the other side."""
    mix = "if(size({x}) = 1, transform({y}, q -> " + element.replace("P", "{x}[0]").replace("Q", "q") + "), if(size({y}) = 1, transform({x}, p -> " + element.replace("P", "p").replace("Q", "{y}[0]") + "), zip_with({x}, {y}, (p, q) -> " + element.replace("P", "p").replace("Q", "q") + ")))"
    if a.per_sample or b.per_sample:
        return Value(f"zip_with({_lift(a)}, {_lift(b)}, (u, v) -> {mix.format(x='u', y='v')})", "n", True)
    return Value(mix.format(x=f"({a.sql})", y=f"({b.sql})"), "n")


def _arithmetic(sign: str, a: Value, b: Value) -> Value:
    if not (isinstance(a, Value) and isinstance(b, Value)) or "n" != a.kind or "n" != b.kind:
        raise ExpressionError(f"{sign!r} needs numbers")
    element = {"+": "P + Q", "-": "P - Q", "*": "P * Q", "/": "try_divide(P, Q)", "%": "cast(try_mod(cast(P as bigint), cast(Q as bigint)) as double)", "&": "cast(cast(P as bigint) & cast(Q as bigint) as double)"}[sign]
    return _pairwise(a, b, element)


def _single(p: str, q: str, sign: str) -> str:
    """Numbers in single precision unless one is large; missing values as the language has them."""
    small = f"(abs({p}) <= 16777216 and abs({q}) <= 16777216)"
    test = f"if({small}, cast({p} as float) {sign} cast({q} as float), {p} {sign} {q})"
    if sign == "=":
        return f"(({p} is null and {q} is null) or coalesce({test.replace(' = ', ' = ')}, false))"
    if sign == "<>":
        return f"(({p} is null) <> ({q} is null) or coalesce({test}, false))"
    return f"coalesce({test}, false)"


def _text(p: str, q: str, sign: str) -> str:
    if sign == "=":
        return f"({p} <=> {q})"
    if sign == "<>":
        return f"not ({p} <=> {q})"
    if sign == "~":
        return f"coalesce({p} rlike {q}, false)"
    if sign == "!~":
        return f"coalesce(not {p} rlike {q}, true)"
    return f"coalesce({p} {sign} {q}, false)"


def _compare(sign: str, a, b, sets: dict[str, list[str]]) -> Truth:
    if not isinstance(a, Value) or not isinstance(b, Value):
        raise ExpressionError("a comparison of truths")
    sign = "<>" if sign == "!=" else sign
    if b.kind == "set":
        listed = ", ".join(map(_quoted, sets.get(b.sql, []))) or "null"
        inside = f"exists({a.sql}, p -> coalesce(p in ({listed}), false))"
        return Truth(inside if sign in ("=", "~") else f"not {inside}")
    if a.kind == "f" or b.kind == "f":
        return _filter_test(sign, a if a.kind == "f" else b, b if a.kind == "f" else a)
    if a.kind == "gt" or b.kind == "gt":
        classes, wanted = (a, b) if a.kind == "gt" else (b, a)
        if sign in ("~", "!~"):
            one = f"exists(v, c -> c rlike {wanted.sql}[0])"
        else:
            one = f"(array_contains(v, coalesce({wanted.sql}[0], 'mis')) or array_contains(v, lower({wanted.sql}[0])) and {wanted.sql}[0] not in ('RR','RA','AA','aA','R','A'))"
        samples = f"transform({classes.sql}, v -> {'not ' if sign in ('<>', '!~') else ''}{one})"
        return Truth(f"exists({samples}, t -> t)", samples)
    text = "s" in (a.kind, b.kind)
    if text and "n" in (a.kind, b.kind) and "cast(null as string)" not in a.sql + b.sql:
        raise ExpressionError("text compared with a number")
    test = (_text if a.kind == b.kind == "s" else _single)("p", "q", sign)
    # Different from a vector: no element of it is equal only where each differs; a pair that matches suffices otherwise.
    any_pair = "exists({x}, p -> exists({y}, q -> " + test + "))"
    if sign in ("!~",):
        any_pair = "forall({x}, p -> forall({y}, q -> " + test + "))"
    if a.per_sample or b.per_sample:
        samples = f"zip_with({_lift(a)}, {_lift(b)}, (u, v) -> {any_pair.format(x='u', y='v')})"
        return Truth(f"exists({samples}, t -> t)", samples)
    return Truth(any_pair.format(x=f"({a.sql})", y=f"({b.sql})"))


def _filter_test(sign: str, filters: Value, wanted: Value) -> Truth:
    listed = f"filter(split(coalesce({wanted.sql}[0], ''), '[;,]'), x -> x <> '' and x <> '.')"
    if sign in ("=", "<>"):
        same = f"(array_sort({filters.sql}) = array_sort({listed}))"
        return Truth(same if sign == "=" else f"not {same}")
    if sign in ("~", "!~"):
        held = f"if(size({listed}) = 0, size({filters.sql}) = 0, size(array_except({listed}, {filters.sql})) = 0)"
        return Truth(held if sign == "~" else f"not {held}")
    raise ExpressionError("filters compare by =, !=, ~ and !~")


def _truth(value) -> Truth:
    if isinstance(value, Truth):
        return value
    one = "exists({x}, p -> coalesce(p <> 0, false))" if value.kind == "n" else "exists({x}, p -> p is not null)"
    if value.per_sample:
        samples = f"transform({value.sql}, v -> {one.format(x='v')})"
        return Truth(f"exists({samples}, t -> t)", samples)
    return Truth(one.format(x=f"({value.sql})"))


def _combine(sign: str, a: Truth, b: Truth) -> Truth:
    """Sites and samples of two truths together."""
    if a.samples is None and b.samples is None:
        return Truth(f"({a.site} {'and' if '&' in sign else 'or'} {b.site})")
    x = a.samples or f"transform(samples, s_ -> {a.site})"
    y = b.samples or f"transform(samples, s_ -> {b.site})"
    if sign == "&":
        samples = f"zip_with({x}, {y}, (p, q) -> p and q)"
        return Truth(f"exists({samples}, t -> t)", samples)
    if sign == "|":
        samples = f"zip_with({x}, {y}, (p, q) -> p or q)"
        return Truth(f"exists({samples}, t -> t)", samples)
    if sign == "&&":
        site = f"({a.site} and {b.site})"
        samples = f"zip_with({x}, {y}, (p, q) -> {site} and (p or q))" if a.samples and b.samples else f"transform({a.samples or b.samples}, p -> {site} and p)"
        return Truth(site, samples)
    site = f"({a.site} or {b.site})"
    return Truth(site, f"transform(samples, s_ -> {site})")


_REDUCE = {
    "MAX": "array_max({v})",
    "MIN": "array_min({v})",
    "SUM": "aggregate({v}, 0.0D, (a, x) -> a + x)",
    "AVG": "try_divide(aggregate({v}, 0.0D, (a, x) -> a + x), size({v}))",
    "MEDIAN": "if(size({v}) = 0, null, if(size({v}) % 2 = 1, array_sort({v})[size({v}) div 2], (array_sort({v})[size({v}) div 2 - 1] + array_sort({v})[size({v}) div 2]) / 2))",
    "STDEV": "if(size({v}) = 0, null, sqrt(greatest(0.0D, aggregate({v}, 0.0D, (a, x) -> a + x * x) / size({v}) - pow(aggregate({v}, 0.0D, (a, x) -> a + x) / size({v}), 2))))",
    "COUNT": "cast(size({v}) as double)",
}
_REDUCE["MEAN"] = _REDUCE["AVG"]


def _call(name: str, args: list) -> Value | Truth:
    up = name.upper()
    if up in ("N_PASS", "F_PASS"):
        t = _truth(args[0])
        if t.samples is None:
            raise ExpressionError(f"{up} needs an expression on samples")
        n = f"cast(size(filter({t.samples}, t -> t)) as double)"
        return Value(f"array({n})" if up == "N_PASS" else f"array(try_divide({n}, size(samples)))", "n")
    a = args[0]
    if not isinstance(a, Value):
        raise ExpressionError(f"{name} needs values")
    each = up.startswith("SMPL_") or (len(name) > 1 and name[0] == "s" and name[1:] in _REDUCE)
    reduce = up.removeprefix("SMPL_") if up.startswith("SMPL_") else name[1:] if each else up
    if reduce in _REDUCE:
        present = "filter({x}, x -> x is not null)"
        if each:
            if not a.per_sample:
                raise ExpressionError(f"{name} needs a sample field")
            return Value(f"transform({a.sql}, v -> array({_REDUCE[reduce].format(v=present.format(x='v'))}))", "n", True)
        flat = f"flatten({a.sql})" if a.per_sample else a.sql
        return Value(f"array({_REDUCE[reduce].format(v='(' + present.format(x=flat) + ')')})", "n")
    one = {"ABS": "abs(x)", "STRLEN": "cast(length(x) as double)", "PHRED": "-10 * log10(x)"}.get(up)
    if one:
        if a.per_sample:
            return Value(f"transform({a.sql}, v -> transform(v, x -> {one}))", "n", True)
        return Value(f"transform({a.sql}, x -> {one})", "n")
    if up == "BINOM":
        # Twice the smaller tail for two counts, by sums of exact terms.
        if len(args) == 2:
            a = Value(f"concat({a.sql}, {args[1].sql})", "n") if not a.per_sample else Value(f"zip_with({a.sql}, {_lift(args[1])}, (u, w) -> concat(u, w))", "n", True)
        return Value(f"transform({a.sql}, v -> array({_binomial('v')}))", "n", True) if a.per_sample else Value(f"array({_binomial('(' + a.sql + ')')})", "n")
    if up == "FISHER":
        # Four counts, or two vectors of two.
        if len(args) == 2:
            a = Value(f"concat({a.sql}, {args[1].sql})", "n") if not a.per_sample else Value(f"zip_with({a.sql}, {_lift(args[1])}, (u, w) -> concat(u, w))", "n", True)
        return Value(f"transform({a.sql}, v -> array({_fisher('v')}))", "n", True) if a.per_sample else Value(f"array({_fisher('(' + a.sql + ')')})", "n")
    raise ExpressionError(f"no function {name!r}")


def _fisher(v: str) -> str:
    """SQL: the two-sided exact test of the 2 x 2 table v[0] v[1] / v[2] v[3]: tables with its margins that are no likelier.

    A table's chance against that of the first possible one is a product of ratios of neighbours; logarithms keep it in range.
    """
    a, b, c, d = (f"cast({v}[{i}] as int)" for i in range(4))
    low, high = f"greatest(0, {a} - {d})", f"least({a} + {b}, {a} + {c})"
    step = f"ln(cast(({a} + {b} - x + 1) as double)) + ln(cast(({a} + {c} - x + 1) as double)) - ln(cast(x as double)) - ln(cast(({d} - {a} + x) as double))"
    chances = f"aggregate(sequence({low}, {high}), named_struct('t', 0.0D, 'all', cast(array() as array<double>)), (s, x) -> named_struct('t', s.t + if(x = {low}, 0.0D, {step}), 'all', concat(s.all, array(s.t + if(x = {low}, 0.0D, {step})))), s -> s.all)"
    return (
        f"if(size({v}) < 4 or exists(slice({v}, 1, 4), y -> y is null), null, if({a} + {b} + {c} + {d} = 0, 1.0D, aggregate(array({chances}), 1.0D, (r, l) ->"
        f" least(1.0D, aggregate(filter(l, y -> y <= l[{a} - {low}] + 1e-7D), 0.0D, (s, y) -> s + exp(y - array_max(l))) / aggregate(l, 0.0D, (s, y) -> s + exp(y - array_max(l)))))))"
    )


def _binomial(v: str) -> str:
    """SQL: the two-sided binomial test of one half for counts v[0] and v[1]."""
    n, k = f"cast({v}[0] + {v}[1] as int)", f"cast(least({v}[0], {v}[1]) as int)"
    terms = f"aggregate(sequence(0, {k}), named_struct('t', -{n} * ln(2.0D), 's', 0.0D), (a, i) -> named_struct('t', a.t + if(i < {n}, ln(({n} - i) / (i + 1.0D)), 0.0D), 's', a.s + exp(a.t)), a -> a.s)"
    return f"if({v}[0] is null or {v}[1] is null, null, if({n} = 0, 1.0D, least(1.0D, 2 * {terms})))"


def compile_expression(text: str, header: VariantHeader, sets: dict[str, list[str]] | None = None) -> tuple[Column, Column | None]:
    """(site, samples) of an expression; ``sets`` are the lines of the files that ``@name`` stands for."""
    t = _Parser(text, header, sets or {}).whole()
    return F.expr(f"coalesce({t.site}, false)"), None if t.samples is None else F.expr(t.samples)
