"""The alignment filter language, compiled to a column.

Grammar, weakest first: ``||``, ``&&``, ``|``, ``^``, ``&``, comparisons
(``== != =~ !~`` and ``< <= > >=``), ``+ -``, ``* / %``, unary ``! ~ + -``, then
literals, names, tags in brackets, functions and parentheses.

A value may be undefined (a tag that the read lacks): it carries through every
operator but ``exists`` and ``default``, as null does, and a filter passes only
on a defined value that is not zero or empty. ``%`` and bit operators work on
whole numbers; a remainder by zero is undefined.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import flags

_TOKEN = re.compile(r"\s*(?:(0[xX][0-9a-fA-F]+|\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+)|(\"(?:\\.|[^\"\\])*\")|(\[[A-Za-z][A-Za-z0-9](?::[A-Za-z])?\])|([A-Za-z_][\w.]*)|(\|\||&&|==|!=|=~|!~|<=|>=|[-+*/%&|^<>!~(),]))")


class ExpressionError(ValueError):
    pass


def _read_sql(kind: str, sql: str):
    return kind, F.expr(sql)


_CONSUMING = "aggregate(cigar_ops, 0L, (a, o) -> a + if(o.op in {}, o.len, 0))"
_CLIPS = "aggregate({}, named_struct('n', 0L, 'on', true), (a, o) -> named_struct('n', a.n + if(a.on and o.op = {}, o.len, 0), 'on', a.on and o.op in (4,5)), a -> a.n)"
#: Name -> (number or string, SQL over ``reads``).
VARIABLES = {
    "flag": ("n", "flag"),
    "mapq": ("n", "mapq"),
    "pos": ("n", "pos + 1"),
    "mpos": ("n", "mate_pos + 1"),
    "pnext": ("n", "mate_pos + 1"),
    "endpos": ("n", "end_pos"),
    "tlen": ("n", "tlen"),
    "refid": ("n", "tid"),
    "mrefid": ("n", "mate_tid"),
    "rname": ("s", "coalesce(rname, '*')"),
    "mrname": ("s", "coalesce(mate_rname, '*')"),
    "rnext": ("s", "coalesce(mate_rname, '*')"),
    "qname": ("s", "qname"),
    "seq": ("s", "coalesce(seq, '*')"),
    "qual": ("s", "qual"),
    "cigar": ("s", "coalesce(cigar, '*')"),
    "ncigar": ("n", "coalesce(size(cigar_ops), 0)"),
    "qlen": ("n", f"coalesce({_CONSUMING.format('(0,1,4,7,8)')}, 0L)"),
    "rlen": ("n", f"coalesce({_CONSUMING.format('(0,2,3,7,8)')}, 0L)"),
    "sclen": ("n", f"coalesce({_CONSUMING.format('(4)')}, 0L)"),
    "hclen": ("n", f"coalesce({_CONSUMING.format('(5)')}, 0L)"),
    "library": ("s", "library"),
}
_FLAG_NAMES = {**{f"flag.{k.lower()}": v for k, v in flags.BITS.items()}, "flag.proper_pair": 2, "flag.munmap": 8, "flag.mreverse": 0x20}

# A compiled value: (kind, column); kind n number, s string, b truth, q quality text (its bytes less 33 in numeric functions).


class _Parser:
    def __init__(self, text: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        while text[at:].strip():
            m = _TOKEN.match(text, at)
            if not m:
                raise ExpressionError(f"cannot read {text[at:]!r}")
            self.tokens.append(next((k, g) for k, g in zip(("number", "string", "tag", "name", "sign"), m.groups()) if g is not None))
            at = m.end()
        self.at = 0

    def accept(self, *signs: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "sign" and self.tokens[self.at][1] in signs:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def expect(self, sign: str) -> None:
        if not self.accept(sign):
            raise ExpressionError(f"{sign!r} expected")

    def whole(self):
        value = self.logic()
        if self.at < len(self.tokens):
            raise ExpressionError(f"unexpected {self.tokens[self.at][1]!r}")
        return value

    def _chain(self, below, signs: tuple[str, ...], make):
        left = below()
        while sign := self.accept(*signs):
            left = make(sign, left, below())
        return left

    def logic(self):
        """``&&`` and ``||`` from left to right, ``&&`` first."""
        return self._chain(lambda: self._chain(self.bit_or, ("&&",), lambda _, a, b: ("b", truth(a) & truth(b))), ("||",), lambda _, a, b: ("b", truth(a) | truth(b)))

    def bit_or(self):
        return self._chain(self.bit_xor, ("|",), _bits)

    def bit_xor(self):
        return self._chain(self.bit_and, ("^",), _bits)

    def bit_and(self):
        return self._chain(self.equal, ("&",), _bits)

    def equal(self):
        return self._chain(self.order, ("==", "!=", "=~", "!~"), _equal)

    def order(self):
        return self._chain(self.sum, ("<=", ">=", "<", ">"), _order)

    def sum(self):
        return self._chain(self.product, ("+", "-"), lambda s, a, b: ("n", number(a) + number(b) if s == "+" else number(a) - number(b)))

    def product(self):
        return self._chain(self.unary, ("*", "/", "%"), _product)

    def unary(self):
        if self.accept("!"):
            value = truth(self.unary())
            return ("b", F.coalesce(~value, F.lit(True)))
        if self.accept("~"):
            return ("n", F.bitwise_not(number(self.unary()).cast("bigint")).cast("double"))
        if self.accept("-"):
            return ("n", -number(self.unary()))
        if self.accept("+"):
            return ("n", number(self.unary()))
        return self.atom()

    def atom(self):
        if self.accept("("):
            value = self.logic()
            self.expect(")")
            return value
        if self.at >= len(self.tokens):
            raise ExpressionError("the expression ends early")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "number":
            return ("n", F.lit(float(int(text, 16) if text[:2].lower() == "0x" else text)))
        if kind == "string":
            return ("s", F.lit(re.sub(r"\\(.)", r"\1", text[1:-1])))
        if kind == "tag":
            return _tag_value(text[1:3])
        if kind == "name":
            if self.accept("("):
                args = [self.logic()]
                while self.accept(","):
                    args.append(self.logic())
                self.expect(")")
                return _call(text, args)
            if text in _FLAG_NAMES:
                return ("n", F.col("flag").bitwiseAND(F.lit(_FLAG_NAMES[text])).cast("double"))
            if text in VARIABLES:
                k, sql = VARIABLES[text]
                return ("q" if text == "qual" else k, F.expr(sql).cast("double") if k == "n" else F.expr(sql))
            raise ExpressionError(f"unknown name {text!r}")
        raise ExpressionError(f"unexpected {text!r}")


def _tag_value(name: str):
    """A tag is text or number as it comes; both forms are kept: (t, text, number)."""
    v = f"try_element_at(tags, '{name}')"
    return ("t", F.expr(f"{v}.s"), F.expr(f"coalesce(cast({v}.i as double), {v}.d)"))


def number(value) -> Column:
    kind, column, *rest = value
    if kind == "t":
        return rest[0]
    if kind == "b":
        return column.cast("double")
    if kind in ("s", "q"):
        raise ExpressionError("a number is needed where there is text")
    return column


def string(value) -> Column:
    if value[0] in ("n", "b"):
        raise ExpressionError("text is needed where there is a number")
    return value[1]


def truth(value) -> Column:
    """Defined and neither zero nor empty text (a text that is there counts)."""
    kind, column, *rest = value
    if kind == "b":
        return F.coalesce(column, F.lit(False))
    if kind == "t":
        return F.coalesce(column.isNotNull() | (rest[0] != 0), F.lit(False))
    if kind == "n":
        return F.coalesce(column != 0, F.lit(False))
    return column.isNotNull()


def _is_text(*values) -> bool:
    return any(v[0] in ("s", "q") for v in values)


def _bits(sign: str, a, b):
    x, y = number(a).cast("bigint"), number(b).cast("bigint")
    return ("n", {"|": x.bitwiseOR(y), "&": x.bitwiseAND(y), "^": x.bitwiseXOR(y)}[sign].cast("double"))


def _product(sign: str, a, b):
    x, y = number(a), number(b)
    if sign == "*":
        return ("n", x * y)
    if sign == "/":
        return ("n", F.try_divide(x, y))
    return ("n", F.try_mod(x.cast("bigint"), y.cast("bigint")).cast("double"))


def _equal(sign: str, a, b):
    if sign in ("=~", "!~"):
        found = F.regexp_like(string(a), string(b))
        return ("b", found if sign == "=~" else ~found)
    if _is_text(a, b):
        same = string(a) == string(b)
    elif a[0] == b[0] == "t":
        same = F.coalesce(a[1] == b[1], a[2] == b[2])
    else:
        same = number(a) == number(b)
    return ("b", same if sign == "==" else ~same)


def _order(sign: str, a, b):
    x, y = (string(a), string(b)) if _is_text(a, b) else (number(a), number(b))
    return ("b", {"<": x < y, "<=": x <= y, ">": x > y, ">=": x >= y}[sign])


def _values(value) -> Column:
    """The numbers of a quality text or of an array tag, or the one number there is."""
    kind, column, *rest = value
    if kind in ("s", "q"):
        base = 33 if kind == "q" else 0
        return F.transform(F.filter(F.split(column, ""), lambda c: c != ""), lambda c: (F.ascii(c) - base).cast("double"))
    return F.array(number(value))


def _call(name: str, args: list):
    if name == "exists" and len(args) == 1:
        a = args[0]
        return ("b", (a[1].isNotNull() | a[2].isNotNull()) if a[0] == "t" else a[1].isNotNull())
    if name == "default" and len(args) == 2:
        a, b = args
        if _is_text(a, b):
            return ("s", F.coalesce(string(a), string(b)))
        return ("n", F.coalesce(number(a), number(b)))
    if name == "length" and len(args) == 1:
        return ("n", F.length(string(args[0])).cast("double"))
    if name in ("min", "max", "avg") and len(args) == 1:
        xs = _values(args[0])
        if name == "avg":
            return ("n", F.try_divide(F.aggregate(xs, F.lit(0.0), lambda t, x: t + x), F.size(xs)))
        return ("n", F.array_min(xs) if name == "min" else F.array_max(xs))
    if name in ("exp", "log", "sqrt") and len(args) == 1:
        return ("n", {"exp": F.exp, "log": F.log, "sqrt": F.sqrt}[name](number(args[0])))
    if name == "pow" and len(args) == 2:
        return ("n", F.pow(number(args[0]), number(args[1])))
    raise ExpressionError(f"no function {name!r} of {len(args)} arguments")


def compile_value(text: str) -> Column:
    """The value of an expression, undefined as null."""
    value = _Parser(text).whole()
    return F.coalesce(value[1], value[2].cast("string")) if value[0] == "t" else value[1]


def compile_filter(text: str) -> Column:
    """True for reads that pass."""
    return truth(_Parser(text).whole())
