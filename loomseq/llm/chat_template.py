"""A compiler for a small sandboxed template language for conversations.

Source text is cut into text, ``{{ expression }}`` and ``{% statement %}``;
statements are ``for x in messages``, ``if``/``elif``/``else``, ``set`` and
``generation`` (what a model would have written: the loss mask). Expressions
know literals, names, ``a.b`` and ``a['b']`` on mappings, comparisons,
``and``/``or``/``not``, ``+``, ``~`` and the filters listed in ``FILTERS``.
There are no calls and no access to Python attributes, so a template reaches
nothing but its messages and constants.

The source becomes a syntax tree, whose constant parts are folded (constants
given to the compiler included), neighbouring texts joined and decided branches
taken; from the tree nested Python closures are generated, once per worker.

``control`` and ``control_name`` escape control strings reversibly: a backslash
becomes two, ``<|`` becomes ``<\\|`` (and in names a line end ``\\n``), so no text
inside a turn can look like a turn's mark.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHAT = (
    "{% for m in messages %}<|im_start|>{{ m.role | control_name }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | control }}{% endgeneration %}{% else %}{{ m.text | control }}{% endif %}"
    "<|im_end|>\n{% endfor %}"
)
#: Characters of formatted text that make one row at most, beyond a single turn.
CHUNK_CHARS = 1 << 20


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def escape_name(text: str) -> str:
    return escape(text).replace("\n", "\\n")


def unescape_name(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


FILTERS: dict[str, Callable[[str], str]] = {"control": escape, "control_name": escape_name, "trim": str.strip, "lower": str.lower, "upper": str.upper, "length": lambda v: len(v)}


class TemplateError(ValueError):
    pass


# Syntax tree: tuples (kind, ...). Expressions: const value | name n | get base key | not a | and a b | or a b |
# op symbol a b | filter name a. Statements: text s | put e | for name e body | if [(e, body)] | set name e | generation body.

_TOKEN = re.compile(r"\s*(?:(\d+)|('(?:\\.|[^'\\])*'|\"(?:\\.|[^\"\\])*\")|([A-Za-z_]\w*)|(==|!=|<=|>=|[<>+~|.\[\]()]))", re.S)
_WORDS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_COMPARE = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b}
_BINARY = _COMPARE | {"+": lambda a, b: a + b, "~": lambda a, b: _shown(a) + _shown(b)}


def _shown(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


class _Expression:
    """Recursive descent over one expression's tokens."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            at = m.end()
            number, string, word, sign = m.groups()
            if number:
                self.tokens.append(("const", int(number)))
            elif string:
                self.tokens.append(("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), string[1:-1], flags=re.S)))
            else:
                self.tokens.append(("word", word) if word else ("sign", sign))
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "const" and self.tokens[self.at][1] in values

    def accept(self, *values: str) -> str | None:
        if self.peek(*values):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def expect(self, value: str) -> None:
        if not self.accept(value):
            raise TemplateError(f"{value!r} expected")

    def whole(self):
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def either(self):
        tree = self.both()
        while self.accept("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self):
        tree = self.negated()
        while self.accept("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self):
        if self.accept("not"):
            return ("not", self.negated())
        tree = self.joined()
        while sign := self.accept(*_COMPARE):
            tree = ("op", sign, tree, self.joined())
        return tree

    def joined(self):
        tree = self.filtered()
        while sign := self.accept("+", "~"):
            tree = ("op", sign, tree, self.filtered())
        return tree

    def filtered(self):
        tree = self.atom()
        while self.accept("|"):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "word" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            tree = ("filter", name, tree)
        return tree

    def atom(self):
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "const":
            tree = ("const", value)
        elif kind == "word":
            tree = ("const", _WORDS[value]) if value in _WORDS else ("name", value)
        elif value == "(":
            tree = self.either()
            self.expect(")")
        else:
            raise TemplateError(f"unexpected {value!r}")
        while sign := self.accept(".", "["):
            if sign == ".":
                kind, key = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
                if kind != "word":
                    raise TemplateError("a name expected after '.'")
                self.at += 1
                tree = ("get", tree, ("const", key))
            else:
                tree = ("get", tree, self.either())
                self.expect("]")
        return tree


def parse(source: str) -> list:
    """The syntax tree of a template."""
    parts = re.split(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", source, flags=re.S)
    at = 0

    def block(*ends: str) -> tuple[list, str]:
        nonlocal at
        body: list = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{"):
                body.append(("put", _Expression(part[2:-2]).whole()))
            elif part.startswith("{#"):
                continue
            elif part.startswith("{%"):
                word, _, rest = part[2:-2].strip("- \n\t").partition(" ")
                if word in ends:
                    return body, f"{word} {rest}".strip()
                if word == "for":
                    name, _, over = rest.partition(" in ")
                    body.append(("for", name.strip(), _Expression(over).whole(), block("endfor")[0]))
                elif word == "if":
                    arms, test = [], _Expression(rest).whole()
                    while True:
                        inner, end = block("elif", "else", "endif")
                        arms.append((test, inner))
                        if end == "endif":
                            break
                        test = _Expression(end[5:]).whole() if end.startswith("elif") else ("const", True)
                    body.append(("if", arms))
                elif word == "set":
                    name, _, value = rest.partition("=")
                    body.append(("set", name.strip(), _Expression(value).whole()))
                elif word == "generation":
                    body.append(("generation", block("endgeneration")[0]))
                else:
                    raise TemplateError(f"unknown statement {word!r}")
            elif part:
                body.append(("text", part))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return body, ""

    return block()[0]


def fold(tree: tuple, constants: dict) -> tuple:
    """An expression with its constant parts computed."""
    kind = tree[0]
    if kind == "name":
        return ("const", constants[tree[1]]) if tree[1] in constants else tree
    if kind == "const":
        return tree
    parts = [fold(t, constants) if isinstance(t, tuple) else t for t in tree[1:]]
    new = (kind, *parts)
    inner = [t for t in parts if isinstance(t, tuple)]
    if kind in ("and", "or") and parts[0][0] == "const":
        return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
    if all(t[0] == "const" for t in inner):
        return ("const", expression(new)({}))
    return new


def fold_block(body: list, constants: dict) -> list:
    """Statements with folded expressions, decided branches taken and neighbouring texts joined."""
    out: list = []

    def add(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    constants = dict(constants)
    for node in body:
        kind = node[0]
        if kind == "put":
            e = fold(node[1], constants)
            add(("text", _shown(e[1])) if e[0] == "const" else ("put", e))
        elif kind == "for":
            inner = {k: v for k, v in constants.items() if k not in (node[1], "loop", *_assigned(node[3]))}
            add(("for", node[1], fold(node[2], constants), fold_block(node[3], inner)))
            constants = {k: v for k, v in constants.items() if k not in _assigned(node[3])}
        elif kind == "if":
            arms = []
            for test, inner in node[1]:
                test = fold(test, constants)
                if test[0] == "const" and not test[1]:
                    continue
                arms.append((test, fold_block(inner, constants)))
                if test[0] == "const":
                    break
            if arms and arms[0][0][0] == "const" and not _assigned(arms[0][1]):
                for n in arms[0][1]:
                    add(n)
            elif arms:
                add(("if", arms))
            constants = {k: v for k, v in constants.items() if k not in _assigned([node])}
        elif kind == "set":
            e = fold(node[2], constants)
            add(("set", node[1], e))
            constants = constants | {node[1]: e[1]} if e[0] == "const" else {k: v for k, v in constants.items() if k != node[1]}
        elif kind == "generation":
            add(("generation", fold_block(node[1], constants)))
        else:
            add(node)
    return out


def _assigned(body: list) -> set:
    names: set = set()
    for node in body:
        if node[0] == "set":
            names.add(node[1])
        elif node[0] == "for":
            names |= {node[1]} | _assigned(node[3])
        elif node[0] == "if":
            names |= {n for _, inner in node[1] for n in _assigned(inner)}
        elif node[0] == "generation":
            names |= _assigned(node[1])
    return names


def _names(tree) -> set:
    """Names that a tree, or a list of trees, reads."""
    if isinstance(tree, list):
        return {n for t in tree for n in _names(t)}
    if not isinstance(tree, tuple):
        return set()
    return {tree[1]} if tree[0] == "name" else {n for t in tree for n in _names(t)}


def expression(tree: tuple) -> Callable[[dict], object]:
    """The closure of an expression."""
    kind = tree[0]
    if kind == "const":
        value = tree[1]
        return lambda env: value
    if kind == "name":
        name = tree[1]
        return lambda env: env.get(name)
    if kind == "get":
        base, key = expression(tree[1]), expression(tree[2])
        return lambda env: b.get(key(env)) if isinstance(b := base(env), dict) else None
    if kind == "filter":
        call, inner = FILTERS[tree[1]], expression(tree[2])
        return lambda env: call(_shown(inner(env)))
    if kind == "not":
        inner = expression(tree[1])
        return lambda env: not inner(env)
    a, b = expression(tree[-2]), expression(tree[-1])
    if kind == "and":
        return lambda env: a(env) and b(env)
    if kind == "or":
        return lambda env: a(env) or b(env)
    call = _BINARY[tree[1]]
    return lambda env: call(a(env), b(env))


@dataclass
class Output:
    """Formatted text and the spans of it under generation marks."""

    parts: list = field(default_factory=list)
    size: int = 0
    spans: list = field(default_factory=list)

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)

    def text(self) -> str:
        return "".join(self.parts)


def statements(body: list) -> Callable[[dict, Output], None]:
    """The closure of a block."""
    steps = [_statement(n) for n in body]

    def run(env: dict, out: Output) -> None:
        for step in steps:
            step(env, out)

    return steps[0] if len(steps) == 1 else run


def _statement(node: tuple) -> Callable[[dict, Output], None]:
    kind = node[0]
    if kind == "text":
        text = node[1]
        return lambda env, out: out.add(text)
    if kind == "put":
        value = expression(node[1])
        return lambda env, out: out.add(_shown(value(env)))
    if kind == "set":
        name, value = node[1], expression(node[2])
        return lambda env, out: env.__setitem__(name, value(env))
    if kind == "generation":
        inner = statements(node[1])

        def generation(env: dict, out: Output) -> None:
            start = out.size
            inner(env, out)
            out.spans.append((start, out.size))

        return generation
    if kind == "if":
        arms = [(expression(test), statements(inner)) for test, inner in node[1]]

        def choose(env: dict, out: Output) -> None:
            for test, inner in arms:
                if test(env):
                    return inner(env, out)

        return choose
    name, over, inner = node[1], expression(node[2]), statements(node[3])

    def loop(env: dict, out: Output) -> None:
        items = over(env) or []
        for i, item in enumerate(items):
            inner(env | {name: item, "loop": {"index0": i, "index": i + 1, "first": i == 0, "last": i == len(items) - 1}}, out)

    return loop


class Template:
    """A compiled template: ``render(messages)`` for a whole conversation, ``turn(message)`` for one turn of a streamable one."""

    def __init__(self, source: str = CHAT, constants: dict | None = None):
        self.tree = fold_block(parse(source), constants or {})
        self._all = statements(self.tree)
        loops = [i for i, n in enumerate(self.tree) if n[0] == "for" and n[2] == ("name", "messages")]
        self.streamable = (
            len(loops) == 1
            and all(n[0] == "text" for i, n in enumerate(self.tree) if i not in loops)
            and not _names([self.tree[loops[0]][3]]) - {self.tree[loops[0]][1]}
            and not _assigned(self.tree[loops[0]][3])
        )
        if self.streamable:
            k = loops[0]
            self.before, self.after = ("".join(n[1] for n in part) for part in (self.tree[:k], self.tree[k + 1 :]))
            self._name, self._body = self.tree[k][1], statements(self.tree[k][3])

    def render(self, messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        """Formatted text and generation spans, in code points."""
        out = Output()
        self._all({"messages": messages}, out)
        return out.text(), out.spans

    def turn(self, message: dict, out: Output) -> None:
        self._body({self._name: message}, out)


_templates: dict[str, Template] = {}


def compiled(source: str) -> Template:
    """This worker's compilation of a template."""
    if source not in _templates:
        _templates[source] = Template(source)
    return _templates[source]


_CHUNK = "conv_id long, chunk long, text string, spans array<long>"


def formatted_chunks(conversations: DataFrame, template: str = CHAT) -> DataFrame:
    """Conversations as formatted text, in chunks of whole turns: conv_id, chunk (their order), text, spans.

    Rows (conv_id, turn, role, text) are dealt by ranges of conversation and
    turn, so that a conversation of any length is formatted by many tasks;
    ``spans`` are starts and ends, by turns, of generated text in the chunk.
    Ties in ``turn`` go by role and text; null role and text are empty; rows of
    null id make one conversation; text around the template's loop is not
    repeated here but found as ``before`` and ``after`` of the template.
    """
    if not compiled(template).streamable:
        raise TemplateError("chunks need a template whose only statement on top is a loop over messages that looks at its own message alone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        turn = compiled(template).turn
        number = TaskContext.get().partitionId() << 40
        at, out, done = None, Output(), []

        def close() -> None:
            nonlocal out, number
            if out.parts:
                done.append((at, number, out.text(), [x for s in out.spans for x in s]))
                number += 1
            out = Output()

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())))], names=["conv_id", "chunk", "text", "spans"])
            done.clear()
            return made

        for rows in batches:
            for conv, role, text in zip(*(rows.column(k).to_pylist() for k in range(3))):
                if conv != at or out.size >= CHUNK_CHARS:
                    close()
                    at = conv
                turn({"role": role, "text": text}, out)
            if done:
                yield batch()
        close()
        if done:
            yield batch()

    order = ["conv_id", "turn", "role", "text"]
    rows = conversations.select(F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.repartitionByRange("conv_id", "turn", "role", F.xxhash64("text")).sortWithinPartitions(*order)
    return dealt.select("conv_id", "role", "text").mapInArrow(run, _CHUNK)


def turns_of(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of text that ``CHAT`` formatted."""
    at = 0
    while at < len(text):
        head = text.index("\n", at)
        if not text.startswith("<|im_start|>", at):
            raise ValueError("no turn where one should start")
        end = text.index("<|im_end|>\n", head + 1)
        yield unescape_name(text[at + 12 : head]), unescape(text[head + 1 : end])
        at = end + 11


_SUMMARY = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(chunks: DataFrame) -> DataFrame:
    """Per conversation, from its formatted chunks in order: counts and digests of turns and of what the loss mask covers.

    A conversation's chunks stream through one task (a digest of its whole text
    has to), which holds one chunk at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, done, any_yet = None, None, [], False

        def close() -> None:
            if state:
                done.append((at, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))], names=[f.split()[0] for f in _SUMMARY.split(", ")])
            done.clear()
            return made

        for rows in batches:
            for i in range(rows.num_rows):
                conv, text, spans = (rows.column(k)[i].as_py() for k in range(3))
                if conv != at or not any_yet:
                    close()
                    at, state, any_yet = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0], True
                for role, said in turns_of(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode("utf-8", "replace"))
                for a, b in zip(spans[::2], spans[1::2]):
                    loss = unescape(text[a:b])
                    state[2] += len(loss)
                    state[3].update(loss.encode("utf-8", "replace"))
                state[4] += len(text)
            if done:
                yield batch()
        close()
        if done:
            yield batch()

    dealt = chunks.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return dealt.select("conv_id", "text", "spans").mapInArrow(run, _SUMMARY)
