"""Chat formatting by a template compiler.

A template is parsed into a syntax tree, constants are folded, and the tree is turned into nested Python closures.
The language is a sandbox: values are strings, numbers, booleans, null, lists and mappings; ``a.b`` looks up a key of
a mapping and never a Python attribute; only the filters in ``FILTERS`` can be called; the only loop runs over a list
that was passed in, so every rendering ends.

* ``{{ expression }}`` prints; ``{% if %} {% elif %} {% else %} {% endif %}``; ``{% for x in list %} {% endfor %}`` with
  ``loop.index``, ``loop.first`` and ``loop.last``; ``{% generation %} {% endgeneration %}`` marks text the loss is on.
* Expressions: literals, names, ``a.b``, ``== != in``, ``and or not``, ``~`` (joins strings), ``x | filter``, brackets.

Escaping: inside a text every backslash and every first character of a control string gets a backslash before it, so
the output can be split into turns again without doubt (:func:`parse`).

Edge cases: a null text, role or turn: empty text, empty role, first turn; turns that tie come by role, then text; the
rows with a null ``conv_id`` are one conversation; an empty table gives an empty result; other columns are ignored.
The memory of a task is bounded by its longest conversation, which is one output text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

END = "</turn>"
TEMPLATE = "{% for m in messages %}### {{ m.role | escape_role }}: {% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}" + END + "\n{% endfor %}"


def escape(text: str) -> str:
    return re.sub(r"[\\#<]", r"\\\g<0>", text)


def escape_role(text: str) -> str:
    return re.sub(r"[\\#<:]", r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


FILTERS: dict[str, Callable[[Any], Any]] = {"escape": escape, "escape_role": escape_role, "trim": lambda x: str(x).strip(), "upper": lambda x: str(x).upper(), "lower": lambda x: str(x).lower(), "length": len}


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Node:
    """kind: text, print, for, if, generation, list | const, name, key, filter, not, and, or, eq, ne, in, join."""

    kind: str
    args: tuple


def const(x: Any) -> Node:
    return Node("const", (x,))


class ExpressionParser:
    """Recursive descent, one method a level of precedence."""

    TOKEN = re.compile(r"""\s*(?:(?P<str>'[^']*'|"[^"]*")|(?P<num>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[.|~()]))""")

    def __init__(self, source: str) -> None:
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            if not (m := self.TOKEN.match(source, at)):
                raise TemplateError(f"unexpected {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        return value if kind in ("name", "op") else None

    def take(self, *values: str) -> str | None:
        if (value := self.peek()) in values:
            self.at += 1
            return value
        return None

    def name(self) -> str:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        if kind != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return value

    def parse(self) -> Node:
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def either(self) -> Node:
        node = self.both()
        while self.take("or"):
            node = Node("or", (node, self.both()))
        return node

    def both(self) -> Node:
        node = self.negated()
        while self.take("and"):
            node = Node("and", (node, self.negated()))
        return node

    def negated(self) -> Node:
        return Node("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> Node:
        node = self.joined()
        while op := self.take("==", "!=", "in"):
            node = Node({"==": "eq", "!=": "ne", "in": "in"}[op], (node, self.joined()))
        return node

    def joined(self) -> Node:
        node = self.filtered()
        while self.take("~"):
            node = Node("join", (node, self.filtered()))
        return node

    def filtered(self) -> Node:
        node = self.atom()
        while op := self.take(".", "|"):
            name = self.name()
            if op == "|" and name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            node = Node("key" if op == "." else "filter", (node, name))
        return node

    def atom(self) -> Node:
        if self.take("("):
            node = self.either()
            if not self.take(")"):
                raise TemplateError("a bracket is not closed")
            return node
        if self.at >= len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return const(value[1:-1])
        if kind == "num":
            return const(int(value))
        if kind != "name":
            raise TemplateError(f"unexpected {value!r}")
        known = {"true": True, "false": False, "none": None}
        return const(known[value]) if value in known else Node("name", (value,))


def parse_template(source: str) -> Node:
    """The syntax tree of a template."""
    parts = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", source, flags=re.S)
    at = 0

    def block(*ends: str) -> tuple[Node, str]:
        nonlocal at
        nodes = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{"):
                nodes.append(Node("print", (ExpressionParser(part[2:-2]).parse(),)))
            elif part.startswith("{%"):
                word, _, rest = part[2:-2].strip().partition(" ")
                if word in ends:
                    return Node("list", tuple(nodes)), f"{word} {rest}".strip()
                nodes.append(statement(word, rest.strip()))
            elif part:
                nodes.append(Node("text", (part,)))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return Node("list", tuple(nodes)), ""

    def statement(word: str, rest: str) -> Node:
        if word == "for":
            if not (m := re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, flags=re.S)):
                raise TemplateError(f"for {rest!r}")
            return Node("for", (m[1], ExpressionParser(m[2]).parse(), block("endfor")[0]))
        if word == "generation":
            return Node("generation", (block("endgeneration")[0],))
        if word == "if":
            test = ExpressionParser(rest).parse()
            then, end = block("elif", "else", "endif")
            if end.startswith("elif"):
                return Node("if", (test, then, statement("if", end[4:].strip())))
            return Node("if", (test, then, block("endif")[0] if end == "else" else Node("list", ())))
        raise TemplateError(f"unknown statement {word!r}")

    return block()[0]


def fold(node: Node) -> Node:
    """The same template with constant expressions computed, dead branches gone and neighbouring texts joined."""
    node = Node(node.kind, tuple(fold(x) if isinstance(x, Node) else x for x in node.args))
    kind, args = node.kind, node.args
    if kind in ("not", "eq", "ne", "in", "join", "and", "or", "filter") and all(x.kind == "const" for x in args if isinstance(x, Node)):
        return const(expression(node)({}))
    if kind == "print" and args[0].kind == "const":
        return Node("text", (show(args[0].args[0]),))
    if kind == "if" and args[0].kind == "const":
        return args[1] if args[0].args[0] else args[2]
    if kind == "list":
        flat: list[Node] = []
        for x in args:
            for y in x.args if x.kind == "list" else (x,):
                if y.kind == "text" and flat and flat[-1].kind == "text":
                    flat[-1] = Node("text", (flat[-1].args[0] + y.args[0],))
                elif y != Node("text", ("",)):
                    flat.append(y)
        return Node("list", tuple(flat))
    return node


def show(x: Any) -> str:
    return "" if x is None else str(x)


def expression(node: Node) -> Callable[[dict], Any]:
    kind, args = node.kind, node.args
    if kind == "const":
        return lambda env, x=args[0]: x
    if kind == "name":
        return lambda env, x=args[0]: env.get(x)
    a = expression(args[0])
    if kind == "key":

        def key(env: dict, name: str = args[1]) -> Any:
            found = a(env)
            return found.get(name) if isinstance(found, dict) else None

        return key
    if kind == "filter":
        return lambda env, f=FILTERS[args[1]]: f(show(x) if not isinstance(x := a(env), list) else x)
    if kind == "not":
        return lambda env: not a(env)
    b = expression(args[1])
    return {
        "and": lambda env: a(env) and b(env), "or": lambda env: a(env) or b(env), "eq": lambda env: a(env) == b(env), "ne": lambda env: a(env) != b(env),
        "in": lambda env: a(env) in (b(env) or ()), "join": lambda env: show(a(env)) + show(b(env)),
    }[kind]


class Output:
    def __init__(self) -> None:
        self.parts: list[str] = []
        self.chars = 0
        self.spans: list[tuple[int, int]] = []

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.chars += len(text)


def closure(node: Node) -> Callable[[dict, Output], None]:
    kind, args = node.kind, node.args
    if kind == "text":
        return lambda env, out, x=args[0]: out.add(x)
    if kind == "print":
        return lambda env, out, f=expression(args[0]): out.add(show(f(env)))
    if kind == "list":
        steps = tuple(closure(x) for x in args)

        def run(env: dict, out: Output) -> None:
            for step in steps:
                step(env, out)

        return run
    if kind == "if":
        test, then, other = expression(args[0]), closure(args[1]), closure(args[2])
        return lambda env, out: then(env, out) if test(env) else other(env, out)
    if kind == "generation":
        inner = closure(args[0])

        def mark(env: dict, out: Output) -> None:
            start = out.chars
            inner(env, out)
            out.spans.append((start, out.chars))

        return mark
    name, over, body = args[0], expression(args[1]), closure(args[2])

    def loop(env: dict, out: Output) -> None:
        rows = over(env) or []
        for i, row in enumerate(rows):
            body(env | {name: row, "loop": {"index": i + 1, "first": not i, "last": i + 1 == len(rows)}}, out)

    return loop


def compile_template(source: str) -> Callable[..., tuple[str, list[tuple[int, int]]]]:
    """A function of the template's variables that returns the text and the spans of its generation blocks."""
    run = closure(fold(parse_template(source)))

    def render(**env: Any) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        run(env, out)
        return "".join(out.parts), out.spans

    return render


TURN = re.compile(r"### ([^\\:#<]*(?:\\.[^\\:#<]*)*): ([^\\#<]*(?:\\.[^\\#<]*)*)" + END + "\n", flags=re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a text in the format of ``TEMPLATE``."""
    turns, at = [], 0
    while at < len(formatted):
        if not (m := TURN.match(formatted, at)):
            raise ValueError(f"no turn begins at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def format_conversations(df: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Per conversation: ``conv_id``, ``formatted`` and ``loss_spans``, pairs of code point offsets."""

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = compile_template(template)
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True))
        out, chars = [], 0
        for conv, turns in groupby(rows, key=lambda r: r[0]):
            text, spans = run(messages=[{"role": role or "", "text": said or ""} for _, role, said in turns])
            out.append({"conv_id": conv, "formatted": text, "loss_spans": [{"start": a, "stop": b} for a, b in spans]})
            chars += len(text)
            if chars > 4_000_000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, chars = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])
    by_turn = df.selectExpr("cast(conv_id as long) conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return by_turn.select("conv_id", "role", "text").mapInArrow(render, "conv_id long, formatted string, loss_spans array<struct<start:long,stop:long>>")


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts and spans say when they are read back."""

    def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, text, spans in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                turns = parse(text)
                loss = "".join(unescape(text[s["start"] : s["stop"]]) for s in spans)
                all_turns = "".join(f"{role}\n{said}\n" for role, said in turns)
                out.append((conv, len(turns), hashlib.sha256(all_turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 6, schema, strict=True)], schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    return formatted.mapInArrow(read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
