"""A small sandboxed template language, compiled to Python closures.

Text, ``{{ value }}``, ``{% if %} {% elif %} {% else %} {% endif %}``, ``{% for x in xs %} {% endfor %}``
and ``{% generation %} {% endgeneration %}``, which marks what a model is to be trained on. Values are
strings, numbers, names, fields of a row (``m.text``), ``==  !=  ~  and  or  not`` and the filters below.
Nothing can be called or reached beyond the names that rendering gives.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

Piece = tuple[str, bool]  # text, and whether it is inside a generation block
Env = dict[str, object]

TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
TOKEN = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|([A-Za-z][A-Za-z0-9_]*)|(==|!=|[.|~()]))""")
ESCAPES = {"n": "\n", "t": "\t"}


class TemplateError(ValueError):
    """The template does not follow the language, or asks for what it may not reach."""


# --- syntax tree --------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: object
    name: str


@dataclass(frozen=True)
class Filter:
    of: object
    name: str


@dataclass(frozen=True)
class Op:
    op: str
    args: tuple


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


def _text(value: object) -> str:
    return "" if value is None else str(value)


FILTERS: dict[str, Callable[[object], object]] = {
    "trim": lambda v: _text(v).strip(),
    "upper": lambda v: _text(v).upper(),
    "lower": lambda v: _text(v).lower(),
}

OPS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "~": lambda a, b: _text(a) + _text(b),
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
    "not": lambda a: not a,
}


class _Values:
    """Parser of the expression in one tag."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, object]] = []
        at = 0
        while source[at:].strip():
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:].strip()!r}")
            string, number, word, sign = m.groups()
            if string is not None:
                plain = re.sub(r"\\(.)", lambda e: ESCAPES.get(e[1], e[1]), string[1:-1])
                self.tokens.append(("const", plain))
            elif number is not None:
                self.tokens.append(("const", int(number)))
            else:
                self.tokens.append(("word", word) if word else ("sign", sign))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str, object]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, kind: str | None = None, value: object = None) -> object:
        token = self.peek()
        if (kind and token[0] != kind) or (value is not None and token[1] != value):
            raise TemplateError(f"expected {value or kind}, found {token[1]!r}")
        self.at += 1
        return token[1]

    def whole(self) -> object:
        value = self.either()
        self.take("end")
        return value

    def _chain(self, below: Callable, signs: set[str]) -> object:
        value = below()
        while self.peek()[0] != "const" and self.peek()[1] in signs:
            value = Op(str(self.take()), (value, below()))
        return value

    def either(self) -> object:
        return self._chain(self.both, {"or"})

    def both(self) -> object:
        return self._chain(self.negated, {"and"})

    def negated(self) -> object:
        if self.peek() == ("word", "not"):
            self.take()
            return Op("not", (self.negated(),))
        return self._chain(self.joined, {"==", "!="})

    def joined(self) -> object:
        return self._chain(self.filtered, {"~"})

    def filtered(self) -> object:
        value = self.atom()
        while self.peek() in (("sign", "|"), ("sign", ".")):
            sign, name = self.take(), str(self.take("word"))
            value = Filter(value, name) if sign == "|" else Field(value, name)
        return value

    def atom(self) -> object:
        kind, value = self.peek()
        self.at += 1
        if kind == "const":
            return Const(value)
        if kind == "word":
            return Const({"true": True, "false": False, "none": None}[value]) if value in ("true", "false", "none") else Name(str(value))
        if (kind, value) == ("sign", "("):
            inner = self.either()
            self.take("sign", ")")
            return inner
        raise TemplateError(f"expected a value, found {value!r}")


@dataclass
class _Block:
    kind: str
    head: object = None
    body: list = field(default_factory=list)
    branches: list = field(default_factory=list)


def parse(source: str) -> tuple:
    """The syntax tree of a template, as a tuple of nodes."""
    stack = [_Block("")]

    def close(kind: str) -> _Block:
        if stack[-1].kind != kind:
            raise TemplateError(f"end{kind} without {kind}")
        return stack.pop()

    at = 0
    for m in TAG.finditer(source):
        if m.start() > at:
            stack[-1].body.append(Const(source[at : m.start()]))
        at = m.end()
        if m[1] is not None:
            stack[-1].body.append(Output(_Values(m[1]).whole()))
            continue
        values = _Values(m[2])
        word = values.take("word")
        top = stack[-1]
        if word == "if":
            stack.append(_Block("if", values.whole()))
        elif word in ("elif", "else"):
            if top.kind != "if" or top.head is None:
                raise TemplateError(f"{word} outside an if")
            top.branches.append((top.head, tuple(top.body)))
            top.head, top.body = (values.whole() if word == "elif" else None), []
            if word == "else":
                values.take("end")
        elif word == "for":
            name = str(values.take("word"))
            values.take("word", "in")
            stack.append(_Block("for", (name, values.whole())))
        elif word == "generation":
            values.take("end")
            if any(b.kind == "generation" for b in stack):
                raise TemplateError("generation inside generation")
            stack.append(_Block("generation"))
        elif word == "endif":
            block = close("if")
            last = Const(True) if block.head is None else block.head
            stack[-1].body.append(If((*block.branches, (last, tuple(block.body)))))
        elif word == "endfor":
            block = close("for")
            stack[-1].body.append(For(*block.head, tuple(block.body)))
        elif word == "endgeneration":
            block = close("generation")
            stack[-1].body.append(Generation(tuple(block.body)))
        else:
            raise TemplateError(f"unknown tag {word!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1].kind} is not closed")
    if at < len(source):
        stack[-1].body.append(Const(source[at:]))
    return tuple(stack[-1].body)


# --- constant folding ---------------------------------------------------------------------


def fold_value(value: object, filters: dict) -> object:
    """The value with every part that needs no data worked out."""
    if isinstance(value, Field):
        return Field(fold_value(value.of, filters), value.name)
    if isinstance(value, Filter):
        of = fold_value(value.of, filters)
        if value.name not in filters:
            raise TemplateError(f"unknown filter {value.name!r}")
        return Const(filters[value.name](of.value)) if isinstance(of, Const) else Filter(of, value.name)
    if isinstance(value, Op):
        args = tuple(fold_value(a, filters) for a in value.args)
        if all(isinstance(a, Const) for a in args):
            return Const(OPS[value.op](*[a.value for a in args]))
        return Op(value.op, args)
    return value


def fold(body: tuple, filters: dict) -> tuple:
    """The body with constants worked out, dead branches gone and neighbouring texts joined."""
    done: list = []

    def add(node: object) -> None:
        if isinstance(node, Const):
            if done and isinstance(done[-1], Const):
                done[-1] = Const(done[-1].value + node.value)
            elif node.value:
                done.append(node)
        else:
            done.append(node)

    for node in body:
        if isinstance(node, Output):
            value = fold_value(node.value, filters)
            add(Const(_text(value.value)) if isinstance(value, Const) else Output(value))
        elif isinstance(node, If):
            branches = []
            for condition, inner in node.branches:
                test = fold_value(condition, filters)
                if isinstance(test, Const) and not test.value:
                    continue
                branches.append((test, fold(inner, filters)))
                if isinstance(test, Const):
                    break
            if branches and isinstance(branches[0][0], Const):
                for inner in branches[0][1]:
                    add(inner)
            elif branches:
                add(If(tuple(branches)))
        elif isinstance(node, For):
            add(For(node.name, fold_value(node.over, filters), fold(node.body, filters)))
        elif isinstance(node, Generation):
            add(Generation(fold(node.body, filters)))
        else:
            add(node)
    return tuple(done)


# --- closures -----------------------------------------------------------------------------


def value_closure(value: object, filters: dict) -> Callable[[Env], object]:
    if isinstance(value, Const):
        constant = value.value
        return lambda env: constant
    if isinstance(value, Name):
        name = value.name

        def look_up(env: Env) -> object:
            if name not in env:
                raise TemplateError(f"unknown name {name!r}")
            return env[name]

        return look_up
    if isinstance(value, Field):
        of, key = value_closure(value.of, filters), value.name

        def field_of(env: Env) -> object:
            row = of(env)
            if not isinstance(row, dict):
                raise TemplateError(f"no field {key!r} on this value")
            return row.get(key)

        return field_of
    if isinstance(value, Filter):
        of, apply = value_closure(value.of, filters), filters[value.name]
        return lambda env: apply(of(env))
    args = [value_closure(a, filters) for a in value.args]
    if value.op == "not":
        return lambda env: not args[0](env)
    left, right, op = args[0], args[1], value.op
    if op == "and":
        return lambda env: left(env) and right(env)
    if op == "or":
        return lambda env: left(env) or right(env)
    apply = OPS[op]
    return lambda env: apply(left(env), right(env))


def body_closure(body: tuple, filters: dict, marked: bool = False) -> Callable[[Env], Iterator[Piece]]:
    """A generator function that renders the body, piece by piece."""
    parts = [node_closure(node, filters, marked) for node in body]

    def render(env: Env) -> Iterator[Piece]:
        for part in parts:
            yield from part(env)

    return render


def node_closure(node: object, filters: dict, marked: bool) -> Callable[[Env], Iterable[Piece]]:
    if isinstance(node, Const):
        constant = ((node.value, marked),)
        return lambda env: constant
    if isinstance(node, Output):
        value = value_closure(node.value, filters)
        return lambda env: ((_text(value(env)), marked),)
    if isinstance(node, If):
        branches = [(value_closure(c, filters), body_closure(b, filters, marked)) for c, b in node.branches]

        def choose(env: Env) -> Iterable[Piece]:
            for test, inner in branches:
                if test(env):
                    return inner(env)
            return ()

        return choose
    if isinstance(node, For):
        name, over, inner = node.name, value_closure(node.over, filters), body_closure(node.body, filters, marked)

        def repeat(env: Env) -> Iterator[Piece]:
            for index, item in enumerate(over(env)):
                yield from inner({**env, name: item, "loop": {"index": index + 1, "first": index == 0}})

        return repeat
    return body_closure(node.body, filters, True)


def compile_template(source: str, filters: dict | None = None) -> Callable[[Env], Iterator[Piece]]:
    """A function from the names a template uses to the pieces of its text."""
    known = {**FILTERS, **(filters or {})}
    return body_closure(fold(parse(source), known), known)
