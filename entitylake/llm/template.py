"""A small sandboxed template language, compiled to Python closures.

Text with ``{{ expression }}``, ``{% for x in list %}``, ``{% if %}{% elif %}{% else %}``,
``{% generation %}`` and ``{# comment #}``; a minus sign inside a tag trims the white space next
to it. Expressions have strings, whole numbers, true, false, none, names, ``a.b`` and ``a['b']``,
``== !=``, ``and or not``, ``~`` (joins text) and ``| filter``.

A name reads what the caller passes in and what loops bind, a member reads a key of a mapping:
no attribute, call or import of Python can be reached. A template is parsed to a tree, constant
parts are folded, and each node becomes a closure that yields pieces of text, each with whether
it lies inside a generation block. Lists may be iterators: loops look one item ahead at most,
so a rendering of any length needs the memory of one item.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from typing import Any

Piece = tuple[str, bool]
Scope = dict[str, Any]
Value = Callable[[Scope], Any]
Writer = Callable[[Scope, bool], Iterator[Piece]]


class TemplateError(ValueError):
    """The template doesn't follow the language."""


@dataclass(frozen=True)
class Constant:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Member:
    whole: Any
    key: str


@dataclass(frozen=True)
class Apply:
    """An operator or filter over its operands."""

    what: str
    operands: tuple


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class Block:
    parts: tuple


@dataclass(frozen=True)
class Loop:
    name: str
    items: Any
    body: Block


@dataclass(frozen=True)
class Choice:
    """Conditions with their blocks; the last condition is the constant true for an else."""

    cases: tuple


@dataclass(frozen=True)
class Generation:
    body: Block


def _shown(value: Any) -> str:
    return "" if value is None else str(value)


OPERATORS: dict[str, Callable[..., Any]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "and": lambda a, b: bool(a) and bool(b),
    "or": lambda a, b: bool(a) or bool(b),
    "not": lambda a: not a,
    "~": lambda a, b: _shown(a) + _shown(b),
}
FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda a: _shown(a).strip(),
    "lower": lambda a: _shown(a).lower(),
    "upper": lambda a: _shown(a).upper(),
    "length": lambda a: len(_shown(a)),
}

_TAG = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<word>\w+)|(?P<sign>==|!=|[~|.()\[\]]))", re.S)
_ESCAPES = {"n": "\n", "t": "\t"}


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str) -> None:
        self.tokens: list[tuple[str, str]] = []
        at, source = 0, source.rstrip()
        while at < len(source):
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"unexpected {source[at:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "text" else None

    def take(self, wanted: str) -> bool:
        if self.peek() == wanted:
            self.at += 1
            return True
        return False

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} expected")

    def all(self) -> Any:
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def either(self) -> Any:
        tree = self.both()
        while self.take("or"):
            tree = Apply("or", (tree, self.both()))
        return tree

    def both(self) -> Any:
        tree = self.negated()
        while self.take("and"):
            tree = Apply("and", (tree, self.negated()))
        return tree

    def negated(self) -> Any:
        return Apply("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> Any:
        tree = self.joined()
        if (sign := self.peek()) in ("==", "!="):
            self.at += 1
            tree = Apply(sign, (tree, self.joined()))
        return tree

    def joined(self) -> Any:
        tree = self.filtered()
        while self.take("~"):
            tree = Apply("~", (tree, self.filtered()))
        return tree

    def filtered(self) -> Any:
        tree = self.member()
        while self.take("|"):
            tree = Apply(f"|{self.word()}", (tree,))
        return tree

    def member(self) -> Any:
        tree = self.atom()
        while True:
            if self.take("."):
                tree = Member(tree, self.word())
            elif self.take("["):
                key = self.either()
                self.need("]")
                if not isinstance(key, Constant):
                    raise TemplateError("a member's key is a constant")
                tree = Member(tree, str(key.value))
            else:
                return tree

    def word(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "word":
            raise TemplateError("a name expected")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def atom(self) -> Any:
        if self.take("("):
            tree = self.either()
            self.need(")")
            return tree
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return Constant(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "number":
            return Constant(int(text))
        if kind != "word":
            raise TemplateError(f"unexpected {text!r}")
        return Constant({"true": True, "false": False, "none": None}[text]) if text in ("true", "false", "none") else Name(text)


class _Parser:
    """Tags and text to a tree."""

    def __init__(self, source: str) -> None:
        self.parts, trim = [], False
        for k, part in enumerate(_TAG.split(source)):
            if k % 2 == 0:
                part = part.lstrip() if trim else part
                trim = False
                if part:
                    self.parts.append(("text", part))
                continue
            if part.startswith("{#"):
                continue
            inner = part[2:-2]
            if inner.startswith("-"):
                inner = inner[1:]
                if self.parts and self.parts[-1][0] == "text":
                    self.parts[-1] = ("text", self.parts[-1][1].rstrip())
            if inner.endswith("-"):
                inner, trim = inner[:-1], True
            self.parts.append(("show" if part.startswith("{{") else "tag", inner.strip()))
        self.at = 0

    def block(self, *ends: str) -> tuple[Block, str]:
        """The parts up to a tag that begins with one of ``ends``, and that tag."""
        found = []
        while self.at < len(self.parts):
            kind, text = self.parts[self.at]
            self.at += 1
            if kind == "text":
                found.append(Output(Constant(text)))
            elif kind == "show":
                found.append(Output(_Expression(text).all()))
            elif text.split(" ")[0] in ends:
                return Block(tuple(found)), text
            else:
                found.append(self.statement(text))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return Block(tuple(found)), ""

    def statement(self, text: str) -> Any:
        if loop := re.fullmatch(r"for\s+(\w+)\s+in\s+(.+)", text, re.S):
            body, _ = self.block("endfor")
            return Loop(loop[1], _Expression(loop[2]).all(), body)
        if text == "generation":
            return Generation(self.block("endgeneration")[0])
        if text.startswith("if "):
            cases, condition = [], _Expression(text[3:]).all()
            while True:
                body, end = self.block("elif", "else", "endif")
                cases.append((condition, body))
                if end.startswith("elif "):
                    condition = _Expression(end[5:]).all()
                elif end == "else":
                    cases.append((Constant(True), self.block("endif")[0]))
                    return Choice(tuple(cases))
                else:
                    return Choice(tuple(cases))
        raise TemplateError(f"unknown tag {text!r}")


@dataclass
class Template:
    """A compiled template: call ``pieces`` or ``render`` with the names it reads."""

    source: str
    filters: Mapping[str, Callable[[Any], Any]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.known = {**FILTERS, **self.filters}
        self.tree = self.fold(_Parser(self.source).block()[0])
        self.write = self.writer(self.tree)

    def fold(self, node: Any) -> Any:
        """The tree with constant expressions computed, settled branches taken and constant text joined."""
        if isinstance(node, Apply):
            operands = tuple(self.fold(x) for x in node.operands)
            if all(isinstance(x, Constant) for x in operands):
                return Constant(self.function(node.what)(*(x.value for x in operands)))
            return Apply(node.what, operands)
        if isinstance(node, Member):
            return Member(self.fold(node.whole), node.key)
        if isinstance(node, Output):
            value = self.fold(node.value)
            return Output(Constant(_shown(value.value)) if isinstance(value, Constant) else value)
        if isinstance(node, Loop):
            return Loop(node.name, self.fold(node.items), self.fold(node.body))
        if isinstance(node, Generation):
            return Generation(self.fold(node.body))
        if isinstance(node, Choice):
            cases = []
            for condition, body in node.cases:
                condition = self.fold(condition)
                if isinstance(condition, Constant) and not condition.value:
                    continue
                cases.append((condition, self.fold(body)))
                if isinstance(condition, Constant):
                    break
            if cases and isinstance(cases[0][0], Constant):
                return cases[0][1]
            return Choice(tuple(cases))
        if isinstance(node, Block):
            parts: list[Any] = []
            for part in (self.fold(x) for x in node.parts):
                for one in part.parts if isinstance(part, Block) else (part,):
                    if isinstance(one, Output) and isinstance(one.value, Constant):
                        if not one.value.value:
                            continue
                        if parts and isinstance(parts[-1], Output) and isinstance(parts[-1].value, Constant):
                            one = Output(Constant(parts.pop().value.value + one.value.value))
                    parts.append(one)
            return Block(tuple(parts))
        return node

    def function(self, what: str) -> Callable[..., Any]:
        table, name = (self.known, what[1:]) if what.startswith("|") else (OPERATORS, what)
        if name not in table:
            raise TemplateError(f"unknown filter {name!r}")
        return table[name]

    def value(self, node: Any) -> Value:
        """A closure that computes an expression."""
        if isinstance(node, Constant):
            return lambda scope: node.value
        if isinstance(node, Name):
            return lambda scope: scope.get(node.name)
        if isinstance(node, Member):
            whole = self.value(node.whole)

            def member(scope: Scope) -> Any:
                found = whole(scope)
                return found.get(node.key) if isinstance(found, Mapping) else None

            return member
        function, operands = self.function(node.what), [self.value(x) for x in node.operands]
        if len(operands) == 1:
            only = operands[0]
            return lambda scope: function(only(scope))
        left, right = operands
        return lambda scope: function(left(scope), right(scope))

    def writer(self, node: Any) -> Writer:
        """A closure that yields the pieces of a node."""
        if isinstance(node, Output):
            if isinstance(node.value, Constant):
                text = node.value.value
                return lambda scope, inside: iter(((text, inside),))
            value = self.value(node.value)
            return lambda scope, inside: iter(((_shown(value(scope)), inside),))
        if isinstance(node, Generation):
            body = self.writer(node.body)
            return lambda scope, inside: body(scope, True)
        if isinstance(node, Block):
            parts = [self.writer(x) for x in node.parts]

            def block(scope: Scope, inside: bool) -> Iterator[Piece]:
                for part in parts:
                    yield from part(scope, inside)

            return block
        if isinstance(node, Choice):
            cases = [(self.value(condition), self.writer(body)) for condition, body in node.cases]

            def choice(scope: Scope, inside: bool) -> Iterator[Piece]:
                for condition, body in cases:
                    if condition(scope):
                        yield from body(scope, inside)
                        return

            return choice
        items, body = self.value(node.items), self.writer(node.body)

        def loop(scope: Scope, inside: bool) -> Iterator[Piece]:
            index = 0
            for item, last in _with_last(items(scope) or ()):
                place = {"index": index + 1, "index0": index, "first": index == 0, "last": last}
                yield from body({**scope, node.name: item, "loop": place}, inside)
                index += 1

        return loop

    def pieces(self, **names: Any) -> Iterator[Piece]:
        """Pieces of the rendering, each with whether the model is to generate it."""
        return self.write(names, False)

    def render(self, **names: Any) -> tuple[str, list[tuple[int, int]]]:
        """The whole text, and the ranges of code points inside generation blocks."""
        texts, spans, at = [], [], 0
        for text, inside in self.pieces(**names):
            if inside and text:
                if spans and spans[-1][1] == at:
                    spans[-1] = (spans[-1][0], at + len(text))
                else:
                    spans.append((at, at + len(text)))
            texts.append(text)
            at += len(text)
        return "".join(texts), spans


def _with_last(items: Iterable[Any]) -> Iterator[tuple[Any, bool]]:
    """Items, each with whether it is the last: one item ahead."""
    rest = iter(items)
    for held in rest:
        for after in rest:
            yield held, False
            held = after
        yield held, True
