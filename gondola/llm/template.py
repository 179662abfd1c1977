"""A small template language, compiled to closures.

`{{ expression }}`, `{% if %}` / `{% elif %}` / `{% else %}` / `{% endif %}`, `{% for name in expression %}` / `{% endfor %}`
(with `loop.index`, `loop.first`, `loop.last`), `{% set name = expression %}`, `{% generation %}` / `{% endgeneration %}` and
`{# comments #}`. Expressions: strings, whole numbers, true, false, none, names, `a.key`, `a[key]`, `==`, `!=`, `<`, `>`, `in`,
`and`, `or`, `not`, `+` (numbers), `~` (text) and filters `x | name(argument)`.

The sandbox is the language itself: a dot or bracket looks a key up in a mapping or list and never reads a
Python attribute, nothing can be called but the given filters, and every loop runs over given data.
Constant parts are computed at compile time. Rendering is lazy: a loop over an iterator of messages holds
one message (and the next, for `loop.last`) at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

Scope = dict[str, Any]
#: (text, whether it is inside a generation block)
Part = tuple[str, bool]

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(\d+)|'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)"|([A-Za-z_]\w*)|(==|!=|[-.|()\[\]<>+~,=]))""")
_NAMED = {"true": True, "false": False, "none": None}


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Node:
    """`kind` and children; a "const" node holds its value, all others depend on the scope."""

    kind: str
    parts: tuple = ()
    value: Any = None


@dataclass
class _Reader:
    """A recursive-descent reader of one expression."""

    text: str
    tokens: list[tuple[str, Any]] = field(default_factory=list)
    at: int = 0

    def __post_init__(self):
        pos = 0
        while self.text[pos:].strip():
            m = _TOKEN.match(self.text, pos)
            if not m:
                raise TemplateError(f"unreadable: {self.text[pos:]!r}")
            number, one, two, name, sign = m.groups()
            quoted = one if one is not None else two
            if number:
                self.tokens.append(("const", int(number)))
            elif quoted is not None:
                unquote = {"n": "\n", "t": "\t"}
                self.tokens.append(("const", re.sub(r"\\(.)", lambda x: unquote.get(x[1], x[1]), quoted, flags=re.S)))
            else:
                self.tokens.append(("name", name) if name else ("sign", sign))
            pos = m.end()

    def next_is(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "const" and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value: str) -> None:
        if not self.next_is(value):
            raise TemplateError(f"{value!r} is missing in {self.text!r}")

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError(f"a name is missing in {self.text!r}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self) -> Node:
        node = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"too much in {self.text!r}")
        return node

    def either(self) -> Node:
        node = self.both()
        while self.next_is("or"):
            node = Node("or", (node, self.both()))
        return node

    def both(self) -> Node:
        node = self.negated()
        while self.next_is("and"):
            node = Node("and", (node, self.negated()))
        return node

    def negated(self) -> Node:
        return Node("not", (self.negated(),)) if self.next_is("not") else self.compared()

    def compared(self) -> Node:
        node = self.joined()
        while sign := self.next_is("==", "!=", "<", ">", "in"):
            node = Node(sign, (node, self.joined()))
        return node

    def joined(self) -> Node:
        node = self.filtered()
        while sign := self.next_is("+", "~"):
            node = Node(sign, (node, self.filtered()))
        return node

    def filtered(self) -> Node:
        node = self.reached()
        while self.next_is("|"):
            name, arguments = self.name(), ()
            if self.next_is("("):
                arguments = (self.either(),)
                self.need(")")
            node = Node("filter", (node, *arguments), name)
        return node

    def reached(self) -> Node:
        node = self.single()
        while sign := self.next_is(".", "["):
            if sign == ".":
                node = Node("key", (node, Node("const", value=self.name())))
            else:
                node = Node("key", (node, self.either()))
                self.need("]")
        return node

    def single(self) -> Node:
        if self.next_is("("):
            node = self.either()
            self.need(")")
            return node
        if self.at < len(self.tokens):
            kind, value = self.tokens[self.at]
            self.at += 1
            if kind == "const":
                return Node("const", value=value)
            if kind == "name":
                return Node("const", value=_NAMED[value]) if value in _NAMED else Node("name", value=value)
        raise TemplateError(f"a value is missing in {self.text!r}")


def parse(template: str) -> Node:
    """The template's syntax tree."""
    pieces: list[tuple[str, str]] = []
    at = 0
    for m in _TAG.finditer(template):
        pieces.append(("text", template[at : m.start()]))
        pieces.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()) if m[2] is not None else ("text", ""))
        at = m.end()
    pieces = [p for p in [*pieces, ("text", template[at:])] if p != ("text", "")]
    node, rest = _block(pieces, 0, ())
    if rest != len(pieces):
        raise TemplateError(f"unexpected tag {pieces[rest][1]!r}")
    return node


def _block(pieces: list[tuple[str, str]], at: int, ends: tuple[str, ...]) -> tuple[Node, int]:
    """Nodes up to a tag that begins with one of `ends`, and where that is."""
    out: list[Node] = []
    while at < len(pieces):
        kind, text = pieces[at]
        word, _, rest = text.partition(" ")
        if kind == "text":
            out.append(Node("out", (Node("const", value=text),)))
        elif kind == "out":
            out.append(Node("out", (_Reader(text).whole(),)))
        elif word in ends:
            return Node("all", tuple(out)), at
        elif word == "set":
            reader = _Reader(rest)
            name = reader.name()
            reader.need("=")
            out.append(Node("set", (reader.whole(),), name))
        elif word == "generation":
            body, at = _block(pieces, at + 1, ("endgeneration",))
            out.append(Node("generation", (body,)))
        elif word == "for":
            reader = _Reader(rest)
            name = reader.name()
            reader.need("in")
            body, at = _block(pieces, at + 1, ("endfor",))
            out.append(Node("for", (reader.whole(), body), name))
        elif word == "if":
            node, at = _branches(pieces, at, rest)
            out.append(node)
        else:
            raise TemplateError(f"unexpected tag {text!r}")
        at += 1
    if ends:
        raise TemplateError(f"{ends[-1]} is missing")
    return Node("all", tuple(out)), at


def _branches(pieces: list[tuple[str, str]], at: int, condition: str) -> tuple[Node, int]:
    test = _Reader(condition).whole()
    body, at = _block(pieces, at + 1, ("elif", "else", "endif"))
    word, _, rest = pieces[at][1].partition(" ")
    other = Node("all")
    if word == "elif":
        other, at = _branches(pieces, at, rest)
    elif word == "else":
        other, at = _block(pieces, at + 1, ("endif",))
    return Node("if", (test, body, other)), at


def _text(value: Any) -> str:
    return "" if value is None else "true" if value is True else "false" if value is False else str(value)


def _key(value: Any, key: Any) -> Any:
    if isinstance(value, dict):
        return value.get(key)
    if isinstance(value, (list, tuple, str)) and isinstance(key, int) and not isinstance(key, bool):
        return value[key] if -len(value) <= key < len(value) else None
    return None


_PAIRED: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
    "in": lambda a, b: a in b, "+": lambda a, b: a + b, "~": lambda a, b: _text(a) + _text(b), "key": _key,
}
FILTERS: dict[str, Callable[..., Any]] = {
    "trim": lambda x: _text(x).strip(), "upper": lambda x: _text(x).upper(), "lower": lambda x: _text(x).lower(),
    "length": len, "default": lambda x, other="": other if x is None else x,
}


def fold(node: Node, filters: dict[str, Callable[..., Any]]) -> Node:
    """The tree with constant expressions computed, decided branches chosen and neighbouring texts joined."""
    parts = tuple(fold(p, filters) for p in node.parts)
    node = Node(node.kind, parts, node.value)
    fixed = bool(parts) and all(p.kind == "const" for p in parts)
    if node.kind == "filter" and node.value not in filters:
        raise TemplateError(f"no filter {node.value!r}")
    if fixed and node.kind in _PAIRED or fixed and node.kind in ("not", "and", "or", "filter"):
        return Node("const", value=_expression(node, filters)({}))
    if node.kind == "if" and parts[0].kind == "const":
        return parts[1] if parts[0].value else parts[2]
    if node.kind == "all":
        flat: list[Node] = []
        for p in parts:
            for q in p.parts if p.kind == "all" else (p,):
                constant = q.kind == "out" and q.parts[0].kind == "const"
                if constant and flat and flat[-1].kind == "out" and flat[-1].parts[0].kind == "const":
                    q = Node("out", (Node("const", value=_text(flat.pop().parts[0].value) + _text(q.parts[0].value)),))
                flat.append(q)
        return Node("all", tuple(flat))
    return node


def _expression(node: Node, filters: dict[str, Callable[..., Any]]) -> Callable[[Scope], Any]:
    value, parts = node.value, [_expression(p, filters) for p in node.parts]
    if node.kind == "const":
        return lambda scope: value
    if node.kind == "name":
        return lambda scope: scope.get(value)
    if node.kind == "not":
        return lambda scope: not parts[0](scope)
    if node.kind == "and":
        return lambda scope: parts[0](scope) and parts[1](scope)
    if node.kind == "or":
        return lambda scope: parts[0](scope) or parts[1](scope)
    work = filters[value] if node.kind == "filter" else _PAIRED[node.kind]
    return lambda scope: work(*[p(scope) for p in parts])


def _loop(items: Iterable[Any]) -> Iterator[tuple[Any, dict[str, Any]]]:
    missing = object()
    items, index = iter(items), 0
    item = next(items, missing)
    while item is not missing:
        following = next(items, missing)
        index += 1
        yield item, {"index": index, "first": index == 1, "last": following is missing}
        item = following


def _statement(node: Node, filters, inside: bool) -> Callable[[Scope], Iterator[Part]]:
    if node.kind == "out":
        if node.parts[0].kind == "const":
            part = (_text(node.parts[0].value), inside)
            return lambda scope: iter((part,))
        value = _expression(node.parts[0], filters)
        return lambda scope: iter(((_text(value(scope)), inside),))
    if node.kind == "set":
        value, name = _expression(node.parts[0], filters), node.value

        def assign(scope: Scope) -> Iterator[Part]:
            scope[name] = value(scope)
            return iter(())

        return assign
    if node.kind == "generation":
        return _statement(node.parts[0], filters, True)
    if node.kind == "if":
        test = _expression(node.parts[0], filters)
        yes, no = (_statement(p, filters, inside) for p in node.parts[1:])
        return lambda scope: yes(scope) if test(scope) else no(scope)
    if node.kind == "for":
        items, body, name = _expression(node.parts[0], filters), _statement(node.parts[1], filters, inside), node.value

        def repeat(scope: Scope) -> Iterator[Part]:
            for item, loop in _loop(items(scope) or ()):
                yield from body({**scope, name: item, "loop": loop})

        return repeat
    parts = [_statement(p, filters, inside) for p in node.parts]

    def every(scope: Scope) -> Iterator[Part]:
        for part in parts:
            yield from part(scope)

    return every


def compile_template(template: str, filters: dict[str, Callable[..., Any]] | None = None) -> Callable[[Scope], Iterator[Part]]:
    """A function from the named values to the rendered parts, in order."""
    known = FILTERS | (filters or {})
    render = _statement(fold(parse(template), known), known, False)
    return lambda scope: (part for part in render(dict(scope)) if part[0])
