"""A small sandboxed template language, compiled to Python closures.

    {{ expr }}   {% if a %}..{% elif b %}..{% else %}..{% endif %}   {% set x = expr %}
    {% for m in messages %}..{% endfor %}   {% generation %}..{% endgeneration %}

Expressions know strings, whole numbers, true, false, none, names, `m.key` and `m["key"]` on
mappings, `+`, `==`, `!=`, `in`, `and`, `or`, `not`, parentheses and filters `value | name`.
There are no calls, no Python attributes and no names beyond those given, so a template can
reach nothing but its data. Within `for`, `loop.first`, `loop.last` and `loop.index0` are set.

Parsing gives a syntax tree of tuples (kind, ...). Folding evaluates what holds no name,
drops dead branches and joins adjacent text. Compiling turns each node into a closure that
yields (text, marked); the loop reads its messages one ahead, so they may be a stream.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

Piece = tuple[str, bool]


class TemplateError(ValueError):
    """The template is not well formed or asks for something unknown."""


_CHUNK = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<text>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|[|+().\[\]]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t"}
_WORDS = {"true": True, "false": False, "none": None}
_RESERVED = {"and", "or", "not", "in"}


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "text" and self.tokens[self.at][1] in values

    def take(self, *values: str) -> str | None:
        if self.peek(*values):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} expected")

    def name(self) -> str:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
        if kind != "name" or value in _RESERVED:
            raise TemplateError("a name is expected")
        self.at += 1
        return value

    def whole(self) -> tuple:
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} is not expected")
        return tree

    def either(self) -> tuple:
        tree = self.both()
        while self.take("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self) -> tuple:
        tree = self.negated()
        while self.take("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        tree = self.added()
        while sign := self.take("==", "!=", "in"):
            tree = (sign, tree, self.added())
        return tree

    def added(self) -> tuple:
        tree = self.filtered()
        while self.take("+"):
            tree = ("+", tree, self.filtered())
        return tree

    def filtered(self) -> tuple:
        tree = self.atom()
        while True:
            if self.take("."):
                tree = ("item", tree, ("const", self.name()))
            elif self.take("["):
                tree = ("item", tree, self.either())
                self.need("]")
            elif self.take("|"):
                tree = ("filter", self.name(), tree)
            else:
                return tree

    def atom(self) -> tuple:
        if self.take("("):
            tree = self.either()
            self.need(")")
            return tree
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, value = self.tokens[self.at]
        if kind == "text":
            self.at += 1
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "number":
            self.at += 1
            return ("const", int(value))
        name = self.name()
        return ("const", _WORDS[name]) if name in _WORDS else ("name", name)


def parse(source: str) -> list[tuple]:
    """The syntax tree of a template: a list of nodes."""
    steps, at = [], 0
    for m in _CHUNK.finditer(source):
        steps.append(("text", source[at : m.start()]))
        steps.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    steps.append(("text", source[at:]))
    steps.reverse()

    def block(*ends: str) -> tuple[list[tuple], str]:
        nodes: list[tuple] = []
        while steps:
            kind, body = steps.pop()
            if kind == "text":
                if "{%" in body or "{{" in body:
                    raise TemplateError("a tag is not closed")
                nodes.append(("out", ("const", body)))
                continue
            if kind == "out":
                nodes.append(("out", _Expression(body).whole()))
                continue
            word, _, rest = body.partition(" ")
            if word in ends:
                return nodes, body
            if word == "if":
                arms, test = [], _Expression(rest).whole()
                while True:
                    inner, end = block("elif", "else", "endif")
                    arms.append((test, inner))
                    if end == "endif":
                        break
                    if end.startswith("elif"):
                        test = _Expression(end[4:]).whole()
                    else:
                        arms.append((("const", True), block("endif")[0]))
                        break
                nodes.append(("if", arms))
            elif word == "for":
                m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
                if not m:
                    raise TemplateError("for NAME in EXPRESSION is expected")
                nodes.append(("for", m[1], _Expression(m[2]).whole(), block("endfor")[0]))
            elif word == "set":
                name, found, value = rest.partition("=")
                if not found or not re.fullmatch(r"[A-Za-z_]\w*", name.strip()):
                    raise TemplateError("set NAME = EXPRESSION is expected")
                nodes.append(("set", name.strip(), _Expression(value).whole()))
            elif word == "generation":
                nodes.append(("generation", block("endgeneration")[0]))
            else:
                raise TemplateError(f"unknown tag {word!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return nodes, ""

    return block()[0]


def _value(tree: tuple, filters: dict[str, Callable[[str], str]]) -> Callable[[dict], object]:
    """A closure that evaluates an expression in a scope."""
    kind = tree[0]
    if kind == "const":
        fixed = tree[1]
        return lambda scope: fixed
    if kind == "name":
        name = tree[1]

        def look(scope: dict) -> object:
            if name not in scope:
                raise TemplateError(f"unknown name {name!r}")
            return scope[name]

        return look
    if kind == "item":
        of, key = _value(tree[1], filters), _value(tree[2], filters)

        def item(scope: dict) -> object:
            holder = of(scope)
            if not isinstance(holder, dict):
                raise TemplateError("only mappings have items")
            return holder.get(key(scope))

        return item
    if kind == "filter":
        if tree[1] not in filters:
            raise TemplateError(f"unknown filter {tree[1]!r}")
        apply, inner = filters[tree[1]], _value(tree[2], filters)
        return lambda scope: apply(_shown(inner(scope)))
    if kind == "not":
        inner = _value(tree[1], filters)
        return lambda scope: not inner(scope)
    left, right = _value(tree[1], filters), _value(tree[2], filters)
    if kind == "and":
        return lambda scope: left(scope) and right(scope)
    if kind == "or":
        return lambda scope: left(scope) or right(scope)
    if kind == "==":
        return lambda scope: left(scope) == right(scope)
    if kind == "!=":
        return lambda scope: left(scope) != right(scope)
    if kind == "in":
        return lambda scope: left(scope) in (right(scope) or ())
    return lambda scope: _shown(left(scope)) + _shown(right(scope))


def _shown(value: object) -> str:
    return "" if value is None else str(value)


def _fold_value(tree: tuple, filters: dict) -> tuple:
    if tree[0] in ("const", "name"):
        return tree
    if tree[0] == "filter":
        tree = ("filter", tree[1], _fold_value(tree[2], filters))
        fixed = tree[2][0] == "const"
    else:
        parts = [_fold_value(t, filters) for t in tree[1:]]
        tree = (tree[0], *parts)
        fixed = all(p[0] == "const" for p in parts) and tree[0] != "item"
        if tree[0] in ("and", "or") and parts[0][0] == "const":
            return parts[1] if bool(parts[0][1]) == (tree[0] == "and") else parts[0]
    return ("const", _value(tree, filters)({})) if fixed else tree


def fold(nodes: list[tuple], filters: dict[str, Callable[[str], str]]) -> list[tuple]:
    """The same tree with constants evaluated, dead branches dropped and adjacent text joined."""
    out: list[tuple] = []

    def put(node: tuple) -> None:
        if node[0] == "out" and node[1][0] == "const":
            text = _shown(node[1][1])
            if out and out[-1][0] == "out" and out[-1][1][0] == "const":
                text = out.pop()[1][1] + text
            node = ("out", ("const", text))
            if not text:
                return
        out.append(node)

    for node in nodes:
        kind = node[0]
        if kind == "out":
            put(("out", _fold_value(node[1], filters)))
        elif kind == "set":
            put(("set", node[1], _fold_value(node[2], filters)))
        elif kind == "for":
            put(("for", node[1], _fold_value(node[2], filters), fold(node[3], filters)))
        elif kind == "generation":
            put(("generation", fold(node[1], filters)))
        else:
            arms = []
            for test, inner in node[1]:
                test = _fold_value(test, filters)
                if test[0] == "const" and not test[1]:
                    continue
                arms.append((test, fold(inner, filters)))
                if test[0] == "const":
                    break
            if arms and arms[0][0][0] == "const":
                for inner in arms[0][1]:
                    put(inner)
            elif arms:
                put(("if", arms))
    return out


def _closure(nodes: list[tuple], filters: dict) -> Callable[[dict, bool], Iterator[Piece]]:
    steps = [_step(n, filters) for n in nodes]

    def run(scope: dict, marked: bool) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope, marked)

    return run


def _step(node: tuple, filters: dict) -> Callable[[dict, bool], Iterable[Piece]]:
    kind = node[0]
    if kind == "out":
        value = _value(node[1], filters)
        return lambda scope, marked: ((_shown(value(scope)), marked),)
    if kind == "set":
        name, value = node[1], _value(node[2], filters)

        def assign(scope: dict, marked: bool) -> Iterable[Piece]:
            scope[name] = value(scope)
            return ()

        return assign
    if kind == "generation":
        inner = _closure(node[1], filters)
        return lambda scope, marked: inner(scope, True)
    if kind == "if":
        arms = [(_value(test, filters), _closure(inner, filters)) for test, inner in node[1]]

        def choose(scope: dict, marked: bool) -> Iterator[Piece]:
            for test, inner in arms:
                if test(scope):
                    yield from inner(scope, marked)
                    return

        return choose
    name, items, inner = node[1], _value(node[2], filters), _closure(node[3], filters)

    def each(scope: dict, marked: bool) -> Iterator[Piece]:
        rows, none = iter(items(scope) or ()), object()
        row, index = next(rows, none), 0
        while row is not none:
            following = next(rows, none)
            here = scope | {name: row, "loop": {"first": index == 0, "last": following is none, "index0": index}}
            yield from inner(here, marked)
            row, index = following, index + 1

    return each


def compile_template(source: str, filters: dict[str, Callable[[str], str]]) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from messages to (text, marked) pieces; names and filters are checked as far as they are known."""
    run = _closure(fold(parse(source), filters), filters)

    def render(messages: Iterable[dict], **names: object) -> Iterator[Piece]:
        return run({"messages": messages, **names}, False)

    return render
