"""A small sandboxed template language for chat formats.

    {{ expression }}                           its text
    {% if e %} {% elif e %} {% else %} {% endif %}
    {% for x in e %} {% endfor %}              with loop.index, loop.first, loop.last
    {% set x = e %}                            until the enclosing loop's turn ends
    {% generation %} {% endgeneration %}       marks what a model is to learn
    {# comment #}                              a '-' inside a delimiter eats the white space outside it

A template is parsed to a syntax tree, parts that depend on no variable are
computed once (neighbouring texts become one, branches never taken go), and
the tree becomes Python closures.  Rendering is a generator of (text, is in a
generation block): a loop takes the next item only when the last is rendered,
so that a conversation of any length needs the memory of one turn.

Sandbox: values are strings, whole numbers below 2 ** 63, booleans, none,
lists and string-keyed maps; names are those given to ``render``; '.' and []
look into maps and lists alone; nothing can be called but the filters.  An
undefined name or member is none.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain


class TemplateError(ValueError):
    """What is wrong with a template, or what it may not do."""


# ---------------------------------------------------------------- syntax tree
@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Op:
    """An operator, filter or test applied to its operands."""
    name: str
    args: tuple


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Emit:
    value: object


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    items: object
    body: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class Generation:
    body: tuple


# ---------------------------------------------------------------- operators
def _number(x) -> int:
    if isinstance(x, bool) or not isinstance(x, int):
        raise TemplateError(f"a number is needed, not {x!r}")
    return x


def _bounded(x: int) -> int:
    if abs(x) >= 1 << 63:
        raise TemplateError("a number is out of range")
    return x


def text_of(x) -> str:
    if isinstance(x, str):
        return x
    if x is None:
        return ""
    if isinstance(x, (bool, int)):
        return str(x).lower() if isinstance(x, bool) else str(x)
    return json.dumps(x, ensure_ascii=False)


def _plus(a, b):
    return a + b if isinstance(a, str) and isinstance(b, str) else _bounded(_number(a) + _number(b))


def _member(x, key):
    if isinstance(x, dict):
        return x.get(key)
    if isinstance(x, (list, tuple)) and isinstance(key, int) and not isinstance(key, bool):
        return x[key] if -len(x) <= key < len(x) else None
    return None


def _within(a, b):
    if isinstance(b, str):
        return isinstance(a, str) and a in b
    return isinstance(b, (list, tuple, dict)) and a in b


OPERATORS: dict[str, Callable] = {
    "+": _plus,
    "-": lambda a, b: _bounded(_number(a) - _number(b)),
    "*": lambda a, b: _bounded(_number(a) * _number(b)),
    "//": lambda a, b: _number(a) // _number(b),
    "%": lambda a, b: _number(a) % _number(b),
    "negate": lambda a: -_number(a),
    "~": lambda a, b: text_of(a) + text_of(b),
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
    "in": _within, "not in": lambda a, b: not _within(a, b),
    "not": lambda a: not a,
    "member": _member,
    "list": lambda *a: list(a),
    "is none": lambda a: a is None, "is defined": lambda a: a is not None,
    "is string": lambda a: isinstance(a, str),
    "is number": lambda a: isinstance(a, int) and not isinstance(a, bool),
}

FILTERS: dict[str, Callable] = {
    "trim": lambda x: text_of(x).strip(), "upper": lambda x: text_of(x).upper(),
    "lower": lambda x: text_of(x).lower(), "capitalize": lambda x: text_of(x).capitalize(),
    "string": text_of, "length": lambda x: len(x) if isinstance(x, (str, list, tuple, dict)) else 0,
    "tojson": lambda x: json.dumps(x, ensure_ascii=False, sort_keys=True),
    "default": lambda x, y="": y if x is None else x,
    "replace": lambda x, a, b: text_of(x).replace(text_of(a), text_of(b)),
    "join": lambda x, by="": text_of(by).join(map(text_of, x or [])),
}


def _apply(function: Callable, name: str, values) -> object:
    try:
        return function(*values)
    except TemplateError:
        raise
    except (TypeError, ZeroDivisionError, ValueError) as e:
        raise TemplateError(f"{name}: {e}") from None


# ---------------------------------------------------------------- parsing
PIECE = re.compile(r"\{([{%#])(-?)(.*?)(-?)([}%#])\}", re.S)
TOKEN = re.compile(r"""\s*(?:(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")
                       |(?P<sign>//|==|!=|<=|>=|[-+*%~<>()\[\],.|=]))""", re.X | re.S)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
# binary operators, loosest first
LEVELS = [("==", "!=", "<", "<=", ">", ">=", "in", "not in"), ("~",), ("+", "-"), ("*", "//", "%")]
WORDS = {"if", "else", "or", "and", "not", "in", "is", "true", "false", "none"}


def pieces(source: str) -> Iterator[tuple[str, str]]:
    """(kind, content): kind is 'text', '{' (expression) or '%' (statement)."""
    at, eat = 0, False
    for m in PIECE.finditer(source):
        text = source[at:m.start()]
        if eat:
            text = text.lstrip()
        if m[2]:
            text = text.rstrip()
        yield "text", text
        if {"{": "}", "%": "%", "#": "#"}[m[1]] != m[5]:
            raise TemplateError(f"unbalanced delimiter {m[0]!r}")
        if m[1] != "#":
            yield m[1], m[3]
        at, eat = m.end(), bool(m[4])
    rest = source[at:]
    if re.search(r"\{[{%#]", rest):
        raise TemplateError("a delimiter is not closed")
    yield "text", rest.lstrip() if eat else rest


class Expression:
    """One expression's tokens, read by recursive descent."""

    def __init__(self, source: str, filters: dict[str, Callable]):
        self.tokens: list[tuple[str, str]] = []
        self.at, self.filters = 0, filters
        pos, source = 0, source.strip()
        while pos < len(source):
            m = TOKEN.match(source, pos)
            if not m:
                raise TemplateError(f"cannot read {source[pos:pos + 20]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            pos = m.end()

    def peek(self) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "string":
            return self.tokens[self.at][1]
        return None

    def take(self, *wanted: str) -> str | None:
        word = self.peek()
        if word in wanted:
            self.at += 1
            return word
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} is missing")

    def word(self) -> str:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")
        if kind != "name" or text in WORDS:
            raise TemplateError(f"a name is needed, not {text!r}")
        self.at += 1
        return text

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"not expected: {self.tokens[self.at][1]!r}")

    def whole(self):
        out = self.choice()
        self.end()
        return out

    def choice(self):
        then = self.either()
        if not self.take("if"):
            return then
        test = self.either()
        return Op("choose", (test, then, self.choice() if self.take("else") else Const(None)))

    def either(self):
        left = self.both()
        while self.take("or"):
            left = Op("or", (left, self.both()))
        return left

    def both(self):
        left = self.negation()
        while self.take("and"):
            left = Op("and", (left, self.negation()))
        return left

    def negation(self):
        return Op("not", (self.negation(),)) if self.take("not") else self.binary(0)

    def binary(self, level: int):
        if level == len(LEVELS):
            return self.unary()
        left = self.binary(level + 1)
        while True:
            sign = self.take(*LEVELS[level])
            if level == 0 and not sign:
                if self.take("is"):
                    negated = bool(self.take("not"))
                    test = "is " + ("none" if self.take("none") else self.word())
                    if test not in OPERATORS:
                        raise TemplateError(f"no test {test!r}")
                    left = Op(test, (left,))
                    left = Op("not", (left,)) if negated else left
                    continue
                if self.peek() == "not" and self.at + 1 < len(self.tokens) and self.tokens[self.at + 1][1] == "in":
                    self.at += 2
                    sign = "not in"
            if not sign:
                return left
            left = Op(sign, (left, self.binary(level + 1)))

    def unary(self):
        return Op("negate", (self.unary(),)) if self.take("-") else self.postfix(self.primary())

    def postfix(self, x):
        while sign := self.take(".", "[", "|"):
            if sign == ".":
                x = Op("member", (x, Const(self.word())))
            elif sign == "[":
                x = Op("member", (x, self.choice()))
                self.need("]")
            else:
                name = self.word()
                if name not in self.filters:
                    raise TemplateError(f"no filter {name!r}")
                x = Op("|" + name, (x, *(self.items(")") if self.take("(") else ())))
        return x

    def items(self, close: str) -> tuple:
        out = []
        while not self.take(close):
            out.append(self.choice())
            if not self.take(","):
                self.need(close)
                break
        return tuple(out)

    def primary(self):
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, text = self.tokens[self.at]
        if kind == "string":
            self.at += 1
            return Const(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "number":
            self.at += 1
            return Const(_bounded(int(text)))
        if word := self.take("true", "false", "none"):
            return Const({"true": True, "false": False, "none": None}[word])
        if self.take("("):
            out = self.choice()
            self.need(")")
            return out
        if self.take("["):
            return Op("list", self.items("]"))
        return Name(self.word())


def parse(source: str, filters: dict[str, Callable]) -> tuple:
    """The template's syntax tree."""
    todo = list(pieces(source))[::-1]

    def body(*ends: str) -> tuple[tuple, str, Expression | None]:
        out: list = []
        while todo:
            kind, content = todo.pop()
            if kind == "text":
                if content:
                    out.append(Text(content))
                continue
            e = Expression(content, filters)
            if kind == "{":
                out.append(Emit(e.whole()))
                continue
            word = e.peek()
            e.at += 1
            if word in ends:
                return tuple(out), word, e
            if word == "if":
                out.append(branch(e))
            elif word == "for":
                name = e.word()
                e.need("in")
                items = e.whole()
                inside, _, end = body("endfor")
                end.end()
                out.append(For(name, items, inside))
            elif word == "set":
                name = e.word()
                e.need("=")
                out.append(Set(name, e.whole()))
            elif word == "generation":
                e.end()
                inside, _, end = body("endgeneration")
                end.end()
                out.append(Generation(inside))
            else:
                raise TemplateError(f"not expected: {word!r}")
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return tuple(out), "", None

    def branch(e: Expression) -> If:
        test = e.whole()
        then, word, e = body("elif", "else", "endif")
        if word == "elif":
            return If(test, then, (branch(e),))
        e.end()
        other = ()
        if word == "else":
            other, _, e = body("endif")
            e.end()
        return If(test, then, other)

    return body()[0]


# ---------------------------------------------------------------- folding
LAZY = {"and", "or", "choose"}


def fold(node, functions: dict[str, Callable]):
    """An expression with what is constant in it computed."""
    if not isinstance(node, Op):
        return node
    args = tuple(fold(a, functions) for a in node.args)
    first = args[0] if args else None
    if node.name in LAZY and isinstance(first, Const):
        if node.name == "choose":
            return args[1] if first.value else args[2]
        return args[1] if bool(first.value) == (node.name == "and") else first
    if node.name not in LAZY and all(isinstance(a, Const) for a in args):
        try:
            return Const(_apply(functions[node.name], node.name, [a.value for a in args]))
        except TemplateError:
            pass                                 # it fails when, and only if, it is rendered
    return Op(node.name, args)


def fold_body(body: tuple, functions: dict[str, Callable]) -> tuple:
    out: list = []
    for node in body:
        if isinstance(node, Emit):
            value = fold(node.value, functions)
            new = [Text(text_of(value.value)) if isinstance(value, Const) else Emit(value)]
        elif isinstance(node, If):
            test = fold(node.test, functions)
            then, other = fold_body(node.then, functions), fold_body(node.other, functions)
            new = (list(then if test.value else other) if isinstance(test, Const)
                   else [If(test, then, other)])
        elif isinstance(node, For):
            new = [For(node.name, fold(node.items, functions), fold_body(node.body, functions))]
        elif isinstance(node, Set):
            new = [Set(node.name, fold(node.value, functions))]
        elif isinstance(node, Generation):
            new = [Generation(fold_body(node.body, functions))]
        else:
            new = [node]
        for n in new:
            if isinstance(n, Text) and out and isinstance(out[-1], Text):
                out[-1] = Text(out[-1].text + n.text)
            elif not (isinstance(n, Text) and not n.text):
                out.append(n)
    return tuple(out)


# ---------------------------------------------------------------- closures
Env = dict[str, object]
Pieces = Iterator[tuple[str, bool]]


def expression(node, functions: dict[str, Callable]) -> Callable[[Env], object]:
    if isinstance(node, Const):
        return lambda env: node.value
    if isinstance(node, Name):
        return lambda env: env.get(node.name)
    args = [expression(a, functions) for a in node.args]
    if node.name == "choose":
        test, then, other = args
        return lambda env: then(env) if test(env) else other(env)
    if node.name in ("and", "or"):
        left, right = args
        return (lambda env: left(env) and right(env)) if node.name == "and" else (lambda env: left(env) or right(env))
    function, name = functions[node.name], node.name
    return lambda env: _apply(function, name, [a(env) for a in args])


def statements(body: tuple, functions: dict[str, Callable]) -> Callable[[Env], Pieces]:
    parts = [statement(node, functions) for node in body]

    def run(env: Env) -> Pieces:
        for part in parts:
            yield from part(env)
    return run


def _loop(node: For, functions: dict[str, Callable]) -> Callable[[Env], Pieces]:
    items, body, name, end = expression(node.items, functions), statements(node.body, functions), node.name, object()

    def run(env: Env) -> Pieces:
        todo = iter(items(env) or ())
        item, n = next(todo, end), 0
        while item is not end:
            after, n = next(todo, end), n + 1
            yield from body({**env, name: item, "loop": {"index": n, "first": n == 1, "last": after is end}})
            item = after
    return run


def statement(node, functions: dict[str, Callable]) -> Callable[[Env], Pieces]:
    if isinstance(node, Text):
        out = ((node.text, False),)
        return lambda env: out
    if isinstance(node, Emit):
        value = expression(node.value, functions)
        return lambda env: ((text_of(value(env)), False),)
    if isinstance(node, If):
        test, then, other = (expression(node.test, functions), statements(node.then, functions),
                             statements(node.other, functions))
        return lambda env: then(env) if test(env) else other(env)
    if isinstance(node, For):
        return _loop(node, functions)
    if isinstance(node, Generation):
        body = statements(node.body, functions)
        return lambda env: ((text, True) for text, _ in body(env))
    name, value = node.name, expression(node.value, functions)

    def assign(env: Env) -> Pieces:
        env[name] = value(env)
        return iter(())
    return assign


class Template:
    """A compiled template; ``filters`` adds pure functions to ``FILTERS``."""

    def __init__(self, source: str, filters: dict[str, Callable] | None = None):
        known = FILTERS | (filters or {})
        functions = OPERATORS | {"|" + k: f for k, f in known.items()}
        self.tree = fold_body(parse(source, known), functions)
        self._run = statements(self.tree, functions)

    def render(self, values: dict[str, object] | None = None, **more: object) -> Pieces:
        """(text, in a generation block), piece by piece."""
        return ((t, g) for t, g in self._run({**(values or {}), **more}) if t)

    def text(self, values: dict[str, object] | None = None, **more: object) -> str:
        return "".join(t for t, _ in self.render(values, **more))


def marked(rendered: Iterable[tuple[str, bool]]) -> tuple[str, list[tuple[int, int]]]:
    """The whole text and the (start, end) of its generation blocks, neighbours merged."""
    out, spans, at = [], [], 0
    for text, mark in chain(rendered):
        if mark:
            if spans and spans[-1][1] == at:
                spans[-1] = (spans[-1][0], at + len(text))
            else:
                spans.append((at, at + len(text)))
        out.append(text)
        at += len(text)
    return "".join(out), spans
