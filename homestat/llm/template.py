"""A small sandboxed template language, compiled to Python closures.

Source -> tokens -> syntax tree -> folded tree -> closures. Templates know the loop over messages,
conditions, generation blocks, string expressions and named filters; there are no calls, no
imports, no attributes beyond a fixed list, and the size of a template is limited.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

MAX_SOURCE = 20_000
MAX_DEPTH = 40
FIELDS = {"message": ("role", "text"), "loop": ("first", "last", "index0")}
#: What templates put around turns; ``escape`` hides these strings inside texts.
CONTROL = re.compile(r"\\|</?turn")
IN_NAME = re.compile(r"[\\>]")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)


class TemplateError(ValueError):
    """The template is not in the language."""


def escape(text: str) -> str:
    return CONTROL.sub(r"\\\g<0>", text)


def escape_name(text: str) -> str:
    return IN_NAME.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "name": escape_name, "trim": str.strip, "upper": str.upper, "lower": str.lower}


# ---- syntax tree ---------------------------------------------------------------------

@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Field:
    owner: str
    name: str


@dataclass(frozen=True)
class Filter:
    name: str
    of: object


@dataclass(frozen=True)
class Binary:
    op: str
    left: object
    right: object


@dataclass(frozen=True)
class Not:
    of: object


@dataclass(frozen=True)
class Emit:
    of: object


@dataclass(frozen=True)
class If:
    test: object
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


@dataclass(frozen=True)
class Loop:
    name: str
    body: tuple


# ---- parser --------------------------------------------------------------------------

PART = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<id>[A-Za-z_]\w*)|(?P<op>==|!=|[|.~()])|(?P<bad>\S))""", re.DOTALL)
PLAIN = {"n": "\n", "t": "\t"}


def tokens(source: str) -> list[tuple[str, str]]:
    out = []
    for m in TOKEN.finditer(source):
        if m.lastgroup == "bad":
            raise TemplateError(f"unexpected {m['bad']!r}")
        if m.lastgroup:
            out.append((m.lastgroup, m[m.lastgroup]))
    return out


class Expression:
    """Recursive descent over one expression: or < and < not < comparison < join < filter."""

    def __init__(self, source: str, scope: dict[str, str]):
        self.todo, self.at, self.scope, self.depth = tokens(source), 0, scope, 0

    def peek(self) -> tuple[str, str]:
        return self.todo[self.at] if self.at < len(self.todo) else ("end", "")

    def take(self, *values: str) -> str | None:
        kind, value = self.peek()
        if kind in ("op", "id") and value in values:
            self.at += 1
            return value
        return None

    def parse(self):
        out = self.either()
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return out

    def either(self):
        out = self.both()
        while self.take("or"):
            out = Binary("or", out, self.both())
        return out

    def both(self):
        out = self.negated()
        while self.take("and"):
            out = Binary("and", out, self.negated())
        return out

    def negated(self):
        if self.take("not"):
            return Not(self.negated())
        left = self.joined()
        op = self.take("==", "!=")
        return Binary(op, left, self.joined()) if op else left

    def joined(self):
        out = self.filtered()
        while self.take("~"):
            out = Binary("~", out, self.filtered())
        return out

    def filtered(self):
        out = self.primary()
        while self.take("|"):
            kind, name = self.peek()
            if kind != "id" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            out = Filter(name, out)
        return out

    def primary(self):
        self.depth += 1
        if self.depth > 1000:
            raise TemplateError("expression too long")
        kind, value = self.peek()
        self.at += 1
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: PLAIN.get(m[1], m[1]), value[1:-1], flags=re.DOTALL))
        if kind == "int":
            return Const(int(value))
        if kind == "op" and value == "(":
            out = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return out
        if kind == "id" and value in ("true", "false"):
            return Const(value == "true")
        if kind == "id" and value in self.scope:
            owner = self.scope[value]
            if self.take("."):
                name = self.peek()[1]
                self.at += 1
                if name in FIELDS[owner]:
                    return Field(owner, name)
                raise TemplateError(f"{value} has no {name!r}")
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> tuple:
    """The statements of a template."""
    if len(source) > MAX_SOURCE:
        raise TemplateError("template too long")
    parts: list[tuple[str, str]] = []
    last = 0
    for m in PART.finditer(source):
        if m.start() > last:
            parts.append(("text", source[last:m.start()]))
        parts.append(("emit", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        last = m.end()
    if last < len(source):
        parts.append(("text", source[last:]))
    at = 0

    def block(scope: dict[str, str], ends: tuple[str, ...], depth: int) -> tuple[tuple, str]:
        nonlocal at
        if depth > MAX_DEPTH:
            raise TemplateError("blocks nested too deep")
        out: list = []
        while at < len(parts):
            kind, body = parts[at]
            at += 1
            if kind == "text":
                out.append(Emit(Const(body)))
            elif kind == "emit":
                out.append(Emit(Expression(body, scope).parse()))
            else:
                word, _, rest = body.partition(" ")
                if word in ends:
                    at -= word == "elif"
                    return tuple(out), word
                if word == "generation" and not rest:
                    inner, _ = block(scope, ("endgeneration",), depth + 1)
                    out.append(Generation(inner))
                elif word == "if":
                    out.append(condition(rest, scope, depth))
                elif word == "for" and (m := re.fullmatch(r"([A-Za-z_]\w*) in messages", rest.strip())) and not scope:
                    inner, _ = block({m[1]: "message", "loop": "loop"}, ("endfor",), depth + 1)
                    out.append(Loop(m[1], inner))
                else:
                    raise TemplateError(f"unexpected {{% {body} %}}")
        if ends:
            raise TemplateError(f"missing {{% {ends[-1]} %}}")
        return tuple(out), ""

    def condition(test: str, scope: dict[str, str], depth: int) -> If:
        nonlocal at
        what = Expression(test, scope).parse()
        yes, end = block(scope, ("elif", "else", "endif"), depth + 1)
        no: tuple = ()
        if end == "elif":
            rest = parts[at][1].partition(" ")[2]
            at += 1
            no = (condition(rest, scope, depth + 1),)
        elif end == "else":
            no, _ = block(scope, ("endif",), depth + 1)
        return If(what, yes, no)

    return block({}, (), 0)[0]


# ---- constant folding ----------------------------------------------------------------

def shown(value: object) -> str:
    return "" if value is None else str(value)


def apply(op: str, left: object, right: object) -> object:
    if op == "~":
        return shown(left) + shown(right)
    return left == right if op == "==" else left != right


def fold(node):
    """The same expression with its constant parts worked out."""
    if isinstance(node, Filter):
        of = fold(node.of)
        return Const(FILTERS[node.name](shown(of.value))) if isinstance(of, Const) else Filter(node.name, of)
    if isinstance(node, Not):
        of = fold(node.of)
        return Const(not of.value) if isinstance(of, Const) else Not(of)
    if isinstance(node, Binary):
        left, right = fold(node.left), fold(node.right)
        if node.op in ("and", "or"):
            if isinstance(left, Const):
                return right if bool(left.value) == (node.op == "and") else left
        elif isinstance(left, Const) and isinstance(right, Const):
            return Const(apply(node.op, left.value, right.value))
        return Binary(node.op, left, right)
    return node


def fold_block(body: tuple) -> tuple:
    """Folded statements: decided conditions are replaced by a branch, adjacent constants joined."""
    out: list = []
    for s in body:
        if isinstance(s, If):
            test = fold(s.test)
            made = list(fold_block(s.yes if test.value else s.no)) if isinstance(test, Const) else [If(test, fold_block(s.yes), fold_block(s.no))]
        elif isinstance(s, (Generation, Loop)):
            inner = fold_block(s.body)
            made = [Generation(inner) if isinstance(s, Generation) else Loop(s.name, inner)]
        else:
            made = [Emit(fold(s.of))]
        for m in made:
            if out and isinstance(m, Emit) and isinstance(out[-1], Emit) and isinstance(m.of, Const) and isinstance(out[-1].of, Const):
                out[-1] = Emit(Const(shown(out[-1].of.value) + shown(m.of.value)))
            elif not (isinstance(m, Emit) and isinstance(m.of, Const) and shown(m.of.value) == ""):
                out.append(m)
    return tuple(out)


# ---- closures ------------------------------------------------------------------------

class Writer:
    """Collects output and the spans (in code points of the conversation) of generation blocks."""

    def __init__(self, at: int = 0):
        self.parts: list[str] = []
        self.spans: list[tuple[int, int]] = []
        self.at = at

    def put(self, text: str) -> None:
        self.parts.append(text)
        self.at += len(text)


def value_of(node) -> Callable[[dict], object]:
    if isinstance(node, Const):
        return lambda env, v=node.value: v
    if isinstance(node, Field):
        return lambda env, o=node.owner, n=node.name: env[o][n]
    if isinstance(node, Filter):
        return lambda env, f=FILTERS[node.name], of=value_of(node.of): f(shown(of(env)))
    if isinstance(node, Not):
        return lambda env, of=value_of(node.of): not of(env)
    left, right = value_of(node.left), value_of(node.right)
    if node.op == "and":
        return lambda env: left(env) and right(env)
    if node.op == "or":
        return lambda env: left(env) or right(env)
    return lambda env, op=node.op: apply(op, left(env), right(env))


def writer_of(body: tuple) -> Callable[[dict, Writer], None]:
    steps: list[Callable[[dict, Writer], None]] = []
    for s in body:
        if isinstance(s, Emit) and isinstance(s.of, Const):
            steps.append(lambda env, out, t=shown(s.of.value): out.put(t))
        elif isinstance(s, Emit):
            steps.append(lambda env, out, of=value_of(s.of): out.put(shown(of(env))))
        elif isinstance(s, If):
            steps.append(lambda env, out, test=value_of(s.test), yes=writer_of(s.yes), no=writer_of(s.no): (yes if test(env) else no)(env, out))
        elif isinstance(s, Generation):
            def marked(env, out, inner=writer_of(s.body)):
                first = out.at
                inner(env, out)
                out.spans.append((first, out.at))
            steps.append(marked)
        else:
            raise TemplateError("a loop stands inside another block")

    def run(env: dict, out: Writer) -> None:
        for step in steps:
            step(env, out)

    return run


@dataclass(frozen=True)
class Compiled:
    """Closures for what stands before the loop, for one message, and for what stands after."""

    head: Callable[[dict, Writer], None]
    turn: Callable[[dict, Writer], None]
    tail: Callable[[dict, Writer], None]


def compile_template(source: str) -> Compiled:
    """One top-level loop over messages, so that a conversation is rendered message by message."""
    body = fold_block(parse(source))
    loops = [i for i, s in enumerate(body) if isinstance(s, Loop)]
    if len(loops) != 1:
        raise TemplateError("a template has one loop over messages")
    k = loops[0]
    return Compiled(writer_of(body[:k]), writer_of(body[k].body), writer_of(body[k + 1:]))
