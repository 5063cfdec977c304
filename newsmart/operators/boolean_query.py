"""The search service's boolean ``q`` (RA-1), as a tree and as one Catalyst predicate.

* Words side by side are a literal phrase, as in ``phrase_match``; ``"..."`` is one too, of any characters.
  Several phrases side by side must all match.
* ``AND``, ``OR`` and ``NOT`` (upper case), with ``NOT`` binding tightest, then side by side, then
  ``AND``, then ``OR``; parentheses group.
* ``+x`` must match and ``-x`` (or ``NOT x``) must not; beside a ``+x``, phrases without a sign are optional.

A phrase matches an article where it occurs, without regard to case, in any of the searched fields;
a null field holds nothing. What can't be read so raises ``ValueError``."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Phrase:
    text: str


@dataclass(frozen=True)
class Not:
    one: object


@dataclass(frozen=True)
class And:
    all: tuple


@dataclass(frozen=True)
class Or:
    any: tuple


# A sign counts only where something follows it at once; inside a word it is a character.
_TOKEN = re.compile(r'\s*(?:(?P<paren>[()])|(?P<sign>[+-])(?=[^\s)])|"(?P<quoted>[^"]*)"|(?P<word>[^\s()"]+))')
_OPERATORS = ("AND", "OR", "NOT")


def _tokens(q: str) -> list[tuple[str, str, int, int]]:
    """``(kind, text, start, end)``: kinds are the parentheses, signs, operators, ``quoted`` and ``word``."""
    out, at = [], 0
    end = len(q.rstrip())
    while at < end:
        m = _TOKEN.match(q, at)
        if m is None:
            raise ValueError(f"a quotation mark is not closed in {q!r}")
        kind = m.lastgroup
        text = m.group(kind)
        if kind in ("paren", "sign") or (kind == "word" and text in _OPERATORS):
            kind = text
        if kind == "quoted" and not text:
            raise ValueError(f"an empty phrase in {q!r}")
        out.append((kind, text, m.end() - len(m.group().lstrip()), m.end()))
        at = m.end()
    return out


def parse(q: str):
    """The tree of ``q``, of Phrase, Not, And and Or."""
    tokens = [*_tokens(q), ("end", "", len(q), len(q))]
    at = 0

    def take() -> tuple:
        nonlocal at
        at += 1
        return tokens[at - 1]

    def one():
        kind, text, start, _ = take()
        if kind == "quoted":
            return Phrase(text)
        if kind == "(":
            inner = either()
            if take()[0] != ")":
                raise ValueError(f"a parenthesis is not closed in {q!r}")
            return inner
        if kind == "word":
            return Phrase(text)
        raise ValueError(f"a phrase is missing at {start} in {q!r}")

    def run():
        """Words side by side, as they are written."""
        start, end = tokens[at][2:]
        while tokens[at][0] == "word":
            end = take()[3]
        return Phrase(q[start:end])

    def beside():
        must, never, plain = [], [], []
        while tokens[at][0] not in ("AND", "OR", ")", "end"):
            kind = tokens[at][0]
            if kind in ("+", "-", "NOT"):
                take()
                (must if kind == "+" else never).append(one())
            else:
                plain.append(run() if kind == "word" else one())
        if not (must or never or plain):
            raise ValueError(f"a phrase is missing at {tokens[at][2]} in {q!r}")
        parts = [*(must or plain), *map(Not, never)]
        return parts[0] if len(parts) == 1 else And(tuple(parts))

    def joined(word: str, inner: Callable, kind):
        parts = [inner()]
        while tokens[at][0] == word:
            take()
            parts.append(inner())
        return parts[0] if len(parts) == 1 else kind(tuple(parts))

    def either():
        return joined("OR", lambda: joined("AND", beside, And), Or)

    tree = either()
    if tokens[at][0] != "end":
        raise ValueError(f"a parenthesis is not opened in {q!r}")
    return tree


def phrases(tree) -> list[str]:
    """The distinct phrases of a tree, in order."""
    if isinstance(tree, Phrase):
        return [tree.text]
    parts = [tree.one] if isinstance(tree, Not) else tree.all if isinstance(tree, And) else tree.any
    return list(dict.fromkeys(p for part in parts for p in phrases(part)))


def predicate(tree, phrase: Callable[[str], Column]) -> Column:
    """The tree as one condition, ``phrase`` giving that of a phrase (never null)."""
    if isinstance(tree, Phrase):
        return phrase(tree.text)
    if isinstance(tree, Not):
        return ~predicate(tree.one, phrase)
    parts = tree.all if isinstance(tree, And) else tree.any
    join = Column.__and__ if isinstance(tree, And) else Column.__or__
    return reduce(join, (predicate(p, phrase) for p in parts))


def boolean_match(q: str, phrase: Callable[[str], Column]) -> Column:
    return F.coalesce(predicate(parse(q), phrase), F.lit(False))
