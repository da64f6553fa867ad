"""Boolean trigram queries that every match of a regular expression must satisfy.

A query is a list of clauses, all of which hold; a clause is a set of alternatives, one of which holds; an
alternative is a set of trigrams, all of which occur. Everything is lower case, so it is asked of the
lower-cased text. Leaving out a clause only weakens a query, so sets that grow too large are given up.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import product
from re import _constants as op
from re import _parser as parser

MOST = 64

Clause = frozenset[frozenset[str]]


@dataclass(frozen=True)
class Facts:
    """What is known of the strings an expression matches: all of them, or how they begin and end."""

    exact: frozenset[str] | None = None
    prefix: frozenset[str] = frozenset([""])
    suffix: frozenset[str] = frozenset([""])
    clauses: tuple[Clause, ...] = field(default=())


ANYTHING = Facts()
NOTHING_TO_MATCH = Facts(exact=frozenset([""]))


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _clause(strings: frozenset[str]) -> tuple[Clause, ...]:
    """One of ``strings`` occurs; says nothing if one of them has no trigram."""
    sets = {trigrams(s) for s in strings}
    if not sets or frozenset() in sets or len(sets) > MOST:
        return ()
    return (frozenset(s for s in sets if not any(t < s for t in sets)),)


def _opened(facts: Facts) -> Facts:
    """The same without the exact set."""
    if facts.exact is None:
        return facts
    return Facts(None, _cut(facts.exact, slice(0, 2)), _cut(facts.exact, slice(-2, None)), facts.clauses + _clause(facts.exact))


def _cut(strings: frozenset[str], part: slice) -> frozenset[str]:
    short = frozenset(s[part] for s in strings)
    return short if len(short) <= MOST else frozenset([""])


def _joined(a: Facts, b: Facts) -> Facts:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MOST:
        return Facts(frozenset(x + y for x, y in product(a.exact, b.exact)))
    left, right = _opened(a), _opened(b)
    border = frozenset(x + y for x, y in product(left.suffix, right.prefix))
    prefix, suffix = left.prefix, right.suffix
    if a.exact is not None and len(a.exact) * len(right.prefix) <= MOST:
        prefix = _cut(frozenset(x + y for x, y in product(a.exact, right.prefix)), slice(0, 2))
    if b.exact is not None and len(left.suffix) * len(b.exact) <= MOST:
        suffix = _cut(frozenset(x + y for x, y in product(left.suffix, b.exact)), slice(-2, None))
    return Facts(None, prefix, suffix, left.clauses + right.clauses + _clause(border))


def _either(a: Facts, b: Facts) -> Facts:
    if a.exact is not None and b.exact is not None and len(a.exact | b.exact) <= MOST:
        return Facts(a.exact | b.exact)
    left, right = _opened(a), _opened(b)
    pairs = [x | y for x, y in product(left.clauses, right.clauses)]
    prefix, suffix = (x if len(x) <= MOST else frozenset([""]) for x in (left.prefix | right.prefix, left.suffix | right.suffix))
    return Facts(None, prefix, suffix, tuple(p for p in pairs if len(p) <= MOST))


def _letters(items) -> Facts:
    """A character class."""
    found = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < MOST:
            found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return ANYTHING
    return Facts(frozenset(found)) if len(found) <= MOST // 4 else ANYTHING


def _sequence(nodes) -> Facts:
    facts = NOTHING_TO_MATCH
    for kind, value in nodes:
        facts = _joined(facts, _node(kind, value))
    return facts


def _node(kind, value) -> Facts:
    if kind is op.LITERAL:
        return Facts(frozenset([chr(value).lower()]))
    if kind is op.IN:
        return _letters(value)
    if kind is op.AT or kind is op.ASSERT or kind is op.ASSERT_NOT:
        return NOTHING_TO_MATCH
    if kind is op.SUBPATTERN:
        return _sequence(value[-1])
    if kind is op.BRANCH:
        branches = [_sequence(b) for b in value[1]]
        facts = branches[0]
        for branch in branches[1:]:
            facts = _either(facts, branch)
        return facts
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        least, most, nodes = value
        inner = _sequence(nodes)
        if (least, most) == (0, 1):
            return _either(inner, NOTHING_TO_MATCH)
        if least == 0:
            return ANYTHING
        facts = NOTHING_TO_MATCH
        for _ in range(min(least, 4)):
            facts = _joined(facts, inner)
        return facts if least == most <= 4 else _joined(_joined(facts, ANYTHING), inner)
    return ANYTHING


def mandatory_trigrams(pattern: str) -> tuple[Clause, ...]:
    """The query of ``pattern``; empty if no trigram is mandatory, so that all texts are candidates."""
    return _opened(_sequence(parser.parse(pattern))).clauses
