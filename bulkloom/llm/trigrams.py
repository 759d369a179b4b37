"""Boolean trigram queries of regular expressions: what every text with a match must hold."""

from __future__ import annotations

from re import _constants as C
from re import _parser

#: A query in disjunctive form: a text can match only if it holds all trigrams of one of the sets. An empty set asks for nothing.
Query = frozenset[frozenset[str]]
ANY: Query = frozenset({frozenset()})
#: Literal strings that a part is spelt out into, and sets of a query, at most; beyond them a query asks for less, which loses no match.
SPELT, SETS = 64, 64


def _least(sets) -> Query:
    """Sets without those that hold another one: whoever holds the larger holds the smaller."""
    out: list[frozenset[str]] = []
    for s in sorted(set(sets), key=lambda s: (len(s), sorted(s))):
        if not any(o <= s for o in out):
            out.append(s)
    return frozenset(out)


def _both(a: Query, b: Query) -> Query:
    return _least(x | y for x in a for y in b) if len(a) * len(b) <= SETS else a if len(a) <= len(b) else b


def _of_strings(strings: set[str]) -> Query:
    return _least(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _spelt(op, arg) -> set[str] | None:
    """The strings that one part of a pattern stands for, in lower case; None if they are many or endless."""
    if op is C.LITERAL:
        return {chr(arg).lower()}
    if op in (C.AT, C.ASSERT, C.ASSERT_NOT):  # no width
        return {""}
    if op is C.IN:
        if not all(o is C.LITERAL for o, _ in arg):
            return None
        return {chr(a).lower() for _, a in arg}
    if op is C.SUBPATTERN:
        return _spelt_all(arg[-1])
    if op is C.BRANCH:
        every = [_spelt_all(part) for part in arg[1]]
        return None if None in every else set().union(*every)
    if op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[1] <= 4:
        one, out = _spelt_all(arg[2]), set()
        if one is None:
            return None
        for n in range(arg[0], arg[1] + 1):
            power = {""}
            for _ in range(n):
                power = {a + b for a in power for b in one}
            out |= power
            if len(out) > SPELT:
                return None
        return out
    return None


def _spelt_all(parts) -> set[str] | None:
    out = {""}
    for op, arg in parts:
        one = _spelt(op, arg)
        if one is None or len(out) * len(one) > SPELT:
            return None
        out = {a + b for a in out for b in one}
    return out


def _query(parts) -> Query:
    """The query of parts in a row: runs that can be spelt out give their trigrams, all others what they hold themselves."""
    out, run = ANY, {""}
    for op, arg in parts:
        one = _spelt(op, arg)
        if one is not None and len(run) * len(one) <= SPELT:
            run = {a + b for a in run for b in one}
            continue
        out, run = _both(out, _of_strings(run)), {""} if one is None else one
        if op is C.SUBPATTERN:
            out = _both(out, _query(arg[-1]))
        elif op is C.BRANCH:
            out = _both(out, _least(s for part in arg[1] for s in _query(part)))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] > 0:
            out = _both(out, _query(arg[2]))
    return _both(out, _of_strings(run))


def query_of(pattern: str) -> Query:
    """The query of a pattern, over texts in lower case. ANY if the pattern has no mandatory trigram."""
    return _query(_parser.parse(pattern))


def holds(query: Query, low: str) -> bool:
    """Whether a text in lower case holds what the query asks for."""
    return any(all(t in low for t in s) for s in query)
