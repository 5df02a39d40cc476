"""Boolean text queries, compiled to a disjunction of conjunctions and then to a Column.

Grammar: words; "phrases" in straight or curly quotes (exact); ``& && AND``, ``| || OR`` and parentheses.  AND binds
tighter than OR; terms side by side in a query that has any connector are a conjunction; without
connectors the default operator holds.  Lower-case and/or are words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_LEX = re.compile(r"""\s+|"(?P<straight>[^"]*)"?|“(?P<curly>[^”"]*)[”"]?|”(?P<closing>[^”"]*)[”"]?|(?P<open>\()|(?P<close>\))|(?P<both>&&?)|(?P<either>\|\|?)|(?P<word>[^\s()&|"]+)""")


@dataclass(frozen=True)
class Term:
    text: str
    exact: bool = False


@dataclass(frozen=True)
class Query:
    clauses: tuple[tuple[Term, ...], ...]
    explicit: bool = False

    @property
    def terms(self) -> list[str]:
        return list(dict.fromkeys(t.text for clause in self.clauses for t in clause))


def _lex(raw: str) -> list[str | Term]:
    """Terms, and the connectors as one of ``& | ( )``."""
    out: list[str | Term] = []
    for m in _LEX.finditer(raw or ""):
        kind, value = m.lastgroup, m[m.lastgroup] if m.lastgroup else ""
        if kind in ("straight", "curly", "closing"):
            if value.strip():
                out.append(Term(value.strip().lower(), True))
        elif kind == "word":
            out.append({"AND": "&", "OR": "|"}.get(value) or Term(value.lower()))
        elif kind:
            out.append({"open": "(", "close": ")", "both": "&", "either": "|"}[kind])
    return out


Dnf = list[tuple[Term, ...]]


class _Reader:
    """Reads tokens straight into clauses; None stands for nothing read."""

    def __init__(self, tokens: list[str | Term]):
        self.rest = tokens[::-1]

    def either(self) -> Dnf | None:
        left = self.both()
        while left is not None and self.rest and self.rest[-1] == "|":
            self.rest.pop()
            right = self.both()
            if right is None:
                break
            left = left + right
        return left

    def both(self) -> Dnf | None:
        left = self.one()
        while left is not None and self.rest and self.rest[-1] not in ("|", ")"):
            if self.rest[-1] == "&":
                self.rest.pop()
            right = self.one()
            if right is None:
                break
            left = [a + b for a in left for b in right]
        return left

    def one(self) -> Dnf | None:
        while self.rest:
            token = self.rest.pop()
            if isinstance(token, Term):
                return [(token,)]
            if token == "(":
                inner = self.either()
                if self.rest and self.rest[-1] == ")":
                    self.rest.pop()
                return inner
        return None


def parse(raw: str, default: str = "or") -> Query:
    tokens = _lex(raw)
    terms = [t for t in tokens if isinstance(t, Term)]
    explicit = len(terms) < len(tokens)
    if not terms:
        return Query((), explicit)
    if not explicit:
        return Query((tuple(dict.fromkeys(terms)) if default == "and" else (),) if default == "and" else tuple((t,) for t in terms))
    clauses = _Reader(tokens).either() or []
    return Query(tuple(tuple(dict.fromkeys(c)) for c in clauses if c), True)


def term_in(hay: Column, term: Term) -> Column:
    """Substring; an exact term must not touch letters, digits or underscores.  ``hay`` is in lower case."""
    if not term.exact:
        return hay.contains(term.text)
    return hay.rlike(r"(?iu)(?<![\p{L}\p{N}_])" + re.escape(term.text) + r"(?![\p{L}\p{N}_])")


def matches(hay: Column, query: Query) -> Column:
    """False for a query without clauses."""
    clauses = [reduce(Column.__and__, [term_in(hay, t) for t in clause]) for clause in query.clauses]
    return F.coalesce(reduce(Column.__or__, clauses), F.lit(False)) if clauses else F.lit(False)


def haystack(title: Column, content: Column, tags: Column) -> Column:
    blank = F.lit("")
    return F.lower(F.concat_ws(" ", F.coalesce(title, blank), F.coalesce(content, blank), F.array_join(F.coalesce(tags, F.array().cast("array<string>")), " ")))


def fields_match(fields: list[Column], raw: str, default: str = "and") -> Column:
    """An empty query holds everywhere, one without terms nowhere."""
    if not (raw or "").strip():
        return F.lit(True)
    hay = F.lower(F.concat_ws(" \n ", *[F.coalesce(f, F.lit("")) for f in fields]))
    return matches(hay, parse(raw, default))
