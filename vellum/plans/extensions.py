"""The extension surface: folds of transformers and filters, emitters, page kinds, dependencies."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame

Transformer = Callable[[DataFrame], DataFrame]


@dataclass
class Plugin:
    """A named step; ``order`` places it among its kind, ``needs`` must be enabled and come earlier."""

    name: str
    transform: Transformer | None = None
    keep: Callable[[], Column] | None = None
    emit: Callable[[DataFrame], None] | None = None
    order: int = 50
    enabled: bool = True
    needs: tuple[str, ...] = field(default=())


@dataclass
class PageKind:
    """Pages that a matcher picks, and rows that a generator adds."""

    name: str
    matches: Callable[[], Column]
    generate: Callable[[DataFrame], DataFrame] | None = None


def in_order(plugins: Iterable[Plugin]) -> list[Plugin]:
    return sorted((p for p in plugins if p.enabled), key=lambda p: p.order)


def transformed(rows: DataFrame, plugins: Iterable[Plugin]) -> DataFrame:
    return reduce(lambda df, p: df.transform(p.transform), (p for p in in_order(plugins) if p.transform), rows)


def published(rows: DataFrame, plugins: Iterable[Plugin]) -> DataFrame:
    return reduce(lambda df, p: df.where(p.keep()), (p for p in in_order(plugins) if p.keep), rows)


def emitted(rows: DataFrame, plugins: Iterable[Plugin], kinds: Iterable[PageKind] = ()) -> DataFrame:
    """Virtual pages first, then every emitter on all pages."""
    every = reduce(lambda df, k: df.unionByName(k.generate(rows.where(k.matches()))) if k.generate else df, kinds, rows)
    for p in in_order(plugins):
        if p.emit:
            p.emit(every)
    return every


def problems(plugins: Iterable[Plugin]) -> tuple[list[str], list[str]]:
    """Errors (missing, later, cyclic dependencies) and warnings (disabled ones)."""
    known = {p.name: p for p in plugins}
    errors, warnings = [], []
    for p in known.values():
        if not p.enabled:
            continue
        for need in p.needs:
            other = known.get(need)
            if other is None:
                errors.append(f"{p.name} needs {need}, which is missing")
            elif not other.enabled:
                warnings.append(f"{p.name} needs {need}, which is disabled")
            elif other.order > p.order:
                errors.append(f"{p.name} needs {need}, which comes later")
    state: dict[str, int] = {}

    def visit(name: str, path: tuple[str, ...]) -> None:
        if state.get(name) == 2 or name not in known:
            return
        if state.get(name) == 1:
            errors.append("cycle: " + " > ".join((*path[path.index(name) :], name)))
            return
        state[name] = 1
        for need in known[name].needs:
            visit(need, (*path, name))
        state[name] = 2

    for name in known:
        visit(name, ())
    return errors, warnings


#: Sort and filter rules by name; code in configuration files is never run.
FUNCTIONS: dict[str, Callable[..., object]] = {}


def register_function(name: str, f: Callable[..., object]) -> None:
    FUNCTIONS[name] = f
