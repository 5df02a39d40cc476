"""Row predicates over notes, works and pages."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import own_prose

# Navigation shells that search never shows.
HIDDEN = ("index", "brani", "404")


def has_value(column: str, value: str, multi: bool) -> Column:
    return F.array_contains(F.col(column), value) if multi else F.col(column).cast("string") == value


def facet_any(selected: Mapping[str, Iterable[str]], multi: Iterable[str] = ()) -> Column:
    """OR within a facet, AND across facets; nothing selected matches nothing."""
    groups = [reduce(Column.__or__, [has_value(k, v, k in multi) for v in values]) for k, values in selected.items() if values]
    return reduce(Column.__and__, groups) if groups else F.lit(False)


def facet_any_tag(selected: Mapping[str, Iterable[str]], multi: Iterable[str] = ()) -> Column:
    """Any selected value of any facet."""
    single = [has_value(k, v, k in multi) for k, values in selected.items() for v in values]
    return reduce(Column.__or__, single) if single else F.lit(False)


def exclude_works(slug: Column) -> Column:
    return ~slug.startswith("works/")


def scope(rows: DataFrame, author: str | None = None, cluster: str | None = None) -> DataFrame:
    """Rows of the author; a cluster, if given, is taken from all rows instead."""
    if cluster:
        return rows.where(F.col("cluster") == cluster)
    return rows.where(F.col("author") == author) if author else rows


def hidden_slug(slug: Column) -> Column:
    return slug.isin(*HIDDEN) | slug.startswith("tags/") & (slug != "tags/index")


def thin(slug: Column, text: Column, noindex: Column) -> Column:
    """Character pages that say less than 40 characters of their own, or pages marked so; an explicit false opts out."""
    return F.coalesce(noindex, slug.startswith("characters/") & (F.length(own_prose(text)) < 40), F.lit(False))


def is_atom(slug: Column) -> Column:
    return slug.contains("#")


def stub_atom(title: Column, text: Column) -> Column:
    """"Part N" and short units of contents."""
    return title.rlike(r"(?i)^\s*part\s+(\d+|[ivxlc]+)\.?\s*$") | title.rlike(r"(?i)^\s*(contents|part)\b") & (F.length(text) < 280)


def all_of(predicates: Iterable[Column]) -> Column:
    """The fold of publishing filters; none lets everything through."""
    return reduce(Column.__and__, predicates, F.lit(True))


class Match:
    """Matchers of page kinds; they combine with & | ~ and become Columns."""

    def __init__(self, make: Callable[[], Column]):
        self.make = make

    def __and__(self, other: Match) -> Match:
        return Match(lambda: self.make() & other.make())

    def __or__(self, other: Match) -> Match:
        return Match(lambda: self.make() | other.make())

    def __invert__(self) -> Match:
        return Match(lambda: ~self.make())

    @staticmethod
    def ext(*endings: str) -> Match:
        return Match(lambda: reduce(Column.__or__, [F.col("path").endswith(e) for e in endings]))

    @staticmethod
    def prefix(start: str) -> Match:
        return Match(lambda: F.col("slug").startswith(start))

    @staticmethod
    def field(name: str, value: object) -> Match:
        return Match(lambda: F.coalesce(F.col(name) == value, F.lit(False)))

    @staticmethod
    def all() -> Match:
        return Match(lambda: F.lit(True))

    @staticmethod
    def none() -> Match:
        return Match(lambda: F.lit(False))


CONDITIONS: dict[str, Callable[[], Column]] = {
    "not-index": lambda: F.col("slug") != "index",
    "has-tags": lambda: F.size("tags") > 0,
    "has-backlinks": lambda: F.col("backlinks") > 0,
    "has-toc": lambda: F.col("toc") > 1,
}


def condition(name: str) -> Column:
    return CONDITIONS[name]()


def register_condition(name: str, make: Callable[[], Column]) -> None:
    """A predicate by name, at run time; a name is given once."""
    if name in CONDITIONS:
        raise ValueError(f"condition {name} exists")
    CONDITIONS[name] = make


def shard_of(key: Column, shards: int) -> Column:
    """The shard that works a key off, by the first 8 hex digits of its SHA-1."""
    return F.conv(F.substring(F.sha1(key), 1, 8), 16, 10).cast("long") % shards
