"""Tiered text search: projections of one ranked master, boolean retrieval, scores, section dedup; vectors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions import boolquery as B
from vellum.functions import text as T
from vellum.operators.aggregates import tfidf

# Terms and characters of the snippet that each tier keeps, and whether reading units are in it.
TIERS = {0: (30, 160, False), 1: (150, 400, False), 2: (80, 400, True), 3: (500, 700, True)}
DIM = 256


def master(notes: DataFrame, key: str = "slug", content: str = "content", keep: int = 500) -> DataFrame:
    """Notes with ``terms``, ranked, and ``snippet``: written once, projected for every tier."""
    ranked = tfidf(notes, T.search_rows(notes, key, content), key, keep)
    held = F.transform(F.sort_array(F.collect_list(F.struct("rank", "term"))), lambda s: s["term"])
    terms = ranked.groupBy(key).agg(held.alias("terms"))
    return notes.join(terms, key, "left").withColumns({"terms": F.coalesce("terms", F.array().cast("array<string>")), "snippet": T.snippet(F.col(content))})


def content_for(snippet: Column, terms: Column, atom_titles: Column, title: Column, n: int, chars: int) -> Column:
    """Snippet, top terms, the units' titles and the own title, those that aren't empty."""

    def some(x: Column) -> Column:
        return F.when(x != "", x)

    return F.concat_ws(" ", some(F.substring(snippet, 1, chars)), some(F.array_join(F.slice(terms, 1, n), " ")), some(F.coalesce(atom_titles, F.lit(""))), some(F.coalesce(title, F.lit(""))))


def tier(ranked: DataFrame, stop: int) -> DataFrame:
    """(slug, title, content) of one depth; ``ranked`` has slug, title, snippet, terms, atom_titles."""
    n, chars, units = TIERS[stop]
    rows = ranked if units else ranked.where(~F.col("slug").contains("#"))
    return rows.select("slug", "title", content_for(F.col("snippet"), F.col("terms"), F.col("atom_titles"), F.col("title"), n, chars).alias("content"))


def occurrences(hay: Column, needle: str) -> Column:
    """How often a text holds another, without overlap."""
    return ((F.length(hay) - F.length(F.replace(hay, F.lit(needle), F.lit("")))) / len(needle)).cast("long")


def score(title: Column, content: Column, terms: list[str]) -> Column:
    """100 + 10 for each hit in the title and 10 for each in the content, by term; -1 without a hit."""
    parts, hits = [], []
    for term in terms:
        a, b = occurrences(F.lower(F.coalesce(title, F.lit(""))), term), occurrences(F.lower(F.coalesce(content, F.lit(""))), term)
        parts.append(F.when(a > 0, 100 + 10 * a).otherwise(0) + 10 * b)
        hits.append((a > 0) | (b > 0))
    if not terms:
        return F.lit(-1).cast("long")
    return F.when(reduce(Column.__or__, hits), reduce(Column.__add__, parts)).otherwise(-1).cast("long")


def search(docs: DataFrame, raw: str, default: str = "or") -> DataFrame:
    """(slug, score): notes that match, one a section, best first by score then slug.

    Every note is looked at: no candidate limit cuts conjunctions short.
    """
    query = B.parse(raw, default)
    hay = B.haystack(F.col("title"), F.col("content"), F.col("tags"))
    found = docs.where(B.matches(hay, query)).select("slug", score(F.col("title"), F.col("content"), query.terms).alias("score")).where("score >= 0")
    section = Window.partitionBy(T.section_key(F.col("slug"))).orderBy(F.desc("score"), "slug")
    return found.withColumn("_n", F.row_number().over(section)).where("_n = 1").select("slug", "score")


def prefix_candidates(postings: DataFrame, term: str) -> DataFrame:
    """Keys whose field has a word that starts with the term; ``postings``: (key, field, word)."""
    return postings.where(F.col("word").startswith(term.lower())).select("key", "field").distinct()


def fuzzy_candidates(postings: DataFrame, term: str, share: float = 0.2, boost: dict[str, float] | None = None) -> DataFrame:
    """(key, score): words within ``share`` of the term's length in edits, or that it begins; fields weigh by ``boost``.

    The distance is taken once for each distinct word, not for each posting.
    """
    limit = max(1, round(share * len(term)))
    far = F.levenshtein(F.col("word"), F.lit(term.lower()), limit)
    words = postings.select("word").distinct().withColumn("far", far).where((F.col("far") >= 0) | F.col("word").startswith(term.lower()))
    weight = reduce(lambda x, item: x.when(F.col("field") == item[0], item[1]), (boost or {"title": 3.0, "tags": 2.0}).items(), F.when(F.lit(False), 1.0)).otherwise(1.0)
    near = F.when(F.col("far") >= 0, 1 / (1 + F.col("far"))).otherwise(0.5)
    return postings.join(words, "word").groupBy("key").agg(F.sum(weight * near).alias("score"))


def unit_length(v: Column, dim: int = DIM) -> Column:
    """The first ``dim`` components at length 1."""
    cut = F.slice(F.transform(v, lambda x: x.cast("double")), 1, dim)
    norm = F.sqrt(F.aggregate(cut, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(cut, lambda x: x / norm)


def quantized(v: Column, dim: int = DIM) -> Column:
    """Unit vectors in whole steps of 1/127, halves to even."""
    return F.transform(unit_length(v, dim), lambda x: F.greatest(F.lit(-127.0), F.least(F.lit(127.0), F.rint(x * 127))).cast("tinyint"))


def corpus(atoms: DataFrame, pages: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, kind, title, speaker, text): units, pages without units and spoken lines of the semantic corpus.

    atoms: (id, title, text); pages: (id, title, text); lines: (id, title, speaker, text).
    """
    with_units = atoms.select(F.split_part("id", F.lit("#"), F.lit(1)).alias("id")).distinct()
    one = atoms.select("id", F.lit("atom").alias("kind"), "title", F.lit("").alias("speaker"), F.substring("text", 1, 1500).alias("text")).where("text <> '' or title <> ''")
    two = pages.join(with_units, "id", "left_anti").select("id", F.lit("page").alias("kind"), "title", F.lit("").alias("speaker"), F.substring("text", 1, 1500).alias("text")).where("length(text) >= 20 or title <> ''")
    three = lines.where("length(text) >= 12").select("id", F.lit("line").alias("kind"), "title", "speaker", F.substring("text", 1, 1500).alias("text"))
    return one.unionByName(two).unionByName(three)
