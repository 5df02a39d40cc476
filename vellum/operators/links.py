"""Wikilinks, the link graph and the path hierarchy."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.sources.scratch import written

#: Target, anchor, separator (escaped in table rows) and words of a link; links don't nest.
WIKILINK = r"\[\[([^\[\]|#\\]+)(#[^\[\]|\\]*)?(?:(\\?\|)([^\[\]]*))?\]\]"
_LINK = re.compile(WIKILINK)


def extract_links(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, target, anchor, alias) of each link, in order; alias is null where the link has none."""
    whole = F.posexplode(F.regexp_extract_all(text, F.lit(WIKILINK), F.lit(0)))
    found = rows.select(key, whole.alias("pos", "link"))
    return found.select(
        key, "pos",
        F.regexp_extract("link", WIKILINK, 1).alias("target"),
        F.regexp_extract("link", WIKILINK, 2).alias("anchor"),
        F.when(F.regexp_extract("link", WIKILINK, 3) != "", F.regexp_extract("link", WIKILINK, 4)).alias("alias"),
    )


def resolve_links(links: DataFrame, notes: DataFrame, folders: list[str]) -> DataFrame:
    """``links`` (target, alias, author, ...) with ``slug``: where each leads, null if nowhere.

    A target with a slash must be a slug.  Else notes of that last part count: those with works before empty ones, then by
    the folder's place, then by name.  Else, if the link reads as a title (capital, shown as it is), works whose title
    is the target without its suffixes in parentheses: the fewest suffixes, then the same author, then by name.
    ``notes``: (slug, weight, author).
    """
    sluggish = F.lower(F.regexp_replace(F.trim("target"), r"\s+", "-"))
    asked = written(links.withColumn("_t", sluggish).withColumn("_id", F.monotonically_increasing_id()))  # read twice, so ids must stay
    folder = F.split_part("slug", F.lit("/"), F.lit(1))
    place = F.array_position(F.array(*map(F.lit, folders)), folder)
    known = notes.select("slug", F.col("author").alias("note_author"), "weight", F.element_at(F.split("slug", "/"), -1).alias("base"), F.when(place > 0, place).otherwise(len(folders) + 1).alias("place"))
    exact = known.select("slug", F.col("slug").alias("_t"), F.lit(0).alias("level"), F.lit(0).alias("empty"), F.lit(0).alias("place"), "note_author")
    by_base = known.select("slug", F.col("base").alias("_t"), F.lit(1).alias("level"), (F.coalesce("weight", F.lit(0)) <= 0).cast("int").alias("empty"), "place", "note_author")
    works = known.where(F.col("slug").startswith("works/"))
    suffix = r"(?:[-\s]*\([^()]*\))"
    stripped = [works.select("slug", F.regexp_replace("base", suffix + "{%d}$" % n, "").alias("_t"), F.lit(2).alias("level"), F.lit(n).alias("empty"), F.lit(0).alias("place"), "note_author").where(F.col("base").rlike(suffix + "{%d}$" % n)) for n in (1, 2, 3)]
    candidates = exact.unionByName(by_base)
    for more in stripped:
        candidates = candidates.unionByName(more.where("_t <> ''"))
    titled = (F.coalesce("alias", "target") == F.col("target")) & F.trim("target").rlike(r"^\p{Lu}")
    joined = asked.join(candidates, "_t", "left").where(F.col("level").isNull() | F.when(F.col("_t").contains("/"), F.col("level") == 0).otherwise((F.col("level") == 1) | (F.col("level") == 2) & titled))
    same = F.when(F.col("level") == 2, (F.lower("note_author") != F.lower("author")).cast("int")).otherwise(0)
    best = Window.partitionBy("_id").orderBy("level", "empty", F.coalesce(same, F.lit(1)), "place", "slug")
    found = joined.withColumn("_n", F.row_number().over(best)).where("_n = 1").select("_id", "slug")
    return asked.join(found, "_id", "left").drop("_id", "_t")


def rewrite(text: str, resolve: Callable[[str, str | None], str | None]) -> str:
    """Links lead to full slugs and show what they showed; in a table row a new separator is escaped."""

    def put(m: re.Match) -> str:
        target, anchor, sep, alias = m[1], m[2] or "", m[3], m[4]
        slug = resolve(target, alias if sep else None)
        if slug is None or slug == target:
            return m[0]
        line = text[text.rfind("\n", 0, m.start()) + 1 : m.start() + 1]
        sep = sep or (r"\|" if line.lstrip(" \t").startswith("|") else "|")
        return f"[[{slug}{anchor}{sep}{target if alias is None else alias}]]"

    return _LINK.sub(put, text)


def strip_dead(text: str, keep: Callable[[str, str | None], bool]) -> tuple[str, list[str]]:
    """Links that lead nowhere become their words; the targets lost."""
    lost: list[str] = []

    def put(m: re.Match) -> str:
        alias = m[4] if m[3] else None
        if keep(m[1], alias):
            return m[0]
        lost.append(m[1])
        return m[1] if alias is None else alias

    return _LINK.sub(put, text), lost


def _by_targets(rows: DataFrame, key: str, text: str, known: DataFrame, change, extra: str) -> DataFrame:
    """Rewrite every text with the (target, slug) pairs of its own links only, joined by key."""
    links = extract_links(rows, key, text).select(key, "target").distinct()
    pairs = links.join(known, "target").groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("target", "slug"))).alias("known"))
    joined = rows.select(key, text).join(pairs, key, "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [change(t or "", dict(k or {})) for t, k in zip(pdf[text], pdf["known"], strict=True)]
            yield pd.DataFrame({key: pdf[key], text: [a for a, _ in out], "stripped": [b for _, b in out]})

    return joined.mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, {text} string, stripped {extra}")


def rewrite_links(rows: DataFrame, key: str, text: str, known: DataFrame) -> DataFrame:
    """Texts whose links lead to the slugs of ``known`` (target, slug)."""
    return _by_targets(rows, key, text, known, lambda t, k: (rewrite(t, lambda target, _: k.get(target)), []), "array<string>").drop("stripped")


def strip_dead_links(rows: DataFrame, key: str, text: str, known: DataFrame) -> DataFrame:
    """Texts without the links that ``known`` doesn't have, and the targets lost."""
    return _by_targets(rows, key, text, known, lambda t, k: strip_dead(t, lambda target, _: target in k), "array<string>")


def backlinks(edges: DataFrame) -> DataFrame:
    """(dst, n, sources) of (src, dst), each source once."""
    return edges.distinct().groupBy("dst").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("src")).alias("sources"))


def leaf_edges(slugs: DataFrame) -> DataFrame:
    """(src, dst): from each reading unit to its work; none to itself."""
    work = F.split_part("slug", F.lit("#"), F.lit(1))
    return slugs.where(F.col("slug").contains("#") & (work != F.col("slug"))).select(F.col("slug").alias("src"), work.alias("dst"))


def capped_nodes(edges: DataFrame, most: int) -> DataFrame:
    """(node, degree): the best connected nodes, ties by name."""
    both = edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node")))
    return both.groupBy("node").agg(F.count("*").alias("degree")).orderBy(F.desc("degree"), "node").limit(most)


def capped_links(rows: DataFrame, links: str, most: int = 20) -> DataFrame:
    return rows.withColumn(links, F.slice(links, 1, most))


def cyclic_core(edges: DataFrame) -> DataFrame:
    """The edges (src, dst) that lie on cycles or between them: what is left when nodes that nothing leads to, or from, are peeled off
    until none is found.  Of a graph without a cycle nothing is left, however deep it is."""
    left, before = written(edges.select("src", "dst").where("src is not null and dst is not null").distinct()), -1
    count = left.count()
    while 0 < count != before:
        led_to, led_from = left.select(F.col("dst").alias("src")).distinct(), left.select(F.col("src").alias("dst")).distinct()
        left = written(left.join(led_to, "src", "left_semi").join(led_from, "dst", "left_semi").select("src", "dst"))
        before, count = count, left.count()
    return left


def has_cycle(edges: DataFrame) -> bool:
    """Whether some walk along (src, dst) comes back to where it began."""
    return not cyclic_core(edges).isEmpty()


def transclusions(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, page, path, cyclic): all that a page includes, step by step, to any depth; a page met again ends its path."""
    includes = written(edges.select("src", "dst").distinct())
    step = written(roots.select(F.col("page").alias("root"), "page", F.array("page").alias("path"), F.lit(False).alias("cyclic")))
    found = step
    while not step.isEmpty():  # paths hold no page twice but at their end, so they end
        ahead = step.where("not cyclic").join(includes, F.col("page") == F.col("src"))
        step = written(ahead.select("root", F.col("dst").alias("page"), F.array_append("path", F.col("dst")).alias("path"), F.array_contains("path", F.col("dst")).alias("cyclic")))
        found = found.unionByName(step)
    return found


def trie(paths: DataFrame, path: str) -> DataFrame:
    """(node, parent, depth, is_folder, pages): every prefix of every path once; ``a/index`` is the folder a itself."""
    clean = F.regexp_replace(path, "(^|/)index$", "")
    parts = F.filter(F.split(clean, "/"), lambda p: p != "")
    nodes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))), lambda i: F.struct(F.array_join(F.slice(parts, F.lit(1), i), "/").alias("node"), F.array_join(F.slice(parts, F.lit(1), i - 1), "/").alias("parent"), i.alias("depth"), ((i < F.size(parts)) | F.col(path).rlike("(^|/)index$")).alias("inner")))
    return paths.select(F.inline(nodes)).groupBy("node", "parent", "depth").agg(F.bool_or("inner").alias("is_folder"), F.count("*").alias("pages"))


def assemble(leaves: DataFrame, parent: Column, order: str, title: str, body: Column) -> DataFrame:
    """(page, leaves, body): a page's text from its children in order; pages with an incomplete child are left out."""
    held = F.transform(F.sort_array(F.collect_list(F.struct(order, title, body.alias("body")))), lambda s: F.concat(F.lit("## "), s[title], F.lit("\n"), s["body"]))
    return leaves.groupBy(parent.alias("page")).agg(F.count("*").alias("leaves"), F.every(body.isNotNull()).alias("whole"), held.alias("held")).where("whole").select("page", "leaves", F.array_join("held", "\n\n").alias("body"))
