"""Aggregations of the collection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions import text as T


def term_counts(terms: DataFrame, key: str) -> DataFrame:
    """(key, term, tf) of rows (key, term): how often each note has each term."""
    return terms.groupBy(key, "term").agg(F.count("*").alias("tf"))


def document_frequency(counts: DataFrame) -> DataFrame:
    """(term, df); a row of ``counts`` is a distinct pair, so this needs no distinct."""
    return counts.groupBy("term").agg(F.count("*").alias("df"))


def tfidf(notes: DataFrame, terms: DataFrame, key: str, keep: int, drop_zero: bool = True) -> DataFrame:
    """(key, rank, term, score): the ``keep`` terms of largest tf * ln(N / df) of rows ``terms`` (key, term).

    N counts all of ``notes``, also those without terms.  Terms of every note have no weight and are dropped if
    ``drop_zero``.  Ties go by term.
    """
    counts = term_counts(terms, key)
    total = notes.agg(F.count_distinct(key).alias("n"))
    weighed = counts.join(document_frequency(counts), "term").crossJoin(F.broadcast(total))  # one row
    scored = weighed.withColumn("score", F.col("tf") * F.log(F.col("n") / F.col("df")))
    if drop_zero:
        scored = scored.where("df < n")
    order = Window.partitionBy(key).orderBy(F.desc(F.round("score", 9)), "term")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep).select(key, "rank", "term", "score")


def child_titles(notes: DataFrame, parent: str, order: str, title: str) -> DataFrame:
    """(parent, titles): the children's titles in order, joined by blanks."""
    held = F.transform(F.sort_array(F.collect_list(F.struct(order, title))), lambda s: s[title])
    return notes.where(F.col(title) != "").groupBy(parent).agg(F.array_join(held, " ").alias("titles"))


def facet_counts(rows: DataFrame, facets: dict[str, bool]) -> DataFrame:
    """(facet, value, n) of all rows; facets map a column to whether it holds an array.  One pass over the rows."""

    def values(column: str, multi: bool) -> Column:
        held = F.col(column) if multi else F.array(F.col(column).cast("string"))
        return F.transform(held, lambda v: F.struct(F.lit(column).alias("facet"), v.alias("value")))

    each = [values(c, multi) for c, multi in facets.items()]
    return rows.select(F.inline(F.concat(*each))).where("value is not null").groupBy("facet", "value").agg(F.count("*").alias("n"))


def prefixes(tag: Column) -> Column:
    """a/b/c: a, a/b, a/b/c."""
    parts = F.split(tag, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))


def tag_rollup(notes: DataFrame, tags: str) -> DataFrame:
    """(tag, type, count): a note counts once for each prefix of its tags."""
    own = F.array_distinct(F.flatten(F.transform(F.filter(tags, lambda t: t != ""), prefixes)))
    counted = notes.select(F.explode(own).alias("tag")).groupBy("tag").agg(F.count("*").alias("count"))
    return counted.select("tag", F.when(F.col("tag").contains("/"), F.split_part("tag", F.lit("/"), F.lit(1))).otherwise("generale").alias("type"), "count")


def profile(notes: DataFrame, author: str, text: str) -> DataFrame:
    """Per author: words, vocabulary, sentences, syllables and words of three syllables or more, and what follows from them.

    Words of one or two letters count nowhere.
    """
    counted = T.profile_rows(notes, author, text).groupBy(author, "term").agg(F.count("*").alias("n"))
    syl = T.syllables(F.col("term"))
    lexical = counted.groupBy(author).agg(F.sum("n").alias("words"), F.count("*").alias("vocabulary"), F.sum(F.col("n") * syl).alias("syllables"), F.sum(F.when(syl >= 3, F.col("n")).otherwise(0)).alias("complex"))
    spans = notes.groupBy(author).agg(F.sum(F.size(T.sentences(F.col(text)))).alias("sentences"))
    return lexical.join(spans, author).withColumn("sentences", F.greatest("sentences", F.lit(1)))


def readability(stats: DataFrame) -> DataFrame:
    """Flesch, Flesch-Kincaid and fog of :func:`profile`, not rounded."""
    w, s, c = F.col("words") / F.col("sentences"), F.col("syllables") / F.col("words"), F.col("complex") / F.col("words")
    return stats.withColumns({"flesch": 206.835 - 1.015 * w - 84.6 * s, "fk_grade": 0.39 * w + 11.8 * s - 15.59, "fog": 0.4 * (w + 100 * c)})


def top_per(rows: DataFrame, group: str, value: str, keep: int) -> DataFrame:
    """(group, value, n, rank): the most frequent values of each group, ties by value."""
    order = Window.partitionBy(group).orderBy(F.desc("n"), value)
    return rows.groupBy(group, value).agg(F.count("*").alias("n")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def merged_clusters(rows: DataFrame, cluster: str, merge: dict[str, str], least: int) -> DataFrame:
    """(cluster, size, small): sizes under the final labels; ``small`` marks those under ``least``."""
    final = F.col(cluster)
    if merge:
        pairs = F.create_map(*[F.lit(x) for pair in merge.items() for x in pair])
        final = F.coalesce(F.try_element_at(pairs, F.col(cluster)), F.col(cluster))
    return rows.select(final.alias("cluster")).groupBy("cluster").agg(F.count("*").alias("size")).withColumn("small", F.col("size") < least)


def tail_merge(rows: DataFrame, cluster: str, least: int, targets: DataFrame) -> DataFrame:
    """(cluster, size, into): clusters under ``least`` go where ``targets`` (cluster, into) says; unresolved ones have no target."""
    sizes = rows.groupBy(F.col(cluster).alias("cluster")).agg(F.count("*").alias("size"))
    return sizes.join(targets, "cluster", "left").withColumn("into", F.when(F.col("size") >= least, F.col("cluster")).otherwise(F.col("into")))


def lexicon(pairs: DataFrame, label: str, target: str, least: int = 2, share: float = 0.8) -> DataFrame:
    """(label, target, n, total): the target that has at least ``share`` of a label's ``least`` or more uses."""
    counts = pairs.groupBy(label, target).agg(F.count("*").alias("n"))
    totals = counts.groupBy(label).agg(F.sum("n").alias("total"))
    return counts.join(totals, label).where((F.col("total") >= least) & (F.col("n") >= share * F.col("total")))


def label_mode(pairs: DataFrame, target: str, label: str, position: str) -> DataFrame:
    """(target, label): its most common label, of ties the one seen first."""
    counts = pairs.groupBy(target, label).agg(F.count("*").alias("n"), F.min(position).alias("first"))
    return counts.groupBy(target).agg(F.min(F.struct((-F.col("n")).alias("n"), "first", label)).alias("best")).select(target, f"best.{label}")


def _commonest(rows: DataFrame, group: list[str], by: Column, raw: Column) -> DataFrame:
    """(group, best, n, second, total): of the most frequent ``by`` the most frequent ``raw``, how often ``by`` is met, and the runner-up."""
    counts = rows.select(*group, by.alias("by"), raw.alias("raw")).groupBy(*group, "by", "raw").agg(F.count("*").alias("n"))
    each = counts.groupBy(*group, "by").agg(F.sum("n").alias("n"), F.min(F.struct((-F.col("n")).alias("less"), "raw")).alias("top"))
    place = Window.partitionBy(*group).orderBy(F.desc("n"), "by")
    ranked = each.withColumn("place", F.row_number().over(place))
    return ranked.groupBy(*group).agg(F.min(F.when(F.col("place") == 1, F.col("top.raw"))).alias("best"), F.max("n").alias("n"), F.coalesce(F.max(F.when(F.col("place") == 2, F.col("n"))), F.lit(0)).alias("second"), F.sum("n").alias("total"))


def majority_title(rows: DataFrame, group: str, title: Column, work: str | None = None) -> DataFrame:
    """(group, title): what most of a group's titles agree on, as one of them spells it; else null.

    First the whole title, compared in its normal form, if more than half have it.  Else, if all have the form "work — rest", the
    part before the dash, if more than half agree on that.  Else, if all rests agree, that rest under the name that the
    titles of the whole ``work`` have more often than any other.  Ties in spelling go to the smaller text.
    """
    dash = " \u2014 "
    flat = F.regexp_replace(title, " [\u2013\u2014-] ", dash)
    rows = rows.select(group, *([work] if work and work != group else []), title.alias("_t"), F.split_part(flat, F.lit(dash), F.lit(1)).alias("_head"), F.when(flat.contains(dash), F.substring(flat, F.instr(flat, dash) + 3, F.length(flat))).alias("_rest")).where("_t is not null")

    def named(found: DataFrame, prefix: str, on: str) -> DataFrame:
        return found.select(on, *[F.col(c).alias(f"{prefix}_{c}") for c in ("best", "n", "second", "total")])

    whole = named(_commonest(rows, [group], T.title_norm(F.col("_t")), F.col("_t")), "t", group)
    parted = rows.where("_rest is not null")
    heads = named(_commonest(parted, [group], T.title_norm(F.col("_head")), F.col("_head")), "h", group)
    rests = named(_commonest(parted, [group], T.title_norm(F.col("_rest")), F.col("_rest")), "r", group)
    joined = whole.join(heads, group, "left").join(rests, group, "left")
    if work:
        votes = named(_commonest(parted, [work], T.title_norm(F.col("_head")), F.col("_head")), "w", work)
        joined = joined.join(rows.groupBy(group).agg(F.min(work).alias(work)), group).join(votes, work, "left") if work != group else joined.join(votes, work, "left")
        winner = F.when(F.col("w_n") > F.col("w_second"), F.col("w_best"))
    else:
        winner = F.lit(None).cast("string")
    every = F.col("h_total") == F.col("t_total")
    ladder = (
        F.when(F.col("t_n") * 2 > F.col("t_total"), F.col("t_best"))
        .when(every & (F.col("h_n") * 2 > F.col("h_total")), F.col("h_best"))
        .when(every & (F.col("r_n") == F.col("r_total")), F.concat(winner, F.lit(dash), F.col("r_best")))
    )
    return joined.select(group, ladder.alias("title"))


def completion(leaves: DataFrame, group: str, done: Column) -> DataFrame:
    """(group, leaves, done, pct, complete): pct rounded down."""
    counted = leaves.groupBy(group).agg(F.count("*").alias("leaves"), F.count(F.when(done, 1)).alias("done"), F.every(done).alias("complete"))
    return counted.withColumn("pct", F.floor(100 * F.col("done") / F.col("leaves")).cast("long"))


def index_quantile(rows: DataFrame, value: str, p: float) -> DataFrame:
    """The value at place floor(n * p) of the sorted values, 0 for none; found by counting values, not by gathering rows."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    upto = F.sum("n").over(Window.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))  # a row for each distinct value
    place = F.least(F.floor(F.col("total") * p), F.col("total") - 1)
    hit = counts.withColumn("upto", upto).crossJoin(F.broadcast(total)).where(F.col("upto") > place)
    return hit.agg(F.coalesce(F.min(value), F.lit(0)).cast("long").alias("value"))


def merge_tier(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Upsert: content from ``new`` where it has the key; other columns stay unless ``new`` has them."""
    columns = [c for c in old.columns if c != key]
    renamed = new.select(key, *[F.col(c).alias(f"new_{c}") for c in new.columns if c != key])
    held = [F.coalesce(F.col(f"new_{c}"), F.col(c)).alias(c) if c in new.columns else F.col(c) for c in columns]
    return old.join(renamed, key, "full").select(key, *held)
