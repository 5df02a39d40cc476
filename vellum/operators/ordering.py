"""Sort rules and pages of the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions import text as T
from vellum.sources.scratch import small, written

#: Pages that end before this row are read through a limit.
NEAR = 10_000
# Order of the tag axes.
AXES = ("topos", "archetype", "motif", "concept", "form", "histref", "setting", "character")


def _directed(key: Column, ascending: bool) -> Column:
    """Missing values last either way."""
    return key.asc_nulls_last() if ascending else key.desc_nulls_last()


def works_order(key: str, ascending: bool, numeric: bool, title: str = "title", tie: str = "slug") -> list[Column]:
    """Numbers as they are, missing last; other columns without their article; ties by title, always upwards.

    Reading bands go by difficulty; without one last upwards, first downwards.
    """
    if key == "cefr":
        rank = T.cefr_rank(F.col("flesch"))
        first = rank.asc() if ascending else rank.desc()
    elif numeric:
        first = _directed(F.when(~F.isnan(F.col(key).cast("double")), F.col(key)), ascending)
    else:
        first = _directed(T.no_article(F.coalesce(F.col(key), F.lit(""))), ascending)
    return [first, F.lower(title).asc(), F.col(tie).asc()]


def excerpts_order(key: str, ascending: bool = True) -> list[Column]:
    return [_directed(T.no_article(T.human(F.col(key))), ascending), F.col("work").asc(), F.col("order").asc()]


def concept_order(key: str) -> list[Column]:
    return [T.no_article(F.col(key)).asc(), T.no_article(F.col("title")).asc(), F.col("slug").asc()]


def tags_order(descending: bool = True) -> list[Column]:
    return [F.desc("count") if descending else F.asc("count"), F.asc("tag")]


def pages_order(folder_first: bool = False) -> list[Column]:
    """Dated pages first, latest first; the rest by title."""
    dated = [F.col("date").desc_nulls_last(), F.lower("title").asc(), F.col("slug").asc()]
    return [F.desc("is_folder"), *dated] if folder_first else dated


def scene_order(act: str, scene: str, letter: str) -> list[Column]:
    return [F.struct(F.col(act), F.col(scene), F.col(letter)).asc()]


def axis_order(tag: Column) -> list[Column]:
    axis = F.split_part(tag, F.lit("/"), F.lit(1))
    rank = F.array_position(F.array(*map(F.lit, AXES)), axis)
    return [F.when(rank > 0, rank).asc_nulls_last(), tag.asc()]


def toc_order(chapter: str, position: str) -> list[Column]:
    """Units without a number first, then by number, then as they came."""
    return [F.col(chapter).asc_nulls_first(), F.col(position).asc()]


def _ranges(rows: DataFrame, order: list[Column], group: str | None, value: Column) -> DataFrame:
    """``rows`` sorted into ranges over all tasks, by group first, with ``_here``, the sum of ``value`` over the range's rows of the group
    up to each row, and ``_before``, that of the ranges before it."""
    by = [F.col(group).asc()] if group else []
    keyed = rows.withColumns({"_g": F.struct((F.col(group) if group else F.lit(0)).alias("g")), "_v": value.cast("long")})
    held = written(keyed.orderBy(*by, *order).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    totals = held.groupBy("_g", "_part").agg(F.sum("_v").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # a row for each range
    starts = written(totals.select("_g", "_part", F.coalesce(before, F.lit(0)).alias("_before")))
    here = F.sum("_v").over(Window.partitionBy("_g", "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    return held.withColumn("_here", here).join(small(starts), ["_g", "_part"])


def numbered(rows: DataFrame, order: list[Column], group: str | None = None) -> DataFrame:
    """Rows with their place (``pos``, from 1); within a group if one is given.  No task holds a whole group."""
    return _ranges(rows, order, group, F.lit(1)).select(*rows.columns, (F.col("_here") + F.col("_before")).alias("pos"))


def running(rows: DataFrame, order: list[Column], group: str, value: Column, name: str) -> DataFrame:
    """Rows with ``name``: the sum of ``value`` over the rows of their group before them.  No task holds a whole group."""
    return _ranges(rows, order, group, value).select(*rows.columns, (F.col("_here") + F.col("_before") - F.col("_v")).alias(name))


def page(rows: DataFrame, order: list[Column], size: int, number: int) -> DataFrame:
    """The rows of a page; size 0 shows all, and a page beyond the last (or before the first) becomes the last (first).

    The first pages sort no further than their end: a limit on an ordered frame keeps only so many rows of each
    partition.  Pages further on are cut from the places of all rows.
    """
    if size <= 0:
        return rows.orderBy(*order)
    pages = max(1, -(-rows.count() // size))
    number = min(max(number, 0), pages - 1)
    if (number + 1) * size <= NEAR:
        return rows.orderBy(*order).offset(number * size).limit(size)
    return numbered(rows, order).where(F.col("pos").between(number * size + 1, (number + 1) * size)).orderBy("pos").drop("pos")


def pager(pages: int, current: int, around: int = 2) -> list[int]:
    """Page numbers shown beside the current one."""
    return list(range(max(0, current - around), min(pages - 1, current + around) + 1))
