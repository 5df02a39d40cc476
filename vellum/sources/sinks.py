"""Writers: tiers with manifests and size guards, upserts, rekeying, sitemaps, redirects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions.text import esc_html
from vellum.operators.ordering import running

#: No file may be larger, and tiers above their soft size are reported.
HARD_CAP = 25 * 1024 * 1024
SOFT = {0: 4_500_000, 1: 5_000_000, 2: HARD_CAP * 9 // 10, 3: HARD_CAP * 9 // 10}


def json_bytes(row: Column) -> Column:
    return F.octet_length(F.to_json(row)).cast("long")


def bucketed(rows: DataFrame, group: str, order: str, row: Column, target: int) -> DataFrame:
    """Rows with ``bucket``: each about ``target`` bytes of JSON, by running size within a group."""
    summed = running(rows, [F.col(order).asc()], group, json_bytes(row) + 1, "_before_bytes")
    return summed.withColumn("bucket", F.floor(F.col("_before_bytes") / target).cast("int")).drop("_before_bytes")


def write_shards(rows: DataFrame, path: str, group: str = "tier") -> DataFrame:
    """Write JSON by group and bucket, then return the manifest; a file over the hard cap fails."""
    rows.repartition(group, "bucket").write.partitionBy(group, "bucket").mode("errorifexists").json(path)
    return guard(rows.sparkSession, path)


def guard(spark, path: str, cap: int = HARD_CAP) -> DataFrame:
    """(path, bytes) of all files below; fails if one is larger than the cap."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("bytes"))
    over = files.where(F.col("bytes") > cap).limit(5).collect()
    if over:
        raise ValueError(f"files over {cap} bytes: {[r['path'] for r in over]}")
    return files


def upsert(store: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Fresh rows replace those of their key; of fresh rows with one key the last by ``at`` counts, of those the greatest by its other columns."""
    both = store.withColumn("_new", F.lit(0)).withColumn("at", F.lit(0).cast("long") if "at" not in store.columns else F.col("at")).unionByName(fresh.withColumn("_new", F.lit(1)))
    latest = Window.partitionBy(key).orderBy(F.desc("_new"), F.desc("at"), *(F.desc(c) for c in store.columns if c not in (key, "at")))
    return both.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n", "_new")


def rekey(rows: DataFrame, key: str, mapping: DataFrame) -> DataFrame:
    """Keys replaced by ``mapping`` (old, new); others pass, with ``unmapped``."""
    joined = rows.join(mapping, F.col(key) == F.col("old"), "left")
    return joined.withColumn("unmapped", F.col("new").isNull()).withColumn(key, F.coalesce("new", key)).drop("old", "new")


def sitemap(urls: DataFrame, url: str, thin: DataFrame) -> DataFrame:
    """Urls whose path, also without its first part, is in no thin page's ``slug``."""
    path = F.regexp_replace(F.regexp_replace(url, r"^https?://[^/]+/", ""), r"[?#].*$", "")
    rows = urls.withColumn("_p", path).withColumn("_q", F.regexp_replace(path, "^[^/]*/", ""))
    return rows.join(thin.select(F.col("slug").alias("_p")), "_p", "left_anti").join(thin.select(F.col("slug").alias("_q")), "_q", "left_anti").drop("_p", "_q")


def redirects(mapping: DataFrame, pages: DataFrame) -> DataFrame:
    """(old, new) for pages that exist no more; keys that start with _ are notes, not pages."""
    return mapping.where(~F.col("old").startswith("_")).join(pages.select(F.col("slug").alias("old")), "old", "left_anti")


def page_html(title: Column, paragraphs: Column, lang: Column) -> Column:
    """A page: title, heading and paragraphs, escaped."""
    body = F.array_join(F.transform(paragraphs, lambda p: F.concat(F.lit("<p>"), esc_html(p), F.lit("</p>"))), "")
    return F.concat(F.lit('<!DOCTYPE html><html lang="'), lang, F.lit('"><head><title>'), esc_html(title), F.lit("</title></head><body><article><h1>"), esc_html(title), F.lit("</h1>"), body, F.lit("</article></body></html>"))


def manifest(rows: DataFrame, group: str, order: str, member: Column) -> DataFrame:
    """(group, members as JSON, size)."""
    held = F.transform(F.sort_array(F.collect_list(F.struct(F.col(order), member.alias("m")))), lambda s: s["m"])
    return rows.groupBy(group).agg(F.to_json(held).alias("members"), F.count("*").alias("size"))
