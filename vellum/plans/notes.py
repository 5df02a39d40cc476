"""The annotated collection that queries run on, made from the test tables, in both languages.

A document is a note: every fifth one a work, the four after it reading units (``work#part-k``) of it.  Source is
the author; language, author and labels are namespaced tags.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.plans.registry import table
from vellum.sources.readers import balanced

NOTES = """label AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
notes AS (SELECT d.doc_id, 'works/w' || (d.doc_id - d.doc_id % 5) || CASE WHEN d.doc_id % 5 > 0 THEN '#part-' || (d.doc_id % 5) ELSE '' END AS slug,
  'works/w' || (d.doc_id - d.doc_id % 5) AS work, substr(string_split(d.text, chr(10))[1], 1, 60) AS title, d.text AS content, d.source AS author, d.lang AS lang, d.n_chars AS n_chars,
  l.quality AS quality, l.toxic AS toxic,
  list_filter(['author/' || d.source, 'lang/' || d.lang, 'label/quality/' || l.quality, 'label/toxic/' || l.toxic], lambda x: x IS NOT NULL) AS tags,
  CASE WHEN d.n_chars % 11 = 0 THEN NULL ELSE (d.n_chars % 120 - 5)::DOUBLE END AS flesch, (d.n_chars % 37)::BIGINT AS links
  FROM documents d LEFT JOIN label l ON l.doc_id = d.doc_id)"""


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = balanced(table(spark, sf_dir, "documents"))
    label = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    work = F.concat(F.lit("works/w"), (F.col("doc_id") - F.col("doc_id") % 5).cast("string"))
    part = F.when(F.col("doc_id") % 5 > 0, F.concat(F.lit("#part-"), (F.col("doc_id") % 5).cast("string"))).otherwise("")
    tags = F.filter(
        F.array(F.concat(F.lit("author/"), "source"), F.concat(F.lit("lang/"), "lang"), F.concat(F.lit("label/quality/"), F.col("quality").cast("string")), F.concat(F.lit("label/toxic/"), F.col("toxic").cast("string"))),
        lambda t: t.isNotNull(),
    )
    return docs.join(label, "doc_id", "left").select(
        "doc_id", F.concat(work, part).alias("slug"), work.alias("work"), F.substring(F.split_part("text", F.lit("\n"), F.lit(1)), 1, 60).alias("title"), F.col("text").alias("content"), F.col("source").alias("author"), "lang", "n_chars", "quality", "toxic", tags.alias("tags"),
        F.when(F.col("n_chars") % 11 != 0, (F.col("n_chars") % 120 - 5).cast("double")).alias("flesch"), (F.col("n_chars") % 37).cast("long").alias("links"),
    )
