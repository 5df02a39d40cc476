"""Queries of the predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.functions import boolquery as B
from vellum.operators import filters as P
from vellum.plans.notes import NOTES, notes
from vellum.plans.registry import query

HAY = "lower(coalesce(title, '') || ' ' || coalesce(content, '') || ' ' || array_to_string(tags, ' '))"


def kept(name: str, where: str, column, columns: str = "doc_id, slug") -> None:
    @query(name, f"WITH {NOTES} SELECT {columns} FROM notes WHERE {where}")
    def run(spark, sf_dir):
        return notes(spark, sf_dir).where(column()).select(*columns.split(", "))


def exact(term: str) -> str:
    return rf"regexp_matches({HAY}, '(^|[^\p{{L}}\p{{N}}_]){term}([^\p{{L}}\p{{N}}_]|$)')"


def hay():
    return B.haystack(F.col("title"), F.col("content"), F.col("tags"))


kept("flt_bool_query", f"({HAY} LIKE '%thon%' AND {HAY} LIKE '%lang/en%') OR ({HAY} LIKE '%eau%' AND {HAY} LIKE '%src1%')", lambda: B.matches(hay(), B.parse("(thon & lang/en) | eau AND src1")))
kept("flt_bool_and", f"{HAY} LIKE '%und%' AND {HAY} LIKE '%der%' AND {HAY} LIKE '%schen%'", lambda: B.matches(hay(), B.parse("und der schen", "and")))
kept("flt_bool_phrase", f"{exact('of the')} OR {exact('de la')}", lambda: B.matches(hay(), B.parse('"of the" | “de la”')))
kept("flt_term", exact("anor"), lambda: B.term_in(hay(), B.Term("anor", True)))
kept("flt_fields", "lower(title || ' ' || chr(10) || ' ' || author) LIKE '%src%' AND lower(title || ' ' || chr(10) || ' ' || author) LIKE '%en%'", lambda: B.fields_match([F.col("title"), F.col("author")], "src en"))
kept("flt_fields_empty", "true", lambda: B.fields_match([F.col("title")], "  "))
kept("flt_doc_bool", f"{HAY} LIKE '%quality/1%' AND ({HAY} LIKE '%rre%' OR {HAY} LIKE '%lich%')", lambda: B.matches(hay(), B.parse("quality/1 & (rre | lich)")))
kept("flt_facet_any", "(lang = 'en' OR lang = 'fr') AND (list_contains(tags, 'label/quality/1') OR list_contains(tags, 'author/src3'))", lambda: P.facet_any({"lang": ["en", "fr"], "tags": ["label/quality/1", "author/src3"]}, ["tags"]))
kept("flt_facet_anytag", "lang = 'es' OR author = 'src2' OR list_contains(tags, 'label/toxic/1')", lambda: P.facet_any_tag({"lang": ["es"], "author": ["src2"], "tags": ["label/toxic/1"]}, ["tags"]))
kept("flt_exclude_works", "NOT starts_with(slug, 'works/w1')", lambda: P.exclude_works(F.regexp_replace("slug", "^works/w(?!1)", "texts/w")))
kept("flt_atom", "contains(slug, '#')", lambda: P.is_atom(F.col("slug")))
kept("flt_stub_atom", r"(regexp_matches('Part ' || quality, '(?i)^\s*part\s+(\d+|[ivxlc]+)\.?\s*$') AND doc_id % 2 = 0) OR (doc_id % 2 = 1 AND regexp_matches(title, '(?i)^\s*(contents|part)\b') AND length(content) < 280)", lambda: P.stub_atom(F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("Part "), F.col("quality").cast("string"))).otherwise(F.col("title")), F.col("content")))
kept("flt_hidden_slug", "lang IN ('en', 'de')", lambda: ~P.hidden_slug(F.when(F.col("lang") == "fr", "404").when(F.col("lang") == "es", F.concat(F.lit("tags/"), "slug")).when(F.col("lang") == "de", "tags/index").otherwise(F.col("slug"))))
kept("flt_thin", "CASE WHEN quality = 0 THEN true WHEN quality = 1 THEN false ELSE lang = 'fr' AND length(trim(regexp_replace(substr(content, 1, 39), '\\s+', ' ', 'g'))) < 40 END", lambda: P.thin(F.when(F.col("lang") == "fr", F.concat(F.lit("characters/"), "slug")).otherwise(F.col("slug")), F.substring("content", 1, 39), F.when(F.col("quality") == 0, True).when(F.col("quality") == 1, False)))
kept("flt_corpus_page", "NOT contains(slug, '#') AND lang <> 'es' AND (length(trim(content)) >= 20 OR title <> '')", lambda: P.all_of([~P.is_atom(F.col("slug")), F.col("lang") != "es", (F.length(F.trim("content")) >= 20) | (F.col("title") != "")]))
kept("flt_publish", "coalesce(quality, 1) = 1 AND coalesce(toxic, 0) = 0 AND n_chars > 100", lambda: P.all_of([F.coalesce("quality", F.lit(1)) == 1, F.coalesce("toxic", F.lit(0)) == 0, F.col("n_chars") > 100]))
kept("flt_page_match", "(starts_with(slug, 'works/w1') OR coalesce(lang = 'de', false)) AND NOT coalesce(quality = 0, false)", lambda: ((P.Match.prefix("works/w1") | P.Match.field("lang", "de")) & ~P.Match.field("quality", 0)).make())
kept("flt_conditions", "slug <> 'index' AND len(tags) > 0", lambda: P.condition("not-index") & P.condition("has-tags"))
kept("flt_shard_hash", "('0x' || substr(sha1(slug), 1, 8))::BIGINT % 7 = 3", lambda: P.shard_of(F.col("slug"), 7) == 3)


@query("flt_scope", f"WITH {NOTES} SELECT doc_id, slug FROM notes WHERE lang = 'de'")
def flt_scope(spark, sf_dir):
    return P.scope(notes(spark, sf_dir).withColumn("cluster", F.col("lang")), author="src1", cluster="de").select("doc_id", "slug")


@query("flt_scope_author", f"WITH {NOTES} SELECT doc_id, slug FROM notes WHERE author = 'src1'")
def flt_scope_author(spark, sf_dir):
    return P.scope(notes(spark, sf_dir), author="src1").select("doc_id", "slug")


@query("flt_tag_text", f"WITH {NOTES} SELECT DISTINCT tag FROM (SELECT unnest(tags) AS tag FROM notes) WHERE contains(lower(tag), 'src1') OR contains(lower(split_part(tag, '/', 1)), 'lab')")
def flt_tag_text(spark, sf_dir):
    tags = notes(spark, sf_dir).select(F.explode("tags").alias("tag")).distinct()
    return tags.where(F.lower("tag").contains("src1") | F.lower(F.split_part("tag", F.lit("/"), F.lit(1))).contains("lab"))
