"""Queries of the aggregations."""

from __future__ import annotations


from pyspark.sql import functions as F

from vellum.functions import text as T
from vellum.operators import aggregates as A
from vellum.plans.joins import EDGES, PAIRS, edges, sides
from vellum.plans.notes import NOTES, notes
from vellum.plans.registry import query, table
from vellum.sources.readers import balanced
from vellum.plans.scalars import TOKENS_SQL, WORDS_SQL

TF = f"tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({TOKENS_SQL}) AS term FROM documents) GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)"
MASTER = f"{TF}, master AS (SELECT doc_id, term, tf * ln(n / df) AS score, row_number() OVER (PARTITION BY doc_id ORDER BY round(tf * ln(n / df), 9) DESC, term) AS rank FROM tf JOIN df USING (term), (SELECT count(DISTINCT doc_id) AS n FROM documents) WHERE df < n)"
PROFILE_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in T.PROFILE_STOP) + "]"
SYL = "CASE WHEN p = '' THEN 0 WHEN length(p) <= 3 THEN 1 ELSE greatest(1, len(regexp_extract_all(regexp_replace(regexp_replace(p, '(?:[^laeiouy]es|ed|[^laeiouy]e)$', ''), '^y', ''), '[aeiouy]{1,2}'))) END"
PROFILE = f"""spoken AS (SELECT source AS author, unnest({WORDS_SQL}) AS word FROM documents),
syl AS (SELECT author, word, {SYL} AS s FROM (SELECT author, word, regexp_replace(lower(word), '[^a-z]', '', 'g') AS p FROM spoken)),
sent AS (SELECT source AS author, greatest(1, sum(len(list_filter(regexp_split_to_array(text, '[.!?]+'), lambda s: regexp_matches(s, '[a-zA-Z]')))))::BIGINT AS sentences FROM documents GROUP BY 1),
profile AS (SELECT author, count(*) AS words, count(DISTINCT word) AS vocabulary, sum(s)::BIGINT AS syllables, count(CASE WHEN s >= 3 THEN 1 END) AS complex FROM syl GROUP BY author)"""


def docs(spark, sf_dir):
    return balanced(table(spark, sf_dir, "documents"))


def master(spark, sf_dir, keep):
    rows = docs(spark, sf_dir)
    return A.tfidf(rows, T.search_rows(rows, "doc_id", "text"), "doc_id", keep)


@query("agg_tf_df", f"WITH {TF} SELECT term, df, sum(tf)::BIGINT AS tf FROM tf JOIN df USING (term) GROUP BY ALL")
def agg_tf_df(spark, sf_dir):
    return A.term_counts(T.search_rows(docs(spark, sf_dir), "doc_id", "text"), "doc_id").groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))


@query("agg_tfidf_topn", f"WITH {MASTER} SELECT doc_id, rank, term, round(score, 6) AS score FROM master WHERE rank <= 10")
def agg_tfidf_topn(spark, sf_dir):
    return master(spark, sf_dir, 10).select("doc_id", F.col("rank").cast("long").alias("rank"), "term", F.round("score", 6).alias("score"))


@query("agg_atom_titles", f"WITH {NOTES} SELECT work, array_to_string(list(title ORDER BY doc_id), ' ') AS titles FROM notes WHERE contains(slug, '#') AND title <> '' GROUP BY work")
def agg_atom_titles(spark, sf_dir):
    rows = notes(spark, sf_dir)
    return A.child_titles(rows.where(F.col("slug").contains("#")), "work", "doc_id", "title")


@query("agg_facet_counts", f"WITH {NOTES} SELECT facet, value, count(*) AS n FROM (SELECT 'lang' AS facet, lang AS value FROM notes UNION ALL SELECT 'author', author FROM notes UNION ALL SELECT 'tags', unnest(tags) FROM notes UNION ALL SELECT 'quality', quality::VARCHAR FROM notes) WHERE value IS NOT NULL GROUP BY ALL")
def agg_facet_counts(spark, sf_dir):
    return A.facet_counts(notes(spark, sf_dir), {"lang": False, "author": False, "tags": True, "quality": False})


@query("agg_tag_prefix_rollup", f"WITH {NOTES}, t AS (SELECT DISTINCT doc_id, unnest([split_part(tag, '/', 1)] || CASE WHEN split_part(tag, '/', 2) <> '' THEN [split_part(tag, '/', 1) || '/' || split_part(tag, '/', 2)] ELSE [] END || CASE WHEN split_part(tag, '/', 3) <> '' THEN [tag] ELSE [] END) AS tag FROM (SELECT doc_id, unnest(tags) AS tag FROM notes)) SELECT tag, CASE WHEN contains(tag, '/') THEN split_part(tag, '/', 1) ELSE 'generale' END AS type, count(*) AS count FROM t GROUP BY tag")
def agg_tag_prefix_rollup(spark, sf_dir):
    return A.tag_rollup(notes(spark, sf_dir), "tags")


@query("agg_score_map", "WITH s AS (SELECT q.vec_id AS qid, e.vec_id, list_dot_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS s FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0), hit AS (SELECT qid, 'w' || (vec_id // 4) || CASE WHEN vec_id % 4 > 0 THEN '#' || vec_id ELSE '' END AS id, s, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, vec_id) AS r FROM s) SELECT qid, id, round(max(s), 6) AS score FROM (SELECT qid, id, s FROM hit WHERE r <= 3000 UNION ALL SELECT qid, split_part(id, '#', 1), s FROM hit WHERE r <= 3000) GROUP BY qid, id")
def agg_score_map(spark, sf_dir):
    from vellum.operators.joins import top_by_product
    from vellum.plans.joins import asked

    part = F.when(F.col("id") % 4 > 0, F.concat(F.lit("#"), F.col("id").cast("string"))).otherwise("")
    hits = top_by_product(*asked(spark, sf_dir), 3000).select("qid", F.concat(F.lit("w"), F.floor(F.col("id") / 4).cast("string"), part).alias("id"), "score")
    each = hits.select("qid", F.explode(F.array_distinct(F.array("id", F.split_part("id", F.lit("#"), F.lit(1))))).alias("id"), "score")
    return each.groupBy("qid", "id").agg(F.round(F.max("score"), 6).alias("score"))


@query("agg_author_footprint", f"WITH {PROFILE} SELECT author, words, vocabulary, round(vocabulary / sqrt(words), 1) AS rttr, sentences, round(words / sentences, 1) AS avg_sentence, syllables, complex FROM profile JOIN sent USING (author)")
def agg_author_footprint(spark, sf_dir):
    stats = A.profile(docs(spark, sf_dir), "source", "text")
    return stats.select(F.col("source").alias("author"), "words", "vocabulary", F.round(F.col("vocabulary") / F.sqrt("words"), 1).alias("rttr"), "sentences", F.round(F.col("words") / F.col("sentences"), 1).alias("avg_sentence"), "syllables", F.col("complex").cast("long").alias("complex"))


@query("agg_readability", f"WITH {PROFILE} SELECT author, round(206.835 - 1.015 * (words / sentences) - 84.6 * (syllables / words), 1) AS flesch, round(0.39 * (words / sentences) + 11.8 * (syllables / words) - 15.59, 1) AS fk_grade, round(0.4 * (words / sentences + 100 * (complex / words)), 1) AS fog FROM profile JOIN sent USING (author)")
def agg_readability(spark, sf_dir):
    stats = A.readability(A.profile(docs(spark, sf_dir), "source", "text"))
    return stats.select(F.col("source").alias("author"), *[F.round(c, 1).alias(c) for c in ("flesch", "fk_grade", "fog")])


@query("agg_distinctive", f"WITH w AS (SELECT source AS author, term, count(*) AS tf FROM (SELECT source, unnest(list_filter({WORDS_SQL}, lambda w: NOT list_contains({PROFILE_STOP_SQL}, w))) AS term FROM documents) GROUP BY ALL), d AS (SELECT term, count(*) AS df FROM w GROUP BY term), r AS (SELECT author, term, tf * ln(n / df) AS score, row_number() OVER (PARTITION BY author ORDER BY round(tf * ln(n / df), 9) DESC, term) AS rank FROM w JOIN d USING (term), (SELECT count(DISTINCT source) AS n FROM documents)) SELECT author, rank, term, round(score, 6) AS score FROM r WHERE rank <= 30")
def agg_distinctive(spark, sf_dir):
    rows = docs(spark, sf_dir)
    ranked = A.tfidf(rows, T.profile_rows(rows, "source", "text", stop=True), "source", 30, drop_zero=False)
    return ranked.select(F.col("source").alias("author"), F.col("rank").cast("long").alias("rank"), "term", F.round("score", 6).alias("score"))


@query("agg_top_concepts", f"WITH {NOTES}, c AS (SELECT author, regexp_replace(tag, '_', ' ', 'g') AS concept, count(*) AS n FROM (SELECT author, unnest(tags) AS tag FROM notes) WHERE starts_with(tag, 'label/') OR starts_with(tag, 'lang/') GROUP BY ALL) SELECT author, concept, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY author ORDER BY n DESC, concept) AS rank FROM c) WHERE rank <= 10")
def agg_top_concepts(spark, sf_dir):
    rows = notes(spark, sf_dir).select("author", F.explode("tags").alias("tag")).where(F.col("tag").startswith("label/") | F.col("tag").startswith("lang/"))
    return A.top_per(rows.select("author", T.human(F.col("tag")).alias("concept")), "author", "concept", 10).withColumn("rank", F.col("rank").cast("long"))


@query("agg_works_per_author", "SELECT source AS author, count(*) AS works FROM documents GROUP BY 1")
def agg_works_per_author(spark, sf_dir):
    return docs(spark, sf_dir).groupBy(F.col("source").alias("author")).agg(F.count("*").alias("works"))


@query("agg_cluster_members", "SELECT CASE source WHEN 'src5' THEN 'src1' WHEN 'src6' THEN 'src1' ELSE source END AS cluster, count(*) AS size, count(*) < 40 AS small FROM documents GROUP BY 1")
def agg_cluster_members(spark, sf_dir):
    return A.merged_clusters(docs(spark, sf_dir), "source", {"src5": "src1", "src6": "src1"}, 40)


@query("agg_cluster_tags", f"WITH {NOTES}, c AS (SELECT author, tag, count(*) AS n FROM (SELECT author, unnest(tags) AS tag FROM notes) GROUP BY ALL) SELECT author, array_to_string(['graph/cluster', 'cluster/' || author] || list(tag ORDER BY n DESC, tag), ',') AS tags FROM (SELECT *, row_number() OVER (PARTITION BY author ORDER BY n DESC, tag) AS r FROM c) WHERE r <= 4 GROUP BY author")
def agg_cluster_tags(spark, sf_dir):
    top = A.top_per(notes(spark, sf_dir).select("author", F.explode("tags").alias("tag")), "author", "tag", 4)
    held = F.transform(F.sort_array(F.collect_list(F.struct("rank", "tag"))), lambda s: s["tag"])
    return top.groupBy("author").agg(held.alias("held")).select("author", F.array_join(F.concat(F.array(F.lit("graph/cluster"), F.concat(F.lit("cluster/"), "author")), "held"), ",").alias("tags"))


@query("agg_tail_merge", "WITH s AS (SELECT source AS cluster, count(*) AS size FROM documents GROUP BY 1), t AS (SELECT DISTINCT source AS cluster, 'src0' AS into_ FROM documents WHERE source LIKE '%1%') SELECT s.cluster, size, CASE WHEN size >= 30 THEN s.cluster ELSE into_ END AS target FROM s LEFT JOIN t USING (cluster)")
def agg_tail_merge(spark, sf_dir):
    rows = docs(spark, sf_dir)
    targets = rows.where("source like '%1%'").select(F.col("source").alias("cluster"), F.lit("src0").alias("into")).distinct()
    return A.tail_merge(rows, "source", 30, targets).withColumnRenamed("into", "target")


@query("agg_vocab", f"WITH {NOTES} SELECT split_part(tag, '/', 1) AS axis, array_to_string(list_sort(list(DISTINCT substr(tag, instr(tag, '/') + 1))), ',') AS slugs FROM (SELECT unnest(tags) AS tag FROM notes) GROUP BY 1")
def agg_vocab(spark, sf_dir):
    tags = notes(spark, sf_dir).select(F.explode("tags").alias("tag")).distinct()
    return tags.groupBy(F.split_part("tag", F.lit("/"), F.lit(1)).alias("axis")).agg(F.array_join(F.sort_array(F.collect_set(F.expr("substr(tag, instr(tag, '/') + 1)"))), ",").alias("slugs"))


@query("agg_axis_collisions", f"WITH {NOTES} SELECT slug, count(DISTINCT axis) AS axes FROM (SELECT split_part(tag, '/', 2) AS slug, split_part(tag, '/', 1) AS axis FROM (SELECT unnest(tags || [lang || '/' || lang, 'x/' || author]) AS tag FROM notes)) GROUP BY slug HAVING count(DISTINCT axis) > 1")
def agg_axis_collisions(spark, sf_dir):
    added = F.array(F.concat_ws("/", "lang", "lang"), F.concat(F.lit("x/"), "author"))
    tags = notes(spark, sf_dir).select(F.explode(F.concat("tags", added)).alias("tag")).distinct()
    return tags.groupBy(F.split_part("tag", F.lit("/"), F.lit(2)).alias("slug")).agg(F.count_distinct(F.split_part("tag", F.lit("/"), F.lit(1))).alias("axes")).where("axes > 1")


@query("agg_lexicon", f"WITH {EDGES}, p AS (SELECT lower(target) AS label, target, count(*) AS n FROM edges GROUP BY ALL), t AS (SELECT label, sum(n)::BIGINT AS total FROM p GROUP BY label) SELECT label, target, n, total FROM p JOIN t USING (label) WHERE total >= 2 AND n >= 0.8 * total")
def agg_lexicon(spark, sf_dir):
    return A.lexicon(edges(spark, sf_dir).select(F.lower("target").alias("label"), "target"), "label", "target")


@query("agg_label_mode", f"WITH {EDGES}, p AS (SELECT host, target, count(*) AS n, min(page_id) AS first FROM edges GROUP BY ALL) SELECT host, target FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY n DESC, first, target) AS r FROM p) WHERE r = 1")
def agg_label_mode(spark, sf_dir):
    return A.label_mode(edges(spark, sf_dir), "host", "target", "page_id")


TITLED = """t AS (SELECT doc_id // 4 AS chapter, doc_id // 40 AS work, CASE WHEN n_chars % 23 = 0 THEN 'Prologue' ELSE (CASE WHEN (doc_id // 4) % 5 = 0 AND doc_id % 2 = 0 OR n_chars % 9 = 0 THEN 'Other Work ' ELSE 'The Work ' END) || lang || ' \u2014 ' ||
  CASE WHEN (doc_id // 4) % 3 = 0 THEN 'Chapter ' || doc_id % 4 ELSE 'Chapter one' || CASE WHEN doc_id % 2 = 0 THEN '.' ELSE '' END END END AS title FROM documents),
p AS (SELECT *, lower(regexp_replace(title, '[ .…]+$', '')) AS norm, split_part(title, ' \u2014 ', 1) AS head, CASE WHEN contains(title, ' \u2014 ') THEN split_part(title, ' \u2014 ', 2) END AS rest FROM t WHERE title IS NOT NULL)"""


def titles_sql(name: str, group: str, by: str, raw: str, where: str) -> str:
    """SQL for the most frequent normal form of a group, spelled as most often, with the counts of it, of the next and of all."""
    return f"""{name}_c AS (SELECT {group}, {by} AS by_, {raw} AS raw, count(*) AS n FROM p WHERE {where} GROUP BY ALL),
{name}_e AS (SELECT {group}, by_, sum(n) AS n, list(raw ORDER BY n DESC, raw)[1] AS raw FROM {name}_c GROUP BY ALL),
{name} AS (SELECT {group}, list(raw ORDER BY n DESC, by_)[1] AS best, max(n) AS n, coalesce(list(n ORDER BY n DESC, by_)[2], 0) AS second, sum(n) AS total FROM {name}_e GROUP BY {group})"""


NORM = "lower(regexp_replace({}, '[ .…]+$', ''))"
LADDER = ", ".join([TITLED, titles_sql("w_", "chapter", "norm", "title", "true"), titles_sql("h_", "chapter", NORM.format("head"), "head", "rest IS NOT NULL"), titles_sql("r_", "chapter", NORM.format("rest"), "rest", "rest IS NOT NULL"), titles_sql("v_", "work", NORM.format("head"), "head", "rest IS NOT NULL")])


@query("agg_majority_title", f"WITH {LADDER}, c AS (SELECT chapter, min(work) AS work FROM p GROUP BY chapter) SELECT c.chapter, CASE WHEN w.n * 2 > w.total THEN w.best WHEN h.total = w.total AND h.n * 2 > h.total THEN h.best WHEN h.total = w.total AND r.n = r.total AND v.n > v.second THEN v.best || ' \u2014 ' || r.best END AS title FROM c JOIN w_ w USING (chapter) LEFT JOIN h_ h USING (chapter) LEFT JOIN r_ r USING (chapter) LEFT JOIN v_ v ON v.work = c.work")
def agg_majority_title(spark, sf_dir):
    """Chapters of four titles in works of ten chapters; some name another work, some a prologue, some differ in the chapter."""
    other = (F.floor(F.col("doc_id") / 4) % 5 == 0) & (F.col("doc_id") % 2 == 0) | (F.col("n_chars") % 9 == 0)
    rest = F.when(F.floor(F.col("doc_id") / 4) % 3 == 0, F.concat(F.lit("Chapter "), (F.col("doc_id") % 4).cast("string"))).otherwise(F.concat(F.lit("Chapter one"), F.when(F.col("doc_id") % 2 == 0, ".").otherwise("")))
    title = F.when(F.col("n_chars") % 23 == 0, "Prologue").otherwise(F.concat(F.when(other, "Other Work ").otherwise("The Work "), F.col("lang"), F.lit(" \u2014 "), rest))
    rows = docs(spark, sf_dir).select(F.floor(F.col("doc_id") / 4).alias("chapter"), F.floor(F.col("doc_id") / 40).alias("work"), title.alias("title"))
    return A.majority_title(rows, "chapter", F.col("title"), "work")


@query("agg_completion", f"WITH {PAIRS} SELECT conv_id, count(*) AS leaves, count(it) AS done, bool_and(it IS NOT NULL) AS complete, floor(100 * count(it) / count(*))::BIGINT AS pct FROM en LEFT JOIN it USING (conv_id, turn) GROUP BY conv_id")
def agg_completion(spark, sf_dir):
    en, it = sides(spark, sf_dir)
    return A.completion(en.join(it, ["conv_id", "turn"], "left"), "conv_id", F.col("it").isNotNull())


@query("agg_status_tally", f"WITH {PAIRS}, s AS (SELECT conv_id % 10 AS play, CASE WHEN it IS NULL THEN 'MISSING' WHEN length(it) < 0.6 * length(en) OR length(it) > 1.9 * length(en) THEN 'FAIL' ELSE 'OK' END AS status FROM en LEFT JOIN it USING (conv_id, turn)) SELECT coalesce(play::VARCHAR, 'total') AS play, count(CASE WHEN status = 'OK' THEN 1 END) AS ok, count(CASE WHEN status = 'FAIL' THEN 1 END) AS fail, count(CASE WHEN status = 'MISSING' THEN 1 END) AS missing FROM s GROUP BY ROLLUP (play)")
def agg_status_tally(spark, sf_dir):
    en, it = sides(spark, sf_dir)
    ratio = F.length("it") / F.length("en")
    status = F.when(F.col("it").isNull(), "MISSING").when((ratio < 0.6) | (ratio > 1.9), "FAIL").otherwise("OK")
    rows = en.join(it, ["conv_id", "turn"], "left").select((F.col("conv_id") % 10).cast("string").alias("play"), status.alias("status"))
    return rows.rollup("play").agg(*[F.count(F.when(F.col("status") == s, 1)).alias(s.lower()) for s in ("OK", "FAIL", "MISSING")]).withColumn("play", F.coalesce("play", F.lit("total")))


@query("agg_index_quantiles", "WITH c AS (SELECT n_chars::BIGINT AS v FROM documents), s AS (SELECT list(v ORDER BY v) AS a FROM c) SELECT a[floor(len(a) * 0.5)::BIGINT + 1] AS p50, a[floor(len(a) * 0.9)::BIGINT + 1] AS p90 FROM s")
def agg_index_quantiles(spark, sf_dir):
    rows = docs(spark, sf_dir)
    return A.index_quantile(rows, "n_chars", 0.5).withColumnRenamed("value", "p50").crossJoin(A.index_quantile(rows, "n_chars", 0.9).withColumnRenamed("value", "p90"))


@query("agg_gutenberg_report", r"WITH c AS (SELECT source AS author, length(text) - length(regexp_replace(text, '(?s)\n[^\n]*$', '')) AS removed FROM documents) SELECT author, count(*) AS files, sum(removed)::BIGINT AS removed FROM c WHERE removed > 0 GROUP BY author ORDER BY removed DESC, author LIMIT 8")
def agg_gutenberg_report(spark, sf_dir):
    cut = F.length("text") - F.length(F.regexp_replace("text", r"(?s)\n[^\n]*\z", ""))
    rows = docs(spark, sf_dir).select(F.col("source").alias("author"), cut.alias("removed")).where("removed > 0")
    return rows.groupBy("author").agg(F.count("*").alias("files"), F.sum("removed").alias("removed")).orderBy(F.desc("removed"), "author").limit(8)


@query("agg_merge_tier", f"WITH {NOTES}, delta AS (SELECT slug, reverse(content) AS content FROM notes WHERE lang = 'en') SELECT coalesce(o.slug, d.slug) AS slug, o.title, md5(coalesce(d.content, o.content)) AS content FROM (SELECT slug, title, content FROM notes WHERE doc_id % 2 = 0) o FULL JOIN delta d ON d.slug = o.slug")
def agg_merge_tier(spark, sf_dir):
    rows = notes(spark, sf_dir)
    old = rows.where("doc_id % 2 = 0").select("slug", "title", "content")
    merged = A.merge_tier(old, rows.where("lang = 'en'").select("slug", F.reverse("content").alias("content")), "slug")
    return merged.withColumn("content", F.md5("content"))


@query("agg_candidates", f"WITH {EDGES} SELECT regexp_replace(lower(target), '[^a-z]', '', 'g') AS concept, count(DISTINCT page_id) AS atoms FROM edges GROUP BY 1 HAVING concept <> ''")
def agg_candidates(spark, sf_dir):
    canonical = F.regexp_replace(F.lower("target"), "[^a-z]", "").alias("concept")
    return edges(spark, sf_dir).select(canonical, "page_id").where("concept <> ''").distinct().groupBy("concept").agg(F.count("*").alias("atoms"))
