"""Queries of the joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vellum.operators import joins as J
from vellum.operators import ordering as O
from vellum.plans.notes import NOTES, notes
from vellum.plans.registry import query, table

PAIRS = """en AS (SELECT conv_id, turn, text AS en FROM conversations WHERE role = 'user'),
it AS (SELECT conv_id, turn - 1 AS turn, text AS it FROM conversations WHERE role = 'assistant')"""
EDGES = r"""edges AS (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, unnest(regexp_extract_all(html, '<a href="/([^"]*)">', 1)) AS target FROM pages)"""


def sides(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("en")), turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("it"))


def edges(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), F.explode(F.regexp_extract_all("html", F.lit('<a href="/([^"]*)">'), F.lit(1))).alias("target"))


@query("join_concept_works", f"WITH {NOTES}, member AS (SELECT lang || '/' || author AS concept, slug, row_number() OVER (PARTITION BY lang, author ORDER BY doc_id) - 1 AS pos FROM notes) SELECT m.concept, m.pos::BIGINT AS pos, n.slug, n.title FROM member m JOIN notes n ON n.slug = m.slug WHERE coalesce(n.quality, 1) = 1")
def join_concept_works(spark, sf_dir):
    rows = notes(spark, sf_dir)
    members = O.numbered(rows.select(F.concat_ws("/", "lang", "author").alias("concept"), "doc_id", "slug"), [F.col("doc_id").asc()], "concept")
    works = rows.where(F.coalesce("quality", F.lit(1)) == 1).select("slug", "title")
    return J.placed_lookup(members, works, "slug").select("concept", (F.col("pos") - 1).alias("pos"), "slug", "title")


@query("join_keyword", f"WITH {NOTES} SELECT n.slug, coalesce(p.p_name, '') AS keywords FROM notes n LEFT JOIN part p ON p.p_partkey = n.doc_id * 3 + 1")
def join_keyword(spark, sf_dir):
    words = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    rows = notes(spark, sf_dir)
    return rows.join(words, words.p_partkey == rows.doc_id * 3 + 1, "left").select("slug", F.coalesce("p_name", F.lit("")).alias("keywords"))


@query("join_semantic_score", f"WITH {NOTES}, score AS (SELECT slug AS id, label::DOUBLE AS score FROM notes JOIN embeddings ON vec_id = doc_id WHERE label < 4) SELECT slug, coalesce(a.score, b.score) AS score FROM notes n LEFT JOIN score a ON a.id = n.slug LEFT JOIN score b ON b.id = n.work WHERE coalesce(a.score, b.score) IS NOT NULL")
def join_semantic_score(spark, sf_dir):
    rows = notes(spark, sf_dir).select("doc_id", "slug", "work")
    scores = rows.join(table(spark, sf_dir, "embeddings").where("label < 4"), F.col("vec_id") == F.col("doc_id")).select(F.col("slug").alias("id"), F.col("label").cast("double").alias("score"))
    return J.lookup_or_base(rows, "slug", scores).select("slug", "score")


@query("join_atom_parent", f"WITH {NOTES} SELECT w.slug, count(a.slug) AS atoms FROM notes w LEFT JOIN notes a ON a.work = w.slug AND contains(a.slug, '#') WHERE NOT contains(w.slug, '#') GROUP BY w.slug")
def join_atom_parent(spark, sf_dir):
    rows = notes(spark, sf_dir)
    atoms = rows.where(F.col("slug").contains("#")).groupBy(F.split_part("slug", F.lit("#"), F.lit(1)).alias("slug")).agg(F.count("*").alias("atoms"))
    return rows.where(~F.col("slug").contains("#")).select("slug").join(atoms, "slug", "left").select("slug", F.coalesce("atoms", F.lit(0)).cast("long").alias("atoms"))


@query("join_parent_title", f"WITH {NOTES} SELECT a.slug, w.title AS work_title FROM notes a JOIN notes w ON lower(w.slug) = lower(a.work) WHERE contains(a.slug, '#')")
def join_parent_title(spark, sf_dir):
    rows = notes(spark, sf_dir)
    works = rows.select(F.lower("slug").alias("parent"), F.col("title").alias("work_title"))
    return rows.where(F.col("slug").contains("#")).join(works, F.lower("work") == F.col("parent")).select("slug", "work_title")


AXES = f"axis_of AS (SELECT DISTINCT target AS slug, CASE length(target) % 3 WHEN 0 THEN 'topos' WHEN 1 THEN 'motif' ELSE 'form' END AS axis FROM edges UNION SELECT DISTINCT target, 'concept' FROM edges WHERE contains(target, 'th'))"


def axis_map(links):
    by_length = F.when(F.length("target") % 3 == 0, "topos").when(F.length("target") % 3 == 1, "motif").otherwise("form")
    return links.select(F.col("target").alias("slug"), by_length.alias("axis")).unionByName(links.where(F.col("target").contains("th")).select(F.col("target").alias("slug"), F.lit("concept").alias("axis"))).distinct()


@query("join_axis_map", f"WITH {EDGES}, {AXES} SELECT page_id, array_to_string(list_sort(list(DISTINCT a.axis || '/' || a.slug)), ',') AS tags FROM edges e JOIN axis_of a ON a.slug = e.target GROUP BY page_id")
def join_axis_map(spark, sf_dir):
    links = edges(spark, sf_dir)
    axes = axis_map(links)
    return links.join(axes, links.target == axes.slug).groupBy("page_id").agg(F.array_join(F.sort_array(F.collect_set(F.concat_ws("/", "axis", "slug"))), ",").alias("tags"))


@query("join_en_it", f"WITH {PAIRS} SELECT conv_id, turn, CASE WHEN it IS NULL THEN 'MISSING' WHEN en IS NULL THEN 'ORPHAN' ELSE 'OK' END AS status FROM en FULL JOIN it USING (conv_id, turn)")
def join_en_it(spark, sf_dir):
    return J.paired(*sides(spark, sf_dir), ["conv_id", "turn"]).select("conv_id", "turn", "status")


RAW = "leaf AS (SELECT doc_id, lang || '/' || n_chars AS file, list_transform(string_split(text, chr(10)), lambda x: trim(x)) AS lines FROM documents)"


@query("join_raw_leaf", f"WITH {RAW} SELECT a.doc_id, b.doc_id AS raw_id FROM leaf a JOIN leaf b ON a.file = b.file AND a.doc_id <> b.doc_id WHERE len(list_filter(range(0, len(b.lines) - least(len(a.lines), 2) + 1), lambda i: b.lines[i + 1:i + least(len(a.lines), 2)] = a.lines[1:2])) > 0")
def join_raw_leaf(spark, sf_dir):
    """Units and raw files of one file name, kept where the raw lines hold the unit's first two in a row."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.col("lang"), F.lit("/"), F.col("n_chars").cast("string")).alias("file"), F.transform(F.split("text", "\n", -1), lambda x: F.trim(x)).alias("lines"))
    a = rows.select("doc_id", "file", F.slice("lines", 1, 2).alias("head"))
    b = rows.select(F.col("doc_id").alias("raw_id"), "file", "lines")
    return a.join(b, "file").where((F.col("doc_id") != F.col("raw_id")) & J.holds_run(F.col("lines"), F.col("head"))).select("doc_id", "raw_id")


@query("join_adjacent", "SELECT conv_id, turn, lead(turn) OVER w AS next_turn, lead(role) OVER w AS next_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def join_adjacent(spark, sf_dir):
    order = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.lead("turn").over(order).alias("next_turn"), F.lead("role").over(order).alias("next_role"))


@query("join_nearest_num", "WITH r AS (SELECT DISTINCT item_id * item_id AS k FROM benchmark), l AS (SELECT doc_id FROM documents) SELECT doc_id, (SELECT arg_min(k, abs(k - doc_id) * 2 + CASE WHEN k > doc_id THEN 1 ELSE 0 END) FROM r) AS near FROM l")
def join_nearest_num(spark, sf_dir):
    right = table(spark, sf_dir, "benchmark").select((F.col("item_id") * F.col("item_id")).alias("k2"))
    return J.nearest_key(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", right, "k2", 100)


@query("join_sequence_locate", "WITH l AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: lower(trim(x))) AS a FROM documents), w AS (SELECT doc_id, a, a[2:3] AS w FROM l WHERE len(a) >= 2), f AS (SELECT doc_id, list_min(list_filter(range(0, len(a) - len(w) + 1), lambda i: a[i + 1:i + len(w)] = w)) AS k FROM w) SELECT doc_id, k AS \"at\", CASE WHEN k = 0 THEN 'exact' ELSE 'exact-anywhere' END AS tier FROM f")
def join_sequence_locate(spark, sf_dir):
    lines = F.transform(F.split("text", "\n"), lambda x: F.lower(F.trim(x)))
    rows = table(spark, sf_dir, "documents").select("doc_id", lines.alias("lines"), F.slice(lines, F.lit(2), F.lit(2)).alias("wanted"))
    return J.sequence_locate(rows.where(F.size("wanted") > 0), "doc_id")


#: Queries of the vector searches: every row whose id is divisible by 100.
SCORES = "s AS (SELECT q.vec_id AS qid, e.vec_id, e.label, list_dot_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS s FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0)"


def asked(spark, sf_dir):
    """(queries, rows) of the vector searches."""
    rows = table(spark, sf_dir, "embeddings")
    return rows.where("vec_id % 100 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("q")), rows.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))


@query("join_vector_nn", f"WITH {SCORES} SELECT qid, id, round(s, 6) AS score FROM (SELECT qid, vec_id AS id, s, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, vec_id) AS rank FROM s) WHERE rank <= 5")
def join_vector_nn(spark, sf_dir):
    return J.top_by_product(*asked(spark, sf_dir), 5).select("qid", "id", F.round("score", 6).alias("score"))


@query("join_lexicon", f"WITH {EDGES}, lex AS (SELECT lower(target) AS label, count(*) AS n FROM edges GROUP BY 1 HAVING count(*) >= 2) SELECT e.page_id, e.target, l.n FROM edges e JOIN lex l ON l.label = lower(e.target) WHERE starts_with(e.host, 'blog.')")
def join_lexicon(spark, sf_dir):
    links = edges(spark, sf_dir)
    lexicon = links.groupBy(F.lower("target").alias("label")).agg(F.count("*").alias("n")).where("n >= 2")
    return links.where(F.col("host").startswith("blog.")).join(lexicon, F.lower("target") == F.col("label")).select("page_id", "target", "n")


@query("join_related", f"WITH {NOTES}, rel AS (SELECT work, array_to_string(list(slug ORDER BY slug), ',') AS related FROM notes WHERE contains(slug, '#') AND doc_id % 5 < 4 GROUP BY work) SELECT n.slug, coalesce(r.related, '') AS related FROM notes n LEFT JOIN rel r ON r.work = n.work")
def join_related(spark, sf_dir):
    rows = notes(spark, sf_dir)
    related = rows.where(F.col("slug").contains("#") & (F.col("doc_id") % 5 < 4)).groupBy("work").agg(F.array_join(F.sort_array(F.collect_list("slug")), ",").alias("related"))
    return rows.join(related, "work", "left").select("slug", F.coalesce("related", F.lit("")).alias("related"))


@query("join_redirect", f"WITH {NOTES} SELECT slug, coalesce(CASE WHEN title[1] <> '_' THEN 'moved/' || author END, slug) AS target FROM notes WHERE coalesce(quality, 1) = 1")
def join_redirect(spark, sf_dir):
    rows = notes(spark, sf_dir)
    moved = rows.where(~F.col("title").startswith("_")).select("slug", F.concat(F.lit("moved/"), "author").alias("to"))
    return rows.where(F.coalesce("quality", F.lit(1)) == 1).select("slug").join(moved, "slug", "left").select("slug", F.coalesce("to", "slug").alias("target"))


@query("join_rekey", "SELECT coalesce(p.p_name || '/' || d.doc_id, 'old/' || d.doc_id) AS rel, p.p_name IS NULL AS unmapped, d.n_chars FROM documents d LEFT JOIN part p ON p.p_partkey = d.doc_id * 2 AND p.p_size > 10")
def join_rekey(spark, sf_dir):
    docs, names = table(spark, sf_dir, "documents"), table(spark, sf_dir, "part").where("p_size > 10").select("p_partkey", "p_name")
    joined = docs.join(names, names.p_partkey == docs.doc_id * 2, "left")
    return joined.select(F.coalesce(F.concat("p_name", F.lit("/"), F.col("doc_id").cast("string")), F.concat(F.lit("old/"), F.col("doc_id").cast("string"))).alias("rel"), F.col("p_name").isNull().alias("unmapped"), "n_chars")


@query("anti_pending", f"WITH {PAIRS} SELECT conv_id, turn FROM en WHERE NOT EXISTS (SELECT 1 FROM it WHERE it.conv_id = en.conv_id AND it.turn = en.turn)")
def anti_pending(spark, sf_dir):
    en, it = sides(spark, sf_dir)
    return en.join(it, ["conv_id", "turn"], "left_anti").select("conv_id", "turn")


@query("anti_invalid_tags", f"WITH {NOTES} SELECT DISTINCT t.tag FROM (SELECT unnest(tags) AS tag FROM notes) t WHERE t.tag NOT IN (SELECT 'lang/' || lang FROM documents WHERE lang <> 'es')")
def anti_invalid_tags(spark, sf_dir):
    rows = notes(spark, sf_dir)
    known = rows.where("lang <> 'es'").select(F.concat(F.lit("lang/"), "lang").alias("tag")).distinct()
    return rows.select(F.explode("tags").alias("tag")).distinct().join(known, "tag", "left_anti")


@query("anti_dead_links", f"WITH {EDGES} SELECT DISTINCT target FROM edges WHERE lower(target) NOT IN (SELECT lower(regexp_extract(html, '<h1>([^ <]*)', 1)) FROM pages)")
def anti_dead_links(spark, sf_dir):
    heads = table(spark, sf_dir, "pages").select(F.lower(F.regexp_extract("html", "<h1>([^ <]*)", 1)).alias("head")).distinct()
    links = edges(spark, sf_dir).select("target").distinct()
    return links.join(heads, F.lower("target") == F.col("head"), "left_anti")


@query("semi_linkless", "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def semi_linkless(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id")


@query("full_outer_tagdiff", f"WITH {NOTES}, d AS (SELECT doc_id, tags, list_filter(['lang/' || lang, 'label/quality/1'], lambda x: true) AS derived FROM notes) SELECT doc_id, array_to_string(list_sort(list_filter(tags, lambda t: NOT list_contains(derived, t))), ',') AS only_existing, array_to_string(list_sort(list_filter(derived, lambda t: NOT list_contains(tags, t))), ',') AS only_derived FROM d")
def full_outer_tagdiff(spark, sf_dir):
    derived = F.array(F.concat(F.lit("lang/"), "lang"), F.lit("label/quality/1"))
    return notes(spark, sf_dir).select("doc_id", F.array_join(F.sort_array(F.array_except("tags", derived)), ",").alias("only_existing"), F.array_join(F.sort_array(F.array_except(derived, "tags")), ",").alias("only_derived"))
