"""Queries of search, vectors, links and the hierarchy."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vellum.functions import text as T
from vellum.operators import links as L
from vellum.operators import search as S
from vellum.operators.aggregates import child_titles
from vellum.operators import joins as J
from vellum.operators.joins import scores
from vellum.plans.joins import EDGES, SCORES, asked, edges
from vellum.plans.notes import NOTES, notes
from vellum.plans.registry import query, table
from vellum.plans.scalars import TOKENS_SQL
from vellum.sources.scratch import written

HAY = "lower(coalesce(title, '') || ' ' || coalesce(content, '') || ' ' || array_to_string(tags, ' '))"
TOKENS = TOKENS_SQL.replace("lower(text)", "lower(content)")
RANKED = f"""tf AS (SELECT slug, term, count(*) AS tf FROM (SELECT slug, unnest({TOKENS}) AS term FROM notes) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
ranked AS (SELECT slug, term, row_number() OVER (PARTITION BY slug ORDER BY round(tf * ln(n / df), 9) DESC, term) AS rank FROM tf JOIN df USING (term), (SELECT count(*) AS n FROM notes) WHERE df < n),
unit_titles AS (SELECT work AS slug, array_to_string(list(title ORDER BY doc_id), ' ') AS titles FROM notes WHERE contains(slug, '#') AND title <> '' GROUP BY work)"""


def occ(field: str, term: str) -> str:
    return f"((length(lower({field})) - length(replace(lower({field}), '{term}', ''))) // {len(term)})"


def score_sql(*terms: str) -> str:
    return "(" + " + ".join(f"CASE WHEN {occ('title', t)} > 0 THEN 100 + 10 * {occ('title', t)} ELSE 0 END + 10 * {occ('content', t)}" for t in terms) + ")"


def ranked(spark, sf_dir):
    rows = notes(spark, sf_dir)
    titles = child_titles(rows.where(F.col("slug").contains("#")), "work", "doc_id", "title").select(F.col("work").alias("slug"), F.col("titles").alias("atom_titles"))
    return S.master(rows).join(titles, "slug", "left")


def tier_sql(n: int, chars: int, units: bool) -> str:
    where = "" if units else "WHERE NOT contains(n.slug, '#')"
    terms = f"(SELECT slug, array_to_string(list(term ORDER BY rank), ' ') AS terms FROM ranked WHERE rank <= {n} GROUP BY slug)"
    return rf"SELECT n.slug, concat_ws(' ', nullif(substr(trim(regexp_replace(content, '\s+', ' ', 'g')), 1, {chars}), ''), nullif(t.terms, ''), nullif(u.titles, ''), nullif(title, '')) AS content FROM notes n LEFT JOIN {terms} t ON t.slug = n.slug LEFT JOIN unit_titles u ON u.slug = n.slug {where}"


@query("search_tiers", f"WITH {NOTES}, {RANKED} SELECT 0::BIGINT AS tier, slug, md5(content) AS digest FROM ({tier_sql(30, 160, False)}) UNION ALL SELECT 2, slug, md5(content) FROM ({tier_sql(80, 400, True)})")
def search_tiers(spark, sf_dir):
    whole = written(ranked(spark, sf_dir))
    zero, two = (S.tier(whole, k).select(F.lit(k).cast("long").alias("tier"), "slug", F.md5("content").alias("digest")) for k in (0, 2))
    return zero.unionByName(two)


@query("search_content_for", f"WITH {NOTES}, {RANKED} SELECT slug, length(content) AS size FROM ({tier_sql(150, 400, True)})")
def search_content_for(spark, sf_dir):
    content = S.content_for(F.col("snippet"), F.col("terms"), F.col("atom_titles"), F.col("title"), 150, 400)
    return ranked(spark, sf_dir).select("slug", F.length(content).cast("long").alias("size"))


POSTINGS = rf"posting AS (SELECT slug AS key, 'title' AS field, unnest(regexp_extract_all(lower(title), '[a-zà-ÿ]+')) AS word FROM notes UNION ALL SELECT slug, 'content', unnest(regexp_extract_all(lower(content), '[a-zà-ÿ]+')) FROM notes)"


def postings(spark, sf_dir):
    rows = notes(spark, sf_dir)
    both = [rows.select(F.col("slug").alias("key"), F.lit(c).alias("field"), F.explode(T.all_matches(F.lower(c), "[a-zà-ÿ]+")).alias("word")) for c in ("title", "content")]
    return both[0].unionByName(both[1])


@query("search_flex", f"WITH {NOTES}, {POSTINGS} SELECT DISTINCT key, field FROM posting WHERE starts_with(word, 'erth')")
def search_flex(spark, sf_dir):
    return S.prefix_candidates(postings(spark, sf_dir), "erth")


@query("search_fuzzy", f"WITH {NOTES}, {POSTINGS}, w AS (SELECT DISTINCT word, levenshtein(word, 'thingen') AS far FROM posting) SELECT key, round(sum(CASE field WHEN 'title' THEN 3.0 ELSE 1.0 END::DOUBLE * CASE WHEN far <= 1 THEN 1 / (1 + far) ELSE 0.5 END::DOUBLE), 6) AS score FROM posting JOIN w USING (word) WHERE far <= 1 OR starts_with(word, 'thingen') GROUP BY key")
def search_fuzzy(spark, sf_dir):
    return S.fuzzy_candidates(postings(spark, sf_dir), "thingen").withColumn("score", F.round("score", 6))


QUERY_SQL = f"WITH {NOTES}, hit AS (SELECT slug, {score_sql('thon', 'und', 'tion')}::BIGINT AS score FROM notes WHERE ({HAY} LIKE '%thon%' AND {HAY} LIKE '%und%') OR {HAY} LIKE '%tion%')"


@query("search_query", f"{QUERY_SQL} SELECT slug, score FROM hit WHERE score > 0 OR slug IN (SELECT slug FROM notes WHERE contains(lower(title || content), 'thon') OR contains(lower(title || content), 'und') OR contains(lower(title || content), 'tion'))")
def search_query(spark, sf_dir):
    return S.search(notes(spark, sf_dir), "(thon & und) | tion")


@query("rank_search", f"{QUERY_SQL} SELECT slug, score, row_number() OVER (ORDER BY score DESC, slug) AS place FROM hit ORDER BY place LIMIT 20")
def rank_search(spark, sf_dir):
    top = S.search(notes(spark, sf_dir), "(thon & und) | tion").orderBy(F.desc("score"), "slug").limit(20)
    from vellum.operators.ordering import numbered

    return numbered(top, [F.desc("score"), F.asc("slug")]).withColumnRenamed("pos", "place")


VECTORS = "unit AS (SELECT vec_id, label, list_transform(embedding[1:32]::DOUBLE[], lambda x: x / sqrt(list_dot_product(embedding[1:32]::DOUBLE[], embedding[1:32]::DOUBLE[]))) AS u FROM embeddings)"
QUANT = "list_transform(u, lambda x: greatest(-127, least(127, round_even(x * 127, 0))))"


@query("vec_quantize", f"WITH {VECTORS} SELECT vec_id, array_to_string(list_transform({QUANT}, lambda x: x::INTEGER), ',') AS q FROM unit")
def vec_quantize(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.array_join(F.transform(S.quantized(F.col("embedding"), 32), lambda x: x.cast("string")), ",").alias("q"))


@query("vec_search", f"WITH {VECTORS}, s AS (SELECT a.vec_id AS qid, u.vec_id, list_dot_product(a.u, {QUANT.replace('(u,', '(u.u,')}::DOUBLE[]) / 127 AS s FROM unit u, unit a WHERE a.vec_id % 100 = 0) SELECT qid, vec_id, round(s, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, vec_id) AS r FROM s) WHERE r <= 50")
def vec_search(spark, sf_dir):
    """Queries of unit length against the quantised rows."""
    rows = table(spark, sf_dir, "embeddings")
    queries = rows.where("vec_id % 100 = 0").select(F.col("vec_id").alias("qid"), S.unit_length(F.col("embedding"), 32).alias("q"))
    held = rows.select(F.col("vec_id").alias("id"), F.transform(S.quantized(F.col("embedding"), 32), lambda x: x / 127).alias("v"))
    return J.top_by_product(queries, held, 50).select("qid", F.col("id").alias("vec_id"), F.round("score", 6).alias("score"))


@query("vec_semantic_dedup", f"WITH {SCORES}, b AS (SELECT qid, vec_id % 50 AS id, vec_id, s, row_number() OVER (PARTITION BY qid, vec_id % 50 ORDER BY round(s, 9) DESC, vec_id) AS r FROM s) SELECT qid, id, vec_id, round(s, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, id) AS place FROM b WHERE r = 1) WHERE place <= 20")
def vec_semantic_dedup(spark, sf_dir):
    """The best line of each page, and of those a query's 20 best."""
    from vellum.operators.sequences import first_per

    hits = scores(*asked(spark, sf_dir)).select("qid", (F.col("id") % 50).alias("id"), F.col("id").alias("vec_id"), F.round("score", 9).alias("s"), "score")
    best = first_per(hits, ["qid", "id"], F.desc("s"), F.asc("vec_id"))
    place = Window.partitionBy("qid").orderBy(F.desc("s"), "id")
    return best.withColumn("place", F.row_number().over(place)).where("place <= 20").select("qid", "id", "vec_id", F.round("score", 6).alias("score"))


@query("vec_corpus_build", rf"WITH {NOTES} SELECT slug AS id, 'atom' AS kind, '' AS speaker, length(substr(content, 1, 1500)) AS size FROM notes WHERE contains(slug, '#') UNION ALL SELECT slug, 'page', '', length(substr(content, 1, 1500)) FROM notes n WHERE NOT contains(slug, '#') AND NOT EXISTS (SELECT 1 FROM notes a WHERE contains(a.slug, '#') AND a.work = n.slug) UNION ALL SELECT 'conv/' || conv_id, 'line', role, length(substr(text, 1, 1500)) FROM conversations WHERE length(text) >= 12")
def vec_corpus_build(spark, sf_dir):
    rows = notes(spark, sf_dir).select(F.col("slug").alias("id"), "title", F.col("content").alias("text"))
    spoken = table(spark, sf_dir, "conversations").select(F.concat(F.lit("conv/"), F.col("conv_id").cast("string")).alias("id"), F.lit("").alias("title"), F.col("role").alias("speaker"), "text")
    unit = F.col("id").contains("#")
    return S.corpus(rows.where(unit), rows.where(~unit), spoken).select("id", "kind", "speaker", F.length("text").cast("long").alias("size"))


#: Navigation links of the pages as wikilinks; every third has an alias, some an anchor.
WIKI = r"""wiki AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?s)^.*<ul>|</ul>.*$', '', 'g'), '<li><a href="/([^"]*a)">([^<]*)</a></li>', '[[works/\1#top|\2]] ', 'g'), '<li><a href="/([^"]*)">[^<]*</a></li>', '[[\1]] ', 'g') AS md FROM pages)"""
FOUND = r"""found AS (SELECT page_id, unnest(regexp_extract_all(md, '\[\[[^\]]*\]\]')) AS link, generate_subscripts(regexp_extract_all(md, '\[\[[^\]]*\]\]'), 1) - 1 AS pos FROM wiki)"""


def wiki(spark, sf_dir):
    md = T.chain(F.col("html"), (r"(?s)^.*<ul>|</ul>.*$", ""), (r'<li><a href="/([^"]*a)">([^<]*)</a></li>', "[[works/$1#top|$2]] "), (r'<li><a href="/([^"]*)">[^<]*</a></li>', "[[$1]] "))
    return table(spark, sf_dir, "pages").select("page_id", md.alias("md"))


@query("link_extract", rf"WITH {WIKI}, {FOUND} SELECT page_id, pos, regexp_extract(link, '\[\[([^\]|#]*)', 1) AS target, regexp_extract(link, '(#[^\]|]*)', 1) AS anchor, CASE WHEN contains(link, '|') THEN regexp_extract(link, '\|([^\]]*)', 1) END AS alias FROM found")
def link_extract(spark, sf_dir):
    return L.extract_links(wiki(spark, sf_dir), "page_id", "md").withColumn("pos", F.col("pos").cast("long"))


@query("link_resolve", rf"WITH {WIKI}, {FOUND}, t AS (SELECT DISTINCT page_id, regexp_extract(link, '\[\[([^\]|#]*)', 1) AS target FROM found), slug AS (SELECT DISTINCT lower(target) AS s FROM t WHERE contains(target, 'th') AND NOT contains(target, '/')) SELECT page_id, target, CASE WHEN NOT contains(target, '/') AND lower(trim(target)) IN (SELECT s FROM slug) THEN 'concepts/' || lower(trim(target)) END AS slug FROM t")
def link_resolve(spark, sf_dir):
    links = L.extract_links(wiki(spark, sf_dir), "page_id", "md").select("page_id", "target").distinct().withColumns({"alias": F.lit(None).cast("string"), "author": F.lit("x")})
    names = links.where(F.col("target").contains("th") & ~F.col("target").contains("/")).select(F.lower("target").alias("s")).distinct()
    known = names.select(F.concat(F.lit("concepts/"), "s").alias("slug"), F.lit(1).alias("weight"), F.lit(None).cast("string").alias("author"))
    empty = names.select(F.concat(F.lit("aaa/"), "s").alias("slug"), F.lit(0).alias("weight"), F.lit(None).cast("string").alias("author"))
    return L.resolve_links(links, known.unionByName(empty), ["topos", "concepts"]).select("page_id", "target", "slug")


def known_targets(spark, sf_dir):
    return L.extract_links(wiki(spark, sf_dir), "page_id", "md").select("target").distinct().where(F.col("target").contains("th")).select("target", F.concat(F.lit("concepts/"), F.lower("target")).alias("slug"))


TARGET = r"regexp_extract(l, '\[\[([^\]|#]*)', 1)"
ANCHOR = r"regexp_extract(l, '(#[^\]|]*)', 1)"
WORDS = rf"CASE WHEN contains(l, '|') THEN regexp_extract(l, '\|([^\]]*)', 1) ELSE {TARGET} END"


@query("link_rewrite", rf"WITH {WIKI} SELECT page_id, coalesce(array_to_string(list_transform(regexp_extract_all(md, '\[\[[^\]]*\]\] '), lambda l: CASE WHEN contains({TARGET}, 'th') THEN '[[concepts/' || lower({TARGET}) || {ANCHOR} || '|' || {WORDS} || ']] ' ELSE l END), ''), '') AS md FROM wiki")
def link_rewrite(spark, sf_dir):
    return L.rewrite_links(wiki(spark, sf_dir), "page_id", "md", known_targets(spark, sf_dir))


@query("link_strip_dead", rf"WITH {WIKI}, f AS (SELECT page_id, regexp_extract_all(md, '\[\[[^\]]*\]\] ') AS ls FROM wiki) SELECT page_id, coalesce(array_to_string(list_transform(ls, lambda l: CASE WHEN contains({TARGET}, 'th') THEN l ELSE {WORDS} || ' ' END), ''), '') AS md, coalesce(array_to_string(list_transform(list_filter(ls, lambda l: NOT contains({TARGET}, 'th')), lambda l: {TARGET}), ','), '') AS stripped FROM f")
def link_strip_dead(spark, sf_dir):
    return L.strip_dead_links(wiki(spark, sf_dir), "page_id", "md", known_targets(spark, sf_dir)).withColumn("stripped", F.array_join("stripped", ","))


@query("graph_backlinks", f"WITH {EDGES} SELECT target AS dst, count(DISTINCT host) AS n, array_to_string(list_sort(list(DISTINCT host)), ',') AS sources FROM edges GROUP BY target")
def graph_backlinks(spark, sf_dir):
    found = L.backlinks(edges(spark, sf_dir).select(F.col("host").alias("src"), F.col("target").alias("dst")))
    return found.withColumn("sources", F.array_join("sources", ","))


@query("graph_leaf_edge", f"WITH {NOTES} SELECT slug AS src, work AS dst FROM notes WHERE contains(slug, '#')")
def graph_leaf_edge(spark, sf_dir):
    return L.leaf_edges(notes(spark, sf_dir).select("slug"))


@query("graph_node_cap", f"WITH {EDGES} SELECT node, count(*) AS degree FROM (SELECT host AS node FROM edges UNION ALL SELECT target FROM edges) GROUP BY node ORDER BY degree DESC, node LIMIT 220")
def graph_node_cap(spark, sf_dir):
    return L.capped_nodes(edges(spark, sf_dir).select(F.col("host").alias("src"), F.col("target").alias("dst")), 220)


@query("graph_link_cap", "SELECT page_id, array_to_string(regexp_extract_all(html, '<a href=\"/([^\"]*)\">', 1)[1:4], ',') AS links FROM pages")
def graph_link_cap(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract_all("html", F.lit('<a href="/([^"]*)">'), F.lit(1)).alias("links"))
    return L.capped_links(rows, "links", 4).withColumn("links", F.array_join("links", ","))


#: Notes that point at each other inside runs of fifty: one edge a note.
POINTS = "e AS (SELECT doc_id AS src, doc_id - doc_id % 50 + (n_chars * 7 + doc_id) % 50 AS dst FROM documents), known AS (SELECT e.* FROM e JOIN documents d ON d.doc_id = e.dst)"


def points(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    run = F.col("doc_id") - F.col("doc_id") % 50
    every = rows.select(F.col("doc_id").alias("src"), (run + (F.col("n_chars").cast("long") * 7 + F.col("doc_id")) % 50).alias("dst"))
    return every.join(rows.select(F.col("doc_id").alias("dst")), "dst", "left_semi").select("src", "dst")


@query("graph_cycle", f"WITH RECURSIVE {POINTS}, walk(origin, here) AS (SELECT src, dst FROM known UNION SELECT origin, dst FROM walk JOIN known ON src = here) SELECT DISTINCT origin AS node FROM walk WHERE origin = here")
def graph_cycle(spark, sf_dir):
    """The notes on a cycle; each has one edge, so that what neither end of peeling removes are the cycles."""
    return L.cyclic_core(points(spark, sf_dir)).select(F.col("src").alias("node")).distinct()


@query("graph_transclude", f"WITH RECURSIVE {POINTS}, inc AS (SELECT doc_id AS root, doc_id AS page, [doc_id] AS path, false AS cyclic FROM documents UNION ALL SELECT root, e.dst, list_append(path, e.dst), list_contains(path, e.dst) FROM inc JOIN known e ON e.src = page WHERE NOT cyclic) SELECT root, page, array_to_string(path, '>') AS path, cyclic FROM inc")
def graph_transclude(spark, sf_dir):
    roots = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page"))
    found = L.transclusions(points(spark, sf_dir), roots)
    return found.withColumn("path", F.array_join(F.transform("path", lambda x: x.cast("string")), ">"))


@query("trie_build", f"WITH {NOTES}, p AS (SELECT lang || '/' || author || '/' || doc_id AS path FROM notes), n AS (SELECT split_part(path, '/', 1) AS node, '' AS parent, 1 AS depth, true AS is_folder FROM p UNION ALL SELECT split_part(path, '/', 1) || '/' || split_part(path, '/', 2), split_part(path, '/', 1), 2, true FROM p UNION ALL SELECT path, split_part(path, '/', 1) || '/' || split_part(path, '/', 2), 3, false FROM p) SELECT node, parent, depth::BIGINT AS depth, is_folder, count(*) AS pages FROM n GROUP BY ALL")
def trie_build(spark, sf_dir):
    paths = notes(spark, sf_dir).select(F.concat_ws("/", "lang", "author", F.col("doc_id").cast("string")).alias("path"))
    return L.trie(paths, "path").withColumn("depth", F.col("depth").cast("long"))


@query("trie_assemble", f"WITH {NOTES} SELECT work AS page, count(*) AS leaves, md5(array_to_string(list('## ' || title || chr(10) || content ORDER BY doc_id), chr(10) || chr(10))) AS digest FROM notes GROUP BY work HAVING bool_and(coalesce(quality, 1) = 1)")
def trie_assemble(spark, sf_dir):
    body = F.when(F.coalesce("quality", F.lit(1)) == 1, F.col("content"))
    return L.assemble(notes(spark, sf_dir), F.col("work"), "doc_id", "title", body).select("page", "leaves", F.md5("body").alias("digest"))
