"""Queries of windows, packing, ordering and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.functions import text as T
from vellum.operators import aggregates as A
from vellum.operators import ordering as O
from vellum.operators import sequences as S
from vellum.plans.aggregates import MASTER, docs, master
from vellum.operators import joins as J
from vellum.operators.joins import scores
from vellum.plans.joins import PAIRS, SCORES, asked, sides
from vellum.plans.notes import NOTES, notes
from vellum.plans.registry import query, table

LINES = "line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)"


def lines(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("pos", F.col("pos").cast("long"))


@query("win_section_dedup", f"WITH {NOTES} SELECT slug, links FROM (SELECT slug, links, row_number() OVER (PARTITION BY work ORDER BY links DESC, slug) AS r FROM notes) WHERE r = 1")
def win_section_dedup(spark, sf_dir):
    return S.first_per(notes(spark, sf_dir), ["work"], F.desc("links"), F.asc("slug")).select("slug", "links")


@query("win_best_per_target", f"WITH {SCORES} SELECT qid, label::BIGINT AS label, vec_id, round(s, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY qid, label ORDER BY round(s, 9) DESC, vec_id) AS r FROM s) WHERE r = 1")
def win_best_per_target(spark, sf_dir):
    labels = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("label"))
    scored = scores(*asked(spark, sf_dir)).join(labels, "id").withColumnRenamed("id", "vec_id")
    return S.first_per(scored, ["qid", "label"], F.desc(F.round("score", 9)), F.asc("vec_id")).select("qid", "label", "vec_id", F.round("score", 6).alias("score"))


@query("win_top_terms", f"WITH {MASTER} SELECT doc_id, count(CASE WHEN rank <= 30 THEN 1 END) AS t0, count(CASE WHEN rank <= 80 THEN 1 END) AS t2, count(*) AS t1 FROM master WHERE rank <= 150 GROUP BY doc_id")
def win_top_terms(spark, sf_dir):
    return master(spark, sf_dir, 150).groupBy("doc_id").agg(F.count(F.when(F.col("rank") <= 30, 1)).alias("t0"), F.count(F.when(F.col("rank") <= 80, 1)).alias("t2"), F.count("*").alias("t1"))


@query("win_part_of_total", f"WITH {NOTES} SELECT slug, row_number() OVER (PARTITION BY work ORDER BY doc_id) AS part, count(*) OVER (PARTITION BY work) AS total FROM notes")
def win_part_of_total(spark, sf_dir):
    return S.part_of_total(notes(spark, sf_dir).select("slug", "work", "doc_id"), "work", "doc_id").select("slug", "part", "total")


@query("win_tail_mask", f"WITH {LINES} SELECT doc_id, pos, max(CASE WHEN contains(line, 'tion') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) = 1 AS boilerplate FROM line")
def win_tail_mask(spark, sf_dir):
    return S.tail_mask(lines(spark, sf_dir), "doc_id", "pos", F.col("line").contains("tion")).select("doc_id", "pos", "boilerplate")


@query("win_atom_partition", "SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN conv_id || '#' || turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS atom FROM conversations")
def win_atom_partition(spark, sf_dir):
    marker = F.when(F.col("role") == "user", F.concat_ws("#", F.col("conv_id").cast("string"), F.col("turn").cast("string")))
    return S.carried(table(spark, sf_dir, "conversations"), "conv_id", "turn", marker, "atom").select("conv_id", "turn", "atom")


@query("win_adjacent_overlap", "WITH t AS (SELECT doc_id, lang, list_transform(string_split(text, chr(10)), lambda x: trim(x)) AS a FROM documents), n AS (SELECT doc_id, a, lead(a) OVER (PARTITION BY doc_id // 20 ORDER BY doc_id) AS b FROM t) SELECT doc_id, coalesce(list_max(list_filter(range(1, least(len(a), len(b)) + 1), lambda k: a[len(a) - k + 1:] = b[1:k])), 0)::BIGINT AS k FROM (SELECT doc_id, list_concat(a, CASE WHEN doc_id % 3 = 0 THEN b[1:1 + doc_id % 4] ELSE [] END) AS a, b FROM n WHERE b IS NOT NULL)")
def win_adjacent_overlap(spark, sf_dir):
    """Lines that the next unit repeats; every third unit of a run of twenty goes on with its next one's first lines."""
    held = F.transform(F.split("text", "\n", -1), lambda x: F.trim(x))
    rows = S.neighbours(docs(spark, sf_dir).select("doc_id", F.floor(F.col("doc_id") / 20).alias("run"), held.alias("a")), "run", "doc_id", "a").where("next is not null")
    runs_on = F.when(F.col("doc_id") % 3 == 0, F.slice("next", F.lit(1), (1 + F.col("doc_id") % 4).cast("int"))).otherwise(F.array().cast("array<string>"))
    return rows.select("doc_id", S.overlap(F.concat("a", runs_on), F.col("next")).cast("long").alias("k"))


@query("win_rising", "SELECT conv_id, bool_and(n % 5 = 0 AND (b IS NULL OR n > b)) AS rising FROM (SELECT conv_id, n, lag(n) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM (SELECT conv_id, turn, turn * 5 + CASE WHEN conv_id % 7 = 0 THEN length(text) % 6 ELSE 0 END AS n FROM conversations)) GROUP BY conv_id")
def win_rising(spark, sf_dir):
    number = F.col("turn") * 5 + F.when(F.col("conv_id") % 7 == 0, F.length("text") % 6).otherwise(0)
    return S.rising(table(spark, sf_dir, "conversations").withColumn("n", number), "conv_id", "turn", "n")


@query("win_prev_next", f"WITH {NOTES} SELECT slug, lag(slug) OVER w AS previous, lead(slug) OVER w AS next FROM notes WINDOW w AS (PARTITION BY work ORDER BY doc_id)")
def win_prev_next(spark, sf_dir):
    return S.neighbours(notes(spark, sf_dir).select("slug", "work", "doc_id"), "work", "doc_id", "slug").select("slug", "previous", "next")


@query("win_newly_complete", f"WITH {PAIRS}, d AS (SELECT conv_id, bool_and(it IS NOT NULL) AS complete FROM en LEFT JOIN it USING (conv_id, turn) GROUP BY conv_id) SELECT conv_id FROM d WHERE complete AND conv_id % 3 <> 0")
def win_newly_complete(spark, sf_dir):
    en, it = sides(spark, sf_dir)
    done = A.completion(en.join(it, ["conv_id", "turn"], "left"), "conv_id", F.col("it").isNotNull()).where("complete")
    notified = en.where("conv_id % 3 = 0").select("conv_id").distinct()
    return done.join(notified, "conv_id", "left_anti").select("conv_id")


def folded(group: str, size: str, fits: str, add: str) -> str:
    """SQL that folds a group's rows in order into buckets, one row a step."""
    return f"""WITH RECURSIVE item AS (SELECT {group} AS grp, doc_id, {size} AS size, row_number() OVER (PARTITION BY {group} ORDER BY doc_id) AS nr FROM documents),
fold AS (SELECT grp, doc_id, nr, 0::BIGINT AS bucket, (size + {add})::BIGINT AS used, 1::BIGINT AS held FROM item WHERE nr = 1
  UNION ALL SELECT i.grp, i.doc_id, i.nr, f.bucket + CASE WHEN {fits} THEN 0 ELSE 1 END, CASE WHEN {fits} THEN f.used ELSE 0 END + i.size + {add}, CASE WHEN {fits} THEN f.held ELSE 0 END + 1
  FROM fold f JOIN item i ON i.grp = f.grp AND i.nr = f.nr + 1)
SELECT grp AS {group}, bucket, array_to_string(list(doc_id ORDER BY nr), ',') AS ids FROM fold GROUP BY ALL"""


def joined_ids(rows):
    return rows.withColumns({"bucket": F.col("bucket").cast("long"), "ids": F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")})


@query("pack_bytes", folded("source", "strlen(text)", "f.used + i.size + 3 <= 20000", "1"))
def pack_bytes(spark, sf_dir):
    return joined_ids(S.pack_bytes(docs(spark, sf_dir).withColumn("size", F.octet_length("text")), "source", "doc_id", "size", 20_000))


@query("pack_batches", folded("lang", "least(length(text), 8000)", "f.held < 35 AND f.used + i.size <= 180000", "0"))
def pack_batches(spark, sf_dir):
    return joined_ids(S.pack_batches(docs(spark, sf_dir).withColumn("size", F.length("text")), "lang", "doc_id", "size"))


@query("pack_chunks")
def pack_chunks(spark, sf_dir):
    return S.pack_chunks(docs(spark, sf_dir), "doc_id", "text")


def rank_sizes(spark, sf_dir):
    ranked = master(spark, sf_dir, 500).select("rank", (F.octet_length("term") + 10).cast("long").alias("bytes"))
    return ranked.unionByName(docs(spark, sf_dir).select(F.lit(0).alias("rank"), (F.least(F.octet_length("text"), F.lit(700)) + 60).cast("long").alias("bytes")))


SIZES = f"{MASTER}, size AS (SELECT rank, strlen(term) + 10 AS bytes FROM master WHERE rank <= 500 UNION ALL SELECT 0, least(strlen(text), 700) + 60 FROM documents)"


@query("budget_search", f"WITH {SIZES}, total AS (SELECT sum(bytes) AS b FROM size), best AS (SELECT coalesce(max(n), 5) AS n FROM range(5, 501) t(n) WHERE (SELECT sum(bytes) FROM size WHERE rank <= n) <= (SELECT b * 0.8 FROM total)) SELECT n::BIGINT AS n, (SELECT sum(bytes)::BIGINT FROM size, best WHERE rank <= n) AS bytes FROM best")
def budget_search(spark, sf_dir):
    totals = S.rank_totals(rank_sizes(spark, sf_dir))
    n = S.budget_search(totals, int(sum(totals.values()) * 0.8))
    return spark.createDataFrame([(n, sum(b for rank, b in totals.items() if rank <= n))], "n long, bytes long")


NO_ART = r"trim(regexp_replace(lower({}), '^\s*(the|a|an)\s+', ''))"


def sorted_query(name, order, sql_order, source=None):
    @query(name, f"WITH {NOTES} SELECT slug, row_number() OVER (ORDER BY {sql_order}) AS pos FROM notes")
    def run(spark, sf_dir):
        return O.numbered((source or notes)(spark, sf_dir), order()).select("slug", "pos")


def dated(spark, sf_dir):
    """Notes as pages: two of three with a date, works as folders."""
    date = F.when(F.col("n_chars") % 3 > 0, F.date_add(F.lit("2020-01-01").cast("date"), (F.col("n_chars") % 700).cast("int")))
    return notes(spark, sf_dir).withColumns({"date": date, "is_folder": (~F.col("slug").contains("#")).cast("int")})


for way, sql_way in ((True, "ASC"), (False, "DESC")):
    suffix = "" if way else "_desc"
    sorted_query(f"sort_works{suffix}", lambda way=way: O.works_order("flesch", way, True), f"flesch {sql_way} NULLS LAST, lower(title), slug")
    sorted_query(f"sort_works_text{suffix}", lambda way=way: O.works_order("title", way, False), f"{NO_ART.format('title')} {sql_way} NULLS LAST, lower(title), slug")
    sorted_query(f"sort_cerca{suffix}", lambda way=way: O.works_order("links", way, True), f"links {sql_way} NULLS LAST, lower(title), slug")
BAND = "CASE WHEN flesch IS NULL OR flesch < 0 OR flesch > 100 THEN 9 WHEN flesch >= 80 THEN 0 WHEN flesch >= 70 THEN 1 WHEN flesch >= 60 THEN 2 WHEN flesch >= 45 THEN 3 ELSE 4 END"
sorted_query("sort_works_cefr", lambda: O.works_order("cefr", True, False), f"{BAND}, lower(title), slug")
sorted_query("sort_works_cefr_desc", lambda: O.works_order("cefr", False, False), f"{BAND} DESC, lower(title), slug")
sorted_query("sort_concept", lambda: O.concept_order("author"), f"{NO_ART.format('author')}, {NO_ART.format('title')}, slug")
DATE = "CASE WHEN n_chars % 3 > 0 THEN DATE '2020-01-01' + (n_chars % 700)::INTEGER END DESC NULLS LAST, lower(title), slug"
sorted_query("sort_pages_date", O.pages_order, DATE, dated)
sorted_query("sort_pages_folder", lambda: O.pages_order(folder_first=True), f"NOT contains(slug, '#') DESC, {DATE}", dated)


@query("sort_excerpts", f"WITH {NOTES} SELECT slug, row_number() OVER (PARTITION BY lang ORDER BY {NO_ART.format('author')}, work, doc_id) AS pos FROM notes")
def sort_excerpts(spark, sf_dir):
    return O.numbered(notes(spark, sf_dir).withColumn("order", F.col("doc_id").cast("double")), O.excerpts_order("author"), "lang").select("slug", "pos")


@query("sort_tags", f"WITH {NOTES}, t AS (SELECT tag, count(*) AS count FROM (SELECT unnest(tags) AS tag FROM notes) GROUP BY tag) SELECT tag, count, row_number() OVER (ORDER BY count DESC, tag) AS pos FROM t")
def sort_tags(spark, sf_dir):
    counts = notes(spark, sf_dir).select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count("*").alias("count"))
    return O.numbered(counts, O.tags_order()).select("tag", "count", "pos")


@query("sort_scene_order", "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY length(text) % 3, turn % 2, role, turn) AS pos FROM conversations")
def sort_scene_order(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumns({"act": F.length("text") % 3, "scene": F.col("turn") % 2})
    return O.numbered(rows, [*O.scene_order("act", "scene", "role"), F.asc("turn")], "conv_id").select("conv_id", "turn", "pos")


@query("sort_axis_order", f"WITH {NOTES} SELECT doc_id, tag, row_number() OVER (PARTITION BY doc_id ORDER BY CASE split_part(tag, '/', 1) WHEN 'concept' THEN 4 WHEN 'setting' THEN 7 END NULLS LAST, tag) AS pos FROM (SELECT doc_id, replace(replace(unnest(tags), 'lang/', 'concept/'), 'label/quality', 'setting') AS tag FROM notes)")
def sort_axis_order(spark, sf_dir):
    renamed = F.replace(F.replace(F.col("tag"), F.lit("lang/"), F.lit("concept/")), F.lit("label/quality"), F.lit("setting"))
    rows = notes(spark, sf_dir).select("doc_id", F.explode("tags").alias("tag")).withColumn("tag", renamed)
    return O.numbered(rows, O.axis_order(F.col("tag")), "doc_id").select("doc_id", "tag", "pos")


@query("sort_toc", f"WITH {NOTES} SELECT slug, row_number() OVER (PARTITION BY work ORDER BY CASE WHEN quality = 1 THEN n_chars % 9 END NULLS FIRST, doc_id) AS pos FROM notes")
def sort_toc(spark, sf_dir):
    rows = notes(spark, sf_dir).withColumn("chapter", F.when(F.col("quality") == 1, F.col("n_chars") % 9))
    return O.numbered(rows, O.toc_order("chapter", "doc_id"), "work").select("slug", "pos")


@query("topk_vector", f"WITH {SCORES} SELECT qid, vec_id, round(s, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, vec_id) AS r FROM s WHERE label <> 2) WHERE r <= 200")
def topk_vector(spark, sf_dir):
    """The 200 best that a filter accepts before they are ranked."""
    queries, _ = asked(spark, sf_dir)
    rows = table(spark, sf_dir, "embeddings").where("label <> 2").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return J.top_by_product(queries, rows, 200).select("qid", F.col("id").alias("vec_id"), F.round("score", 6).alias("score"))


@query("page_clamp", f"WITH {NOTES}, n AS (SELECT slug, row_number() OVER (ORDER BY {NO_ART.format('title')}, lower(title), slug) AS r, count(*) OVER () AS total FROM notes) SELECT slug FROM n WHERE r > (CEIL(total / 25.0) - 1) * 25")
def page_clamp(spark, sf_dir):
    return O.page(notes(spark, sf_dir), O.works_order("title", True, False), 25, 10_000_000).select("slug")


def set_query(name, sql, make):
    @query(name, f"WITH {NOTES}, s AS (SELECT doc_id, tags AS a, ['lang/en', 'author/src1', 'label/quality/1', 'x'] AS b FROM notes) SELECT doc_id, coalesce(array_to_string({sql}, ','), '') AS value FROM s")
    def run(spark, sf_dir):
        other = F.array(*map(F.lit, ("lang/en", "author/src1", "label/quality/1", "x")))
        return notes(spark, sf_dir).select("doc_id", F.array_join(make(F.col("tags"), other), ",").alias("value"))


set_query("set_intersect", "list_filter(a, lambda x: list_contains(b, x))", F.array_intersect)
set_query("set_union", "a || list_filter(b, lambda x: NOT list_contains(a, x))", F.array_union)
set_query("set_merge_limit", "(a || list_filter(b, lambda x: NOT list_contains(a, x)))[1:3]", lambda a, b: F.slice(F.array_union(a, b), 1, 3))
set_query("set_invented", "list_filter(b, lambda x: NOT list_contains(a, x))", lambda a, b: F.array_except(b, a))
set_query("set_tag_diff", "list_filter(a, lambda x: NOT list_contains(b, x)) || ['<>'] || list_filter(b, lambda x: NOT list_contains(a, x))", lambda a, b: F.concat(F.array_except(a, b), F.array(F.lit("<>")), F.array_except(b, a)))


@query("set_multiset_diff", f"WITH {PAIRS}, a AS (SELECT conv_id, unnest(regexp_extract_all(lower(en), '[a-z]+')) AS w FROM en), b AS (SELECT conv_id, unnest(regexp_extract_all(lower(it), '[a-z]+')) AS w FROM it) SELECT conv_id, w, count(*) AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY ALL")
def set_multiset_diff(spark, sf_dir):
    en, it = sides(spark, sf_dir)

    def words(rows, column):
        return rows.select("conv_id", F.explode(T.all_matches(F.lower(column), "[a-z]+")).alias("w")).groupBy("conv_id", "w")

    wanted, have = words(en, "en").agg(F.count("*").alias("n")), words(it, "it").agg(F.count("*").alias("m"))
    return wanted.join(have, ["conv_id", "w"], "left").select("conv_id", "w", (F.col("n") - F.coalesce("m", F.lit(0))).alias("n")).where("n > 0")


@query("set_char_leak", "WITH d AS (SELECT doc_id, text || CASE WHEN doc_id % 5 = 0 THEN '日本' ELSE '' END AS it, CASE WHEN doc_id % 2 = 0 THEN '本' ELSE '' END AS en FROM documents) SELECT doc_id, coalesce(array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(it, '[\\x{3400}-\\x{9FFF}]'), lambda c: NOT contains(en, c)))), ''), '') AS leaked FROM d".replace("\\\\", "\\"))
def set_char_leak(spark, sf_dir):
    from vellum.operators.hygiene import leaked_characters

    en = F.when(F.col("doc_id") % 2 == 0, "本").otherwise("")
    it = F.concat("text", F.when(F.col("doc_id") % 5 == 0, "日本").otherwise(""))
    return docs(spark, sf_dir).select("doc_id", F.array_join(F.sort_array(leaked_characters(en, it)), "").alias("leaked"))


@query("set_concat", "SELECT doc_id, source FROM documents UNION ALL SELECT item_id, 'benchmark' FROM benchmark")
def set_concat(spark, sf_dir):
    leaves = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), F.lit("benchmark").alias("source"))
    return docs(spark, sf_dir).select("doc_id", "source").unionByName(leaves)
