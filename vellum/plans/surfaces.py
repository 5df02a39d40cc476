"""Queries of sources, sinks, streams and extensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.operators import filters as P
from vellum.plans import extensions as X
from vellum.plans.aggregates import docs
from vellum.plans.joins import PAIRS, sides
from vellum.plans.notes import NOTES, notes
from vellum.plans.registry import query, table
from vellum.sources import readers as R
from vellum.sources import sinks as K
from vellum.sources.scratch import scratch
from vellum.streaming import incremental as I


def front():
    return F.concat(F.lit('---\r\ntitle: "'), "source", F.lit('"\r\nauthor: A B\r\ntype: work\r\ntags:\r\n  - lang/'), "lang", F.lit("\r\n  - x/y\r\ncluster: c\r\n---\r\n"), "text")


@query("src_frontmatter", "SELECT doc_id, source AS title, 'A B' AS author, 'lang/' || lang || ',x/y' AS tags, 'c' AS cluster, md5(text) AS body FROM documents")
def src_frontmatter(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", R.frontmatter(front()).alias("f"))
    return rows.select("doc_id", "f.title", "f.author", F.array_join("f.tags", ",").alias("tags"), "f.cluster", F.md5("f.body").alias("body"))


@query("src_vault_glob", "SELECT source, count(*) AS notes FROM documents WHERE source <> 'src3' GROUP BY source")
def src_vault_glob(spark, sf_dir):
    """A vault of one file an author, written and globbed again without the ignored one."""
    at = scratch(spark)
    docs(spark, sf_dir).select("source", F.concat(F.lit("note "), F.col("doc_id").cast("string")).alias("value")).repartition("source").write.partitionBy("source").text(at)
    files = R.vault(spark, at, ignore=(r"^source=src3/", r"(^|/)_"), pattern="*.txt")
    each = files.select(F.regexp_extract("path", "source=([^/]+)/", 1).alias("source"), F.size(F.regexp_extract_all("text", F.lit(r"(?m)^note \d+$"), F.lit(0))).alias("n"))
    return each.groupBy("source").agg(F.sum("n").alias("notes"))


@query("src_json_union", "SELECT doc_id, lang FROM documents WHERE lang < 'f'")
def src_json_union(spark, sf_dir):
    at = scratch(spark)
    rows = docs(spark, sf_dir).select("doc_id", "lang")
    for lang in ("de", "en", "es"):
        rows.where(F.col("lang") == lang).write.json(f"{at}/{lang}")
    return R.json_union(spark, [f"{at}/{x}" for x in ("de", "en", "es", "missing")], rows.schema, arrays=False)


@query("src_json_gz", "SELECT 'k' || doc_id AS key, lang AS title FROM documents")
def src_json_gz(spark, sf_dir):
    at = scratch(spark)
    entry = F.to_json(F.create_map(F.concat(F.lit("k"), F.col("doc_id").cast("string")), F.struct(F.col("lang").alias("title"))))
    docs(spark, sf_dir).select(entry.alias("value")).write.option("compression", "gzip").text(at)
    return R.keyed(spark.read.text(at), "value", "struct<title: string>").select("key", "value.title")


@query("src_json_wrapped", "SELECT 'k' || doc_id AS key, lang AS value FROM documents")
def src_json_wrapped(spark, sf_dir):
    bare = F.create_map(F.concat(F.lit("k"), F.col("doc_id").cast("string")), F.col("lang"))
    text = F.when(F.col("doc_id") % 2 == 0, F.to_json(F.struct(bare.alias("content")))).otherwise(F.to_json(bare))
    return R.keyed(docs(spark, sf_dir).select(text.alias("j")), "j", "string")


@query("src_jsonl", "SELECT doc_id, source FROM documents WHERE doc_id % 10 <> 0")
def src_jsonl(spark, sf_dir):
    at = scratch(spark)
    rows = docs(spark, sf_dir)
    rows.select(F.when(F.col("doc_id") % 10 == 0, "{bad").otherwise(F.to_json(F.struct("doc_id", "source"))).alias("value")).write.text(at)
    return R.json_lines(spark, at, rows.select("doc_id", "source").schema)


@query("src_tsv", "SELECT doc_id, source || '/' || lang AS path FROM documents")
def src_tsv(spark, sf_dir):
    at = scratch(spark)
    rows = docs(spark, sf_dir).select("doc_id", F.concat_ws("/", "source", "lang").alias("path"))
    rows.write.csv(at, sep="\t", header=True)
    return R.tsv(spark, at, rows.schema)


@query("src_vec_bin", "SELECT vec_id, list_sum(list_transform(embedding[1:8], lambda x: round_even(x::DOUBLE * 100, 0)))::BIGINT AS total FROM embeddings")
def src_vec_bin(spark, sf_dir):
    packed = F.unhex(F.array_join(F.transform(F.slice("embedding", 1, 8), lambda x: F.lpad(F.hex(F.pmod(F.rint(x.cast("double") * 100).cast("long"), F.lit(256))), 2, "0")), ""))
    files = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("path"), packed.alias("content"))
    return R.vector_rows(files, 8).select(F.col("file").cast("long").alias("vec_id"), F.aggregate("vec", F.lit(0).cast("long"), lambda s, x: s + x).alias("total"))


@query("src_keyword_map", f"WITH {NOTES} SELECT n.slug, p.p_brand AS keywords FROM notes n LEFT JOIN part p ON p.p_partkey = n.doc_id")
def src_keyword_map(spark, sf_dir):
    words = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), F.col("p_brand").alias("keywords"))
    return notes(spark, sf_dir).join(words, "doc_id", "left").select("slug", "keywords")


@query("src_leaf_lazy", f"WITH {NOTES} SELECT slug FROM notes WHERE NOT contains(slug, '#') UNION ALL SELECT 'leaf/' || item_id FROM benchmark")
def src_leaf_lazy(spark, sf_dir):
    works = notes(spark, sf_dir).where(~F.col("slug").contains("#")).select("slug")
    return works.unionByName(table(spark, sf_dir, "benchmark").select(F.concat(F.lit("leaf/"), F.col("item_id").cast("string")).alias("slug")))


@query("src_leaf_walk", "SELECT source || '/' || lang || '/' || doc_id || '.md' AS path FROM documents WHERE source <> 'src4'")
def src_leaf_walk(spark, sf_dir):
    rows = docs(spark, sf_dir)
    leaf = rows.select(F.when(F.col("source") == "src4", F.concat(F.lit("_raw/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md"))).otherwise(F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".md")))).alias("path"))
    own = rows.select(F.concat_ws("/", "source", F.concat("lang", F.lit(".md"))).alias("path")).distinct().where("path not like 'src4%'")
    return R.leaves(leaf.unionByName(own), "path")


@query("sink_shards", "WITH r AS (SELECT lang, doc_id, text AS c, coalesce(sum(strlen(to_json({'doc_id': doc_id, 'c': text})) + 1) OVER (PARTITION BY lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM documents) SELECT lang, floor(before / 50000)::BIGINT AS bucket, count(*) AS n, min(doc_id) AS first, sum(length(c))::BIGINT AS chars FROM r GROUP BY ALL")
def sink_shards(spark, sf_dir):
    """Whole texts in buckets of about 50,000 bytes of JSON a language, written and read again."""
    at = scratch(spark)
    rows = K.bucketed(docs(spark, sf_dir).select("lang", "doc_id", F.col("text").alias("c")), "lang", "doc_id", F.struct("doc_id", "c"), 50_000)
    K.write_shards(rows, at, "lang")
    back = spark.read.schema("lang string, bucket long, doc_id long, c string").json(at)
    return back.groupBy("lang", "bucket").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.sum(F.length("c")).alias("chars"))


@query("sink_upsert_store", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'new' ELSE lang END AS value FROM documents UNION ALL SELECT item_id + 1000000, 'new' FROM benchmark")
def sink_upsert_store(spark, sf_dir):
    store = docs(spark, sf_dir).select("doc_id", F.col("lang").alias("value"))
    fresh = store.where("doc_id % 3 = 0").select("doc_id", F.explode(F.array(F.struct(F.lit("old").alias("value"), F.lit(1).cast("long").alias("at")), F.struct(F.lit("new").alias("value"), F.lit(2).cast("long").alias("at")))).alias("r")).select("doc_id", "r.value", "r.at")
    more = table(spark, sf_dir, "benchmark").select((F.col("item_id") + 1000000).alias("doc_id"), F.lit("new").alias("value"), F.lit(1).cast("long").alias("at"))
    return K.upsert(store, fresh.unionByName(more), "doc_id").select("doc_id", "value")


@query("sink_rekey", "SELECT CASE WHEN lang = 'en' THEN 'moved/' || doc_id ELSE 'x/' || doc_id END AS rel, lang <> 'en' AS unmapped FROM documents")
def sink_rekey(spark, sf_dir):
    rel = F.concat(F.lit("x/"), F.col("doc_id").cast("string"))
    mapping = docs(spark, sf_dir).where("lang = 'en'").select(rel.alias("old"), F.concat(F.lit("moved/"), F.col("doc_id").cast("string")).alias("new"))
    return K.rekey(docs(spark, sf_dir).select(rel.alias("rel")), "rel", mapping)


@query("sink_index_project", "SELECT doc_id, substr(text, 1, 100) AS snippet FROM documents")
def sink_index_project(spark, sf_dir):
    at = scratch(spark)
    docs(spark, sf_dir).select("doc_id", F.substring("text", 1, 100).alias("snippet")).write.json(at)
    return spark.read.schema("doc_id long, snippet string").json(at)


@query("sink_sitemap_filter", r"WITH u AS (SELECT page_id, url, regexp_replace(regexp_replace(url, '^https?://[^/]+/', ''), '[?#].*$', '') AS p FROM pages), thin AS (SELECT p FROM u WHERE page_id % 4 = 0) SELECT page_id, url FROM u WHERE p NOT IN (SELECT p FROM thin) AND regexp_replace(p, '^[^/]*/', '') NOT IN (SELECT p FROM thin)")
def sink_sitemap_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    slug = F.regexp_replace(F.regexp_replace("url", r"^https?://[^/]+/", ""), r"[?#].*$", "")
    return K.sitemap(pages, "url", pages.where("page_id % 4 = 0").select(slug.alias("slug")))


@query("sink_redirects", f"WITH {NOTES} SELECT 'old/' || slug AS old, slug AS new FROM notes WHERE doc_id % 2 = 0 AND lang <> 'es'")
def sink_redirects(spark, sf_dir):
    rows = notes(spark, sf_dir)
    old = F.concat(F.when(F.col("doc_id") % 2 == 0, "old/").otherwise("_old/"), "slug")
    pages = rows.where("lang = 'es'").select(old.alias("slug"))
    return K.redirects(rows.select(old.alias("old"), F.col("slug").alias("new")), pages)


@query("sink_manifest", "SELECT source, '[' || array_to_string(list('\"' || doc_id || '\"' ORDER BY doc_id), ',') || ']' AS members, count(*) AS size FROM documents GROUP BY source")
def sink_manifest(spark, sf_dir):
    return K.manifest(docs(spark, sf_dir), "source", "doc_id", F.col("doc_id").cast("string"))


@query("sink_pages", "SELECT doc_id, '<!DOCTYPE html><html lang=\"' || lang || '\"><head><title>' || source || '</title></head><body><article><h1>' || source || '</h1><p>' || replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(10), '</p><p>') || '</p></article></body></html>' AS html FROM documents")
def sink_pages(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", K.page_html(F.col("source"), F.split("text", "\n", -1), F.col("lang")).alias("html"))


@query("sink_cap_guard", "SELECT source, count(*) AS notes, true AS under FROM documents GROUP BY source")
def sink_cap_guard(spark, sf_dir):
    """Whole texts written by source, in as many files as the cap asks for; each source's files, looked through again, are under it."""
    at = scratch(spark)
    rows = docs(spark, sf_dir).select(F.col("source").alias("tier"), "source", "doc_id", "text")
    K.write_shards(K.bucketed(rows, "tier", "doc_id", F.struct("source", "doc_id", "text"), K.HARD_CAP // 2), at, "tier")
    files = spark.read.schema("source string, doc_id long").json(at).select("source", "_metadata.file_size")
    return files.groupBy("source").agg(F.count("*").alias("notes"), F.every(F.col("file_size") <= K.HARD_CAP).alias("under"))


LISTS = "a AS (SELECT doc_id, md5(text) AS v FROM documents WHERE doc_id % 5 <> 0), b AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'new' ELSE md5(text) END AS v FROM documents WHERE doc_id % 3 <> 0)"


def listings(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", F.md5("text").alias("v"))
    return rows.where("doc_id % 5 <> 0"), rows.where("doc_id % 3 <> 0").withColumn("v", F.when(F.col("doc_id") % 7 == 0, "new").otherwise(F.col("v")))


@query("str_file_watch", f"WITH {LISTS} SELECT doc_id, v FROM b")
def str_file_watch(spark, sf_dir):
    a, b = listings(spark, sf_dir)
    return I.apply_changes(a, b, I.changes(a, b, "doc_id", "v"), "doc_id")


@query("str_file_events", f"WITH {LISTS} SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN a.v IS NULL THEN 'add' WHEN b.v IS NULL THEN 'delete' ELSE 'change' END AS type FROM a FULL JOIN b ON a.doc_id = b.doc_id WHERE a.v IS DISTINCT FROM b.v")
def str_file_events(spark, sf_dir):
    return I.changes(*listings(spark, sf_dir), "doc_id", "v")


@query("str_coalesce", "SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def str_coalesce(spark, sf_dir):
    return I.latest(table(spark, sf_dir, "events"), ["user_id"], "ts", "event_id").select("user_id", "event_id")


@query("str_debounce", "SELECT count(*) AS kept FROM (SELECT ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM events) WHERE n IS NULL OR n > ts + INTERVAL 2 HOUR")
def str_debounce(spark, sf_dir):
    return I.debounced(table(spark, sf_dir, "events"), "user_id", "ts", "2 hours").agg(F.count("*").alias("kept"))


def streamed(spark, rows, columns):
    """The rows through a file stream, all that is there in one run, gathered by a sink table."""
    at = scratch(spark)
    rows.write.parquet(f"{at}/in")
    return spark.readStream.schema(rows.schema).parquet(f"{at}/in").select(*columns), at


def gathered(spark, stream, at):
    out = f"{at}/out"
    I.run_available(stream, I.fan_out(lambda batch, epoch: batch.write.mode("append").parquet(out)), f"{at}/state")
    return spark.read.schema(stream.schema).parquet(out)


@query("str_log_tail", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def str_log_tail(spark, sf_dir):
    stream, at = streamed(spark, table(spark, sf_dir, "events").select("event_id", "event_type"), ["event_id", "event_type"])
    return gathered(spark, stream, at).groupBy("event_type").agg(F.count("*").alias("n"))


@query("str_pair_events", "WITH e AS (SELECT user_id, event_id, event_type, max(CASE WHEN event_type = 'click' THEN event_id END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS started FROM events) SELECT user_id, started, event_id AS ended, event_type AS outcome FROM (SELECT *, row_number() OVER (PARTITION BY user_id, started ORDER BY event_id) AS r FROM e WHERE event_type <> 'click' AND started IS NOT NULL) WHERE r = 1")
def str_pair_events(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("at"), F.col("event_type").alias("kind"))
    stream, at = streamed(spark, rows, ["user_id", "at", "kind"])
    return gathered(spark, I.pair_stream(stream, "user_id", "click"), at)


@query("str_every_n", "SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE r % 5 = 0")
def str_every_n(spark, sf_dir):
    return I.every_nth(table(spark, sf_dir, "events"), "user_id", "event_id", 5).select("user_id", "event_id")


@query("str_completion", f"WITH {PAIRS} SELECT conv_id FROM it WHERE conv_id % 3 <> 0 GROUP BY conv_id HAVING count(DISTINCT turn) >= 2")
def str_completion(spark, sf_dir):
    _, it = sides(spark, sf_dir)
    rows = it.select("conv_id", F.col("turn").alias("leaf"))
    stream, at = streamed(spark, rows.where("conv_id % 3 <> 0"), ["conv_id", "leaf"])
    return gathered(spark, I.completion_stream(stream, "conv_id", 2, set()), at).select("conv_id")


@query("str_partial_emit", "SELECT doc_id FROM documents WHERE lang = 'fr'")
def str_partial_emit(spark, sf_dir):
    stream, at = streamed(spark, docs(spark, sf_dir).select("doc_id", "lang"), ["doc_id", "lang"])
    I.run_available(stream, I.fan_out(lambda b, e: b.where("lang = 'fr'").select("doc_id").write.mode("append").parquet(f"{at}/fr"), lambda b, e: b.groupBy("lang").count().write.mode("append").parquet(f"{at}/n")), f"{at}/state")
    return spark.read.schema("doc_id long").parquet(f"{at}/fr")


def plugins():
    return [
        X.Plugin("upper", transform=lambda df: df.withColumn("title", F.upper("title")), order=20, needs=("clean",)),
        X.Plugin("clean", transform=lambda df: df.withColumn("title", F.regexp_replace("title", "[^A-Za-z ]", "")), order=10),
        X.Plugin("drafts", keep=lambda: F.coalesce("quality", F.lit(1)) == 1, order=30),
        X.Plugin("off", keep=lambda: F.lit(False), enabled=False),
    ]


@query("ext_transformer", f"WITH {NOTES} SELECT slug, upper(regexp_replace(title, '[^A-Za-z ]', '', 'g')) AS title FROM notes")
def ext_transformer(spark, sf_dir):
    return X.transformed(notes(spark, sf_dir), plugins()).select("slug", "title")


@query("ext_filter", f"WITH {NOTES} SELECT slug FROM notes WHERE coalesce(quality, 1) = 1")
def ext_filter(spark, sf_dir):
    return X.published(notes(spark, sf_dir), plugins()).select("slug")


@query("ext_emitter", f"WITH {NOTES} SELECT slug, lang FROM notes")
def ext_emitter(spark, sf_dir):
    at = scratch(spark)
    X.emitted(notes(spark, sf_dir).select("slug", "lang"), [X.Plugin("json", emit=lambda df: df.write.json(at))])
    return spark.read.schema("slug string, lang string").json(at)


@query("ext_pagetype", f"WITH {NOTES} SELECT slug, title FROM notes UNION ALL SELECT DISTINCT 'authors/' || author, author FROM notes WHERE lang = 'en'")
def ext_pagetype(spark, sf_dir):
    rows = notes(spark, sf_dir).select("slug", "title", "author", "lang")
    kind = X.PageKind("author", lambda: F.col("lang") == "en", lambda df: df.select(F.concat(F.lit("authors/"), "author").alias("slug"), F.col("author").alias("title"), "author", "lang").distinct())
    return X.emitted(rows, [], [kind]).select("slug", "title")


@query("ext_condition", f"WITH {NOTES} SELECT slug FROM notes WHERE n_chars > 500")
def ext_condition(spark, sf_dir):
    if "long" not in P.CONDITIONS:
        P.register_condition("long", lambda: F.col("n_chars") > 500)
    return notes(spark, sf_dir).where(P.condition("long")).select("slug")


@query("ext_fn_strings", f"WITH {NOTES} SELECT slug FROM notes ORDER BY lower(title), slug LIMIT 30")
def ext_fn_strings(spark, sf_dir):
    X.register_function("by-title", lambda: [F.lower("title").asc(), F.asc("slug")])
    return notes(spark, sf_dir).orderBy(*X.FUNCTIONS["by-title"]()).limit(30).select("slug")


@query("ext_deps", "SELECT 0::BIGINT AS errors, 0::BIGINT AS warnings")
def ext_deps(spark, sf_dir):
    errors, warnings = X.problems(plugins())
    return spark.range(1).select(F.lit(len(errors)).cast("long").alias("errors"), F.lit(len(warnings)).cast("long").alias("warnings"))
