import json

import pytest
from pyspark.sql import functions as F

from vellum.functions import text as T
from vellum.operators import aggregates as A
from vellum.operators import filters as P
from vellum.operators import joins as J
from vellum.operators import links as L
from vellum.operators import ordering as O
from vellum.operators import search as S
from vellum.operators import sequences as Q
from vellum.plans import extensions as X
from vellum.sources import readers as R
from vellum.sources import sinks as K
from vellum.streaming import incremental as I


def test_tfidf_drops_terms_of_every_note(spark):
    rows = spark.createDataFrame([("a", "sea sea shore"), ("b", "sea cliff"), ("c", None), ("d", "sea")], "slug string, t string")
    some = rows.where("slug <> 'c'")
    got = [(r.slug, r["rank"], r.term) for r in A.tfidf(some, T.search_rows(some, "slug", "t"), "slug", 5).orderBy("slug", "rank").collect()]
    assert got == [("a", 1, "shore"), ("b", 1, "cliff")]
    assert A.tfidf(rows, T.search_rows(rows, "slug", "t"), "slug", 5).where("term = 'sea'").count() == 3


def test_tfidf_of_generated_notes(spark):
    rows = spark.createDataFrame([(f"n{i}", " ".join(f"w{(3 * i + j) % 200}" for j in range(60))) for i in range(40)], "slug string, t string")
    terms = rows.select("slug", F.explode(T.all_matches(F.col("t"), r"w\d+")).alias("term"))
    ranked = A.tfidf(rows, terms, "slug", 500).collect()
    by = {}
    for r in sorted(ranked, key=lambda r: (r.slug, r["rank"])):
        by.setdefault(r.slug, []).append(r.score)
    assert len(by) == 40 and all(s == sorted(s, reverse=True) for s in by.values())


def test_tiers_and_search(spark):
    rows = spark.createDataFrame([("w", "Title", "snip", [f"term{i}" for i in range(500)], "Child One"), ("w#a", "Unit", "", [f"av{i}" for i in range(90)], None)], "slug string, title string, snippet string, terms array<string>, atom_titles string")
    t0, t1, t2 = ({r.slug: r.content for r in S.tier(rows, k).collect()} for k in (0, 1, 2))
    assert "term29 " in t0["w"] and "term30" not in t0["w"] and "w#a" not in t0 and "Child One" in t0["w"]
    assert "term149" in t1["w"] and "av79" in t2["w#a"] and "av80" not in t2["w#a"] and t2["w#a"].endswith("Unit")
    docs = spark.createDataFrame([("c--part_01", "Sea", "sea sea", ["x"]), ("c--part_02", "Other", "sea", ["x"]), ("d", "No", "land", ["x"])], "slug string, title string, content string, tags array<string>")
    assert [(r.slug, r.score) for r in S.search(docs, "sea").collect()] == [("c--part_01", 130)]
    assert S.search(docs, "x").count() == 0


def test_rollup_facets_and_tiers(spark):
    rows = spark.createDataFrame([(1, ["a/b/c", "a/b", "d", ""]), (2, ["a/x"])], "id int, tags array<string>")
    got = {r.tag: (r.type, r["count"]) for r in A.tag_rollup(rows, "tags").collect()}
    assert got == {"a": ("generale", 2), "a/b": ("a", 1), "a/b/c": ("a", 1), "d": ("generale", 1), "a/x": ("a", 1)}
    old = spark.createDataFrame([("s", "T", "old")], "slug string, title string, content string")
    new = spark.createDataFrame([("s", "new"), ("t", "n")], "slug string, content string")
    assert sorted(map(tuple, A.merge_tier(old, new, "slug").collect()), key=str) == [("s", "T", "new"), ("t", None, "n")]


def test_quantile_and_titles(spark):
    rows = spark.createDataFrame([(i,) for i in (5, 1, 1, 9, 7)], "v int")
    assert A.index_quantile(rows, "v", 0.5).first()[0] == 5 and A.index_quantile(rows, "v", 0.9).first()[0] == 9
    assert A.index_quantile(rows.limit(0), "v", 0.5).first()[0] == 0
    titles = spark.createDataFrame([("w", "The Sea."), ("w", "the  sea"), ("w", "Shore"), ("v", "A"), ("v", "B")], "w string, t string")
    assert {r.w: r.title for r in A.majority_title(titles, "w", F.col("t")).collect()} == {"w": "The Sea.", "v": None}


def test_nearest_key_against_search(spark):
    left = spark.createDataFrame([(i,) for i in range(-50, 400, 7)], "a long")
    keys = [3, 17, 18, 90, 250, 251, 330]
    got = J.nearest_key(left, "a", spark.createDataFrame([(k,) for k in keys], "b long"), "b", 40).collect()
    assert len(got) == left.count() and all(r.near == min(keys, key=lambda k: (abs(k - r.a), k)) for r in got)


def test_locate():
    assert J.locate(list("abcabc"), list("abc"), 1) == (0, "exact") and J.locate(list("xabc"), list("abc"), 1) == (1, "exact-anywhere")
    assert J.locate(list("xabd"), list("abc"), 1) == (1, "fuzzy-unique") and J.locate(list("zzzz"), list("abc"), 1) == (-1, "none")


def test_packing(spark):
    rows = spark.createDataFrame([("g", i, s) for i, s in enumerate([10, 10, 10, 100, 5, 5])], "g string, id long, size long")
    assert [list(r.ids) for r in Q.pack_bytes(rows, "g", "id", "size", 30).orderBy("bucket").collect()] == [[0, 1], [2], [3], [4, 5]]
    assert [list(r.ids) for r in Q.pack_batches(rows, "g", "id", "size", most=3, chars=120).orderBy("bucket").collect()] == [[0, 1, 2], [3, 4, 5]]
    assert Q.chunks("a. b. c. d", 5) == ["a. b.", "c. d"] and Q.chunks("| a | b |" * 9, 20) == ["| a | b |" * 9]
    sizes = spark.createDataFrame([(0, 100)] + [(r, 10) for r in range(1, 501)], "rank int, bytes long")
    totals = Q.rank_totals(sizes)
    assert [Q.budget_search(totals, t) for t in (1000, 10, 10**6)] == [90, 5, 500]


def test_overlap(spark):
    df = spark.createDataFrame([(["a", "b", "c"], ["b", "c", "d"]), (["a"], ["b"]), (["x", "x"], ["x", "x"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(Q.overlap(F.col("a"), F.col("b"))).collect()] == [2, 0, 2]


def test_orders_and_pages(spark):
    rows = spark.createDataFrame([("a", "The Zoo", 10.0), ("b", "An Ant", None), ("c", "Bee", 70.0), ("d", "Bee", float("nan"))], "slug string, title string, flesch double")

    def order(*args):
        return [r.slug for r in rows.orderBy(*O.works_order(*args)).collect()]

    assert order("title", True, False) == ["b", "c", "d", "a"]
    assert order("flesch", True, True) == ["a", "c", "b", "d"] and order("flesch", False, True) == ["c", "a", "b", "d"]
    assert order("cefr", True, False)[:2] == ["c", "a"] and set(order("cefr", False, False)[:2]) == {"b", "d"}
    assert [r.slug for r in O.page(rows, [F.asc("slug")], 3, 99).collect()] == ["d"] and O.page(rows, [F.asc("slug")], 0, 0).count() == 4
    assert O.pager(10, 0) == [0, 1, 2] and O.pager(10, 9) == [7, 8, 9]


NOTES = [("concepts/sea", 3, None), ("topos/sea", 0, None), ("works/alone-(poe)", 0, "poe"), ("works/the-sphinx-(poe)", 0, "poe"), ("works/the-sphinx-(wilde)", 0, "wilde"), ("motif/ghost", 0, None), ("topos/ghost", 0, None)]


def test_link_resolution(spark):
    notes = spark.createDataFrame(NOTES, "slug string, weight int, author string")
    asked = [("sea", None, None), ("ghost", None, None), ("alone", None, None), ("Alone", None, None), ("Alone", "word", None), ("The Sphinx", None, "wilde"), ("The Sphinx", None, None), ("topos/sea", None, None), ("topos/none", None, None), ("nothing", None, None)]
    links = spark.createDataFrame([(i, *x) for i, x in enumerate(asked)], "i int, target string, alias string, author string")
    got = [r.slug for r in L.resolve_links(links, notes, ["topos", "motif", "concepts"]).orderBy("i").collect()]
    assert got == ["concepts/sea", "topos/ghost", None, "works/alone-(poe)", None, "works/the-sphinx-(wilde)", "works/the-sphinx-(poe)", "topos/sea", None, None]


def test_link_texts(spark):
    text = "a [[Sea#top|the sea]] [[Shore]]\n| [[Shore]] | [[Sea\\|x]] | [[South [[Africa]]]]"
    known = {"Sea": "concepts/sea", "Shore": "concepts/shore", "Africa": "topos/africa"}
    assert L.rewrite(text, lambda t, a: known.get(t)) == "a [[concepts/sea#top|the sea]] [[concepts/shore|Shore]]\n| [[concepts/shore\\|Shore]] | [[concepts/sea\\|x]] | [[South [[topos/africa\\|Africa]]]]"
    assert L.strip_dead("[[Cardenio]] [[x|y]] [[Sea]]", lambda t, a: t == "Sea") == ("Cardenio y [[Sea]]", ["Cardenio", "x"])
    found = L.extract_links(spark.createDataFrame([(1, text)], "id int, md string"), "id", "md").collect()
    assert [(r.target, r.anchor, r.alias) for r in found] == [("Sea", "#top", "the sea"), ("Shore", "", None), ("Shore", "", None), ("Sea", "", "x"), ("Africa", "", None)]


def test_trie_and_graph(spark):
    nodes = {r.node: (r.parent, r.depth, r.is_folder, r.pages) for r in L.trie(spark.createDataFrame([("a/b/c",), ("a/index",), ("a/b/d",)], "path string"), "path").collect()}
    assert nodes["a"] == ("", 1, True, 3) and nodes["a/b"] == ("a", 2, True, 2) and nodes["a/b/c"] == ("a/b", 3, False, 1)
    ring = spark.createDataFrame([(i, (i + 1) % 60) for i in range(60)] + [(100, 0), (30, 200)], "src int, dst int")
    assert L.has_cycle(ring) and L.cyclic_core(ring).count() == 60
    chain = spark.createDataFrame([(i, i + 1) for i in range(30)], "src int, dst int")
    assert not L.has_cycle(chain) and not L.has_cycle(chain.limit(0))
    pages = L.transclusions(chain, spark.createDataFrame([(0,)], "page int")).collect()
    assert len(pages) == 31 and max(len(r.path) for r in pages) == 31 and not any(r.cyclic for r in pages)


def test_places_and_running_sums_of_one_dominating_group(spark):
    rows = spark.range(3000).selectExpr("IF(id % 10 < 9, 'hot', CAST(id % 3 AS STRING)) AS g", "(id * 7919) % 3001 AS v", "id").repartition(6)
    want = {}
    held = sorted(rows.collect(), key=lambda r: (r.g, r.v, r.id))
    for r in held:
        want.setdefault(r.g, []).append(r)
    placed = {r.id: r.pos for r in O.numbered(rows, [F.asc("v"), F.asc("id")], "g").collect()}
    summed = {r.id: r.s for r in O.running(rows, [F.asc("v"), F.asc("id")], "g", F.col("v"), "s").collect()}
    for group in want.values():
        assert [placed[r.id] for r in group] == list(range(1, len(group) + 1))
        assert [summed[r.id] for r in group] == [sum(x.v for x in group[:i]) for i in range(len(group))]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # so few bytes would be one range
    try:
        split = O._ranges(rows, [F.asc("v"), F.asc("id")], "g", F.lit(1)).select("id", "g", "_part", (F.col("_here") + F.col("_before")).alias("pos")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r["_part"] for r in split if r.g == "hot"}) > 1 and {r.id: r.pos for r in split} == placed
    assert {r.id: r.pos for r in O.numbered(rows, [F.asc("id")]).collect()} == {i: i + 1 for i in range(3000)}
    deep = O.page(spark.range(30_000), [F.asc("id")], 25, 700)
    assert [r.id for r in deep.collect()] == list(range(17_500, 17_525))


def test_majority_titles_go_down_the_ladder(spark):
    rows = [("c1", "w", f"The Book \u2014 Chapter {i}") for i in range(4)] + [("c2", "w", "A Book \u2014 One"), ("c2", "w", "The Book \u2014 One."), ("c3", "v", "X \u2014 One"), ("c3", "v", "Y \u2014 One"), ("c4", "w", "Loose"), ("c4", "w", "Other")]
    df = spark.createDataFrame(rows, "c string, w string, t string")
    assert {r.c: r.title for r in A.majority_title(df, "c", F.col("t"), "w").collect()} == {"c1": "The Book", "c2": "The Book \u2014 One", "c3": None, "c4": None}


def test_vector_scores_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "ROWS_A_BLOCK", 7)
    monkeypatch.setattr(J, "QUERIES_A_BLOCK", 2)
    vectors = {i: [float(i % 5), float(i % 3), 1.0] for i in range(40)}
    df = spark.createDataFrame(list(vectors.items()), "id long, v array<double>")
    got = J.top_by_product(df.where("id % 10 = 0").selectExpr("id AS qid", "v AS q"), df, 4).collect()
    for q in (0, 10, 20, 30):
        want = sorted(vectors, key=lambda i: (-sum(a * b for a, b in zip(vectors[i], vectors[q], strict=True)), i))[:4]
        assert [r.id for r in sorted((r for r in got if r.qid == q), key=lambda r: r["rank"])] == want


def test_filters(spark):
    slugs = ["index", "brani", "404", "tags/x", "tags/index", "works/a"]
    df = spark.createDataFrame([(s,) for s in slugs], "slug string")
    assert [r.slug for r in df.where(~P.hidden_slug(F.col("slug"))).collect()] == ["tags/index", "works/a"]
    assert df.where(P.facet_any({})).count() == 0 and df.where(P.all_of([])).count() == 6
    with pytest.raises(ValueError, match="exists"):
        P.register_condition("has-tags", lambda: F.lit(True))


def test_readers(spark, tmp_path):
    for name, text in (("a/b.md", '---\r\ntitle: "T"\r\ntags:\r\n  - x/y\r\n---\r\nbody'), ("a/_raw/c.md", "raw"), ("d e.md", "plain"), ("f.txt", "no")):
        (tmp_path / "v" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "v" / name).write_bytes(text.encode())
    files = R.vault(spark, str(tmp_path / "v"), ignore=("/_raw/",)).withColumn("f", R.frontmatter(F.col("text")))
    assert {r.path: (r.f.title, r.f.tags, r.f.body) for r in files.collect()} == {"a/b.md": ("T", ["x/y"], "body"), "d e.md": (None, [], "plain")}
    (tmp_path / "a.json").write_text(json.dumps([{"k": 1}, {"k": 2}]))
    got = R.json_union(spark, [str(tmp_path / "a.json"), str(tmp_path / "missing.json")], spark.createDataFrame([], "k int").schema)
    assert sorted(r.k for r in got.collect()) == [1, 2]
    (tmp_path / "b.jsonl").write_text('{"k": 1}\n{bad\n{"k": 3}\n')
    assert sorted(r.k for r in R.json_lines(spark, str(tmp_path / "b.jsonl"), got.schema).collect()) == [1, 3]
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        R.json_lines(spark, str(tmp_path / "b.jsonl"), got.schema, strict=True).collect()


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(0, i, "x" * 50) for i in range(20)], "tier int, id long, c string")
    K.write_shards(K.bucketed(rows, "tier", "id", F.struct("id", "c"), 300), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).select("bucket").distinct().count() > 2
    with pytest.raises(ValueError, match="over 10 bytes"):
        K.guard(spark, str(tmp_path / "out"), cap=10)


def test_log_tail(spark, tmp_path):
    log = tmp_path / "log"
    log.write_bytes(b"one\ntwo\npart")
    assert I.whole_lines(log.read_bytes(), 0) == (["one", "two"], 8) and I.whole_lines(b"x\n", 8) == (["x"], 2)
    I.register(spark)
    stream = spark.readStream.format("vellum_tail").option("path", str(log)).load()
    I.run_available(stream, lambda b, e: b.write.mode("append").parquet(str(tmp_path / "o")), str(tmp_path / "s"))
    assert sorted(r.line for r in spark.read.parquet(str(tmp_path / "o")).collect()) == ["one", "two"]
    log.write_bytes(b"one\ntwo\npartial line\nthree\n")
    I.run_available(spark.readStream.format("vellum_tail").option("path", str(log)).load(), lambda b, e: b.write.mode("append").parquet(str(tmp_path / "o")), str(tmp_path / "s"))
    assert sorted(r.line for r in spark.read.parquet(str(tmp_path / "o")).collect()) == ["one", "partial line", "three", "two"]


def test_pair_events_batch_and_stream_agree(spark, tmp_path):
    rows = spark.createDataFrame([(u, i, k) for u in (1, 2) for i, k in enumerate(["done", "start", "start", "done", "done", "start", "fail"])], "u long, at long, kind string")
    batch = {tuple(r) for r in I.pair_events(rows, "u", "at", "start", "done|fail", "kind").collect()}
    rows.write.parquet(str(tmp_path / "in"))
    stream = I.pair_stream(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "u", "start")
    I.run_available(stream, lambda b, e: b.write.mode("append").parquet(str(tmp_path / "out")), str(tmp_path / "s"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == batch == {(u, a, b, k) for u in (1, 2) for a, b, k in ((2, 3, "done"), (5, 6, "fail"))}


def test_dependencies():
    a = X.Plugin("a", needs=("b", "gone"), order=10)
    b = X.Plugin("b", needs=("a",), order=20)
    errors, _ = X.problems([a, b])
    assert any("missing" in e for e in errors) and any("later" in e for e in errors) and any(e.startswith("cycle") for e in errors)
    assert X.problems([X.Plugin("x", needs=("y",)), X.Plugin("y", enabled=False)]) == ([], ["x needs y, which is disabled"])


def test_plans(spark):
    """Filters and columns reach the scan; vector top-k keeps k rows of each partition."""
    from vellum.plans.catalog import QUERIES

    def plan(name):
        return QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()

    assert "TakeOrderedAndProject" in plan("ext_fn_strings") and "WindowGroupLimit" in plan("topk_vector")
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,user)" in plan("join_en_it")
    assert "struct<source:string>" in plan("agg_works_per_author")


def test_cap_guard_query_writes_large_sources_as_several_files(spark, tmp_path, monkeypatch):
    from vellum.plans.catalog import QUERIES

    rows = [(i, s, "x" * 50) for s in ("a", "b/c", None) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(K, "HARD_CAP", 600)
    monkeypatch.setattr(K.guard, "__defaults__", (600,))
    assert {tuple(r) for r in QUERIES["sink_cap_guard"](spark, str(tmp_path)).collect()} == {(s, 20, True) for s in ("a", "b/c", None)}


def test_link_resolution_of_rows_that_come_in_another_order_each_time(spark):
    def shuffled(batches):
        import random

        for pdf in batches:
            order = list(range(len(pdf)))
            random.SystemRandom().shuffle(order)
            yield pdf.iloc[order]

    names = [f"n{i}" for i in range(200)]
    notes = spark.createDataFrame([(f"concepts/{n}", 1, None) for n in names], "slug string, weight int, author string")
    links = spark.createDataFrame([(n, None, None) for n in names], "target string, alias string, author string").coalesce(1)
    links = links.mapInPandas(shuffled, links.schema)
    assert {(r.target, r.slug) for r in L.resolve_links(links, notes, ["concepts"]).collect()} == {(n, f"concepts/{n}") for n in names}


def test_pair_stream_sorts_a_key_whose_rows_come_in_several_batches(spark, tmp_path):
    kinds = ["start", "done", None, "fail", "start", "start", "done"]
    rows = spark.createDataFrame([(1, i, kinds[i % 7]) for i in range(700)], "u long, at long, kind string")
    want = {tuple(r) for r in I.pair_events(rows, "u", "at", "start", "done|fail", "kind").collect()}
    rows.orderBy(F.xxhash64("at")).coalesce(1).write.parquet(str(tmp_path / "in"))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        stream = I.pair_stream(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "u", "start")
        I.run_available(stream, lambda b, e: b.write.mode("append").parquet(str(tmp_path / "out")), str(tmp_path / "s"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == want and len(want) == 200
