import re

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_decontam import brute as leaks
from tests.llm.test_linededup import brute as lines
from tests.llm.test_simhash import closure, plain
from vellum.llm.decontam import remove_contaminated
from vellum.llm.langid import known_language
from vellum.llm.mixing import mix
from vellum.llm.simhash import keep_one


def test_stages_against_brute_force(spark, tmp_path):
    """Stage by stage: what each keeps of its predecessor's rows is what a plain version keeps."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    held, columns = {r.doc_id: r for r in docs.collect()}, docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        rows = {r.doc_id: r for r in docs.collect()}
        if i < 4:
            assert docs.columns == columns, name
        if i == 0:
            assert set(rows) == {d for d, r in held.items() if any(c.isalpha() for c in r.text or "")}
        elif i == 1:
            want = {d: t for d, t in lines([(d, r.text) for d, r in held.items()])[0].items() if re.search(r"[^\W_]", t)}
            assert {d: r.text for d, r in rows.items()} == want and all(r.n_chars == len(r.text) for r in rows.values())
        elif i == 2:
            roots = closure([(d, plain(r.text)) for d, r in held.items()])
            assert set(rows) == set(roots.values())
        elif i == 3:
            assert set(rows) == set(held) - {d for d, _ in leaks([(d, r.text) for d, r in held.items()], items)}
        else:
            assert set(rows) <= set(held) and all(r.rate > 0 for r in rows.values())
        held = rows


def odd(spark):
    words = "Some words here, and enough of them to tell which language this line is written in."
    rows = [(1, None, None, None, None, 5), (2, "", "en", "s", 0, 5), (None, words, "en", "s", 16, 5), (3, words, "en", "s", 16, 5), (3, words, "en", "s", 16, 5), (3, "der die und nicht mit einem ganz anderen Satz", "de", "s", 16, 5), (4, "x " * 60_000, "en", "s", 16, 5), (5, "1234", None, "s", 4, 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, rate int")


def test_odd_rows_in_every_stage(spark):
    table = odd(spark)
    for docs in (table, table.limit(0), table.withColumn("lang", F.lit(None).cast("string"))):
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert set(out.columns) == set(table.columns), name
            kept = sorted((str(r.doc_id), r.text or "") for r in out.collect())
            all_ = sorted((str(r.doc_id), r.text or "") for r in docs.collect())
            if docs.isEmpty():
                assert kept == []
            elif i == 0:  # without text or without a letter
                assert [x for x in all_ if x not in kept] == [("1", ""), ("2", ""), ("5", "1234")], name
            elif i == 2:  # of the empty texts the first stays; rows that repeat the kept id stay, and so do those of another text
                assert [x for x in all_ if x not in kept] == [("2", "")] and len(kept) == len(all_) - 1, name
            elif i == 3:
                assert kept == all_, name


def test_rows_that_repeat_an_id_are_judged_by_their_own_text(spark):
    text = "eins zwei drei vier fünf sechs sieben acht neun zehn elf zwölf"
    docs = spark.createDataFrame([(0, text), (1, text), (1, "quite another document with words of its own that stays")], "doc_id long, text string")
    assert sorted(r.text for r in keep_one(docs).collect()) == sorted([text, "quite another document with words of its own that stays"])
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert [(r.doc_id, r.text[:5]) for r in remove_contaminated(docs, items).collect()] == [(1, "quite")]


def test_no_label_at_all_costs_no_document(spark):
    docs = spark.createDataFrame([(1, "abc def", None), (2, "ghi", None), (3, "77", None)], "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in known_language(docs).collect()) == [1, 2]


def test_mixing_stage_against_its_operator(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rate = {r.doc_id: r.rate for r in mix(docs, labels).collect()}
    got = {r.doc_id: r.rate for r in corpus_pipeline.mixed(spark, docs, sf).collect()}
    assert got == {d: x for d, x in rate.items() if x > 0} and 0 < len(got)
