import zlib

import numpy as np

from vellum.llm.langid import identify
from vellum.llm.svm import counts, features, train_svm

SF = "/root/testdata/sf0.01"


def test_counts_do_not_depend_on_slices(monkeypatch):
    import vellum.llm.svm as m

    text = "Où est l'école? Das Mädchen läuft — 12 3 x." * 7
    whole = counts(text)
    monkeypatch.setattr(m, "SLICE", 11)
    assert np.array_equal(whole, counts(text))
    assert whole.sum() > 0 and abs(features(text) @ features(text) - 1) < 1e-5


def test_svm_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5)).astype(np.float32)
    y = np.where(x[:, 0] + 0.5 * x[:, 1] > 0, 1.0, -1.0)
    w = train_svm(x, y, cost=1000.0, epochs=300)
    assert np.mean(np.sign(x @ w[:-1] + w[-1]) == y) > 0.97


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = identify(docs, per_lang=60).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_rows(spark):
    rows = [(i, t, lang, "x") for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("le chat et le chien", "fr")] * 10)]
    rows += [(100, None, "en", "x"), (101, "", None, "x"), (102, "12 !!", "en", "x"), (None, "the dog", "en", "x"), (0, "the cat and the dog", "en", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    got = identify(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and by[100].score == 0
    assert by[None].lang_pred == "en" and by[None].held_out is False
    assert by[1].lang_pred == "de"
    assert {r.lang_pred for r in identify(df.where("lang is null or doc_id is null")).collect()} == {"und"}
    assert identify(df.limit(0)).collect() == []
