from vellum.llm.common import drop_rows, light_side, materialise, row_key, sample_per, small_side


def test_sample_is_bounded_and_whole_for_small_groups(spark):
    rows = spark.range(5000).selectExpr("id AS doc_id", "CASE WHEN id < 4900 THEN 'big' WHEN id < 4990 THEN 'mid' ELSE 'rare' END AS lang")
    def sizes(**bounds):
        return {r.lang: r["count"] for r in sample_per(rows, "lang", "doc_id", **bounds).groupBy("lang").count().collect()}

    assert sizes(most=50, total=1000) == {"big": 50, "mid": 50, "rare": 10}
    assert sizes(most=50, total=60) == {"big": 20, "mid": 20, "rare": 10}  # the whole is bounded, every group is there
    assert sizes(most=50, total=1) == {"big": 1, "mid": 1, "rare": 1}
    assert sample_per(rows.limit(0), "lang", "doc_id", 50, 9).count() == 0


def test_many_classes_are_all_learned(spark):
    from vellum.llm.langid import train

    rows = spark.createDataFrame([(i, f"word{chr(97 + i % 70 // 26)}{chr(97 + i % 26)} " * 5, f"l{i % 70:02}") for i in range(700)], "doc_id long, text string, lang string")
    assert len(train(rows, per_lang=2, total=140).langs) == 70


def test_sides_are_marked_only_when_counted_small(spark):
    rows = materialise(spark.range(100).selectExpr("id", "array(id, id) AS held"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(small_side(rows, 100)) and not hinted(small_side(rows, 99))
    assert hinted(light_side(rows, "held")) and not hinted(light_side(rows, "held", 100))


def test_drop_rows_judges_rows_by_id_and_text(spark):
    docs = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (2, "d"), (None, None)], "doc_id long, text string")
    gone = materialise(docs.where("doc_id = 2 AND text = 'c' OR text = 'b'").select(row_key("doc_id", "text").alias("key")))
    assert sorted((r.doc_id or 0, r.text or "") for r in drop_rows(docs, gone).collect()) == [(0, ""), (1, "a"), (2, "d")]
