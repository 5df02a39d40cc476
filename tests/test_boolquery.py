import pytest
from pyspark.sql import functions as F

from vellum.functions.boolquery import Query, Term, fields_match, haystack, matches, parse


def words(q):
    return [[t.text for t in c] for c in q.clauses]


@pytest.mark.parametrize(
    ("raw", "default", "clauses", "explicit"),
    [
        ("ivory lamp", "or", [["ivory"], ["lamp"]], False),
        ("ivory lamp", "and", [["ivory", "lamp"]], False),
        ("ivory AND lamp OR garden", "or", [["ivory", "lamp"], ["garden"]], True),
        ("a && b || c", "or", [["a", "b"], ["c"]], True),
        ("(river & bank) | wolf", "or", [["river", "bank"], ["wolf"]], True),
        ("(river AND bank) OR wolf", "or", [["river", "bank"], ["wolf"]], True),
        ("river and bank", "or", [["river"], ["and"], ["bank"]], False),
        ("salt and pepper | oil", "or", [["salt", "and", "pepper"], ["oil"]], True),
        ("(a | b) & (c | d)", "or", [["a", "c"], ["a", "d"], ["b", "c"], ["b", "d"]], True),
        ("a & a", "or", [["a"]], True),
        ("& a", "or", [["a"]], True),
        ("a ) b", "or", [["a"]], True),
        ("&", "or", [], True),
        ("", "or", [], False),
        ('"Half a saying', "or", [["half a saying"]], False),
    ],
)
def test_parse(raw, default, clauses, explicit):
    q = parse(raw, default)
    assert words(q) == clauses and q.explicit == explicit


def test_exact_terms_and_order():
    q = parse("“Wolf by river\" hole")
    assert q.clauses == ((Term("wolf by river", True),), (Term("hole"),))
    assert parse("a AND b OR c").terms == ["a", "b", "c"]


def test_columns(spark):
    df = spark.createDataFrame([("A keyhole by river", "the wolf by river howled", ["author/x"]), ("The Lamp", "ivory tusks", None), (None, None, None)], "title string, content string, tags array<string>")
    hay = haystack(F.col("title"), F.col("content"), F.col("tags"))

    def hits(raw, default="or"):
        return [r[0] for r in df.select(matches(hay, parse(raw, default))).collect()]

    assert hits('"wolf by river"') == [True, False, False]
    assert hits('"hole"') == [False, False, False] and hits("hole") == [True, False, False] and hits('"keyhole"') == [True, False, False]
    assert hits("ivory AND lamp") == [False, True, False] and hits("ivory AND snow") == [False] * 3
    assert hits("snow OR lamp", "and") == [False, True, False]
    assert [r[0] for r in df.select(fields_match([F.col("title")], " ")).collect()] == [True] * 3
    assert [r[0] for r in df.select(fields_match([F.col("title")], "&")).collect()] == [False] * 3
    assert [r[0] for r in df.select(matches(hay, Query(()))).collect()] == [False] * 3
