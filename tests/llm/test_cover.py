import random

import pytest

from vellum.llm.cover import repeated_bytes, suffix_ranks


def brute_starts(docs):
    seen, hit = {}, set()
    for doc, text in sorted((d, (t or "").encode()) for d, t in docs):
        strings = {}
        for i in range(len(text) - 49):
            strings.setdefault(text[i : i + 50], []).append(i)
        hit |= {(doc, i) for s, places in strings.items() if s in seen for i in places}
        seen |= dict.fromkeys(strings)
    return hit


@pytest.mark.parametrize("length", [40, 41, 42])
def test_ranks_are_those_of_all_suffixes(spark, length):
    rng = random.Random(length)
    text = [rng.choice([1, 1, 2, 3]) for _ in range(length)]
    rows = spark.createDataFrame(list(enumerate(text)), "p long, c long")
    got = {r.p: r["rank"] for r in suffix_ranks(rows, length, local=10).collect()}
    assert got == {p: i for i, p in enumerate(sorted(range(length), key=lambda p: text[p:]))}


def test_repeats_against_brute_force(spark):
    rng = random.Random(9)
    shared = ["".join(rng.choice("ab") for _ in range(n)) for n in (49, 50, 70)]
    docs = [(i, "".join(rng.choice("cdé") for _ in range(rng.choice([0, 5, 40]))) + rng.choice(shared) + rng.choice(["", "x", shared[2]])) for i in range(9)] + [(20, None), (21, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {(r.doc_id, r.at) for r in repeated_bytes(df, local=400).collect()} == brute_starts(docs)
    assert repeated_bytes(df.limit(0)).collect() == []
