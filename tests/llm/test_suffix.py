import hashlib
import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from vellum.llm.dc3 import suffix_array
from vellum.llm.suffix import remove_repeats


@given(st.lists(st.integers(1, 3), max_size=60))
def test_suffix_array(values):
    t = np.array(values, np.int64)
    assert suffix_array(t).tolist() == sorted(range(len(values)), key=lambda i: values[i:])


def test_suffix_array_of_large_numbers():
    rng = np.random.default_rng(2)
    t = rng.integers(1, 5, 4000) * (1 << 40)
    assert suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def brute(rows):
    least = {}
    texts = [(d, (t or "").encode()) for d, t in rows]
    for d, b in texts:
        if d is not None:
            for i in range(len(b) - 49):
                w = b[i : i + 50]
                least[w] = min(least.get(w, d), d)
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        if d is not None:
            for i in range(len(b) - 49):
                if least[b[i : i + 50]] < d:
                    gone[i : i + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not p for g, p in zip(gone, b"\0" + gone, strict=False))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def fixture():
    rng = random.Random(8)
    syllables = ["the", " ", "ion", "er", "é", "\n", "aus", "🙂"]
    passages = ["".join(rng.choice(syllables) for _ in range(n)) for n in (20, 25, 30, 60, 200)] + ["a" * 700, "ab" * 90, "x" * 49, "y" * 50]
    rows = []
    for i in range(70):
        parts = []
        for _ in range(rng.randrange(5)):
            own = rng.choice(passages)
            if rng.random() < 0.3:
                at = rng.randrange(len(own))
                own = own[:at] + "Q" + own[at + 1 :]
            parts += ["".join(rng.choice(syllables) for _ in range(rng.randrange(60))), own]
        rows.append((i * 5 % 71, "".join(parts)))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, None), (203, ""), (None, rows[3][1]), (200, rows[3][1]), (204, "y" * 50), (204, "z" * 60), (205, "z" * 60)]
    return rows


def test_against_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_bytes int").repartition(3)
    got = sorted((tuple(r) for r in remove_repeats(df).collect()), key=str)
    want = brute(rows)
    assert got == want and sum(r[2] for r in want) > 1000


def test_very_common_anchors_are_split(spark, monkeypatch):
    import vellum.llm.suffix as m

    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("abcdef ") for _ in range(40)) + "a passage that very many of the documents have in common, word by word" + "".join(rng.choice("abcdef ") for _ in range(40))) for i in range(60)]
    monkeypatch.setattr(m, "HOT", 5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in remove_repeats(df).collect()), key=str) == brute(rows)


def test_pieces_do_not_matter(spark, monkeypatch):
    import vellum.llm.suffix as m

    rows = fixture()
    data = [np.frombuffer((t or "").encode(), np.uint8) for _, t in rows]
    whole = [m.snippets(x, np.array([len(x)])) for x in data]
    assert all(s[1].sum() == max(0, len(x) - 49) for s, x in zip(whole, data, strict=True))
    monkeypatch.setattr(m, "PIECE", 64)
    ids, marks, texts = [1], [2], [b"q" * 300]
    cut = [(e, d) for e, d in m._pieces(ids, marks, texts)]
    assert sum(len(range(e[3] - 49)) for es, _ in cut for e in es) == 251


def test_test_data_and_empty(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in remove_repeats(docs).collect()), key=str) == brute(rows)
    assert remove_repeats(docs.limit(0)).collect() == []
