import random

import numpy as np
import xxhash

from vellum.llm.simhash import anchors, fingerprint, keep_one, near_duplicates


def plain(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(rows):
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in rows:
        for j, b in rows:
            if i < j and bin(a ^ b).count("1") <= 3:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}


def test_fingerprint_matches_plain():
    for t in ["", " \t\n", "One", "One two", "A b c", "Straße ÉCOLE x y z w", "a b c d " * 50]:
        assert fingerprint(t.encode()) == plain(t)


def test_long_text_is_cut_safely(monkeypatch):
    import vellum.llm.simhash as m

    text = " ".join(f"w{i % 37}" for i in range(3000))
    monkeypatch.setattr(m, "PIECE", 100)
    assert m.fingerprint(text.encode()) == plain(text)


def test_close_parts_share_an_anchor():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 31, 300, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 31, 300).astype(np.uint64))
    at = [dict() for _ in range(2)]
    for side, part in zip(at, (a, b), strict=True):
        for i, x in zip(*anchors(part), strict=True):
            side.setdefault(int(i), set()).add(int(x))
    assert all(at[0][i] & at[1][i] for i in range(300))
    assert max(len(x) for x in at[0].values()) <= 16


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    base = [[rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 40, 200]))] for _ in range(25)]
    rows = []
    for i in range(150):
        words = list(rng.choice(base))
        if rng.random() < 0.5 and len(words) > 3:
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((i * 3, " ".join(words), i))
    rows += [(1000, None, 0), (1001, "", 0), (1002, " \n", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(df).collect()}
    want = closure([(i, plain(t)) for i, t, _ in rows])
    assert got == {i: (f"{plain(t):016x}", want[i]) for i, t, _ in rows}
    kept = {r.doc_id for r in keep_one(df).collect()}
    assert kept == set(want.values())


def test_large_group_of_variants(spark):
    base = 0x0123456789ABCDEF
    from vellum.llm.components import components
    from vellum.llm.simhash import link_fingerprints

    fps = [base] + [base ^ (1 << i) ^ (1 << j) for i in range(30) for j in range(i)]
    found = link_fingerprints(spark.createDataFrame([(x if x < 1 << 63 else x - (1 << 64),) for x in fps], "fp long"))
    assert found.count() < 40 * len(fps)
    roots = {r.root for r in components(found, "a", "b").collect()}
    assert len(roots) == 1


def test_empty_and_repeated(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, component_id string")
    assert near_duplicates(empty).collect() == []
    rows = spark.createDataFrame([(5, "a b c"), (5, "a b c"), (2, "a b c"), (None, "a b c")], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.component_id) for r in near_duplicates(rows).collect()) == [(-1, 2), (2, 2), (5, 2), (5, 2)]
