import random

import pytest

import vellum.llm.components as m


def plain(edges):
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("chunk", [200_000, 7])
def test_against_union_find(spark, monkeypatch, chunk):
    """In one task, and by rounds over chunks (workers of this test hold chunks of the module's size)."""
    monkeypatch.setattr(m, "CHUNK", chunk)
    rng = random.Random(chunk)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2060)] + [(5, 5)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = m.components(df, "a", "b").collect()
    want = plain([e for e in edges if e[0] != e[1]])
    assert {r.node: r.root for r in got} == want and len(got) == len(want)


def test_binary_nodes_and_no_edges(spark):
    df = spark.createDataFrame([(b"b", b"c"), (b"a", b"b"), (None, b"x")], "a binary, b binary")
    assert sorted((bytes(r.node), bytes(r.root)) for r in m.components(df, "a", "b").collect()) == [(b"a", b"a"), (b"b", b"a"), (b"c", b"a")]
    assert m.components(df.limit(0), "a", "b").collect() == []


def test_rounds_have_fewer_edges_each(spark, monkeypatch):
    """Many small components: the rounds together write few times the edges, and no later round sees a component that is done."""
    written = []

    def counted(df, materialise=m.materialise):
        written.append(materialise(df))
        return written[-1]

    monkeypatch.setattr(m, "CHUNK", 7)
    monkeypatch.setattr(m, "materialise", counted)
    edges = [(10 * i, 10 * i + k) for i in range(300) for k in (1, 2)] + [(10 * i + 1, 10 * i + 3) for i in range(300)]
    got = {r.node: r.root for r in m.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == plain(edges)
    sizes = [df.count() for df in written if df.columns == ["u", "v"]]
    assert sizes[0] == 900 and all(2 * y <= x for x, y in zip(sizes, sizes[1:-1], strict=False)) and sum(sizes) < 2 * 900
