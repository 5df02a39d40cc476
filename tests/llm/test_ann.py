import numpy as np

from vellum.llm.ann import nearest, shard_count


def exact(ids, v, k, every):
    out = {}
    for i, q in zip(ids, v, strict=True):
        if i % every == 0:
            s = v.astype(float) @ q.astype(float)
            out[i] = [ids[j] for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
    return out


def grouped(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


def test_recall_on_test_data(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    ids, v = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float32)
    want = exact(ids, v, 20, 20)
    found = nearest(df, shard=900).collect()
    got = grouped(found)
    assert set(got) == set(want) and all(len(x) == 20 for x in got.values())
    assert np.mean([len(set(got[i]) & set(want[i])) / 20 for i in want]) >= 0.95
    at = {i: x for i, x in zip(ids, v, strict=True)}
    assert all(abs(r.score - float(at[r.query_id].astype(float) @ at[r.vec_id].astype(float))) < 1e-12 for r in found)


def test_uneven_norms_and_copies(spark):
    rng = np.random.default_rng(4)
    v = (rng.normal(size=(1500, 16)) * rng.uniform(0.2, 3, size=(1500, 1))).astype(np.float32)
    v[200:700] = v[200]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    got = grouped(nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), shard=400).collect())
    want = exact(np.arange(1500), v, 20, 20)
    assert np.mean([len(set(got[i]) & set(want[i])) / 20 for i in want]) >= 0.95
    assert got[200] == want[200]


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (20, [None, 1.0]), (40, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (2, [0.5, 0.5]), (60, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in nearest(df).orderBy("rank").collect()] == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]
    assert nearest(df.limit(0)).collect() == []


def test_shards_grow_with_the_root_of_the_table():
    assert shard_count(0) == shard_count(8192) == 1 and shard_count(51_282) == 7
    many = [shard_count(n) for n in (10**6, 10**8, 10**10)]
    assert many == sorted(many) and many[2] < 11 * many[1] < 121 * many[0] and many[2] < 10**10 / 8192 / 100


def test_recall_on_several_shards_of_default_size(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 32))
    v = (centres[rng.integers(0, 60, 18_000)] + rng.normal(size=(18_000, 32)) * 0.7).astype(np.float32)
    rows = [(i, r.tolist()) for i, r in enumerate(v)]
    got = grouped(nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=200).collect())
    want = exact(np.arange(18_000), v, 20, 200)
    assert shard_count(18_000) == 3
    assert np.mean([len(set(got[i]) & set(want[i])) / 20 for i in want]) >= 0.9
