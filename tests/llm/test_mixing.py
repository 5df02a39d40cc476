import numpy as np

from vellum.llm.mixing import learn, mix, mixed, rates, targets_of

SF = "/root/testdata/sf0.01"


def direct(p, n, want, rounds):
    """The same projected gradient on whole arrays."""
    weight = np.linalg.inv((p * n[:, None]).T @ p / n.sum() + 1e-6 * np.eye(p.shape[1]))
    r = np.ones(len(n))
    for _ in range(rounds):
        error = ((r * n) @ p - want) / n.sum()
        if np.abs(error).max() < 1e-4:
            break
        r = np.maximum(0, r - p @ (weight @ error))
    return r


def test_targets_are_met_and_match_direct_solution(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = mix(docs, labels, per_domain=100).orderBy("doc_id").collect()
    names = sorted(rows[0].posterior)
    p = np.array([[r.posterior[k] for k in names] for r in rows])
    n = np.array([r.n_tokens for r in rows], float)
    rate = np.array([r.rate for r in rows])
    assert len(rows) == 1000 and (rate >= 0).all() and np.allclose(p.sum(axis=1), 1)
    from vellum.llm.mixing import ROUNDS, TARGETS

    want = targets_of(names, TARGETS, n.sum())
    assert np.allclose(rate, direct(p, n, want, ROUNDS), atol=1e-6)
    assert np.abs((rate * n) @ p - want).max() < 0.01 * n.sum()


def test_classifier_on_labels_it_has_not_seen(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    train = labels.where("doc_id % 4 <> 0")
    found = {r.doc_id: r.domain for r in mix(docs, train, per_domain=200, rounds=0).collect()}
    held = labels.where("doc_id % 4 = 0").collect()
    assert np.mean([found[r.doc_id] == f"q{r.quality}t{r.toxic}" for r in held]) > 0.9


def test_rates_are_projected():
    p = np.array([[1.0, 0.0], [0.0, 1.0]])
    assert rates(p, np.array([[2.0, -1.0], [-0.5, 0.0]])).tolist() == [0.5, 2.0]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a good text", 2.0), (2, None, 2.0), (3, "", 2.0), (3, "", 2.0), (None, "b", 2.0)], "doc_id long, text string, rate double")
    none = spark.createDataFrame([(None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    assert learn(docs, none).names == ["all"]
    got = mix(docs, none).collect()
    assert len(got) == 5 and all(r.rate == 1 and r.domain == "all" for r in got)
    some = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    out = mixed(docs, some)
    assert out.columns == ["doc_id", "text", "rate"] and out.count() <= 5
    assert mix(docs.limit(0), some).collect() == [] and mixed(docs.limit(0), none).collect() == []
