"""Operator 9: mixing to target weights with soft membership.

A classifier fitted on the labelled table (documents of ``labels``, one domain for each pair of quality
and toxic) predicts a posterior over domains for every document.  Nonnegative rates, one for each document,
then make the expected tokens of each domain, the sum of rate * tokens * posterior, meet its target:
least squares, weighted by the inverse second moments of the posteriors, by projected gradient from rate 1.  A step needs only one
number for each domain, summed over all documents by a Spark job; a document's rate follows from its own
posterior and the steps so far, so nothing of a document's size is ever gathered.

The classifier (multinomial logistic regression) is fitted on a bounded sample: at most ``PER_DOMAIN``
labelled documents of each domain, the first in the order of a hash of the id, and ``SAMPLE`` of all; every domain with a label is learned.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import as_bytes, byte_slices, materialise, row_key, sample_per, small_side, tidy

PER_DOMAIN = 400
SAMPLE = 4800
#: Hash buckets for byte pairs and for words.
PAIRS, WORDS = 2048, 8192
#: Documents whose features are held at once, however short they are.
ROWS = 256
ROUNDS = 60
TOLERANCE = 1e-4
#: Share of all tokens that each domain is to have after mixing; other domains: none, shares of absent domains are dealt out.
TARGETS = {"q1t0": 0.84, "q0t0": 0.10, "q1t1": 0.05, "q0t1": 0.01}
#: Tokens after mixing, as a multiple of the tokens before.
BUDGET = 1.0


def features(words: list[bytes]) -> np.ndarray:
    """Square-rooted counts of hashed byte pairs and words of a text, halves at unit length."""
    x = np.zeros(PAIRS + WORDS)
    if words:
        codes = np.frombuffer(b" ".join(words), np.uint8).astype(np.uint32)
        pairs = (codes[:-1] * np.uint32(257) + codes[1:]) * np.uint32(0x9E3779B1) >> np.uint32(21)
        x[:PAIRS] = np.bincount(pairs.astype(np.intp), minlength=PAIRS)
        spelled = np.fromiter(map(xxhash.xxh32_intdigest, words), np.uint32, len(words))
        x[PAIRS:] = np.bincount((spelled % np.uint32(WORDS)).astype(np.intp), minlength=WORDS)
    x = np.sqrt(x)
    for half in (x[:PAIRS], x[PAIRS:]):
        if (n := math.sqrt(half @ half)) > 0:
            half /= n
    return x.astype(np.float32)


def fit_softmax(x: np.ndarray, y: np.ndarray, classes: int, prior: np.ndarray, penalty: float = 1e-5, rounds: int = 500) -> np.ndarray:
    """Weights (last row: bias) of a logistic regression, by Nesterov's gradient; rows weigh so that classes have ``prior``."""
    hot = np.eye(classes, dtype=np.float32)[y]
    weight = (prior / np.maximum(hot.sum(axis=0), 1))[y][:, None].astype(np.float32)
    w = look = np.zeros((x.shape[1] + 1, classes), np.float32)
    step = 1 / (0.5 * float((weight[:, 0] * (np.einsum("ij,ij->i", x, x) + 1)).sum()) + penalty)
    for k in range(rounds):
        z = x @ look[:-1] + look[-1]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        off = weight * (p - hot)
        after = look - step * (np.concatenate([x.T @ off, off.sum(axis=0, keepdims=True)]) + penalty * look)
        look = after + np.float32(k / (k + 3)) * (after - w)
        w = after
    return w


class Domains:
    """Names of the learned domains and the classifier's weights."""

    def __init__(self, names: list[str], weights: np.ndarray | None):
        self.names, self.weights = names, weights

    def posterior(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None or not len(x):
            return np.ones((len(x), len(self.names)))
        z = (x @ self.weights[:-1] + self.weights[-1]).astype(np.float64)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in byte_slices(batch, 1, 2 << 20):
            x = [features(t.split()).astype(np.float16).tobytes() for t in as_bytes(part.column(1))]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(x, pa.binary())], ["doc_id", "domain", "x"])


def domain_of(labels: DataFrame) -> DataFrame:
    """(doc_id, domain): one domain for each labelled document; rows with a null in any of the three columns have none."""
    named = labels.where("doc_id is not null and quality is not null and toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string")).alias("domain"))
    return named.groupBy("doc_id").agg(F.min("domain").alias("domain"))


def learn(docs: DataFrame, labels: DataFrame, per_domain: int = PER_DOMAIN) -> Domains:
    known = domain_of(labels)
    chosen = sample_per(known, "domain", "doc_id", per_domain, SAMPLE)
    shares = {r.domain: r["count"] for r in known.groupBy("domain").count().collect()}  # a row a domain
    rows = docs.where("text is not null").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "domain").mapInArrow(tidy(_sample_features), "doc_id long, domain string, x binary")
    rows = rows.groupBy("doc_id", "domain").agg(F.min("x").alias("x")).orderBy("domain", "doc_id").collect()  # about SAMPLE
    names = sorted({r.domain for r in rows})
    if len(names) < 2:
        return Domains(names or ["all"], None)
    x = np.stack([np.frombuffer(r.x, np.float16) for r in rows], dtype=np.float32)
    y = np.array([names.index(r.domain) for r in rows])
    prior = np.array([shares[n] for n in names], float)
    return Domains(names, fit_softmax(x, y, len(names), prior / prior.sum()))


def _member(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        domains = model.value
        for batch in batches:
            for part in byte_slices(batch, 1, 2 << 20):
                words = [t.split() for t in as_bytes(part.column(1))]
                p = np.concatenate([domains.posterior(np.stack([features(w) for w in words[i : i + ROWS]])) for i in range(0, len(words), ROWS)])
                flat = pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), p.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(w) for w in words], pa.int64()), flat], ["doc_id", "n_tokens", "posterior"])

    return run


def rates(posterior: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Rates after the projected steps, from 1."""
    r = np.ones(len(posterior))
    for g in steps:
        r = np.maximum(0.0, r - posterior @ g)
    return r


def _posteriors(batch: pa.RecordBatch, at: int) -> np.ndarray:
    column = batch.column(at)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _totals(steps: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            if batch.num_rows:
                p = _posteriors(batch, 1)
                total = total + (rates(p, steps) * batch.column(0).to_numpy()) @ p
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["t"])

    return run


def _rated(steps: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _posteriors(batch, 2) if batch.num_rows else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.round(rates(p, steps), 9))], ["doc_id", "n_tokens", "posterior", "rate"])

    return run


def targets_of(names: list[str], targets: dict[str, float], tokens: float) -> np.ndarray:
    share = np.array([max(0.0, targets.get(n, 0.0)) for n in names])
    share = share / share.sum() if share.sum() > 0 else np.full(len(names), 1 / len(names))
    return share * tokens


def metric(second: np.ndarray) -> np.ndarray:
    """Weights of the squared errors: the inverse of the posteriors' second moments.

    In this metric the squared errors' gradient has Lipschitz constant 1, so that steps of length 1 descend,
    however rare or alike the domains are.
    """
    return np.linalg.inv(second + 1e-6 * np.eye(len(second)))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens, and the token-weighted second moments of the posteriors, of a task's rows."""
    tokens, second = 0.0, 0.0
    for batch in batches:
        if batch.num_rows:
            n, p = batch.column(0).to_numpy().astype(float), _posteriors(batch, 1)
            tokens, second = tokens + n.sum(), second + (p * n[:, None]).T @ p
    if not np.isscalar(second):
        yield pa.RecordBatch.from_arrays([pa.array([[tokens, *second.ravel()]], pa.list_(pa.float64()))], ["t"])


def _summed(rows: DataFrame, work: Callable) -> np.ndarray:
    """The tasks' arrays added up, number by number."""
    parts = rows.mapInArrow(work, "t array<double>").select(F.posexplode("t").alias("i", "x"))
    return np.array([r.x for r in parts.groupBy("i").agg(F.sum("x").alias("x")).orderBy("i").collect()])


def solve(members: DataFrame, names: list[str], targets: dict[str, float], budget: float, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Steps of the projected gradient, the totals reached and the totals wanted, by domain."""
    d = len(names)
    rows = members.select("n_tokens", "posterior")
    moments = _summed(rows, _moments)
    tokens = float(moments[0]) if len(moments) else 0.0
    want = targets_of(names, targets, tokens * budget)
    steps = np.zeros((0, d))
    if not tokens:
        return steps, np.zeros(d), want
    weight = metric(moments[1:].reshape(d, d) / tokens)
    for _ in range(rounds + 1):
        reached = _summed(rows, _totals(steps))
        error = (reached - want) / tokens
        if len(steps) == rounds or np.abs(error).max() < TOLERANCE:
            break
        steps = np.concatenate([steps, (weight @ error)[None, :]])
    return steps, reached, want


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, budget: float = BUDGET, per_domain: int = PER_DOMAIN, rounds: int = ROUNDS, key: Column | None = None) -> DataFrame:
    """doc_id, n_tokens (words), domain (the likeliest), posterior (by domain name), rate for each row of ``docs``.

    Null and empty texts have no tokens; their rate follows from the posterior all the same.  If no two
    domains can be learned, all belongs to one domain.  Repeated rows and null ids give a row each; only
    doc_id and text are read.  With ``key`` that column stands in for doc_id in the result.
    """
    key = F.col("doc_id").cast("long") if key is None else key
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), key.alias("key"))
    model = learn(docs.select("doc_id", "text"), labels, per_domain)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    members = materialise(docs.select(F.col("key").alias("doc_id"), "text").mapInArrow(tidy(_member(shared)), "doc_id long, n_tokens long, posterior array<double>"))
    steps, _, _ = solve(members, model.names, TARGETS if targets is None else targets, budget, rounds)
    rated = members.mapInArrow(_rated(steps), "doc_id long, n_tokens long, posterior array<double>, rate double")
    names = F.array(*map(F.lit, model.names))
    likeliest = F.element_at(names, F.array_position("posterior", F.array_max("posterior")).cast("int"))
    return rated.select("doc_id", "n_tokens", likeliest.alias("domain"), F.map_from_arrays(names, "posterior").alias("posterior"), "rate")


def mixed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with the column rate; rows whose rate is zero go.

    Rows are judged one by one: rows that repeat an id have the rate of their own text, rows without an id too.  A column
    named rate is replaced; other columns stay.  An empty table gives no rows.
    """
    found = mix(docs, labels, key=row_key("doc_id", "text")).groupBy("doc_id").agg(F.min("rate").alias("rate"))
    found = small_side(materialise(found.withColumnRenamed("doc_id", "vellum_key")))
    joined = docs.drop("rate").join(found, row_key("doc_id", "text") == F.col("vellum_key")).drop("vellum_key")
    return joined.where("rate > 0")
