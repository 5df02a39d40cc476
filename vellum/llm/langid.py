"""Operator 1: language identification in two steps.

First the family of languages, by linear SVMs (one against the rest; with two families a single one);
then, within the family, linear SVMs for each pair of its languages, which vote.  Features are hashed
pairs and triples of letters of the whole text.  The machines are fitted on the driver on a bounded
sample: at most ``PER_LANG`` labelled documents of each language (the first in the order of a hash of
the id) and ``SAMPLE`` of all, so fewer of each where there are many; every language with a label is learned.  Language, source and id are never inputs of a
prediction.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from vellum.llm.common import byte_slices, sample_per, tidy
from vellum.llm.svm import decide, features, has_letter, train_svm

PER_LANG = 250
SAMPLE = 6000
UNKNOWN = "und"
#: A row of the pipeline with a lower score is in no learned language.
LEAST_SCORE = 0.2
# Language families by ISO 639-1 code.  A language that is not here is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "is", "af", "lb"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "la"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl"],
    "uralic": ["fi", "et", "hu"],
    "indic": ["hi", "bn", "ur", "mr", "ne"],
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, per_lang: int = PER_LANG, total: int = SAMPLE) -> DataFrame:
    """(lang, text) of the bounded training sample; ids are chosen first, without reading texts."""
    ids = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & (F.col("lang") != UNKNOWN))
    chosen = sample_per(ids.select("doc_id", "lang").distinct(), "lang", "doc_id", per_lang, total)
    rows = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null").join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").select("doc_id", "text", "lang")
    return rows


def _train_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [(i, lang, t) for i, t, lang in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True) if has_letter(t)]
        for start in range(0, len(kept), 256):
            part = kept[start : start + 256]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _, _ in part], pa.int64()), pa.array([x for _, x, _ in part]), pa.array([features(t).astype(np.float16).tobytes() for _, _, t in part], pa.binary())], ["doc_id", "lang", "x"])


class Model:
    """Family machines and, for each family, one machine for each pair of its languages."""

    def __init__(self, langs: list[str], x: np.ndarray):
        self.langs = sorted(set(langs))
        y = np.array(langs)
        family = {lang: FAMILY_OF.get(lang, f"only {lang}") for lang in self.langs}
        self.families = sorted(set(family.values()))
        of = np.array([family[lang] for lang in langs])
        self.members = {f: [lang for lang in self.langs if family[lang] == f] for f in self.families}
        first = self.families[1:] if len(self.families) == 2 else self.families if len(self.families) > 2 else []
        self.rest = [train_svm(x, np.where(of == f, 1.0, -1.0)) for f in first]
        self.pairs = {}
        for members in self.members.values():
            for a, b in combinations(members, 2):
                rows = (y == a) | (y == b)
                self.pairs[a, b] = train_svm(x[rows], np.where(y[rows] == b, 1.0, -1.0))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score (0 to 1: sigmoid of the family margin by the mean sigmoid of the winner's margins)."""
        n = len(x)
        if not self.langs:
            return np.full(n, UNKNOWN, object), np.zeros(n)
        margins = np.stack([decide(x, w) for w in self.rest], axis=1) if self.rest else np.ones((n, 1))
        if len(self.rest) == 1:
            margins = np.concatenate([-margins, margins], axis=1)
        top = margins.argmax(axis=1)
        sure = 1 / (1 + np.exp(-4 * margins[np.arange(n), top]))
        out, score = np.empty(n, object), np.zeros(n)
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(top == f)
            members = self.members[name]
            votes, total = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            for a, b in combinations(range(len(members)), 2):
                p = 1 / (1 + np.exp(-4 * decide(x[rows], self.pairs[members[a], members[b]])))
                votes[:, b] += p > 0.5
                votes[:, a] += p <= 0.5
                total[:, b] += p
                total[:, a] += 1 - p
            best = (votes + total / max(1, len(members))).argmax(axis=1)  # votes first, then margins
            out[rows] = np.array(members, object)[best]
            score[rows] = sure[rows] * (total[np.arange(len(rows)), best] / (len(members) - 1) if len(members) > 1 else 1)
        return out, np.clip(score, 0, 1)


def train(docs: DataFrame, per_lang: int = PER_LANG, total: int = SAMPLE) -> Model:
    rows = sample(docs, per_lang, total).mapInArrow(tidy(_train_features), "doc_id long, lang string, x binary")
    # About ``total`` rows of a fixed width reach the driver (one for each language at least), repeated rows or not.
    rows = rows.groupBy("doc_id", "lang").agg(F.min("x").alias("x")).orderBy("lang", "doc_id").collect()
    x = np.stack([np.frombuffer(r.x, np.float16) for r in rows], dtype=np.float32) if rows else np.zeros((0, 1), np.float32)
    return Model([r.lang for r in rows], x)


def _predictor(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        for batch in batches:
            for part in byte_slices(batch, 1, 2 << 20):
                texts = part.column(1).to_pylist()
                langs, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
                real = [i for i, t in enumerate(texts) if t and has_letter(t)]
                for start in range(0, len(real), 256):
                    rows = real[start : start + 256]
                    langs[rows], scores[rows] = fitted.predict(np.stack([features(texts[i]) for i in rows]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs.tolist(), pa.string()), pa.array(scores), part.column(2)], ["doc_id", "lang_pred", "score", "held_out"])

    return run


def _annotator(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows as they come, with the language and score of the text in their last column instead of that text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            asked = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), batch.column(last), pa.nulls(batch.num_rows, pa.bool_())], ["doc_id", "text", "held_out"])
            found = list(_predictor(model)(iter([asked]))) if batch.num_rows else []
            for part in found:
                start, n = part.column(0)[0].as_py(), part.num_rows
                rows = batch.slice(start, n)
                yield pa.RecordBatch.from_arrays([*rows.columns[:last], part.column(1), part.column(2)], [*batch.schema.names[:last], "vellum_lang", "vellum_score"])

    return run


def known_language(docs: DataFrame, least: float = LEAST_SCORE, per_lang: int = PER_LANG) -> DataFrame:
    """The rows of ``docs`` whose language is told with a score of at least ``least``, each judged by itself.

    Rows without text or without a letter go.  If no language can be learned, no other row goes.  Columns, null ids and
    repeated rows stay as they are.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    fitted = train(texts, per_lang)
    if not fitted.langs:
        return docs.where(F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)))
    model = docs.sparkSession.sparkContext.broadcast(fitted)
    schema = StructType([*docs.schema.fields, StructField("vellum_lang", StringType()), StructField("vellum_score", DoubleType())])
    told = docs.withColumn("vellum_text", F.col("text").cast("string")).mapInArrow(tidy(_annotator(model)), schema)
    return told.where((F.col("vellum_lang") != UNKNOWN) & (F.col("vellum_score") >= least)).select(docs.columns)


def identify(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of ``docs`` (doc_id, text, lang; others are ignored).

    Null texts and texts without a letter give ``und`` with score 0; so does every text if nothing can be
    learned (empty table, no labels).  A null id counts as not held out and is not learned from.  Repeated
    rows give repeated results; of rows that repeat an id and language one is learned from.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = docs.sparkSession.sparkContext.broadcast(train(docs, per_lang))
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    found = rows.mapInArrow(tidy(_predictor(model)), "doc_id long, lang_pred string, score double, held_out boolean")
    return found.select("doc_id", "held_out", "lang_pred", "score")
