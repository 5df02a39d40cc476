"""Operator 4: benchmark decontamination, with DataFrame functions only.

Containment search by MinHash.  A MinHash sketch of a short item, compared with one of a long document,
would need about document/item times as many hashes; so the sketch stays on the short side: an item's
sketch is the s least hash values of its shingles, and a document is a candidate if its own shingles
hold one of them.  Items are partitioned by size (powers of two); with upper size u of a partition,
s = floor((1 - threshold) * u) + 1, so an item of which at least ``threshold`` is contained cannot miss
all of its sketch: the search loses no match.  Documents with fewer shingles than the match needs are
passed over.  Candidates are then verified by exact containment of the shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.common import drop_rows, materialise, row_key, small_side

WIDTH = 5
THRESHOLD = 0.8


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; no words for null or empty texts."""
    flat = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(F.length(flat) > 0, F.split(flat, " ")).otherwise(F.array().cast("array<string>"))


def _shingles(rows: DataFrame, widths: list[int], hashed: bool) -> DataFrame:
    """doc_id, width, n (shingles of that width, repeats included) and shingle (text) or h (its hash), a row for each position and width.

    The words of a row are taken once for all widths.
    """
    counted = rows.withColumn("size", F.size("words")).where(F.col("size") >= widths[0])
    each = counted.select("doc_id", "words", "size", F.explode(F.sequence(F.lit(0), F.col("size") - widths[0])).alias("at"))

    def own(w: int) -> list[Column]:
        parts = [F.get("words", F.col("at") + i) for i in range(w)]
        return [F.lit(w).alias("width"), (F.col("size") - (w - 1)).alias("n"), F.xxhash64(F.lit(w), *parts).alias("h") if hashed else F.concat_ws(" ", *parts).alias("shingle")]

    if len(widths) == 1:
        return each.select("doc_id", *own(widths[0]))
    spread = each.select("doc_id", F.explode(F.array(*(F.when(F.col("at") + w <= F.col("size"), F.struct(*own(w))) for w in widths))).alias("s"))
    return spread.where("s is not null").select("doc_id", "s.*")


def item_shingles(items: DataFrame, width: int) -> DataFrame:
    """(item_id, width, shingle, size) of distinct items.

    Items with fewer than ``width`` words are one shingle of all their words; items without words have none.
    Items with the same words are one, named by the least id.
    """
    spelled = items.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text").cast("string")).alias("words")).where("size(words) > 0 and item_id is not null")
    spelled = spelled.groupBy("words").agg(F.min("item_id").alias("item_id"))
    w = F.least(F.lit(width), F.size("words"))
    each = spelled.select("item_id", w.alias("width"), F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - w + 1), lambda i: F.concat_ws(" ", F.slice("words", i, w)))).alias("shingle")).distinct()
    size = each.groupBy("item_id").agg(F.count("*").alias("size"))
    return each.join(size, "item_id")


def sketches(shingles: DataFrame, width: int, threshold: float) -> DataFrame:
    """(item_id, size, h): the least hashes of each item of one width, as many as its size partition asks for."""
    parts = F.split("shingle", " ")
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("size").cast("double"))))
    enough = F.floor((1 - F.lit(threshold)) * upper + 1e-9) + 1
    hashed = shingles.select("item_id", "size", enough.alias("s"), F.xxhash64(F.lit(width), *[parts.getItem(i) for i in range(width)]).alias("h"))
    order = Window.partitionBy("item_id").orderBy("h")
    return hashed.withColumn("at", F.row_number().over(order)).where(F.col("at") <= F.col("s")).select("item_id", "size", "h")


def contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles, containment) where containment >= threshold.

    A pair for each document id and each item (items with the same words count once, under the least id), not
    for pairs of documents.  Rows with a null id or without words match nothing; rows that repeat an id
    count as one document with the shingles of all.  Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    shingles = materialise(item_shingles(items, width))
    widths = sorted(r.width for r in shingles.select("width").distinct().collect())  # at most `width` values
    spelled = docs.select("doc_id", words(F.col("text")).alias("words"))
    if not widths:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_shared long, n_shingles long, containment double")
    drawn = None
    for w in widths:
        own = sketches(shingles.where(F.col("width") == w), w, threshold)
        drawn = own if drawn is None else drawn.unionByName(own)
    hashed = _shingles(spelled, widths, hashed=True)
    met = hashed.join(small_side(materialise(drawn)), "h").where(F.col("n") >= F.ceil(F.col("size") * threshold - 1e-9))
    candidates = materialise(met.select("doc_id", "item_id").distinct())
    near = docs.join(small_side(candidates.select("doc_id").distinct()), "doc_id", "left_semi").select("doc_id", words(F.col("text")).alias("words"))
    own = small_side(shingles.select("item_id", "width", "shingle", "size"))
    shared = _shingles(near, widths, hashed=False).select("doc_id", "width", "shingle").join(own, ["width", "shingle"]).select("doc_id", "item_id", "size", "shingle").distinct()
    held = shared.join(small_side(candidates), ["doc_id", "item_id"], "left_semi").groupBy("doc_id", "item_id").agg(F.count("*").alias("n_shared"), F.max("size").alias("n_shingles"))
    return held.withColumn("containment", F.col("n_shared") / F.col("n_shingles")).where(F.col("containment") >= threshold - 1e-9)


def remove_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item.

    Rows are judged one by one, whether they repeat an id or have none; null texts stay.  Columns stay as they are.
    """
    keyed = docs.select(row_key("doc_id", "text").alias("doc_id"), "text")
    return drop_rows(docs, materialise(contained(keyed, items).select(F.col("doc_id").alias("key")).distinct()))


ORACLE = r"""
WITH item AS (
  SELECT min(item_id) AS item_id, w FROM (
    SELECT item_id, string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM benchmark WHERE text IS NOT NULL)
  WHERE w <> [''] GROUP BY w),
item_shingle AS (
  SELECT DISTINCT item_id, least(5, len(w)) AS k, unnest(list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda i: array_to_string(w[i:i + least(5, len(w)) - 1], ' '))) AS s FROM item),
size AS (SELECT item_id, count(*) AS n FROM item_shingle GROUP BY item_id),
doc AS (SELECT doc_id, string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM documents WHERE text IS NOT NULL),
doc_shingle AS (
  SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
  FROM doc, (SELECT DISTINCT k FROM item_shingle))
SELECT d.doc_id, i.item_id, count(*) AS n_shared, any_value(n) AS n_shingles, count(*) / any_value(n) AS containment
FROM doc_shingle d JOIN item_shingle i ON d.s = i.s AND d.k = i.k JOIN size z ON z.item_id = i.item_id
GROUP BY d.doc_id, i.item_id HAVING count(*) / any_value(n) >= 0.8 - 1e-9
"""
