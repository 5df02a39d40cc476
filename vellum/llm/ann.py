"""Operator 5: approximate nearest neighbours by a robust-pruned directed graph in each shard.

Equal vectors are one point (with the least ids of its copies, as many as a result can hold), so that a very
common vector costs one.  Points are dealt by a hash of the id to shards; every shard builds
its graph, answers all queries by beam search, and gives its nearest with exact scores; the nearest of all
shards are the result.  A shard has ``SHARD`` points, and in large tables ``GROWTH`` times the root of the number of points, since a
graph search grows only with the logarithm of its shard: queries times shards, and the answers to merge, then grow with the
power 1.5 of the table.  A shard's task holds its points and graph, and takes the queries as a stream of
batches.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.common import materialise
from vellum.llm.vamana import BATCH, Graph

SHARD = 8192
GROWTH = 32
NEAREST = 20
BEAM = 100
EVERY = 20


def usable(table: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the rows whose vector is neither null nor empty nor zero and all finite."""
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False)))


class _Shard:
    """The points of one shard and its graph, built when the first query comes."""

    def __init__(self, k: int, beam: int):
        self.k, self.beam, self.vectors, self.ids, self.graph = k, beam, [], [], None

    def answer(self, queries: list[tuple[int, np.ndarray]]) -> tuple[list[int], list[int], list[float]]:
        if self.graph is None:
            self.matrix = np.stack(self.vectors)
            self.graph = Graph(self.matrix)
        q = np.stack([v for _, v in queries])
        wide = np.concatenate([q, np.zeros((len(q), 1))], axis=1).astype(np.float32)
        beam = min(max(self.beam, self.k + 1), len(self.ids))
        near = self.graph.search(wide, beam)[0] if beam < len(self.ids) else np.broadcast_to(np.arange(len(self.ids)), (len(q), len(self.ids)))
        out_q, out_v, out_s = [], [], []
        for (own, v), found in zip(queries, near, strict=True):
            found = found[found >= 0]
            scores = self.matrix[found] @ v
            hits = []
            for i in np.lexsort((found, -scores)):
                if len(hits) > self.k and scores[i] < hits[self.k - 1][0]:
                    break
                hits += [(scores[i], x) for x in self.ids[found[i]] if x != own]
            hits.sort(key=lambda x: (-x[0], x[1]))
            for s, x in hits[: self.k]:
                out_q.append(own)
                out_v.append(x)
                out_s.append(float(s))
        return out_q, out_v, out_s


def _searcher(k: int, beam: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, shard, waiting = None, _Shard(k, beam), []

        def flush() -> Iterator[pa.RecordBatch]:
            if waiting and shard.ids:
                q, v, s = shard.answer(waiting)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())], ["query_id", "vec_id", "score"])
            waiting.clear()

        for batch in batches:
            dims, shards, asks, ids, copies = (batch.column(i).to_pylist() for i in range(5))
            offsets = batch.column(5).offsets.to_numpy()
            values = batch.column(5).values.to_numpy(zero_copy_only=False)
            for i, key in enumerate(zip(dims, shards, strict=True)):
                if key != of:
                    yield from flush()
                    of, shard = key, _Shard(k, beam)
                v = values[offsets[i] : offsets[i + 1]]
                if asks[i]:
                    waiting.append((ids[i], v))
                    if len(waiting) == BATCH:
                        yield from flush()
                else:
                    shard.vectors.append(v.copy())
                    shard.ids.append(copies[i])
        yield from flush()

    return run


def shard_count(points: int, shard: int = SHARD, growth: float = GROWTH) -> int:
    return max(1, -(-points // max(shard, int(growth * math.sqrt(points)))))


def nearest(table: DataFrame, k: int = NEAREST, every: int = EVERY, shard: int = SHARD, beam: int = BEAM, growth: float = GROWTH) -> DataFrame:
    """query_id, rank, vec_id, score: for each vec_id divisible by ``every`` its ``k`` nearest by inner product.

    Ties go to the smaller vec_id; a query is not its own neighbour.  Vectors that are null, empty or zero or hold
    null or non-finite components take no part; vectors meet only others of as many components.  Of
    rows that repeat a vec_id with the same vector one counts; columns other than vec_id and embedding are
    ignored.  An empty table gives no rows.
    """
    rows = materialise(usable(table).distinct())
    shards = shard_count(rows.count(), shard, growth)
    first = Window.partitionBy("v").orderBy("vec_id")
    points = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("copies"))
    points = points.select(F.size("v").alias("dim"), F.pmod(F.xxhash64(F.col("copies")[0]), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("asks"), F.col("copies")[0].alias("vec_id"), "copies", "v")
    asked = rows.where(F.col("vec_id") % every == 0)
    asked = asked.select(F.size("v").alias("dim"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("asks"), "vec_id", F.lit(None).cast("array<long>").alias("copies"), "v")
    dealt = points.unionByName(asked).repartition(max(shards, 1), "dim", "shard").sortWithinPartitions("dim", "shard", "asks", "vec_id")
    found = dealt.mapInArrow(_searcher(k, beam), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
