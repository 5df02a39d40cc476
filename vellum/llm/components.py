"""Connected components by contraction.

In a round every node joins its neighbour of least hash, if that is less than its own; edges go over to what their ends
joined.  A small component is done in a round or two, so that each round has a fraction of the edges before it, whatever the nodes
are; a node's neighbours are only aggregated, and joins have one row per node on one side, so a hub's edges are never
gathered in one place: the adaptive planner may split the hub's partition.  At most ``CHUNK`` edges are contracted by one
task.  Rounds are written to the shared folder, so that a lost executor costs one round.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import materialise

#: Edges that one task holds at a time.
CHUNK = 200_000


def stars(edges: list[tuple]) -> list[tuple]:
    """(node, least node of its component) for the nodes of some edges, but for the least ones."""
    up: dict = {}

    def root(x):
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        if a != b:
            low, high = (a, b) if a < b else (b, a)
            up[high] = low
    return [(x, root(x)) for x in up]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    kind = None

    def done() -> Iterator[pa.RecordBatch]:
        if held and (found := stars(held)):
            u, v = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(u, kind), pa.array(v, kind)], ["u", "v"])

    for batch in batches:
        kind = batch.schema.field(0).type
        held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        if len(held) >= CHUNK:
            yield from done()
            held = []
    yield from done()


def _contracted(edges: DataFrame) -> DataFrame:
    kind = edges.schema["u"].dataType.simpleString()
    return edges.select("u", "v").mapInArrow(_contract, f"u {kind}, v {kind}")


def _joined(edges: DataFrame, salt: int) -> DataFrame:
    """(node, to): every node, and its neighbour of least hash or itself."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min_by("v", F.xxhash64(F.lit(salt), "v")).alias("v"))
    return least.select(F.col("u").alias("node"), F.when(F.xxhash64(F.lit(salt), "v") < F.xxhash64(F.lit(salt), "u"), F.col("v")).otherwise(F.col("u")).alias("to"))


def _moved(edges: DataFrame, joined: DataFrame) -> DataFrame:
    """The edges between what their ends joined."""
    low, high = (joined.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to")) for c in ("u", "v"))
    moved = edges.join(low, "u").join(high, "v")
    return moved.select(F.least("u_to", "v_to").alias("u"), F.greatest("u_to", "v_to").alias("v")).where("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has an edge; root is the least node it reaches.

    Nodes are whole numbers or binary.  Self-links and nulls are ignored; no edges give no rows.
    """
    kept = materialise(edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct())
    rounds: list[DataFrame] = []
    while kept.count() > CHUNK:
        rounds.append(materialise(_joined(kept, len(rounds))))
        kept = materialise(_moved(kept, rounds[-1]))
    star = materialise(_contracted(kept.coalesce(1))).select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = star.unionByName(star.select(F.col("root").alias("node"), "root").distinct())
    if not rounds:
        return found
    for joined in reversed(rounds):  # a round's nodes have the root of what they joined, which is its own if no edge is left there
        root = found.withColumnRenamed("node", "to")
        found = materialise(joined.join(root, "to", "left").select("node", F.coalesce("root", "to").alias("root")))
    least = found.groupBy("root").agg(F.min("node").alias("least"))
    return found.join(least, "root").select("node", F.col("least").alias("root"))
