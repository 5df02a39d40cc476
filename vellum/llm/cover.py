"""The difference-cover algorithm with every step dealt over all tasks.

``suffix_ranks`` orders all suffixes of a sequence that may be far too large for one task.  Positions that are not
divisible by three are the sample; their triples are sorted by range, equal ones share a name, and the sequence of names (first the
positions with remainder 1, then those with 2) is ordered by recursion.  The other suffixes are merged in by two sorts by range: one of
those with remainders 0 and 1 by their first symbol and the rank behind it, one of those with remainders 0 and 2 by two symbols and the
rank behind these; how many of the other kind stand before a suffix gives its place.  A sequence of at most ``LOCAL`` symbols is
ordered by one task.  Names and ranks come from counts by range, so no step holds more than a range; equal triples are a run in
one range, through which a task streams.

``repeated_bytes`` applies it to texts: adjacent suffixes whose first 50 bytes agree are one string.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.common import as_bytes, byte_slices, materialise, small_side, tidy
from vellum.llm.dc3 import suffix_array

LOCAL = 300_000
#: Symbols of a block, the unit in which a sequence travels.
BLOCK = 1 << 14
SPAN = 50


def _blocks(rows: DataFrame, length: int) -> DataFrame:
    """(block, at, c): runs of up to ``BLOCK`` symbols of (p, c), and the two after them (0 beyond the end)."""
    block = F.floor(F.col("p") / BLOCK)
    spread = rows.select(F.explode(F.array_distinct(F.array(block, F.greatest(F.floor((F.col("p") - 2) / BLOCK), F.lit(0))))).alias("block"), "p", "c")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = [], None

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                p, c = (np.concatenate(x) for x in zip(*held, strict=True))
                full = np.zeros(int(min(length - of * BLOCK, BLOCK)) + 2, np.int64)
                full[p - of * BLOCK] = c
                yield pa.RecordBatch.from_arrays([pa.array([of], pa.int64()), pa.array([full.tobytes()], pa.binary())], ["block", "c"])

        for batch in batches:
            blocks, p, c = (batch.column(i).to_numpy() for i in range(3))
            for k in np.unique(blocks):
                if k != of:
                    yield from done()
                    held, of = [], int(k)
                own = blocks == k
                held.append((p[own], c[own]))
        yield from done()

    dealt = spread.select(F.col("block").cast("long").alias("block"), "p", "c").repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(tidy(pack), "block long, c binary")


def _triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            c = np.frombuffer(blob, np.int64)
            p = np.arange(len(c) - 2) + block * BLOCK
            own = np.flatnonzero(p % 3)
            yield pa.RecordBatch.from_arrays([pa.array(p[own]), *(pa.array(c[own + i]) for i in range(3))], ["p", "a", "b", "c"])


def _ranged(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` sorted by range and written, with ``part`` and the place ``at`` inside the range."""
    return materialise(rows.orderBy(*order).withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}))


def _before(rows: DataFrame, *sums: str) -> DataFrame:
    """(part, sums of all ranges before); a row for each range."""
    counts = rows.groupBy("part").agg(*[F.sum(c).cast("long").alias(c) for c in sums])
    window = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return small_side(materialise(counts.select("part", *[F.coalesce(F.sum(c).over(window), F.lit(0)).alias(f"{c}_before") for c in sums])))


def _names(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Whether a row (p, a, b, c, part) of a range begins a new triple; rows arrive as sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in (1, 2, 3)])
            part = batch.column(4).to_numpy()
            new = np.ones(batch.num_rows, np.int64)
            new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0) | (part[1:] != part[:-1])
            if last is not None and last == (part[0], *keys[:, 0]):
                new[0] = 0
            last = (part[-1], *keys[:, -1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(4), batch.column(5), pa.array(new)], ["p", "part", "at", "new"])

    return run


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    p, c = (np.concatenate(x) for x in zip(*((b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows), strict=True))
    _, names = np.unique(c[np.argsort(p)], return_inverse=True)
    order = suffix_array(names.ravel().astype(np.int64) + 1)
    yield pa.RecordBatch.from_arrays([pa.array(order.astype(np.int64)), pa.array(np.arange(len(order), dtype=np.int64))], ["p", "rank"])


def suffix_ranks(sequence: DataFrame, length: int, local: int = LOCAL) -> DataFrame:
    """(p, rank) of the suffixes of ``sequence`` (p from 0 to ``length`` - 1, c > 0); a shorter suffix comes before one that goes on."""
    if length <= local:
        return materialise(sequence.select("p", "c").coalesce(1).mapInArrow(tidy(_local), "p long, rank long")) if length else sequence.select("p", F.col("c").alias("rank"))
    blocks = materialise(_blocks(sequence, length))
    ones, twos = (length + 1) // 3, length // 3
    # A sampled triple for the position at the end keeps the two halves of the names apart.
    extra = sequence.sparkSession.createDataFrame([(length, 0, 0, 0)] if length % 3 == 1 else [], "p long, a long, b long, c long")
    ones += length % 3 == 1
    sampled = _ranged(blocks.mapInArrow(tidy(_triples), "p long, a long, b long, c long").unionByName(extra), ["a", "b", "c"])
    # A range is read back in its order: one task a file, files by range.
    begun = materialise(sampled.select("p", "a", "b", "c", "part", "at").repartition(max(1, sampled.select("part").distinct().count()), "part").sortWithinPartitions("part", "at").mapInArrow(tidy(_names(length)), "p long, part int, at long, new long"))
    running = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    named = begun.withColumn("here", F.sum("new").over(running)).join(_before(begun, "new"), "part")
    place = F.floor(F.col("p") / 3) + F.when(F.col("p") % 3 == 2, ones).otherwise(0)
    names = materialise(named.select(place.cast("long").alias("p"), (F.col("here") + F.col("new_before")).alias("c")))
    inner = suffix_ranks(names, ones + twos, local)
    back = F.when(F.col("p") < ones, 3 * F.col("p") + 1).otherwise(3 * (F.col("p") - ones) + 2)
    ranks = inner.select(back.alias("p"), (F.col("rank") + 1).alias("rank"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                c = np.frombuffer(blob, np.int64)
                p = np.arange(len(c) - 2) + block * BLOCK
                yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(c[:-2]), pa.array(c[1:-1])], ["p", "a", "b"])

    symbols = blocks.mapInArrow(tidy(keyed), "p long, a long, b long")
    # The rank behind the first symbol (p + 1) or behind two (p + 2), whichever is sampled; both for remainder 0; 0 beyond the end.
    behind = ranks.select((F.col("p") - 1).alias("p"), F.col("rank").alias("r1")).where("p >= 0")
    further = ranks.select((F.col("p") - 2).alias("p"), F.col("rank").alias("r2")).where("p >= 0")
    whole = materialise(symbols.join(behind, "p", "left").join(further, "p", "left").select("p", "a", "b", F.coalesce("r1", F.lit(0)).alias("r1"), F.coalesce("r2", F.lit(0)).alias("r2")))

    def crossed(kind: int, order: list[str]) -> DataFrame:
        """(p, other): how many of the other kind stand before each, among remainders 0 and ``kind``; and ``own``, of remainder 0 before it."""
        both = _ranged(whole.where((F.col("p") % 3 == 0) | (F.col("p") % 3 == kind)).withColumns({"zero": (F.col("p") % 3 == 0).cast("long"), "one": (F.col("p") % 3 != 0).cast("long")}), order)
        window = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
        summed = both.withColumns({"z": F.sum("zero").over(window) - F.col("zero"), "o": F.sum("one").over(window) - F.col("one")}).join(_before(both, "zero", "one"), "part")
        return summed.select("p", (F.col("z") + F.col("zero_before")).alias("zeros"), (F.col("o") + F.col("one_before")).alias("ones"))

    with_one, with_two = materialise(crossed(1, ["a", "r1", "p"])), materialise(crossed(2, ["a", "b", "r2", "p"]))
    zeros = with_one.where("p % 3 = 0").join(with_two.where("p % 3 = 0").select("p", F.col("ones").alias("twos")), "p").select("p", (F.col("zeros") + F.col("ones") + F.col("twos")).alias("rank"))
    offset = int(length % 3 == 1)  # the extra triple ranks before all
    rest = with_one.where("p % 3 = 1").unionByName(with_two.where("p % 3 = 2")).join(ranks, "p").select("p", (F.col("rank") - 1 - offset + F.col("zeros")).alias("rank"))
    return materialise(zeros.unionByName(rest))


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(p, c) of each text's bytes from its place on, each with 2 added, and 1 behind its end."""
    for batch in batches:
        for part in byte_slices(batch, 1, 1 << 20):
            for start, text in zip(part.column(0).to_pylist(), as_bytes(part.column(1)), strict=True):
                c = np.append(np.frombuffer(text, np.uint8).astype(np.int64) + 2, 1)
                for i in range(0, len(c), 1 << 20):
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(start + i, start + i + len(c[i : i + (1 << 20)]))), pa.array(c[i : i + (1 << 20)])], ["p", "c"])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(p, doc_id, s): each position of a text with the 50 bytes from it on."""
    for batch in batches:
        for part in byte_slices(batch, 1, 1 << 18):
            for start, text, doc in zip(part.column(0).to_pylist(), as_bytes(part.column(1)), part.column(2).to_pylist(), strict=True):
                for i in range(0, len(text) - SPAN + 1, 1 << 14):
                    n = min(1 << 14, len(text) - SPAN + 1 - i)
                    view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text, np.uint8, n + SPAN - 1, i), SPAN)
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(start + i, start + i + n)), pa.array([doc] * n, pa.int64()), pa.array([x.tobytes() for x in view], pa.binary())], ["p", "doc_id", "s"])


def repeated_bytes(docs: DataFrame, local: int = LOCAL) -> DataFrame:
    """(doc_id, at) of every position of ``docs`` (doc_id, text; ids once) whose 50 bytes also start in a document with a smaller id.

    Null texts, null ids and texts of fewer than 50 bytes have none; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    sized = _ranged(rows.select("doc_id", (F.octet_length("text") + 1).cast("long").alias("n")), ["doc_id"])
    window = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    starts = materialise(sized.withColumn("here", F.sum("n").over(window) - F.col("n")).join(_before(sized, "n"), "part").select("doc_id", (F.col("here") + F.col("n_before")).alias("start")))
    length = sized.agg(F.sum("n")).first()[0] or 0
    placed = materialise(rows.join(starts, "doc_id").select("start", "text", "doc_id"))
    ranks = suffix_ranks(placed.select("start", "text").mapInArrow(tidy(_spelled), "p long, c long"), length, local)
    strings = placed.mapInArrow(tidy(_strings), "p long, doc_id long, s binary")
    ordered = _ranged(strings.join(ranks, "p").select("p", "doc_id", "s", "rank"), ["rank"])
    # A group of adjacent suffixes with equal prefixes may go on in the next range: the last prefix of each is carried on.
    inside = Window.partitionBy("part").orderBy("at")
    ends = ordered.groupBy("part").agg(F.max_by("s", "at").alias("last"))
    carried = small_side(materialise(ends.select("part", F.lag("last").over(Window.orderBy("part")).alias("carried"))))
    marked = ordered.join(carried, "part").withColumn("new", (~F.coalesce(F.col("s") == F.coalesce(F.lag("s").over(inside), F.col("carried")), F.lit(False))).cast("long"))
    marked = materialise(marked.select("part", "at", "p", "doc_id", "new"))
    numbered = materialise(marked.withColumn("here", F.sum("new").over(inside.rowsBetween(Window.unboundedPreceding, 0))).join(_before(marked, "new"), "part").select("p", "doc_id", (F.col("here") + F.col("new_before")).alias("string")))
    least = numbered.groupBy("string").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    return numbered.join(least, "string").where("doc_id > least").join(starts, "doc_id").select("doc_id", (F.col("p") - F.col("start")).alias("at"))
