"""Link 64-bit fingerprints that share a bucket and differ in few bits.

Buckets arrive sorted, as a stream.  A bucket emits a spanning forest of its links (small ones: their
few links), never all pairs of a large group; links outside the forest join nodes that it connects.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import materialise, small_side

#: A bucket with more rows is dealt out as pairs of chunks of this size.
CHUNK = 8000
#: One row in so many shows which buckets are that large.
SAMPLE = 32
#: Up to this size all members of a bucket are compared by shifted arrays; larger ones by search.
SMALL = 24


def _close(x: np.ndarray, limit: int) -> np.ndarray:
    return np.bitwise_count(x) <= limit


def forest(values: np.ndarray, limit: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning forest of the links among ``values`` by breadth-first search over the unvisited."""
    found, left = [], np.arange(len(values))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            hit = _close(values[left] ^ values[at], limit)
            if hit.any():
                near = left[hit]
                found.append((np.repeat(values[at], len(near)), values[near]))
                queue.extend(near)
                left = left[~hit]
    return found


def links(keys: np.ndarray, values: np.ndarray, limit: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links among the members of each bucket; ``keys`` are sorted."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    found = []
    some = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
    k, v = keys[some], values[some]
    for d in range(1, min(SMALL, len(k))):
        same = k[d:] == k[:-d]
        if not same.any():
            break
        hit = np.flatnonzero(same & _close(v[d:] ^ v[:-d], limit))
        if len(hit):
            found.append((v[hit], v[hit + d]))
    for i in np.flatnonzero(sizes > SMALL):
        found += forest(values[starts[i] : starts[i] + sizes[i]], limit)
    return found


def _linker(limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        run, here = 0, None  # buckets are numbered as they come

        def flush(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            if parts:
                found = links(np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts]), limit)
                if found:
                    a, b = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
                    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key, c, d = (batch.column(i).to_numpy() for i in range(3))
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (c[1:] != c[:-1]) | (d[1:] != d[:-1])
            same = here == (key[0], c[0], d[0])
            run += 0 if same else 1
            keys = run + np.cumsum(new) - 1
            run, here = int(keys[-1]), (key[-1], c[-1], d[-1])
            values = batch.column(3).to_numpy().astype(np.int64).view(np.uint64)
            cut = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on
            if cut:
                yield from flush([*held, (keys[:cut], values[:cut])])
                held = []
            held.append((keys[cut:], values[cut:]))
        yield from flush(held)

    return search


def in_sample(identity: list[str]) -> Column:
    return F.pmod(F.xxhash64(*identity), F.lit(SAMPLE)) == 0


def hot_keys(sampled: DataFrame, chunk: int) -> DataFrame:
    """(key, chunks) of the keys that the rows of the sample show to have more than about ``chunk`` rows."""
    counts = sampled.groupBy("key").count()
    return counts.where(F.col("count") * SAMPLE > chunk).select("key", F.ceil(F.col("count") * SAMPLE / chunk).cast("int").alias("chunks"))


def deal(rows: DataFrame, identity: list[str], chunk: int = CHUNK, columns: list[str] | None = None, sampled: DataFrame | None = None) -> DataFrame:
    """``rows`` (key, ...) dealt by bucket and sorted: key, c, d and ``columns`` (the identity, if not given).

    A key is one bucket (c = d = 0) unless a sample by the hash of ``identity`` shows it to have more than about ``chunk``
    rows; then it becomes a bucket for each pair of chunks c <= d, and a row goes to all pairs of its own chunk.  The sample
    only says how rows are dealt, not which are compared: two rows of a key meet whatever it shows.  ``sampled`` has the
    rows of the sample, where they are cheaper to make than to pick.
    """
    hot = materialise(hot_keys(rows.where(in_sample(identity)) if sampled is None else sampled, chunk))
    columns = columns or identity
    if hot.isEmpty():
        dealt = rows.select("key", F.lit(0).alias("c"), F.lit(0).alias("d"), *columns)
        return dealt.repartition("key").sortWithinPartitions("key", "c", "d")
    own = F.pmod(F.xxhash64(F.lit(1), *identity), F.coalesce("chunks", F.lit(1))).cast("int")
    marked = rows.join(small_side(hot), "key", "left").withColumn("own", own)
    marked = marked.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)))
    dealt = marked.select("key", F.least("own", "other").alias("c"), F.greatest("own", "other").alias("d"), *columns)
    return dealt.repartition("key", "c", "d").sortWithinPartitions("key", "c", "d")


def link_buckets(fps: DataFrame, keyed: Callable[[DataFrame], DataFrame], limit: int, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) between distinct fingerprints (fp) that share a bucket; ``keyed`` gives each its keys (key long, fp long)."""
    dealt = deal(keyed(fps), ["fp"], chunk, sampled=keyed(fps.where(in_sample(["fp"]))))
    return dealt.mapInArrow(_linker(limit), "a long, b long").distinct()
