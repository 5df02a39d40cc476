"""Incremental processing: file events, log tails, paired events, completion, one-batch triggers."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def changes(before: DataFrame, after: DataFrame, key: str, version: str) -> DataFrame:
    """(key, type): add, change or delete between two listings (key, version)."""
    a, b = before.select(key, F.col(version).alias("_old")), after.select(key, F.col(version).alias("_new"))
    kind = F.when(F.col("_old").isNull(), "add").when(F.col("_new").isNull(), "delete").when(F.col("_old") != F.col("_new"), "change")
    return a.join(b, key, "full").select(key, kind.alias("type")).where("type is not null")


def apply_changes(current: DataFrame, fresh: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """The table after the events: what was deleted or changed goes, fresh rows of additions and changes come."""
    kept = current.join(events.where("type <> 'add'").select(key), key, "left_anti")
    return kept.unionByName(fresh.join(events.where("type <> 'delete'").select(key), key, "left_semi"))


def latest(rows: DataFrame, keys: list[str], order: str, *ties: str) -> DataFrame:
    """Of queued requests the newest counts."""
    window = Window.partitionBy(*keys).orderBy(F.desc(order), *[F.desc(t) for t in ties])
    return rows.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")


def debounced(rows: DataFrame, key: str, at: str, quiet: str = "350 milliseconds") -> DataFrame:
    """Requests that no other of the same key follows within the quiet time."""
    after = F.lead(at).over(Window.partitionBy(key).orderBy(at))
    return rows.withColumn("_next", after).where(F.col("_next").isNull() | (F.col("_next") > F.col(at) + F.expr(f"INTERVAL {quiet}"))).drop("_next")


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """All that is there, once: queued changes coalesce into the batches of one run."""
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def fan_out(*sinks: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Each batch to every emitter; the batch is computed once."""

    def run(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, epoch)
        finally:
            batch.unpersist()

    return run


def whole_lines(data: bytes, start: int) -> tuple[list[str], int]:
    """Complete lines from ``start`` on, and the offset after the last; a shorter file is read anew from 0."""
    if start > len(data):
        start = 0
    end = data.rfind(b"\n") + 1
    if end <= start:
        return [], start
    return data[start:end].decode("utf-8", "replace").splitlines(), end


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class _Tail(DataSourceStreamReader):
    """Offsets are bytes of whole lines, so a half-written last line waits for its end."""

    def __init__(self, path: str):
        self.path = path

    def _size(self) -> int:
        with open(self.path, "rb") as f:
            return f.read().rfind(b"\n") + 1

    def initialOffset(self) -> dict:  # noqa: N802
        return {"at": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"at": self._size()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        begin = 0 if start["at"] > end["at"] else start["at"]  # a truncated file starts anew
        return [_Range(self.path, begin, end["at"])] if end["at"] > begin else []

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(partition.path, "rb") as f:
            f.seek(partition.start)
            at = partition.start
            for raw in f.read(partition.end - partition.start).splitlines(keepends=True):
                yield at, raw.decode("utf-8", "replace").rstrip("\r\n")
                at += len(raw)


class _Once(DataSourceReader):
    def __init__(self, path: str):
        self.tail = _Tail(path)

    def partitions(self) -> list[InputPartition]:
        return self.tail.partitions({"at": 0}, self.tail.latestOffset())

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return self.tail.read(partition)


class LogTail(DataSource):
    """``spark.readStream.format("vellum_tail").option("path", ...)``: (offset, line) as a log grows.

    Spark's file source passes over appended data; this one reads it.  The log must be at the same path for the driver and
    the executors.
    """

    @classmethod
    def name(cls) -> str:
        return "vellum_tail"

    def schema(self) -> str:
        return "offset long, line string"

    def reader(self, schema) -> DataSourceReader:
        return _Once(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _Tail(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LogTail)


def pair_events(rows: DataFrame, key: str, order: str, starts: str, ends: str, kind: str) -> DataFrame:
    """(key, started, ended, outcome): each start with the first end after it, before the next start."""
    window = Window.partitionBy(key).orderBy(order)
    begun = F.last(F.when(F.col(kind) == starts, F.col(order)), True).over(window.rowsBetween(Window.unboundedPreceding, -1))
    ended = rows.withColumn("started", begun).where(F.col(kind).rlike(ends) & F.col("started").isNotNull())
    first = Window.partitionBy(key, "started").orderBy(order)
    return ended.withColumn("_n", F.row_number().over(first)).where("_n = 1").select(key, "started", F.col(order).alias("ended"), F.col(kind).alias("outcome"))


def pair_stream(stream: DataFrame, key: str, starts: str) -> DataFrame:
    """The same on a stream of (key, at, kind): the open start is the state, kept by key.

    A key's rows come in several batches and in no order; they are sorted as a whole, as numbers: the time and a code for the kind.
    """

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        begun = state.get[0] if state.exists else None
        codes: dict[str, int] = {starts: 0}
        times, kinds = [], []
        for pdf in batches:
            pdf = pdf[pdf["kind"].notna() & pdf["at"].notna()]
            times.append(pdf["at"].to_numpy(np.int64))
            kinds.append(np.fromiter((codes.setdefault(k, len(codes)) for k in pdf["kind"]), np.int32, len(pdf)))
        at, kind = np.concatenate(times), np.concatenate(kinds)
        order = np.argsort(at, kind="stable")
        names, out = list(codes), []
        for when, code in zip(at[order].tolist(), kind[order].tolist(), strict=True):
            if code == 0:
                begun = when
            elif begun is not None:
                out.append((group[0], begun, when, names[code]))
                begun = None
        if out:
            yield pd.DataFrame(out, columns=[key, "started", "ended", "outcome"])
        if begun is None:
            if state.exists:
                state.remove()
        else:
            state.update((begun,))

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, started long, ended long, outcome string", "started long", "append", GroupStateTimeout.NoTimeout)


def every_nth(rows: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """Every nth finished item of a group."""
    return rows.withColumn("seq", F.row_number().over(Window.partitionBy(group).orderBy(order)).cast("long")).where(F.col("seq") % n == 0)


def completion_stream(stream: DataFrame, key: str, wanted: int, baseline: set) -> DataFrame:
    """(key, done) once, when a work has all its ``wanted`` leaves; works of the baseline are never told.

    The state of a work is its leaves so far and whether it was told.
    """

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, told = (json.loads(state.get[0]), state.get[1]) if state.exists else ([], group[0] in baseline)
        have = set(seen)
        for pdf in batches:
            have |= {int(x) for x in pdf["leaf"]}
        state.update((json.dumps(sorted(have)), told or len(have) >= wanted))
        if len(have) >= wanted and not told:
            yield pd.DataFrame({key: [group[0]], "done": [len(have)]})

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, done long", "leaves string, told boolean", "append", GroupStateTimeout.NoTimeout)
