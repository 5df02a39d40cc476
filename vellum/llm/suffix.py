"""Operator 3: exact repeats of 50 bytes across documents, by suffix arrays of a difference cover.

The suffixes that must meet are dealt by content.  The least hash of the 27-byte strings inside a 50-byte
string is its anchor; equal strings have equal anchors, so each anchor's strings can be sorted apart from
all others.  Consecutive positions with one anchor make a snippet (about 12 positions); a document is
cut into snippets, each position in exactly one.

1. Anchors are exchanged as packed arrays (about 18 bytes a snippet).  Anchors of a single document are done.
   Equal snippets are one string, of the least document; the others are covered wholly.
2. What is covered and what is wanted is dealt by document, a row each.  Where an anchor has several different
   strings, their bytes are fetched by a join with the texts, and dealt by anchor.
3. Each part sorts all suffixes of its strings by the difference-cover algorithm (sorted sampled triples,
   recursion on names, merge of the rest) and compares prefixes of adjacent suffixes; equal ones are
   removed but in the least document.  Strings of an anchor with more than ``HOT`` of them are dealt out one by one, by
   their 50 bytes themselves, so that no task holds a very common passage's surroundings; the same strings are found.
4. The removed positions of a document meet its text again.

One sort over all suffixes of a corpus, with every step dealt out, is ``cover``; it moves each byte many times, far beyond what this
one does (README has figures), so that here only strings that may be equal are brought together before they are sorted.

Texts longer than ``PIECE`` are cut into pieces that overlap by 49 bytes; results do not depend on it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import as_bytes, byte_slices, light_side, materialise, small_side, tidy
from vellum.llm.dc3 import suffix_array

SPAN = 50
GRAM = 27
PIECE = 1 << 19
#: Text bytes behind one bucket of anchors, and snippet bytes behind one part of the sort.
BUCKET_BYTES = 24 << 20
PART_BYTES = 1 << 20
#: An anchor with more strings is not sorted in one task.
HOT = 20_000
#: Positions of a run of hits in one snippet fit a byte.
RUN = 255
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLES: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte, and powers of an odd base and of its inverse modulo 2**64."""
    if not _TABLES:
        size = 2 * PIECE + 2 * SPAN
        _TABLES["byte"] = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for name, base in (("up", int(_BASE)), ("down", pow(int(_BASE), -1, 1 << 64))):
            powers = np.full(size, np.uint64(base))
            powers[0] = 1
            _TABLES[name] = np.cumprod(powers, dtype=np.uint64)
    return _TABLES["byte"], _TABLES["up"], _TABLES["down"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(29)


def snippets(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of positions, anchor and hash of the bytes of each snippet of the texts that end at ``ends``."""
    none = np.zeros(0, np.int64)
    if len(data) < SPAN:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    byte, up, down = _tables()
    n = len(data)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(byte[data] * up[:n], out=prefix[1:])
    least = _mix((prefix[GRAM:] - prefix[:-GRAM]) * down[: n - GRAM + 1])
    width, left = 1, SPAN - GRAM + 1
    while width < left:
        step = min(width, left - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    whole = np.ones(n - SPAN + 1, bool)
    for end in ends[:-1]:
        whole[max(0, end - SPAN + 1) : end] = False
    at = np.flatnonzero(whole)
    anchor = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(at)))
    if len(size) and size.max() > RUN:
        new |= (np.arange(len(at)) - np.repeat(first, size)) % RUN == 0
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(at)))
    start = at[first]
    content = _mix((prefix[start + size - 1 + SPAN] - prefix[start]) * down[start] + np.uint64(0x51ED270B))
    return start, size, anchor[first], content


def _pieces(ids: list, marks: list, texts: list[bytes]) -> Iterator[tuple[list, bytes]]:
    """Groups of (id, mark, offset, length) with their bytes, of about PIECE bytes."""
    entries, parts, size = [], [], 0
    for doc, mark, text in zip(ids, marks, texts, strict=True):
        if doc is None or len(text) < SPAN:
            continue
        for offset in range(0, len(text) - SPAN + 1, PIECE):
            part = text[offset : offset + PIECE + SPAN - 1]
            if size + len(part) > 2 * PIECE or len(entries) == 60_000:
                yield entries, b"".join(parts)
                entries, parts, size = [], [], 0
            entries.append((doc, mark, offset, len(part)))
            parts.append(part)
            size += len(part)
    if entries:
        yield entries, b"".join(parts)


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join([np.array([len(a) for a in arrays], np.uint32).tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])


def _unpack(blob: bytes, *kinds: type) -> list[np.ndarray]:
    sizes = np.frombuffer(blob, np.uint32, len(kinds))
    at, out = 4 * len(kinds), []
    for size, kind in zip(sizes, kinds, strict=True):
        out.append(np.frombuffer(blob, kind, size, at))
        at += int(size) * np.dtype(kind).itemsize
    return out


def _anchored(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 2, 2 * PIECE):
                for entries, data in _pieces(part.column(0).to_pylist(), part.column(1).to_pylist(), as_bytes(part.column(2))):
                    ends = np.cumsum([e[3] for e in entries])
                    start, size, anchor, content = snippets(np.frombuffer(data, np.uint8), ends)
                    whose = np.searchsorted(ends, start, side="right")
                    begins = ends - np.array([e[3] for e in entries])
                    position = start - begins[whose] + np.array([e[2] for e in entries])[whose]
                    bucket = (anchor % np.uint64(buckets)).astype(np.int64)
                    rest = (anchor // np.uint64(buckets) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                    order = np.argsort(bucket, kind="stable")
                    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
                    ids, marks = np.array([e[0] for e in entries], np.int64), np.array([e[1] for e in entries], np.int64)
                    names, blobs = [], []
                    for rows in np.split(order, cuts) if len(order) else []:
                        used, local = np.unique(whose[rows], return_inverse=True)
                        names.append(int(bucket[rows[0]]))
                        c = content[rows]
                        blobs.append(_pack(ids[used], marks[used], rest[rows], (c & np.uint64(0xFFFFFFFF)).astype(np.uint32), (c >> np.uint64(48)).astype(np.uint16), local.ravel().astype(np.uint16), position[rows].astype(np.uint32), size[rows].astype(np.uint8)))
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "blob"])

    return run


def spans_of(at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes covered by strings that start at ``at`` and the n - 1 positions after."""
    return _joined(at.astype(np.int64), at.astype(np.int64) + n - 1 + SPAN)


def _joined(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of intervals."""
    order = np.argsort(start)
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    return start[first].astype(np.uint32), end[np.append(first[1:] - 1, len(end) - 1)].astype(np.uint32)


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows in sorted ``keys``."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)


def _met(bucket: int, blobs: list[bytes], parts: int) -> Iterator[tuple[int, bytes, bytes]]:
    """For the documents of each part: what is covered wholly and what is wanted, packed."""
    read = [_unpack(b, np.int64, np.int64, np.uint32, np.uint32, np.uint16, np.uint16, np.uint32, np.uint8) for b in blobs]
    base = np.cumsum([0] + [len(p[0]) for p in read])
    ids, marks = (np.concatenate([p[i] for p in read]) for i in (0, 1))
    anchor, low, high, position, size = (np.concatenate([p[i] for p in read]) for i in (2, 3, 4, 6, 7))
    whose = np.concatenate([p[5].astype(np.int64) + b for p, b in zip(read, base, strict=False)])
    order = np.argsort(anchor, kind="stable")
    first = _groups(anchor[order])
    count = np.diff(np.append(first, len(order)))
    docs = ids[whose[order]]
    shared = np.minimum.reduceat(docs, first) != np.maximum.reduceat(docs, first)
    rows = order[np.repeat(shared, count)]
    if not len(rows):
        return
    content = high[rows].astype(np.int64) << 40 | low[rows].astype(np.int64) << 8 | size[rows]
    sort = np.lexsort((content, anchor[rows]))
    rows, content = rows[sort], content[sort]
    same = _groups(anchor[rows], content)
    count = np.diff(np.append(same, len(rows)))
    docs = ids[whose[rows]]
    covered = docs > np.repeat(np.minimum.reduceat(docs, same), count)
    group = _groups(anchor[rows])
    kinds = np.diff(np.searchsorted(same, np.append(group, len(rows))))
    several = np.repeat(kinds > 1, np.diff(np.append(group, len(rows))))
    part = (_mix(ids.view(np.uint64) ^ _mix(marks.view(np.uint64))) % np.uint64(parts)).astype(np.int64)
    rows = rows[covered | several]
    covered = covered[covered | several]
    order = np.argsort(part[whose[rows]], kind="stable")
    rows, covered = rows[order], covered[order]
    cuts = _groups(part[whose[rows]]) if len(rows) else []
    for one, done in zip(np.split(rows, cuts[1:]) if len(rows) else [], np.split(covered, cuts[1:]) if len(rows) else [], strict=True):
        a, w = one[done], one[~done]
        yield int(part[whose[one[0]]]), _pack(ids[whose[a]], marks[whose[a]], position[a], size[a]), _pack(ids[whose[w]], marks[whose[w]], np.uint64(bucket) << np.uint64(32) | anchor[w].astype(np.uint64), position[w], size[w])


def _by_document(ids: np.ndarray, marks: np.ndarray, *rest: np.ndarray) -> dict[tuple[int, int], list[np.ndarray]]:
    """The other arrays, split by (id, mark)."""
    if not len(ids):
        return {}
    order = np.lexsort((marks, ids))
    ids, marks = ids[order], marks[order]
    first = _groups(ids, marks)
    parts = [np.split(r[order], first[1:]) for r in rest]
    return {(int(ids[f]), int(marks[f])): [p[i] for p in parts] for i, f in enumerate(first)}


def _told(blobs: list[tuple[bytes, bytes]]) -> Iterator[tuple[int, int, bytes | None, bytes | None]]:
    """(id, mark, covered runs, wanted snippets) of each document of a part."""
    covered = [_unpack(a, np.int64, np.int64, np.uint32, np.uint8) for a, _ in blobs]
    wanted = [_unpack(b, np.int64, np.int64, np.uint64, np.uint32, np.uint8) for _, b in blobs]
    done = _by_document(*(np.concatenate([c[i] for c in covered]) for i in range(4)))
    asked = _by_document(*(np.concatenate([w[i] for w in wanted]) for i in range(5)))
    for doc in done.keys() | asked.keys():
        spans = _pack(*spans_of(done[doc][0], done[doc][1])) if doc in done else None
        yield *doc, spans, _pack(*asked[doc]) if doc in asked else None


def _grouped(batches: Iterator[pa.RecordBatch], work: Callable, size: int) -> Iterator[tuple]:
    """What ``work(key, rows)`` gives for each run of rows with one key (first column, sorted)."""
    held, of = [], None
    for batch in batches:
        for key, *row in zip(*(batch.column(i).to_pylist() for i in range(size)), strict=True):
            if key != of and held:
                yield from work(of, held)
                held = []
            of = key
            held.append(row)
    if held:
        yield from work(of, held)


def _batched(rows: Iterator[tuple], names: list[str], types: list, most: int = 5000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)


def _meet(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _grouped(batches, lambda bucket, held: _met(bucket, [r[0] for r in held], parts), 2)
        yield from _batched(rows, ["part", "covered", "wanted"], [pa.int32(), pa.binary(), pa.binary()], 16)

    return run


def _tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _grouped(batches, lambda part, held: _told([(a, b) for a, b in held]), 3)
    yield from _batched(rows, ["doc_id", "mark", "spans", "wanted"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()])


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for part in (part for batch in batches for part in byte_slices(batch, 2, 4 << 20)):
            for doc, mark, text, wanted in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), as_bytes(part.column(2)), part.column(3).to_pylist(), strict=True):
                for anchor, at, size in zip(*(x.tolist() for x in _unpack(wanted, np.uint64, np.uint32, np.uint8)), strict=True):
                    yield anchor, doc, mark, at, text[at : at + size - 1 + SPAN]

    yield from _batched(rows(), ["anchor", "doc_id", "mark", "at", "bytes"], [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()])


def repeated(ids: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Which text, and where in it, each 50-byte string starts that also starts in a text of a smaller id."""
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    sizes = np.array([len(t) for t in texts])
    begins = np.cumsum(sizes + 1) - sizes - 1
    spelled = data.astype(np.int64) + 2
    spelled[begins + sizes] = 1
    order = suffix_array(spelled)
    whose = np.repeat(np.arange(len(texts)), sizes + 1)
    order = order[order + SPAN <= (begins + sizes)[whose[order]]]
    if not len(order):
        return order, order
    words = np.zeros(len(data), np.uint64)  # the eight bytes from each position on
    for d in range(8):
        words[: len(data) - d] |= data[d:].astype(np.uint64) << np.uint64(8 * d)
    alike = np.ones(len(order) - 1, bool)
    for d in [*range(0, SPAN - 8, 8), SPAN - 8]:
        rows = np.flatnonzero(alike)
        alike[rows] = words[order[rows] + d] == words[order[rows + 1] + d]
    first = np.concatenate([[0], np.flatnonzero(~alike) + 1])
    docs = ids[whose[order]]
    least = np.repeat(np.minimum.reduceat(docs, first), np.diff(np.append(first, len(order))))
    hit = np.sort(order[docs > least])
    return whose[hit], hit - begins[whose[hit]]


def _sorted_part(held: list[list]) -> Iterator[tuple[int, int, bytes]]:
    docs, marks, ats, texts = (list(c) for c in zip(*held, strict=True))
    whose, where = repeated(np.array(docs, np.int64), texts)
    if not len(whose):
        return
    start = np.array(ats, np.int64)[whose] + where
    found = _by_document(np.array(docs, np.int64)[whose], np.array(marks, np.int64)[whose], start)
    for (doc, mark), (at,) in found.items():
        yield doc, mark, _pack(*spans_of(at, np.ones(len(at), np.int64)))


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _grouped(batches, lambda part, held: _sorted_part(held), 5)
    yield from _batched(rows, ["doc_id", "mark", "spans"], [pa.int64(), pa.int64(), pa.binary()])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every 50-byte string of very common anchors, as it is."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for doc, mark, at, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                for i in range(len(text) - SPAN + 1):
                    yield text[i : i + SPAN], doc, mark, at + i

    yield from _batched(rows(), ["window", "doc_id", "mark", "at"], [pa.binary(), pa.int64(), pa.int64(), pa.int64()])


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [_pack(*spans_of(np.array(at, np.int64), np.ones(len(at), np.int64))) for at in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, pa.binary())], ["doc_id", "mark", "spans"])


def _common(strings: DataFrame) -> DataFrame:
    """(doc_id, mark, spans) for strings of anchors too common for one task: each 50-byte string is a group of its own."""
    windows = strings.select("doc_id", "mark", "at", "bytes").mapInArrow(_windows, "window binary, doc_id long, mark long, at long")
    least = windows.groupBy("window").agg(F.min("doc_id").alias("least"))
    hit = windows.join(least, "window").where("doc_id > least")
    return hit.groupBy("doc_id", "mark").agg(F.collect_list("at").alias("at")).mapInArrow(_starts, "doc_id long, mark long, spans binary")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        merged = []
        for blobs in batch.column(2).to_pylist():
            parts = [_unpack(b, np.uint32, np.uint32) for b in blobs]
            merged.append(_pack(*_joined(*(np.concatenate([p[i] for p in parts]).astype(np.int64) for i in (0, 1)))))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(merged, pa.binary())], ["doc_id", "mark", "spans"])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in byte_slices(batch, 1, 4 << 20):
            out = []
            for text, spans in zip(as_bytes(part.column(1)), part.column(2).to_pylist(), strict=True):
                start, end = _unpack(spans, np.uint32, np.uint32) if spans else ((), ())
                at, kept = 0, []
                for a, b in zip(start, end, strict=True):
                    kept.append(text[at:a])
                    at = b
                kept = b"".join([*kept, text[at:]])
                out.append((len(text), len(text) - len(kept), len(start), kept))
            total, gone, spans, kept = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def removals(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, spans): packed maximal runs of the removed bytes of ``docs`` (doc_id, mark, text)."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-total // BUCKET_BYTES))
    dealt = docs.mapInArrow(tidy(_anchored(buckets)), "bucket int, blob binary").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    met = dealt.mapInArrow(tidy(_meet(buckets)), "part int, covered binary, wanted binary").repartition(buckets, "part").sortWithinPartitions("part")
    told = materialise(met.mapInArrow(tidy(_tell), "doc_id long, mark long, spans binary, wanted binary"))
    wanted = told.where("wanted is not null").select("doc_id", "mark", "wanted")
    fetched = docs.join(wanted.hint("merge"), ["doc_id", "mark"]).select("doc_id", "mark", "text", "wanted").mapInArrow(tidy(_fetch), "anchor long, doc_id long, mark long, at long, bytes binary")
    fetched = materialise(fetched)
    size = fetched.agg(F.sum(F.length("bytes"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    common = small_side(materialise(fetched.groupBy("anchor").count().where(F.col("count") > HOT).select("anchor")))
    several = fetched.join(common, "anchor", "left_anti")
    deal = several.select(F.pmod(F.xxhash64("anchor"), F.lit(parts)).cast("int").alias("part"), "doc_id", "mark", "at", "bytes").repartition("part").sortWithinPartitions("part")
    found = deal.mapInArrow(tidy(_sort), "doc_id long, mark long, spans binary")
    every = told.where("spans is not null").select("doc_id", "mark", "spans").unionByName(found).unionByName(_common(fetched.join(common, "anchor", "left_semi")))
    gathered = every.groupBy("doc_id", "mark").agg(F.collect_list("spans").alias("blobs"))
    return gathered.mapInArrow(_merge, "doc_id long, mark long, spans binary")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of ``docs`` (doc_id, text; others are ignored).

    Null texts count as empty.  Texts under 50 bytes lose nothing.  Rows with a null id lose nothing and cause no
    removal; rows that repeat an id are judged one by one, and do not remove each other's bytes, as neither id
    is smaller.  An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    marked = rows.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    gone = light_side(materialise(removals(marked)), "spans")
    return marked.join(gone, ["doc_id", "mark"], "left").select("doc_id", "text", "spans").mapInArrow(tidy(_finish), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
