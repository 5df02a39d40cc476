"""Operator 10: SimHash near-duplicates by anchor-point covering.

A text's fingerprint is the bitwise majority of the XXH64 values of its word shingles.  Two
fingerprints that differ in at most 3 of 64 bits differ in at most 1 bit of one of two 31-bit parts.
In a part, the anchors are the words of the perfect Hamming code of length 31: every fingerprint lies
within covering radius 1 of exactly one anchor.  A fingerprint is replicated to every anchor within
covering radius plus threshold (1 + 1 = 2; at most 16 anchors a part), so two that are close in the part
meet at the home anchor of either, and are compared there on all 64 bits.  2**26 anchors a part keep the
buckets small as data grows; equal fingerprints are one before they are replicated, so that groups of
copies cost one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.buckets import CHUNK, link_buckets
from vellum.llm.common import as_bytes, byte_slices, drop_rows, materialise, row_key, tidy
from vellum.llm.components import components

PART_BITS = 31
#: Texts beyond this are cut at white space, two words carried over; the fingerprint is of the whole.
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BITS = np.array([[(v >> b) & 1 for b in range(8)] for v in range(256)], dtype=np.int64)
_LANE = np.arange(8, dtype=np.int16) * 256


def _pieces(text: bytes) -> Iterator[bytes]:
    start = 0
    while start < len(text):
        stop = start + PIECE
        if stop < len(text):
            gap = _SPACE.search(text, stop)
            stop = gap.start() if gap else len(text)
        yield text[start:stop]
        start = stop


def _counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    lanes = hashes.view(np.uint8).reshape(-1, 8) + _LANE
    return (np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """The SimHash of a whole text (see the operator's contract); zero if it has no word."""
    total, bits, carried, short = 0, np.zeros(64, np.int64), [], True
    for piece in _pieces(text):
        words = carried + piece.lower().split()
        if len(words) >= width:
            short = False
            grams = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), np.uint64, len(words) - width + 1)
            bits += _counts(hashes)
            total += len(hashes)
        carried = words[-(width - 1) :] if width > 1 else []
    if short and carried:
        bits, total = _counts(np.array([xxhash.xxh64_intdigest(b" ".join(carried), seed)], np.uint64)), 1
    return sum(1 << int(b) for b in np.flatnonzero(2 * bits > total))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in byte_slices(batch, 1, 2 << 20):
            marks = np.fromiter(map(fingerprint, as_bytes(part.column(1))), np.uint64, part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(marks.view(np.int64))], ["doc", "fp"])


def _syndrome_table() -> np.ndarray:
    """XOR of the 1-based indices of the bits set, for each value of each of 4 bytes."""
    table = np.zeros((4, 256), np.uint8)
    for byte in range(4):
        for bit in range(8):
            if (index := 8 * byte + bit + 1) <= PART_BITS:
                table[byte] ^= np.where(np.arange(256) >> bit & 1, index, 0).astype(np.uint8)
    return table


def _mask_table() -> np.ndarray:
    """For each syndrome, the changes of at most 2 bits that lead to an anchor."""
    masks = np.zeros((PART_BITS + 1, 16), np.uint64)
    for s in range(1, PART_BITS + 1):
        pairs = [(1 << i - 1) | (1 << (i ^ s) - 1) for i in range(1, PART_BITS + 1) if i < i ^ s]
        masks[s] = [1 << s - 1, *pairs]
    return masks


_SYNDROME, _MASKS = _syndrome_table(), _mask_table()


def anchors(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the fingerprint and anchor, for all anchors within distance 2 of each 31-bit value."""
    s = _SYNDROME[0][part & np.uint64(255)]
    for byte in range(1, 4):
        s = s ^ _SYNDROME[byte][part >> np.uint64(8 * byte) & np.uint64(255)]
    at = part[:, None] ^ _MASKS[s]
    whose = np.broadcast_to(np.arange(len(part))[:, None], at.shape)
    real = (s[:, None] > 0) | (np.arange(16)[None, :] == 0)
    return whose[real], at[real]


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
        for half in range(2):
            whose, at = anchors(fp >> np.uint64(PART_BITS * half) & np.uint64((1 << PART_BITS) - 1))
            keys = at | np.uint64(half << PART_BITS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(fp[whose].view(np.int64))], ["key", "fp"])


def link_fingerprints(fps: DataFrame, distance: int = 3, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) that span the components of distinct fingerprints ``fps`` (fp) within ``distance`` <= 3 bits."""
    if distance > 3:
        raise ValueError("two parts with threshold 1 each cover up to 3 bits")
    return link_buckets(fps.select("fp"), lambda rows: rows.mapInArrow(_replicate, "key long, fp long"), distance, chunk)


def _components(docs: DataFrame, chunk: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, fp) of the rows of ``docs`` (doc_id, text, key), and (fp, component_id)."""
    rows = docs.select(F.struct("doc_id", "key").alias("doc"), "text")
    marked = rows.mapInArrow(tidy(_fingerprints), "doc struct<doc_id: long, key: long>, fp long")
    marked = materialise(marked.select("doc.doc_id", "doc.key", "fp"))
    distinct = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    linked = components(link_fingerprints(distinct, chunk=chunk), "a", "b")
    rooted = distinct.join(linked, distinct.fp == linked.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialise(rooted)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked, rooted.join(least, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """doc_id, fingerprint, component_id for each row of ``docs``.

    Null and empty texts have fingerprint zero and link like any other.  Repeated rows give repeated
    results; rows whose id is null get a fingerprint and the least non-null id they reach (null if
    none).  Other columns are ignored.  An empty table gives no rows.
    """
    marked, named = _components(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.lit(None).cast("long").alias("key")), chunk)
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without the near copies of a document with a smaller id.

    Rows are judged one by one: of rows that repeat an id those go whose own text is such a copy; rows that repeat the kept
    document's id stay with it.  Rows without an id stay, and others as copies of them only if a smaller id is among these.
    Null and empty texts are copies of each other.  Columns stay as they are.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row_key("doc_id", "text").alias("key"))
    marked, named = _components(rows, CHUNK)
    return drop_rows(docs, materialise(marked.join(named, "fp").where("doc_id > component_id").select("key").distinct()))
