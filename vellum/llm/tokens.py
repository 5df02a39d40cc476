"""Operator 7: token counts, by batch encoding in Arrow functions that return lengths only.

Where a tokenizer shows that it drops white space and that no token crosses it (``parts_at_spaces``), a text may be cut at
any ASCII white space: its count is the sum over its pieces.  With any other whole texts are encoded.  Texts are cut into such pieces; a batch of about
``BATCH_BYTES`` of text encodes each distinct unknown piece once and remembers its length.  Memory is bounded
by the batch and by ``CACHE`` remembered pieces, whatever the texts' lengths.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import as_bytes, byte_slices

BATCH_BYTES = 2 << 20
CACHE = 1_000_000
#: Longer pieces are encoded but not remembered.
REMEMBER = 64
LIMIT = 2048
_SPACE = re.compile(rb"[\x09-\x0D\x20]")


#: Texts that show whether a tokenizer's parts between white space can be counted one by one.
_PROBES = ("word", "Word's", "I'll", "12", "3.5", "...", "(a)", "é", "日本", "<|endoftext|>", "##x", "_", "ﬁ", "\u0301", "🙂", "x" * 70)


def parts_at_spaces(encode: Callable[[str], list[int]]) -> bool:
    """Whether any two probes, with any ASCII white space between, before or behind them, give the tokens of one and of the other."""
    alone = {p: encode(p) for p in _PROBES}
    spaces = [chr(c) for c in (*range(9, 14), 32)] + ["  ", " \n", "\r\n"]
    pairs = all(encode(a + s + b) == alone[a] + alone[b] for a in _PROBES for b in _PROBES for s in spaces)
    return pairs and all(encode(s) == [] and encode(s + p) == encode(p + s) == alone[p] for p in _PROBES for s in spaces)


class Counter:
    """Counts of whole texts under a tokenizer file; special strings in texts as the library's default has them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, int] = {}
        self.parted = parts_at_spaces(lambda x: self.tokenizer.encode(x, add_special_tokens=False).ids)

    def encode(self, pieces: list[bytes]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]

    def _learn(self, pieces: list[bytes]) -> dict[bytes, int]:
        """Counts of the distinct pieces among those that aren't known yet."""
        new = list(dict.fromkeys(p for p in pieces if p not in self.known))
        found = dict(zip(new, self.encode(new), strict=True)) if new else {}
        if len(self.known) + len(found) > CACHE:
            self.known.clear()
            found = None
            return self._learn(pieces)
        self.known |= {p: n for p, n in found.items() if len(p) <= REMEMBER}
        return found

    def count(self, texts: list[bytes]) -> list[int]:
        if not self.parted:
            return self.encode(texts)
        out, waiting, size = [0] * len(texts), [], 0
        for i, text in enumerate(texts):
            for piece in _cut(text):
                waiting.append((i, piece))
                size += len(piece)
                if size >= BATCH_BYTES:
                    self._add(waiting, out)
                    waiting, size = [], 0
        self._add(waiting, out)
        return out

    def _add(self, waiting: list[tuple[int, bytes]], out: list[int]) -> None:
        split = [(i, piece.split()) for i, piece in waiting]
        long = self._learn([p for _, pieces in split for p in pieces])
        known = self.known.get
        for i, pieces in split:
            try:
                out[i] += sum(map(self.known.__getitem__, pieces))
            except KeyError:
                out[i] += sum(n if (n := known(p)) is not None else long[p] for p in pieces)


def _cut(text: bytes) -> Iterator[bytes]:
    """Parts of BATCH_BYTES and a little more: each ends at ASCII white space, or where the text ends."""
    start = 0
    while start < len(text):
        gap = _SPACE.search(text, start + BATCH_BYTES)
        stop = gap.start() if gap else len(text)
        yield text[start:stop]
        start = stop


_COUNTERS: dict[str, Counter] = {}


def _counter(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if path not in _COUNTERS:
            _COUNTERS[path] = Counter(path)
        counter = _COUNTERS[path]
        for batch in batches:
            for part in byte_slices(batch, 1, BATCH_BYTES):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counter.count(as_bytes(part.column(1))), pa.int64())], ["doc_id", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs`` (doc_id, text; others are ignored).

    ``tokenizer`` is the path of a tokenizers JSON file on every executor.  Null texts count as empty: 0 bytes
    and 0 tokens.  Repeated rows and null ids give a row each; an empty table none.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sized = rows.select(F.struct("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")).alias("doc_id"), "text")
    found = sized.mapInArrow(_counter(tokenizer), "doc_id struct<doc_id: long, n_bytes: long>, n_tokens long")
    return found.select("doc_id.doc_id", "doc_id.n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
