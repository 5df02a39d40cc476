"""Operator 6: chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns as context, then the reply, which
alone is under the loss mask.  Turns after the last reply are in one more example without a mask, so
that nothing of a conversation is lost.  A conversation is read as a stream of sorted rows; a task holds
the text of one conversation at a time, as its longest example does.

Template: ``[INST]role\\ntext[/INST]`` for all turns but the assistant's, ``<s>text</s>`` for those.  In a text
that itself holds one of the four control strings, with any number of backslashes after its first character,
one backslash more is put there; reading takes it out again.  In roles, backslashes and newlines are escaped
first.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAINED = "assistant"
#: Rows of an output batch hold about so many characters (at least one row).
BATCH_CHARS = 4 << 20
_PLAIN = re.compile(r"([<\[])(\\*)(?=/?(?:s>|INST\]))")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(?=/?(?:s>|INST\]))")
_TURN = re.compile(r"<s>(.*?)</s>|\[INST\](.*?)\n(.*?)\[/INST\]", re.S)
_ROLE = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def segment(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its text is."""
    if role == TRAINED:
        start, shown, end = "<s>", escape(text), "</s>"
    else:
        start, shown, end = "[INST]" + escape(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n", escape(text), "[/INST]"
    return start + shown + end, len(start), len(start) + len(shown)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted example."""
    turns = []
    for reply, role, text in (m.groups() for m in _TURN.finditer(formatted)):
        if reply is not None:
            turns.append((TRAINED, unescape(reply)))
        else:
            turns.append((_ROLE.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role)), unescape(text)))
    return turns


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "example", "formatted", "loss_start", "loss_end"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    out: list[tuple] = []
    size = 0

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    of, context, length, examples, open_turns = object(), [], 0, 0, False
    for batch in batches:
        for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if conv != of:
                if open_turns:
                    out.append((of, examples, "".join(context), None, None))
                    size += length
                of, context, length, examples, open_turns = conv, [], 0, 0, False
            shown, start, end = segment(role, text)
            context.append(shown)
            open_turns = role != TRAINED
            if not open_turns:
                context = ["".join(context)]
                out.append((of, examples, context[0], length + start, length + end))
                examples += 1
                size += length + len(shown)
            length += len(shown)
            if size >= BATCH_CHARS:
                yield made()
                out, size = [], 0
    if open_turns:
        out.append((of, examples, "".join(context), None, None))
    if out:
        yield made()


def expand(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, formatted, loss_start, loss_end): an example for each reply, in order.

    The mask is ``formatted[loss_start:loss_end]`` in code points; null for the example of turns after the last reply.
    Rows are taken in the order of turn (null first), then role and text.  Null texts and roles count as
    empty; rows whose conv_id is null are one conversation.  An empty table gives no rows; other columns are ignored.
    The examples of a conversation follow each other in one partition.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("turn").cast("long").alias("turn"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")
    return dealt.mapInArrow(_expand, "conv_id long, example long, formatted string, loss_start long, loss_end long")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    of, some, longest, trained, chars, total, done = None, False, "", hashlib.sha256(), 0, 0, []

    def result() -> tuple:
        turns, seen = parse(longest), hashlib.sha256()
        for role, text in turns:
            seen.update(f"{role}\n{text}\n".encode())
        return (of, len(turns), seen.hexdigest(), chars, trained.hexdigest(), total)

    for batch in batches:
        for conv, _, formatted, start, end in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if some and conv != of:
                done.append(result())
                trained, chars, total = hashlib.sha256(), 0, 0
            of, some, longest = conv, True, formatted  # each example starts with the one before
            total += len(formatted)
            if start is not None:
                reply = unescape(formatted[start:end])
                chars += len(reply)
                trained.update(reply.encode())
        if len(done) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names)
            done = []
    if some:
        done.append(result())
    if done:
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names)


def digests(examples: DataFrame) -> DataFrame:
    """What :func:`expand` wrote, read back: a row for each conversation.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars (of all its examples together).
    """
    return examples.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: The digests of the query op6_chat, straight from the turns.
ORACLE = r"""
WITH turn AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '[<\[]\\*/?(?:s>|INST\])')) + CASE WHEN role = 'assistant' THEN 7
    ELSE 14 + length(role) + len(regexp_extract_all(role, '[\\\n]')) + len(regexp_extract_all(role, '[<\[]\\*/?(?:s>|INST\])')) END AS n FROM turn),
upto AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS total,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS back FROM sized)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum(CASE WHEN role = 'assistant' OR back = 1 THEN total ELSE 0 END)::BIGINT AS formatted_chars
FROM upto GROUP BY conv_id
"""
