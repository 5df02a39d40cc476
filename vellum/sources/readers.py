"""Readers of vaults, JSON, TSV and vector files; every path goes through Spark's own readers."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

NOTE = T.StructType([T.StructField(c, T.StringType()) for c in ("title", "author", "type", "cluster", "source")] + [T.StructField("tags", T.ArrayType(T.StringType()))])


def balanced(rows: DataFrame, bytes_a_core: int = 4 << 20) -> DataFrame:
    """A small table dealt out over all cores: it comes in too few row groups to occupy them.  Others stay as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return rows.repartition(cores) if size <= bytes_a_core * cores else rows


def vault(spark: SparkSession, path: str, ignore: tuple[str, ...] = (), pattern: str = "*.md") -> DataFrame:
    """(path, text): the files of a folder and all below; ``ignore`` are regular expressions on the path inside it.

    The path column is relative, with forward slashes.
    """
    rows = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
    inside = F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "^.*?" + _literal(path.split(":", 1)[-1].rstrip("/")) + "/", "")
    rows = rows.select(inside.alias("path"), F.col("value").alias("text"))
    for expression in ignore:
        rows = rows.where(~F.col("path").rlike(expression))
    return rows


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"


def frontmatter(text: Column) -> Column:
    """title, author, type, cluster, source and tags of the block between the first two ``---`` lines; body below."""
    plain = F.regexp_replace(text, "\r\n", "\n")
    head = F.regexp_extract(plain, r"\A---\n([\s\S]*?)\n---(?:\n|\z)", 1)

    def scalar(name: str) -> Column:
        value = F.regexp_extract(head, rf'(?m)^{name}:[ \t]*"?(.*?)"?[ \t]*$', 1)
        return F.when(value != "", value).alias(name)

    listed = F.regexp_extract(head, r"(?m)^tags:[ \t]*\n((?:[ \t]*-[ \t]+.*(?:\n|\z))*)", 1)
    tags = F.transform(F.regexp_extract_all(listed, F.lit(r"(?m)^[ \t]*-[ \t]+(.*?)[ \t]*$"), F.lit(1)), lambda t: F.regexp_replace(t, '^"|"$', ""))
    body = F.regexp_replace(plain, r"\A---\n[\s\S]*?\n---(?:\n|\z)", "")
    return F.struct(*[scalar(c) for c in ("title", "author", "type", "cluster", "source")], tags.alias("tags"), body.alias("body"))


def json_union(spark: SparkSession, paths: list[str], schema: T.StructType, arrays: bool = True) -> DataFrame:
    """The rows of all shards, JSON arrays or lines; a shard that cannot be read is an empty one."""

    def shard(path: str) -> DataFrame:
        try:
            return spark.read.schema(schema).json(path, multiLine=arrays)
        except AnalysisException:
            return spark.createDataFrame([], schema)

    return functools.reduce(DataFrame.unionByName, map(shard, paths))


def wrapped_map(text: Column, value: str) -> Column:
    """A JSON map, bare or under ``content``; gzipped files are read as text all the same."""
    inner = F.from_json(text, f"content map<string, {value}>")["content"]
    return F.coalesce(inner, F.from_json(text, f"map<string, {value}>"))


def keyed(rows: DataFrame, column: str, value: str) -> DataFrame:
    """(key, value) of a column of JSON maps."""
    return rows.select(F.explode(wrapped_map(F.col(column), value)).alias("key", "value"))


def json_lines(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False) -> DataFrame:
    """JSON lines; bad ones are dropped, or fail the job."""
    return spark.read.schema(schema).json(path, mode="FAILFAST" if strict else "DROPMALFORMED")


def tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).csv(path, sep="\t", header=True, quote="")


def vector_rows(rows: DataFrame, dim: int) -> DataFrame:
    """(file, row, vec): int8 matrices, row by row, of binary files (path, content)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                matrix = np.frombuffer(content, np.int8).reshape(-1, dim)
                for start in range(0, len(matrix), 10_000):
                    part = matrix[start : start + 10_000]
                    yield pd.DataFrame({"file": path, "row": np.arange(start, start + len(part)), "vec": list(part)})

    return rows.select("path", "content").mapInPandas(cut, "file string, row long, vec array<tinyint>")


def leaves(rows: DataFrame, path: str, staging: tuple[str, ...] = ("_raw", "_staging")) -> DataFrame:
    """Files that aren't a folder's own page and lie in no staging folder; conflicted copies go too."""
    kept = rows.where(~F.col(path).rlike("(^|/)(" + "|".join(staging) + ")/") & ~F.lower(path).contains("conflicted copy"))
    folders = kept.select(F.regexp_replace(path, "/[^/]*$", "").alias("_folder")).distinct()
    stem = F.regexp_replace(path, r"\.md$", "")
    own = F.regexp_extract(path, r"([^/]+)/([^/]+)\.md$", 1) == F.regexp_extract(path, r"([^/]+)/([^/]+)\.md$", 2)
    return kept.join(folders, stem == F.col("_folder"), "left_anti").where(~own | (F.regexp_extract(path, r"([^/]+)/", 1) == ""))
