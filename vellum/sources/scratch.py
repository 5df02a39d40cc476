"""Tables and folders between steps, where all executors can read them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast up to this many counted rows of a few values each.
SMALL = 200_000


def scratch(spark: SparkSession) -> str:
    """A new folder in the one that the session names; a local one only where it names none and the master is local."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at and spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{(at or 'file://' + tempfile.mkdtemp()).rstrip('/')}/files-{uuid.uuid4().hex}"


def written(rows: DataFrame) -> DataFrame:
    """The rows written once and read again, so that what follows neither repeats their plan nor depends on lost executors."""
    at = scratch(rows.sparkSession)
    rows.write.parquet(at)
    return rows.sparkSession.read.schema(rows.schema).parquet(at)


def small(rows: DataFrame, most: int = SMALL) -> DataFrame:
    """Mark a written table for broadcast if its rows are counted and few; else the join shuffles."""
    return F.broadcast(rows) if rows.count() <= most else rows
