"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.session import materialize

# Words of every operator: maximal runs without ASCII white space.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

# Bytes of an Arrow batch that goes to a Python task, about; Spark's own limits are 64 MB and 10,000 rows.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

__all__ = ["SPACE", "WORD", "materialize", "read", "total_bytes", "partitions_for", "small_batches"]


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """A whole table by any path that Spark can open, pruned to ``columns``."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return df.select(*columns) if columns else df


def total_bytes(df: DataFrame, column: str) -> int:
    """Sum of UTF-8 bytes of a string column (one number reaches the driver)."""
    return int(df.agg(F.sum(F.octet_length(column)).alias("b")).first()["b"] or 0)


def partitions_for(n_bytes: int, each: int, least: int = 1) -> int:
    """How many parts of about ``each`` bytes hold ``n_bytes``; grows with the data."""
    return max(least, math.ceil(n_bytes / each))


def small_batches(df: DataFrame) -> None:
    """Let texts reach Python in batches of about ``BATCH_BYTES``, by the setting of the session; a smaller one stays.

    Batches of 10,000 whole texts are buffers of 16 to 32 MB on both sides.  What the executor's native
    allocator keeps of those, task after task, and the workers' copies count against its memory.
    """
    conf = df.sparkSession.conf
    now = re.fullmatch(r"([1-9]\d*)b?", conf.get(_BATCH, "64m"))  # as bytes, where a smaller one was set
    if not now or int(now.group(1)) > BATCH_BYTES:
        conf.set(_BATCH, str(BATCH_BYTES))
