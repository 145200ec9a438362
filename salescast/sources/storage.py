"""Stored tables (S08, O01, J02): versions published last, range-ordered months, bucketed joins.

A version is a folder that is written in full before a pointer names it.  Readers follow the
newest finished pointer, so a run that fails half way leaves the table as it was, and two
runs at a time do not mix.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a file at most, and bytes of a bucket or range about.
ROWS_PER_FILE = 2_000_000
PART_BYTES = 128 << 20


def new_version() -> str:
    return uuid.uuid4().hex


def version_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/versions/{version}"


def publish(spark: SparkSession, root: str, version: str) -> None:
    """Make ``version`` the current one: the last step of a run."""
    pointer = f"{root.rstrip('/')}/published/{time.time_ns():020d}-{version}"
    spark.createDataFrame([(version,)], "value string").coalesce(1).write.text(pointer)


def current(spark: SparkSession, root: str) -> str:
    """The version published last; pointers that were not written to their end do not count."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/published")
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        raise LookupError(f"nothing was published under {root}")
    names = sorted(x.getPath().getName() for x in fs.listStatus(path)
                   if fs.exists(jvm.org.apache.hadoop.fs.Path(x.getPath(), "_SUCCESS")))
    if not names:
        raise LookupError(f"nothing was published under {root}")
    return names[-1].split("-", 1)[1]


def read_current(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(version_path(root, current(spark, root)))


def write_ordered(df: DataFrame, root: str, time_col: str, order: Sequence[str], rows_per_file: int = ROWS_PER_FILE,
                  ranges: int | None = None) -> str:
    """``df`` as the new version of the table at ``root``, in ranges of (month, ``order``),
    in folders by month of ``time_col`` (column ``month``; rows without a time in one of their own),
    sorted inside each file, files of ``rows_per_file`` rows at most.

    Ranges are cut by Spark's sample of the order columns: give enough of them to tell rows
    apart, so that many rows of one time do not meet in one task."""
    version, spark = new_version(), df.sparkSession
    rows = df.withColumn("month", F.coalesce(F.date_format(time_col, "yyyy-MM"), F.lit("none")))
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(ranges, "month", *order).sortWithinPartitions("month", *order)
    rows.write.option("maxRecordsPerFile", rows_per_file).partitionBy("month").parquet(version_path(root, version))
    publish(spark, root, version)
    return version


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """``df`` as a table bucketed and sorted by ``key``.  Two tables with equal bucket
    counts join and group by the key without an exchange, as often as they are read."""
    df = df.repartition(buckets, key)
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def bucket_count(n_rows: int, row_bytes: int, least: int = 8) -> int:
    """Buckets of about ``PART_BYTES`` each."""
    return max(least, -(-n_rows * row_bytes // PART_BYTES))
