"""Session construction and cluster-safe helpers.

Everything in the library is a plain ``DataFrame -> DataFrame`` function; this
module only builds a session for tests/bench and offers the two helpers that
touch the cluster configuration: the checkpoint folder and the size-checked
broadcast.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default ceiling for a broadcast side, in estimated bytes.  A side is only
# broadcast when a row-count bound times a per-row width estimate stays below
# this; otherwise the join is left to the planner (sort-merge + AQE skew split).
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "salescast") -> SparkSession:
    """Local/test session. On a cluster, use the session the platform gives you."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or max(8, cpus * 2)
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SALESCAST_DRIVER_MEM", "16g"))
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared (HDFS/object-store) folder and is
    used as is.  Only when it is unset and everything runs in one JVM (local
    tests) do we create a scratch folder of our own; on a cluster other
    executors could not see it, so there it is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        conf_dir = tempfile.mkdtemp(prefix="salescast-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def materialize(df: DataFrame, label: str = "t") -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Used for intermediates with several consumers: the job runs once, the
    lineage (and the plan every consumer must analyse) is cut, the copy
    survives executor loss, and the planner sees real file sizes (so a small
    result is broadcast by the planner's own size check).
    """
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.append(path)
    return spark.read.parquet(path)


_WRITTEN: list[str] = []


def drop_intermediates(spark: SparkSession) -> int:
    """Delete every intermediate that :func:`materialize` has written in this process.

    Call it when no DataFrame that reads them is needed any more (after a query's
    result is stored).  Works on any file system that Spark can write.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


_TYPE_WIDTH = {"string": 48, "boolean": 1, "byte": 1, "short": 2, "int": 4, "integer": 4,
               "date": 4, "float": 4}


def row_width(df: DataFrame) -> int:
    """Rough bytes/row of a DataFrame from its schema (strings at 48 bytes)."""
    width = 16
    for f in df.schema.fields:
        width += _TYPE_WIDTH.get(f.dataType.typeName(), 8 if f.dataType.typeName() not in
                                 ("array", "map", "struct") else 128)
    return width


def broadcast_bounded(df: DataFrame, max_rows: int,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only if its proven row bound fits the byte budget.

    ``max_rows`` must be an upper bound on ``df``'s row count that the caller
    can prove (e.g. the row count of the dimension table it is keyed by, read
    from parquet footers).  Beyond the budget the side is returned unhinted and
    the planner falls back to a shuffled join with AQE skew handling.
    """
    return F.broadcast(df) if broadcast_fits(df, max_rows, max_bytes) else df


def broadcast_fits(df: DataFrame, max_rows: int | None, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether :func:`broadcast_bounded` broadcasts ``df``; never without a bound."""
    return max_rows is not None and max_rows * row_width(df) <= max_bytes


_ROWS: dict[tuple[str, str], int] = {}


def table_rows(spark: SparkSession, path: str) -> int:
    """Row count of a parquet table (answered from footers, no data scan);
    remembered per session and path."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _ROWS:
        _ROWS[key] = spark.read.parquet(path).count()
    return _ROWS[key]
