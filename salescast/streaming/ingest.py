"""Incremental ticket-export ingest: one batch of landed exports after the other.

The reference re-reads its exports in batch; here each batch adds only the
tickets whose barcode the target table does not hold yet.  Within a batch the
keep-first rule (W02) decides.  Nothing is dropped for being late: a batch is
compared with the whole target, by an anti-join on the barcode, so there is no
watermark and no state besides the target itself.  A batch that fails half way
is run again: barcodes that were written already are found in the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.operators.clean import dedup_keep_first
from salescast.session import materialize

EXPORT_SCHEMA = T.StructType([
    T.StructField("barcode", T.StringType()), T.StructField("event_name", T.StringType()),
    T.StructField("created_at", T.TimestampType()), T.StructField("product_value", T.DoubleType()),
    T.StructField("product_is_scanned", T.IntegerType()),
])


def read_export(spark: SparkSession, landing: str, source: str) -> DataFrame:
    """Landed CSV exports with a fixed schema, tagged by source."""
    return (spark.read.schema(EXPORT_SCHEMA).option("header", True).option("mode", "PERMISSIVE")
            .csv(landing).withColumn("data_source", F.lit(source))
            .withColumnRenamed("created_at", "verkoopdatum"))


def new_tickets(batch: DataFrame, target: DataFrame | None) -> DataFrame:
    """Rows of ``batch`` to append: one per barcode that ``target`` lacks (a missing
    barcode counts as one barcode, as in W02)."""
    order = [F.col(c) for c in ("verkoopdatum", "product_value", "event_name", "data_source")]
    rows = dedup_keep_first(batch, "barcode", order)
    if target is None:
        return rows
    known = target.select(F.col("barcode").alias("__known")).distinct()
    return rows.join(known, F.col("barcode").eqNullSafe(F.col("__known")), "left_anti")


def ingest(batch: DataFrame, target: str) -> int:
    """Append the new tickets of ``batch`` to the parquet table ``target``; rows added."""
    spark = batch.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    rows = materialize(new_tickets(batch, spark.read.parquet(target) if there else None), "ingest")
    n = rows.count()
    if n:
        rows.write.mode("append").parquet(target)
    return n
