"""As-of join (J04) and horizon grid.

Spark has no as-of join.  An equi-join on the key followed by a range filter
emits every (probe, snapshot) pair of a key before filtering; a single running
window per key puts a hot key (say a third of all rows) into one task.  Here
the search runs on *distinct* timestamps, and each key's time line is cut into
buckets of ``bucket_days``:

1. snapshots are reduced to the largest payload per (key, timestamp), probes to
   their distinct (key, timestamp) pairs -- both combinable aggregates, so the
   duplicates of a hot key collapse map-side;
2. within a (key, bucket) a running ``max`` over the union of probe times and
   snapshots (ordered by time) finds the latest snapshot of the probe's own
   bucket; a window partition holds the distinct timestamps of one key in one
   bucket, not its rows;
3. every (key, bucket) is summarised by its latest snapshot, and a running max
   over those summaries -- one row per bucket -- gives the latest snapshot of
   all *earlier* buckets of each probe bucket; the answer is the later of the
   two;
4. the answers, one per (key, timestamp), are joined back to the probe rows
   with an equi-join (a hot (key, timestamp) is split by AQE's skew handling).

Nothing is expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: str, left_ts: str, right_ts: str,
              payload: Sequence[str], inner: bool = True, bucket_days: int = 30) -> DataFrame:
    """Attach to each ``left`` row the ``payload`` of the latest ``right`` row of the
    same ``by`` key with ``right_ts <= left_ts`` (inclusive).

    Ties on ``right_ts`` resolve to the largest payload tuple (deterministic).
    Null keys and null times match nothing.  With ``inner`` the left rows
    without any earlier snapshot are dropped.  Output: left columns + payload
    columns.
    """
    lcols = list(left.columns)
    bucket = lambda c: F.floor(F.unix_date(F.to_date(F.col(c))) / bucket_days)
    run = Window.unboundedPreceding, Window.currentRow

    # 1. latest payload per (key, time); distinct probe times
    snap = F.struct(F.col(right_ts).cast("timestamp_ntz").alias("__t"), *[F.col(c).alias(c) for c in payload])
    snaps = (right.where(F.col(by).isNotNull() & F.col(right_ts).isNotNull())
             .select(F.col(by).alias("__k"), snap.alias("__S"))
             .groupBy("__k", F.col("__S.__t").alias("__t")).agg(F.max("__S").alias("__S"))
             .withColumn("__b", bucket("__t")))
    s_type = snaps.schema["__S"].dataType
    times = (left.where(F.col(by).isNotNull() & F.col(left_ts).isNotNull())
             .select(F.col(by).alias("__k"), F.col(left_ts).cast("timestamp_ntz").alias("__t")).distinct()
             .withColumn("__b", bucket("__t")))

    # 2. latest snapshot within the probe's own bucket (snapshots sort before probes at equal time)
    u = (times.select("__k", "__b", "__t", F.lit(1).alias("__kind"), F.lit(None).cast(s_type).alias("__S"))
         .unionByName(snaps.select("__k", "__b", "__t", F.lit(0).alias("__kind"), "__S")))
    w_in = Window.partitionBy("__k", "__b").orderBy("__t", "__kind").rowsBetween(*run)
    within = (u.withColumn("__W", F.max("__S").over(w_in)).where(F.col("__kind") == 1)
              .select("__k", "__b", "__t", "__W"))

    # 3. latest snapshot of all earlier buckets, per (key, probe bucket)
    summary = snaps.groupBy("__k", "__b").agg(F.max("__S").alias("__S"))
    v = (times.select("__k", "__b").distinct()
         .select("__k", "__b", F.lit(0).alias("__first"), F.lit(None).cast(s_type).alias("__S"))
         .unionByName(summary.select("__k", "__b", F.lit(1).alias("__first"), "__S")))
    w_prev = Window.partitionBy("__k").orderBy("__b", "__first").rowsBetween(*run)
    carry = (v.withColumn("__C", F.max("__S").over(w_prev)).where(F.col("__first") == 0)
             .select("__k", "__b", "__C"))
    answers = (within.join(carry, ["__k", "__b"], "left")
               .select("__k", "__t", F.greatest("__W", "__C").alias("__M")))
    if inner:
        answers = answers.where(F.col("__M").isNotNull())

    # 4. back to the probe rows
    probes = left.select(*[F.col(c) for c in lcols], F.col(by).alias("__k"),
                         F.col(left_ts).cast("timestamp_ntz").alias("__t"))
    out = probes.join(answers, ["__k", "__t"], "inner" if inner else "left")
    return out.select(*[F.col(c) for c in lcols], *[F.col("__M").getField(c).alias(c) for c in payload])


def horizon_grid(spark, horizons: Sequence[int]) -> DataFrame:
    """The (fixed, caller-given) list of horizons as a broadcastable table."""
    return F.broadcast(spark.createDataFrame([(int(h),) for h in horizons], "forecast_days int"))
