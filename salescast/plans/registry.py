"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole test
tables.  Builders that need bounds, medians or shared intermediates run the jobs for
them while they build.  Doubles are rounded to 4 decimals on both sides so that
summation-order noise does not break the value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}

# Fixed parameters of the oracle queries: with T=14/lag=3 most
# test events have no lag sales, so the checks run at T=180, lag=90 and keep
# events with 400 < tickets < 600.
T_H = 180
LAG = 90
LO, HI = 400, 600
ASOF = "2001-11-02"


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def finish(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column and show dates as timestamps (presentation only)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
