"""Analytical operators.

All are grouped aggregates over ticket rows (map-side partial aggregation),
or small second-level aggregates over per-event rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.operators.stats import attach_one_row, global_percentiles


def noshow_by_event(t: DataFrame, min_sold: int = 10) -> DataFrame:
    """A14 + F16: sold, showed, no-show count / % and show-up % per event."""
    agg = (t.where(F.col("event_name").isNotNull()).groupBy("event_name")
           .agg(F.count(F.lit(1)).alias("tickets_sold"),
                F.sum(F.col("product_is_scanned")).cast("long").alias("showed")))
    agg = agg.where(F.col("tickets_sold") >= min_sold)
    return (agg.withColumn("no_show", F.col("tickets_sold") - F.col("showed"))
            .withColumn("no_show_pct", F.col("no_show") * 100.0 / F.col("tickets_sold"))
            .withColumn("show_up_pct", F.col("showed") * 100.0 / F.col("tickets_sold")))


def top_k(df: DataFrame, by: str, k: int, tie: str, ascending: bool = False) -> DataFrame:
    """Top-k / bottom-k with a deterministic tie-break."""
    order = F.col(by).asc() if ascending else F.col(by).desc()
    return df.orderBy(order, F.col(tie).asc()).limit(k)


def scan_rate(t: DataFrame, by: str | None = None, month_col: str | None = None) -> DataFrame:
    """Scan rate per source or per month."""
    key = F.date_trunc("month", F.col(month_col)).alias("month") if month_col else F.col(by)
    return (t.groupBy(key).agg(F.count(F.lit(1)).alias("tickets"),
                               F.sum("product_is_scanned").cast("long").alias("scanned"))
            .withColumn("scan_rate", F.col("scanned") / F.col("tickets")))


def distribution_summary(df: DataFrame, col: str) -> DataFrame:
    """Mean, median, sd, min, q25, q75, max (exact, linear interpolation)."""
    from salescast.session import materialize

    rows = materialize(df.select(col), "summary")
    q25, median, q75 = (F.lit(v).cast("double") for v in global_percentiles(rows, [(col, p) for p in (0.25, 0.5, 0.75)]))
    return rows.agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("sd"), F.min(col).alias("min"),
                    F.max(col).alias("max"), F.count(col).alias("n")).select(
        "mean", median.alias("median"), "sd", "min", q25.alias("q25"), q75.alias("q75"), "max", "n")


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram between min and max (last bin closed)."""
    rng = df.agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    x = attach_one_row(df.select(col).where(F.col(col).isNotNull()), rng)
    width = F.col("__hi") - F.col("__lo")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - F.col("__lo")) / width * bins), F.lit(bins - 1))).cast("int")
    return (x.withColumn("bin", b).groupBy("bin", "__lo", "__hi").agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * F.col("bin") / bins).alias("bin_lo"),
                    "n"))


def sell_through(t: DataFrame, horizons: Sequence[int] = (1, 5, 10, 20, 30), min_tickets: int = 50) -> DataFrame:
    """Tickets sold at least T days before the event and % of final, per T (one aggregate)."""
    d = F.col("days_until_event")
    aggs = [F.count(F.lit(1)).alias("final_tickets")]
    for h in horizons:
        aggs.append(F.count_if(d >= h).alias(f"sold_at_{h}"))
    out = t.where(F.col("event_name").isNotNull()).groupBy("event_name").agg(*aggs)
    out = out.where(F.col("final_tickets") >= min_tickets)
    for h in horizons:
        out = out.withColumn(f"pct_at_{h}", F.col(f"sold_at_{h}") * 100.0 / F.col("final_tickets"))
    return out


def cumulative_curve(t: DataFrame) -> DataFrame:
    """Per (event, days until event) daily sales, cumulative sales counted from
    the earliest sale day forward, and % of final.  The window runs over the
    per-(event, day) aggregate, so its partitions hold days, not tickets."""
    daily = (t.where(F.col("event_name").isNotNull())
             .groupBy("event_name", "days_until_event").agg(F.count(F.lit(1)).alias("daily_sales")))
    w = Window.partitionBy("event_name").orderBy(F.col("days_until_event").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    total = Window.partitionBy("event_name")
    return (daily.withColumn("cumulative_sales", F.sum("daily_sales").over(w))
            .withColumn("cumulative_pct", F.col("cumulative_sales") * 100.0 / F.sum("daily_sales").over(total)))


def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nulls per column in one wide aggregate, unpivoted to (column, nulls, pct)."""
    n = F.count(F.lit(1)).alias("__n")
    wide = df.agg(n, *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["__n"], list(cols), "column", "nulls")
    return long.select("column", "nulls", (F.col("nulls") * 100.0 / F.col("__n")).alias("null_pct"))


def constant_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nunique including null (``count_distinct`` + 1 if any null), flag <= 1."""
    # Each column is counted for itself, read alone and combined map-side: no row is copied per column.
    parts = [df.groupBy(c).agg(F.lit(1).alias("one")).agg(F.count("one").alias("n_unique")).select(
        F.lit(c).alias("column"), "n_unique") for c in cols]
    return reduce(DataFrame.unionByName, parts).withColumn("is_constant", (F.col("n_unique") <= 1).cast("int"))


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """Counts per value with share (denominator = all counted rows)."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    counts = src.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("__tot"))
    return attach_one_row(counts, total).withColumn("share", F.col("n") / F.col("__tot")).drop("__tot")


def mode_per_group(df: DataFrame, group: str, col: str) -> DataFrame:
    """Most frequent value per group; ties go to the smallest value."""
    counts = df.where(F.col(col).isNotNull()).groupBy(group, col).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(group).agg(
        F.min_by(F.col(col), F.struct((-F.col("n")).alias("neg"), F.col(col).alias("v"))).alias(f"mode_{col}"),
        F.max("n").alias("mode_count"))


def coverage(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """A31 + U03 + U04: overlap between two key sets.  Each key is reduced to two flags in
    one aggregate (partial on the map side), so either side is read once."""
    def side(df: DataFrame, left: bool) -> DataFrame:
        return df.select(F.col(key), F.lit(left).alias("__l")).where(F.col(key).isNotNull())

    keys = side(a, True).unionByName(side(b, False)).groupBy(key).agg(
        F.max("__l").alias("l"), F.max(~F.col("__l")).alias("r"))
    out = keys.agg(F.count_if("l").alias("n_left"), F.count_if("r").alias("n_right"),
                   F.count_if(F.col("l") & F.col("r")).alias("n_both"),
                   F.count_if(F.col("l") & ~F.col("r")).alias("n_left_only"))
    return out.withColumn("pct_left_covered", F.col("n_both") * 100.0 / F.col("n_left"))


def unscanned_events(t: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Events whose scan rate does not exceed ``threshold`` (default: no scan at all)."""
    return (t.where(F.col("event_name").isNotNull()).groupBy("event_name")
            .agg(F.min("first_event_date_start").alias("first_date"), F.avg("product_is_scanned").alias("scan_rate"))
            .where(F.col("scan_rate") <= threshold))
