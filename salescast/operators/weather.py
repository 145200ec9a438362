"""Weather operators: S09 payload flattening, A16 daily roll-up, J01 join,
P10 mean fill, P12 median fill, X23 derived flags, J09 forecast look-up,
J11 fallback precedence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.functions.dates import season
from salescast.operators.stats import attach_one_row, medians_wide
from salescast.session import broadcast_bounded, materialize

WEATHER_COLS = ["t_max", "t_min", "rain_fall", "max_wind"]

# Live fallback defaults (J11) for t_max, t_min, rain_fall, max_wind.
LIVE_DEFAULTS = {"t_max": 15.0, "t_min": 5.0, "rain_fall": 0.0, "max_wind": 0.0}


def daily_weather(obs: DataFrame, ts: str = "obs_ts", temp: str = "temp", rain: str = "rain_mm",
                  wind: str = "wind_kmh") -> DataFrame:
    """Sub-daily observations -> one row per day (max, min, sum, max)."""
    return (obs.groupBy(F.to_date(F.col(ts)).alias("event_date"))
            .agg(F.max(temp).alias("t_max"), F.min(temp).alias("t_min"),
                 F.sum(rain).alias("rain_fall"), F.max(wind).alias("max_wind")))


def join_weather(tickets: DataFrame, daily: DataFrame, key_expr, max_days: int = 366 * 50) -> DataFrame:
    """Left join tickets to the daily table (one row per day, so no fan-out).

    The daily table has at most one row per calendar day; ``max_days`` is that
    proven bound (50 years by default) for the broadcast check.
    """
    d = broadcast_bounded(daily.withColumnRenamed("event_date", "__wdate"), max_days)
    return tickets.join(d, key_expr == F.col("__wdate"), "left").drop("__wdate")


def fill_global_mean(df: DataFrame, cols=WEATHER_COLS) -> DataFrame:
    """P10: fill nulls with the column mean over all rows (one-row aggregate)."""
    means = df.agg(*[F.avg(c).alias(c + "__mean") for c in cols])
    out = attach_one_row(df, means)
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(c + "__mean")))
    return out.drop(*[c + "__mean" for c in cols])


def fill_event_then_global_median(df: DataFrame, group: str = "event_name", cols=WEATHER_COLS,
                                  group_bound: int | None = None) -> DataFrame:
    """``df`` with the fill learned from it by :func:`event_median_fill`."""
    return event_median_fill(df, group, cols, group_bound)(df)


def event_median_fill(df: DataFrame, group: str = "event_name", cols=WEATHER_COLS,
                      group_bound: int | None = None) -> Callable[[DataFrame], DataFrame]:
    """P12, learned from all rows of ``df`` and returned as a step for any of them: per-group median, then the global median of the group-filled column, then 0.

    One pass over the rows: they are first counted per (group, value tuple)
    -- weather joined from a daily table has few distinct tuples per event --
    and every median (exact, frequency-weighted) is computed on that small
    table, which is written once.  The resulting per-group fill values, written too, join
    back with ``group_bound`` (e.g. the event-dimension row count) as a broadcast, and the
    global ones are constants: the result is a row-wise step, and whoever needs the weather of
    a few rows only fills those.
    """
    counted = materialize(df.groupBy(group, *cols).agg(F.count(F.lit(1)).alias("__n")), "weather_counts")
    per = materialize(medians_wide(counted, cols, group, suffix="__gmed", weight="__n"), "weather_medians")
    filled = counted.join(per, group, "left").select(
        group, "__n", *[F.coalesce(F.col(c), F.col(c + "__gmed")).alias(c) for c in cols])
    glob = medians_wide(filled, cols, None, suffix="__med", weight="__n").first()

    def fill(rows: DataFrame) -> DataFrame:
        out = rows.join(broadcast_bounded(per, group_bound) if group_bound is not None else per, group, "left")
        for c in cols:
            out = out.withColumn(c, F.coalesce(F.col(c), F.col(c + "__gmed"), F.lit(glob[c + "__med"]).cast("double"), F.lit(0.0)))
        return out.drop(*[c + "__gmed" for c in cols])
    return fill


def weather_flags(df: DataFrame, date_col: str = "event_date") -> DataFrame:
    """X23 + X13: temperature contrast, rainy flag (> 1.0 mm), month, season."""
    return (df.withColumn("temp_contrast", F.col("t_max") - F.col("t_min"))
            .withColumn("is_rainy", (F.col("rain_fall") > 1.0).cast("int"))
            .withColumn("event_month", F.month(date_col))
            .withColumn("event_season", season(F.col(date_col))))


def forecast_lookup(targets: DataFrame, forecast: DataFrame, date_col: str = "event_date") -> DataFrame:
    """Weather of the exact forecast day, else the mean over all forecast days."""
    means = forecast.agg(*[F.avg(c).alias(c + "__mean") for c in WEATHER_COLS])
    f = forecast.select(F.col("event_date").alias("__fdate"), *WEATHER_COLS)
    out = targets.join(f, F.col(date_col) == F.col("__fdate"), "left").drop("__fdate")
    out = attach_one_row(out, means)
    for c in WEATHER_COLS:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(c + "__mean")))
    return out.drop(*[c + "__mean" for c in WEATHER_COLS])


def weather_precedence(df: DataFrame, live_prefix: str = "live_", row_prefix: str = "row_") -> DataFrame:
    """Live value, else the row value (0 counts as missing for temperatures), else default."""
    out = df
    for c in WEATHER_COLS:
        row = F.col(row_prefix + c)
        if c in ("t_max", "t_min"):
            row = F.nullif(row, F.lit(0.0))
        out = out.withColumn(c, F.coalesce(F.col(live_prefix + c), row, F.lit(LIVE_DEFAULTS[c])))
    return out
