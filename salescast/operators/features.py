"""Point-in-time event features at horizon T.

Design: the reference builds ~8 per-event frames and left-joins them on the
event name.  Here every ticket-level statistic is one *conditional* aggregate
of a single ``groupBy(event_name)`` (one shuffle of partial aggregates):
statistics "over all tickets" use the plain column, statistics "up to T" use
``when(days_until_event >= T, x)``.  Only two extra small aggregates exist:
per (event, day) counts for acceleration and per (event, city) counts for the
main-city share; both reduce to per-event rows before being joined back.
Global fill values (medians, the star threshold) are one-row aggregates
attached by a broadcast of exactly one row -- never an unpartitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.functions.dates import calendar_exprs, floor_days, fractional_hours
from salescast.functions.numeric import gender_std, log1p0
from salescast.operators.stats import global_percentiles

WEATHER_COLS = ["t_max", "t_min", "rain_fall", "max_wind"]
# Weather and type when there is no day-0 row at all.
WEATHER_DEFAULTS = {"t_max": 15.0, "t_min": 5.0, "rain_fall": 0.0, "max_wind": 20.0, "event_type": "other"}


# --------------------------------------------------------------------------- lead days
def add_lead_days(tickets: DataFrame, T: int | None, is_prediction: bool = False,
                  start_col: str = "first_event_date_start", sale_col: str = "verkoopdatum") -> DataFrame:
    """X17 + F06: floored whole days from sale to event start; negative lead
    days are dropped in training (nulls kept, then filled with T unless that is None)."""
    t = tickets.withColumn("days_until_event", floor_days(sale_col, start_col))
    if not is_prediction:
        t = t.where(~F.coalesce(F.col("days_until_event") < 0, F.lit(False)))
    return t if T is None else t.withColumn("days_until_event", F.coalesce(F.col("days_until_event"), F.lit(T).cast("long")))


def past_events(tickets: DataFrame, asof: str, start_col: str = "first_event_date_start") -> DataFrame:
    """keep tickets of events that started on or before ``asof`` (date level);
    rows with a null start are kept (trap T13)."""
    return tickets.where(~F.coalesce(F.to_date(F.col(start_col)) > F.to_date(F.lit(asof)), F.lit(False)))


# --------------------------------------------------------------------------- flagship
def sales_at_horizon(tickets: DataFrame, T: int, lag: int, lo: int = 400, hi: int = 3500) -> DataFrame:
    """A01 target, F07 size filter, A02 lag sales, A03 cumulative, A04 velocity.

    ``tickets`` must carry ``days_until_event`` (see :func:`add_lead_days`).
    One groupBy; map-side partial aggregation absorbs hot events.
    """
    d = F.col("days_until_event")
    upto = d >= T
    lag_col = f"sales_last_{lag}_days"
    agg = (tickets.where(F.col("event_name").isNotNull())
           .groupBy("event_name")
           .agg(F.count(F.lit(1)).alias("full_event_tickets"),
                F.count_if(upto & (d < T + lag)).alias(lag_col),
                F.count_if(upto).alias("cumulative_sales_at_t"),
                F.min(F.when(upto, d)).alias("__dmin"),
                F.max(F.when(upto, d)).alias("__dmax"))
           .where((F.col("full_event_tickets") > lo) & (F.col("full_event_tickets") < hi)))
    velocity = F.when(F.col("cumulative_sales_at_t") > 0,
                      F.col("cumulative_sales_at_t") / (F.col("__dmax") - F.col("__dmin") + 1)
                      ).otherwise(F.lit(0.0))
    return agg.select(
        "event_name", "full_event_tickets",
        F.col(lag_col), log1p0(F.col(lag_col)).alias(f"log_{lag_col}"),
        "cumulative_sales_at_t", log1p0(F.col("cumulative_sales_at_t")).alias("log_cumulative_sales_at_t"),
        velocity.alias("avg_daily_sales_before_t"),
        log1p0(velocity).alias("log_avg_daily_sales_before_t"),
    )


# --------------------------------------------------------------------------- W01
def sales_acceleration(tickets: DataFrame, T: int) -> DataFrame:
    """A05 + W01: mean of the day-over-day change of daily sales (ordered by days
    until event, first change 0), per event, over sales up to T.

    The mean of first differences telescopes to (last - first) / n_days, so no
    window is needed: per-(event, day) counts, then one more small aggregate.
    """
    return daily_sales(tickets, T).groupBy("event_name").agg(
        ((F.max_by("daily_sales", "days_until_event") - F.min_by("daily_sales", "days_until_event"))
         / F.count(F.lit(1))).alias("avg_acceleration"),
        F.count(F.lit(1)).alias("sale_days"))


def daily_sales(tickets: DataFrame, T: int) -> DataFrame:
    """Daily sales per (event, days_until_event) up to T."""
    return (tickets.where(F.col("days_until_event") >= T).where(F.col("event_name").isNotNull())
            .groupBy("event_name", "days_until_event").agg(F.count(F.lit(1)).alias("daily_sales")))


# --------------------------------------------------------------------------- A10
def main_city_share(tickets: DataFrame, T: int, city_col: str = "city_standardized") -> DataFrame:
    """A10: share of the event's most frequent buyer city among tickets up to T."""
    upto = tickets.where(F.col("days_until_event") >= T).where(F.col("event_name").isNotNull())
    per_city = upto.groupBy("event_name", city_col).agg(F.count(F.lit(1)).alias("n"))
    return per_city.groupBy("event_name").agg(
        (F.max("n") / F.sum("n")).alias("main_city_buyer_ratio"))


# --------------------------------------------------------------------------- fused blocks
def _upto(T: int, c: Column) -> Column:
    return F.when(F.col("days_until_event") >= T, c)


def unknown_last(df: DataFrame, c: str) -> Column:
    """A time column with the unknown ones after all others, so that a first value is also
    found where only rows without a time have one (A12)."""
    return F.coalesce(F.col(c), F.lit("9999-12-31 00:00:00").cast("timestamp_ntz").cast(df.schema[c].dataType))


def fused_event_aggregate(tickets: DataFrame, T: int, lag: int, event_bound: int | None = None) -> DataFrame:
    """Every ticket-level statistic of every block per event.

    One hash aggregate over the ticket rows holds all counts, means and extreme sale
    times; its buffers are primitive, so nothing is sorted.  The values *at* an extreme
    sale time (first known dates and capacity, last day-0 weather) come from a second
    step over the few tickets sold at exactly that time.  ``event_bound``, a proven
    number of events, lets those times be broadcast; pass ``tickets`` materialised.
    """
    from salescast.session import broadcast_bounded, materialize

    d = F.col("days_until_event")
    upto = d >= T
    sale = F.col("verkoopdatum")
    g = gender_std(F.col("gender"))

    when_sold = unknown_last(tickets, "verkoopdatum")

    def known(c: str):
        return F.min(F.when(F.col(c).isNotNull(), when_sold))

    # Rows may stand for several tickets; without that column each row is one.
    total = F.count(F.lit(1))
    if "tickets_sold" in tickets.columns:
        total = F.coalesce(F.sum("tickets_sold").cast("long"), total)
    aggs = [
        # A01 / A02 / A03 / A04
        total.alias("full_event_tickets"),
        F.count_if(upto & (d < T + lag)).alias(f"sales_last_{lag}_days"),
        F.count_if(upto).alias("cumulative_sales_at_t"),
        F.min(F.when(upto, d)).alias("__dmin"),
        F.max(F.when(upto, d)).alias("__dmax"),
        # Sale times at which the values below are read
        known("first_event_date_start").alias("__at_start"),
        known("last_event_date_end").alias("__at_end"),
        known("max_capacity").alias("__at_capacity"),
        F.max(F.when(d <= 1, sale)).alias("__at_day0"),
        F.min(sale).alias("__first_sale"),
        F.max(sale).alias("__last_sale_all"),
        F.max(_upto(T, sale)).alias("__last_sale_upto"),
        # A09 demographics (up to T)
        F.avg(_upto(T, F.col("age"))).alias("avg_age"),
        F.stddev_samp(_upto(T, F.col("age"))).alias("std_age"),
        (F.avg(_upto(T, F.when(g == "man", 1.0).otherwise(0.0))) * 100).alias("male_percentage"),
        (F.avg(_upto(T, F.when(g == "woman", 1.0).otherwise(0.0))) * 100).alias("female_percentage"),
        (F.avg(_upto(T, F.when(g == "nonbinary", 1.0).otherwise(0.0))) * 100).alias("nb_percentage"),
        F.count_distinct(_upto(T, F.col("city_standardized"))).alias("unique_cities"),
        # A11 ticket block (up to T)
        F.avg(_upto(T, F.col("product_value"))).alias("avg_product_value"),
        F.stddev_samp(_upto(T, F.col("product_value"))).alias("std_product_value"),
        F.avg(_upto(T, F.col("total_price"))).alias("avg_total_price"),
        F.avg(_upto(T, F.col("product_is_scanned").cast("double"))).alias("scanned_percentage"),
    ]
    named = tickets.where(F.col("event_name").isNotNull())
    base = materialize(named.groupBy("event_name").agg(*aggs), "event_aggregate")
    times = base.select("event_name", "__at_start", "__at_end", "__at_capacity", "__at_day0")
    if event_bound is not None:
        times = broadcast_bounded(times, event_bound)
    at = {c: when_sold == F.col(c) for c in ("__at_start", "__at_end", "__at_capacity")}
    at["__at_day0"] = (sale == F.col("__at_day0")) & (d <= 1)
    some = F.coalesce(at["__at_start"], F.lit(False))
    for hit in list(at.values())[1:]:
        some = some | F.coalesce(hit, F.lit(False))

    def first(c: str, when: str):
        return F.min_by(F.col(c), F.when(at[when] & F.col(c).isNotNull(), F.coalesce("barcode", F.lit(""))))

    values = named.join(times, "event_name").where(some).groupBy("event_name").agg(
        first("first_event_date_start", "__at_start").alias("first_event_date"),
        first("last_event_date_end", "__at_end").alias("__last_event_date"),
        first("max_capacity", "__at_capacity").alias("max_capacity"),
        F.max_by(F.struct(*[F.col(c) for c in day0_columns(tickets.columns)]), F.when(at["__at_day0"], F.coalesce("barcode", F.lit("")))).alias("__day0"))
    return base.drop(*at).join(values, "event_name", "left")


def day0_columns(columns) -> list[str]:
    """What is read from the day-0 row: the weather, and the event type where tickets have it."""
    return WEATHER_COLS + [c for c in ("event_type",) if c in columns]


def add_time_base(agg: DataFrame) -> DataFrame:
    """A06 validity + raw duration (X18) before the median fill."""
    valid = (F.col("first_event_date").isNotNull() & F.col("__last_event_date").isNotNull()
             & F.col("__first_sale").isNotNull() & F.col("__last_sale_all").isNotNull()
             & F.col("__last_sale_upto").isNotNull())
    dur = fractional_hours("first_event_date", "__last_event_date")
    dur = F.when((dur < 0) | (dur > 30 * 24), F.lit(None)).otherwise(dur)
    return (agg.withColumn("__valid", valid)
            .withColumn("event_duration_hours", F.when(F.col("__valid"), dur)))


# Per-event columns whose nulls are filled with the median over events.
MEDIAN_FILLED = ["event_duration_hours", "avg_age", "std_age", "avg_product_value", "std_product_value",
                 "avg_total_price", "scanned_percentage", "max_capacity"]


def attach_event_medians(agg: DataFrame, by: str | None = None, groups: Sequence[int] = ()) -> DataFrame:
    """All P11 fill values, exact medians over the per-event table (the duration median only
    over events with a valid time block), as constants.  With ``by``, a column that takes the
    few values ``groups`` (horizons), each of them has medians of its own.  Pass ``agg``
    materialised: the medians read it a few times."""
    columns = [F.when(F.col("__valid"), F.col(c)) if c == "event_duration_hours" else F.col(c) for c in MEDIAN_FILLED]
    if by is None:
        meds = global_percentiles(agg, [(c, 0.5) for c in columns])
        return agg.withColumns({c + "_med": F.lit(m).cast("double") for c, m in zip(MEDIAN_FILLED, meds)})
    meds = iter(global_percentiles(agg, [(F.when(F.col(by) == g, c), 0.5) for c in columns for g in groups]))
    none = F.lit(None).cast("double")
    return agg.withColumns({c + "_med": F.coalesce(none, *[F.when(F.col(by) == g, F.lit(next(meds)).cast("double"))
                                                           for g in groups]) for c in MEDIAN_FILLED})


def time_block(agg: DataFrame) -> DataFrame:
    """A06 + X13-X16 + X18 + X19.  Events with any missing date get a null
    time block (left-join semantics of the reference)."""
    sales_dur = F.greatest(fractional_hours("__first_sale", "__last_sale_upto"), F.lit(0.0))
    fill = F.coalesce(F.col("event_duration_hours"), F.col("event_duration_hours_med"), F.lit(4.0))
    out = agg.withColumn("event_duration_hours", F.when(F.col("__valid"), fill))
    out = out.withColumn("sales_duration_hours_upto_t",
                         F.when(F.col("__valid"), F.coalesce(sales_dur, F.lit(0.0))))
    out = out.withColumn("log_sales_duration_hours_upto_t",
                         F.when(F.col("__valid"), F.log1p(F.col("sales_duration_hours_upto_t"))))
    out = out.withColumn("first_event_date", F.when(F.col("__valid"), F.col("first_event_date")))
    for name, c in calendar_exprs(F.col("first_event_date")).items():
        out = out.withColumn(name, F.when(F.col("__valid"), c))
    return out


def sales_block(agg: DataFrame) -> DataFrame:
    """A03 + A04 + W01 columns, zero-filled (P09 constant fill; ``avg_acceleration``
    joined in before)."""
    velocity = F.when(F.col("cumulative_sales_at_t") > 0,
                      F.col("cumulative_sales_at_t") / (F.col("__dmax") - F.col("__dmin") + 1))
    return (agg.withColumn("log_cumulative_sales_at_t", log1p0(F.col("cumulative_sales_at_t")))
            .withColumn("avg_daily_sales_before_t", F.coalesce(velocity, F.lit(0.0)))
            .withColumn("log_avg_daily_sales_before_t", log1p0(F.col("avg_daily_sales_before_t")))
            .withColumn("avg_acceleration", F.coalesce(F.col("avg_acceleration"), F.lit(0.0))))


def demographic_block(agg: DataFrame) -> DataFrame:
    """A09 + A10 fills: ages by the median over events, the rest by 0."""
    out = (agg.withColumn("avg_age", F.coalesce("avg_age", "avg_age_med"))
           .withColumn("std_age", F.coalesce("std_age", "std_age_med")))
    for c in ["male_percentage", "female_percentage", "nb_percentage", "main_city_buyer_ratio"]:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0.0)))
    return out.withColumn("log_unique_cities", F.log1p(F.col("unique_cities").cast("double")))


def ticket_block(agg: DataFrame) -> DataFrame:
    """A11 + P11: fill by the median over events, else 0."""
    out = agg
    for c in ["avg_product_value", "std_product_value", "avg_total_price", "scanned_percentage"]:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(c + "_med"), F.lit(0.0)))
    return out


def capacity_block(agg: DataFrame) -> DataFrame:
    """A12 + P11: first non-null capacity, median over events else 1000, log1p."""
    out = agg.withColumn("max_capacity", F.coalesce("max_capacity", "max_capacity_med", F.lit(1000.0)))
    return out.withColumn("log_max_capacity", F.log1p("max_capacity"))


def weather_block(agg: DataFrame) -> DataFrame:
    """Weather (and event type) of the last day-0 sale row; null when the event has
    none.  When no event has such a row, the fixed defaults stand in."""
    names = agg.schema["__day0"].dataType.fieldNames()
    if agg.where(F.col("__day0").isNotNull()).limit(1).count():
        return agg.withColumns({c: F.col("__day0").getField(c) for c in names})
    return agg.withColumns({c: F.lit(WEATHER_DEFAULTS[c]) for c in names})
