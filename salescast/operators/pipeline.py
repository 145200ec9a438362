"""The complete point-in-time feature table for one horizon T, or for many.

Order of the reference is kept where it changes results: past-event filter ->
weather median fill -> event-name normalisation -> city standardisation ->
lead days (negative dropped) -> target + size filter -> blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.functions.text import standardize_city, with_normalized
from salescast.operators import features as feat
from salescast.operators.artists import artist_asof, artist_block
from salescast.operators.cube import build_cube, features_at
from salescast.operators.weather import event_median_fill
from salescast.session import broadcast_fits, materialize

TIME_COLS = ["first_event_date", "event_duration_hours", "sales_duration_hours_upto_t",
             "log_sales_duration_hours_upto_t", "day_of_week", "event_month", "event_year", "is_weekend",
             "month_sin", "month_cos", "day_of_week_sin", "day_of_week_cos"]
SALES_COLS = ["cumulative_sales_at_t", "log_cumulative_sales_at_t", "avg_daily_sales_before_t",
              "log_avg_daily_sales_before_t", "avg_acceleration"]
DEMO_COLS = ["avg_age", "std_age", "male_percentage", "female_percentage", "nb_percentage",
             "unique_cities", "log_unique_cities", "main_city_buyer_ratio"]
TICKET_COLS = ["avg_product_value", "std_product_value", "avg_total_price", "scanned_percentage"]
CAPACITY_COLS = ["max_capacity", "log_max_capacity"]


def model_features(lag: int) -> list[str]:
    """Numeric columns of the event table that models learn from (everything known at T)."""
    sales = [f"sales_last_{lag}_days", f"log_sales_last_{lag}_days"]
    return sales + TIME_COLS[1:] + SALES_COLS + DEMO_COLS + TICKET_COLS + CAPACITY_COLS + feat.WEATHER_COLS


TICKET_INPUT_COLS = ["event_name", "verkoopdatum", "barcode", "first_event_date_start", "last_event_date_end",
                     "age", "gender", "city", "product_value", "total_price", "product_is_scanned", "max_capacity",
                     "t_max", "t_min", "rain_fall", "max_wind", "tickets_sold", "event_type"]


def input_columns(tickets: DataFrame, known_cities: DataFrame, city_bound: int | None = None) -> DataFrame:
    """X01 + J07: the ticket columns that features need, with normalised names and cities.  Events are told
    apart by the folded name (``__event``) in the median fill, as its groups are in the reference."""
    t = tickets.select(*[c for c in TICKET_INPUT_COLS if c in tickets.columns])
    t = with_normalized(t.withColumn("__event", F.lower(F.trim("event_name"))), "event_name")
    return standardize_city(t, known_cities, bound_rows=city_bound)


def prepare_tickets(tickets: DataFrame, known_cities: DataFrame, T: int | None, asof: str | None,
                    name_bound: int | None = None, city_bound: int | None = None,
                    is_prediction: bool = False, reuse: bool = True, landed: bool = False) -> DataFrame:
    """F03 -> P12 -> X01 -> J07 -> X17/F06 on the ticket rows, all of them filled.  Where ``name_bound``
    allows no broadcast of the fill values, the filled rows are written too."""
    t, fill = unfilled_tickets(tickets, known_cities, T, asof, name_bound, city_bound, is_prediction, reuse, landed)
    light = broadcast_fits(t.select("__event", *feat.WEATHER_COLS), name_bound)
    t = fill(t)
    return materialize(t, "tickets_prepared") if reuse and not light else t


def unfilled_tickets(tickets: DataFrame, known_cities: DataFrame, T: int | None, asof: str | None,
                     name_bound: int | None = None, city_bound: int | None = None, is_prediction: bool = False,
                     reuse: bool = True, landed: bool = False) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The rows of :func:`prepare_tickets` before the median fill (P12), and the fill learned from all
    of them, as a step: only the few rows whose weather is read need it.

    The rows are read several times (counts for the median fill, then the aggregates over the
    result); with ``reuse`` they are written once, with their row-wise columns, so those passes
    hit one narrow copy instead of re-running the upstream joins (``landed``: the input is such
    a copy, a stored result of :func:`input_columns`).  ``T`` None leaves unknown lead days null,
    as the horizon cube wants them.
    """
    t = tickets if landed else input_columns(tickets, known_cities, city_bound)
    if asof is not None and not is_prediction:
        t = feat.past_events(t, asof)
    if reuse and not landed:
        t = materialize(t, "tickets_in")
    fill = event_median_fill(t, "__event", group_bound=name_bound)
    return feat.add_lead_days(t, T, is_prediction=is_prediction), lambda rows: fill(rows).drop("__event")


def event_table(t: DataFrame, T: int, lag: int, lo: int, hi: int, is_prediction: bool = False,
                reuse: bool = True, event_bound: int | None = None) -> DataFrame:
    """Fused per-event aggregate with the size filter (F07) and all ticket blocks.

    The prepared ticket rows feed three aggregates (the fused one, per-day
    and per-city counts); pass them materialised (see :func:`prepare_tickets`).
    With ``reuse`` the small per-event result is materialised too.
    """
    agg = feat.fused_event_aggregate(t, T, lag, event_bound)
    if not is_prediction:
        agg = agg.where((F.col("full_event_tickets") > lo) & (F.col("full_event_tickets") < hi))
    agg = (agg.join(feat.sales_acceleration(t, T).select("event_name", "avg_acceleration"), "event_name", "left")
           .join(feat.main_city_share(t, T), "event_name", "left"))
    agg = feat.attach_event_medians(materialize(feat.add_time_base(agg), "event_aggregate"))
    out = blocks(agg.withColumn("forecast_days", F.lit(T)), lag)
    return materialize(out, "events") if reuse else out


def blocks(agg: DataFrame, lag: int) -> DataFrame:
    """All ticket blocks of raw per-event statistics with their fill values attached."""
    lag_col = f"sales_last_{lag}_days"
    agg = agg.withColumn(f"log_{lag_col}", F.log1p(F.col(lag_col).cast("double")))
    for block in (feat.time_block, feat.sales_block, feat.demographic_block, feat.ticket_block, feat.capacity_block,
                  feat.weather_block):
        agg = block(agg)
    kind = [c for c in ("event_type",) if c in agg.columns]
    # Helper columns (``__*``, the day-0 struct, raw sale bounds) are dropped by
    # selecting the output list; ``DataFrame.drop`` would ignore absent names too.
    return agg.select("event_name", "full_event_tickets", lag_col, f"log_{lag_col}", *TIME_COLS, *SALES_COLS,
                      *DEMO_COLS, *TICKET_COLS, *CAPACITY_COLS, *feat.WEATHER_COLS, *kind, "forecast_days")


def event_table_horizons(t: DataFrame, horizons: Sequence[int], lag: int, lo: int, hi: int,
                         event_bound: int | None = None, fill: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The event table for a list of horizons, one row per (event, forecast_days), from the
    horizon cube: the prepared tickets (pass them materialised) are read four times in all.
    Fill values are medians over the events of the same horizon.  ``fill`` is the weather fill of
    :func:`unfilled_tickets`, where ``t`` has yet to get it."""
    agg = features_at(build_cube(t, horizons, event_bound, fill), lag).withColumnRenamed("T", "forecast_days")
    agg = agg.where((F.col("full_event_tickets") > lo) & (F.col("full_event_tickets") < hi))
    agg = materialize(feat.add_time_base(agg), "event_aggregate")
    return materialize(blocks(feat.attach_event_medians(agg, "forecast_days", sorted(horizons)), lag), "event_horizons")


def event_table_routed(t: DataFrame, routes: DataFrame, horizons: Sequence[int], lag: int,
                       event_bound: int | None = None, fill: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row per event of ``routes`` (event_name, T) at its own horizon T, one of ``horizons``.
    Fill values are medians over all rows of the result; ``fill`` as in :func:`event_table_horizons`."""
    agg = features_at(build_cube(t, horizons, event_bound, fill), lag, routes).withColumnRenamed("T", "forecast_days")
    agg = materialize(feat.add_time_base(agg), "event_aggregate")
    return materialize(blocks(feat.attach_event_medians(agg), lag), "event_routed")


def event_features(tickets: DataFrame, lineup: DataFrame, snapshots: DataFrame, known_cities: DataFrame,
                   T: int, lag: int = 3, lo: int = 400, hi: int = 3500, asof: str | None = None,
                   name_bound: int | None = None, city_bound: int | None = None,
                   star_pct: float = 0.80, is_prediction: bool = False) -> DataFrame:
    """All feature blocks for horizon T (one row per event)."""
    t = prepare_tickets(tickets, known_cities, T, asof, name_bound, city_bound, is_prediction)
    events = event_table(t, T, lag, lo, hi, is_prediction, event_bound=name_bound)
    lu = with_normalized(with_normalized(lineup, "event_name"), "artist")
    snaps = with_normalized(snapshots, "artist")
    lu = lu.join(events.select("event_name"), "event_name", "left_semi")   # kept events only
    return artist_block(artist_asof(lu, snaps, T), events, star_pct, one_row_each=True)
