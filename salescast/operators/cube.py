"""Horizon cube: event features of many horizons from one pass over the ticket rows.

Everything that a horizon T asks of the tickets is a sum, an extreme or a count over the
tickets sold T or more days ahead.  So the tickets are reduced once, whatever the number of
horizons, to four tables:

* ``spans``: per (event, largest horizon that its sales still count for) counts, means, variances
  and extreme sale times;
* ``days``: per (event, lead day) a count, for the lead days that a horizon counts;
* ``cities``: per (event, buyer city, largest horizon) a count;
* ``values``: per event what is read at an extreme sale time (dates, capacity, day-0 weather).

A horizon is then a suffix of the spans of an event: the spans that are at least as large.  An
event has nearly as many lead days as tickets, so only counts are kept by day.  ``features_at``
takes either a list of horizons (one row per event and horizon) or a table that routes each event
to one horizon, one of the cube's.

Tickets with an unknown lead day count at every horizon, as if they were sold exactly then.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.functions.numeric import gender_std
from salescast.operators.features import day0_columns, unknown_last
from salescast.session import broadcast_bounded, materialize


class Cube(NamedTuple):
    spans: DataFrame
    days: DataFrame
    cities: DataFrame
    values: DataFrame
    horizons: tuple[int, ...]
    event_bound: int | None


def _bounded(df: DataFrame, rows: int | None) -> DataFrame:
    return df if rows is None else broadcast_bounded(df, rows)


def span(horizons: Sequence[int], d: Column | None = None) -> Column:
    """The largest horizon that a ticket of lead day ``d`` counts for; null where it counts for none."""
    d = F.col("days_until_event") if d is None else d
    grid = sorted(int(T) for T in horizons)
    upto = F.when(d.isNull(), F.lit(grid[-1]))
    for T in reversed(grid):
        upto = upto.when(d >= T, F.lit(T))
    return upto


def span_moments(named: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """Mergeable statistics per (event, span); all buffers are primitive."""
    d, sale, g = F.col("days_until_event"), F.col("verkoopdatum"), gender_std(F.col("gender"))

    def moments(c: str) -> list[Column]:
        return [F.count(c).alias(f"{c}_n"), F.avg(c).alias(f"{c}_mean"), F.var_pop(c).alias(f"{c}_var")]

    def first_at(c: str) -> Column:
        return F.min(F.when(F.col(c).isNotNull(), unknown_last(named, "verkoopdatum")))

    sold = [F.sum("tickets_sold").alias("sold")] if "tickets_sold" in named.columns else []
    return named.groupBy("event_name", span(horizons).alias("upto")).agg(
        F.count(F.lit(1)).alias("n"), *sold,
        F.min(sale).alias("first_sale"), F.max(sale).alias("last_sale"),
        *moments("age"), *moments("product_value"),
        F.count("total_price").alias("total_n"), F.avg("total_price").alias("total_mean"),
        F.count("product_is_scanned").alias("scan_n"), F.avg(F.col("product_is_scanned").cast("double")).alias("scan_mean"),
        *[F.count_if(g == who).alias(who) for who in ("man", "woman", "nonbinary")],
        first_at("first_event_date_start").alias("at_start"), first_at("last_event_date_end").alias("at_end"),
        first_at("max_capacity").alias("at_capacity"), F.max(F.when(d <= 1, sale)).alias("at_day0"))


def day_counts(named: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """Tickets per (event, lead day), from the smallest horizon on."""
    d = F.col("days_until_event")
    return named.where(d.isNull() | (d >= min(horizons))).groupBy("event_name", d.alias("d")).agg(F.count(F.lit(1)).alias("n"))


def city_counts(named: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """Tickets per (event, city, largest horizon they count for)."""
    return named.select("event_name", "city_standardized", span(horizons).alias("upto")).where("upto IS NOT NULL").groupBy(
        "event_name", "city_standardized", "upto").agg(F.count(F.lit(1)).alias("n"))


def extreme_values(named: DataFrame, spans: DataFrame, event_bound: int | None,
                   fill: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """First known dates and capacity, last day-0 weather: read from the few rows sold at that time
    (first barcode first); a value whose rows have no sale time at all is found too.  Only those
    few rows get the weather ``fill``."""
    times = _bounded(spans.groupBy("event_name").agg(
        F.min("at_start").alias("at_start"), F.min("at_end").alias("at_end"), F.min("at_capacity").alias("at_capacity"),
        F.max("at_day0").alias("at_day0")), event_bound)
    sale, code = F.col("verkoopdatum"), F.coalesce("barcode", F.lit(""))
    when = unknown_last(named, "verkoopdatum")
    hits = {c: F.coalesce((when == F.col(at)) & F.col(c).isNotNull(), F.lit(False)) for c, at in (
        ("first_event_date_start", "at_start"), ("last_event_date_end", "at_end"), ("max_capacity", "at_capacity"))}
    day0 = F.coalesce((sale == F.col("at_day0")) & (F.col("days_until_event") <= 1), F.lit(False))
    some = day0
    for hit in hits.values():
        some = some | hit
    names = {"first_event_date_start": "first_event_date", "last_event_date_end": "__last_event_date",
             "max_capacity": "max_capacity"}
    few = named.join(times, "event_name").where(some)
    return (fill(few) if fill else few).groupBy("event_name").agg(
        *[F.min_by(c, F.when(hit, code)).alias(names[c]) for c, hit in hits.items()],
        F.max_by(F.struct(*[F.col(c) for c in day0_columns(named.columns)]), F.when(day0, code)).alias("__day0"))


def build_cube(tickets: DataFrame, horizons: Sequence[int], event_bound: int | None = None,
               fill: Callable[[DataFrame], DataFrame] | None = None) -> Cube:
    """The four tables for prepared tickets (pass them materialised: they are read four times,
    whatever the number of horizons).  ``event_bound`` is a proven number of events; ``fill`` the
    weather fill, where the tickets have yet to get it."""
    named = tickets.where(F.col("event_name").isNotNull())
    spans = materialize(span_moments(named, horizons), "cube_spans")
    return Cube(spans, day_counts(named, horizons), city_counts(named, horizons),
                extreme_values(named, spans, event_bound, fill), tuple(sorted(horizons)), event_bound)


def _at(df: DataFrame, cube: Cube, routes: DataFrame | None) -> DataFrame:
    """``df`` with column T: every horizon, or the one that its event is routed to."""
    if routes is None:
        return df.withColumn("T", F.explode(F.array(*[F.lit(T) for T in cube.horizons])))
    return df.join(_bounded(routes.select("event_name", "T"), cube.event_bound), "event_name")


def _by_horizon(cube: Cube, name: str) -> Column:
    """The column of the row's horizon T among ``name_T``, one for each horizon of the cube."""
    return F.coalesce(*[F.when(F.col("T") == T, F.col(f"{name}_{T}")) for T in cube.horizons])


def day_figures(cube: Cube, lag: int, routes: DataFrame | None = None) -> DataFrame:
    """Per (event, T): lag sales, first and last day, and the mean daily change of sales.
    The days are first reduced to spans, so that no day is repeated for its horizons.  Tickets with an
    unknown lead day lie on day T."""
    d, n, T = F.col("d"), F.col("n"), F.col("T")
    per_span = cube.days.groupBy("event_name", span(cube.horizons, d).alias("upto")).agg(
        F.count(d).alias("rows"), F.min(d).alias("low_day"), F.max(d).alias("high_day"),
        F.min_by("n", d).alias("low"), F.max_by("n", d).alias("high"), F.sum(F.when(d.isNull(), n)).alias("unknown"),
        *[x for h in cube.horizons for x in (F.sum(F.when((d >= h) & (d < h + lag), n)).alias(f"lag_{h}"),
                                             F.sum(F.when(d == h, n)).alias(f"at_{h}"))])
    rows = _at(per_span, cube, routes).where(F.col("upto") >= T)
    none = F.lit(0)
    out = rows.groupBy("event_name", "T").agg(
        F.sum("rows").alias("rows"), F.min("low_day").alias("low_day"), F.max("high_day").alias("high_day"),
        F.min_by("low", "low_day").alias("low"), F.max_by("high", "high_day").alias("high"),
        F.coalesce(F.sum("unknown"), none).alias("unknown"), F.coalesce(F.sum(_by_horizon(cube, "at")), none).alias("at_t"),
        F.coalesce(F.sum(_by_horizon(cube, "lag")), none).alias("lag"))
    some = F.col("unknown") > 0
    on_t = F.when(some, T.cast("long"))
    first, last = F.least("low_day", on_t), F.greatest("high_day", on_t)  # nulls are passed over
    low = F.when(some, F.col("unknown") + F.col("at_t")).otherwise(F.col("low"))
    high = F.when(last == T, low).otherwise(F.col("high"))
    n_days = F.col("rows") + F.when(some & (F.col("at_t") == 0), 1).otherwise(0)
    return out.select(
        "event_name", "T", (F.col("lag") + (F.col("unknown") if lag > 0 else none)).alias(f"sales_last_{lag}_days"),
        first.alias("__dmin"), last.alias("__dmax"), ((high - low) / F.nullif(n_days, none)).alias("avg_acceleration"))


def features_at(cube: Cube, lag: int, routes: DataFrame | None = None) -> DataFrame:
    """One row per (event, T) with all raw ticket statistics, before fills."""
    T, upto = F.col("T"), F.col("upto") >= F.col("T")
    # Means are taken around the event's own mean, so that variances of equal values are exactly 0.
    centre = cube.spans.groupBy("event_name").agg(*[
        (F.sum(F.col(f"{c}_n") * F.col(f"{c}_mean")) / F.sum(f"{c}_n")).alias(f"{c}_centre") for c in ("age", "product_value")])
    rows = _at(cube.spans.join(_bounded(centre, cube.event_bound), "event_name"), cube, routes)

    def total(c: Column) -> Column:
        return F.sum(F.when(upto, c))

    def share(who: str) -> Column:
        return 100.0 * total(F.col(who)) / total(F.col("n"))

    def mean(n: str, m: str) -> Column:
        return total(F.col(n) * F.col(m)) / F.nullif(total(F.col(n)), F.lit(0))

    def spread(c: str) -> tuple[Column, Column]:
        n, off = F.col(f"{c}_n"), F.col(f"{c}_mean") - F.col(f"{c}_centre")
        count, first = total(n), total(n * off)
        squares = total(n * (F.col(f"{c}_var") + off * off)) - first * first / F.nullif(count, F.lit(0))
        return (F.max(f"{c}_centre") + first / F.nullif(count, F.lit(0)),
                F.when(count > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (count - 1))))

    (age_mean, age_std), (price_mean, price_std) = spread("age"), spread("product_value")
    sold = F.coalesce(F.sum("sold").cast("long"), F.sum("n")) if "sold" in cube.spans.columns else F.sum("n")
    out = rows.groupBy("event_name", "T").agg(
        sold.alias("full_event_tickets"),
        F.coalesce(total(F.col("n")), F.lit(0)).alias("cumulative_sales_at_t"),
        F.min("first_sale").alias("__first_sale"), F.max("last_sale").alias("__last_sale_all"),
        F.max(F.when(upto, F.col("last_sale"))).alias("__last_sale_upto"),
        age_mean.alias("avg_age"), age_std.alias("std_age"),
        share("man").alias("male_percentage"), share("woman").alias("female_percentage"),
        share("nonbinary").alias("nb_percentage"),
        price_mean.alias("avg_product_value"), price_std.alias("std_product_value"),
        mean("total_n", "total_mean").alias("avg_total_price"), mean("scan_n", "scan_mean").alias("scanned_percentage"))
    lag_col = f"sales_last_{lag}_days"
    out = out.join(day_figures(cube, lag, routes), ["event_name", "T"], "left").withColumn(lag_col, F.coalesce(lag_col, F.lit(0)))
    cities = _at(cube.cities, cube, routes).where(F.col("upto") >= T)
    per_city = cities.groupBy("event_name", "T", "city_standardized").agg(F.sum("n").alias("n"))
    per_city = per_city.groupBy("event_name", "T").agg(
        F.count("city_standardized").alias("unique_cities"), (F.max("n") / F.sum("n")).alias("main_city_buyer_ratio"))
    out = out.join(per_city, ["event_name", "T"], "left").withColumn("unique_cities", F.coalesce("unique_cities", F.lit(0)))
    return out.join(_bounded(cube.values, cube.event_bound), "event_name", "left")
