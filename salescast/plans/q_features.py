"""Feature-pipeline queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescast.operators import features as feat
from salescast.plans.oracle_base import LEAD_DAYS, TICKETS, TICKETS_BUYER
from salescast.plans.registry import ASOF, HI, LAG, LO, T_H, finish, register
from salescast.sources import testbed

# ----------------------------------------------------------------- flagship
SALES_AT_HORIZON_SQL = f"""
WITH {TICKETS},
lt AS (SELECT event_name, {LEAD_DAYS} AS d FROM tickets),
f AS (SELECT event_name, coalesce(d, {T_H}) AS d FROM lt WHERE NOT coalesce(d < 0, false)),
a AS (
  SELECT event_name, count(*) AS full_event_tickets,
         count(*) FILTER (WHERE d >= {T_H} AND d < {T_H + LAG}) AS sales_last_{LAG}_days,
         count(*) FILTER (WHERE d >= {T_H}) AS cumulative_sales_at_t,
         min(d) FILTER (WHERE d >= {T_H}) AS dmin, max(d) FILTER (WHERE d >= {T_H}) AS dmax
  FROM f WHERE event_name IS NOT NULL GROUP BY event_name
  HAVING count(*) > {LO} AND count(*) < {HI}
),
v AS (SELECT *, CASE WHEN cumulative_sales_at_t > 0
                     THEN cumulative_sales_at_t / (dmax - dmin + 1) ELSE 0.0 END AS vel FROM a)
SELECT event_name, full_event_tickets, sales_last_{LAG}_days,
       round(ln(1 + sales_last_{LAG}_days), 4) AS log_sales_last_{LAG}_days,
       cumulative_sales_at_t, round(ln(1 + cumulative_sales_at_t), 4) AS log_cumulative_sales_at_t,
       round(vel, 4) AS avg_daily_sales_before_t, round(ln(1 + vel), 4) AS log_avg_daily_sales_before_t
FROM v
"""


@register("sales_at_horizon", SALES_AT_HORIZON_SQL)
def q_sales_at_horizon(spark, sf_dir):
    """Flagship: X17 F06 A01-A04 F07 X25."""
    t = testbed.tickets(spark, sf_dir)
    t = feat.add_lead_days(t, T_H)
    return finish(feat.sales_at_horizon(t, T_H, LAG, LO, HI))


# ----------------------------------------------------------------- feature blocks
from salescast.operators import pipeline as pipe  # noqa: E402
from salescast.operators.artists import artist_asof, artist_block  # noqa: E402
from salescast.functions.text import with_normalized  # noqa: E402
from salescast.plans import oracle_features as OF  # noqa: E402
from salescast.plans.oracle_base import EV, typed_select  # noqa: E402
from salescast.session import table_rows  # noqa: E402

TIME_SPEC = [("first_event_date", "t"), ("event_duration_hours", "d"), ("sales_duration_hours_upto_t", "d"),
             ("log_sales_duration_hours_upto_t", "d"), ("day_of_week", "i"), ("event_month", "i"),
             ("event_year", "i"), ("is_weekend", "i"), ("month_sin", "d"), ("month_cos", "d"),
             ("day_of_week_sin", "d"), ("day_of_week_cos", "d")]
SALES_SPEC = [("full_event_tickets", "l"), (f"sales_last_{LAG}_days", "l"), (f"log_sales_last_{LAG}_days", "d"),
              ("cumulative_sales_at_t", "l"), ("log_cumulative_sales_at_t", "d"),
              ("avg_daily_sales_before_t", "d"), ("log_avg_daily_sales_before_t", "d"), ("avg_acceleration", "d")]
DEMO_SPEC = [("avg_age", "d"), ("std_age", "d"), ("male_percentage", "d"), ("female_percentage", "d"),
             ("nb_percentage", "d"), ("unique_cities", "l"), ("log_unique_cities", "d"),
             ("main_city_buyer_ratio", "d")]
TICKET_SPEC = [(c, "d") for c in ["avg_product_value", "std_product_value", "avg_total_price", "scanned_percentage"]]
CAP_SPEC = [("max_capacity", "d"), ("log_max_capacity", "d")]
WEATHER_SPEC = [(c, "d") for c in ["t_max", "t_min", "rain_fall", "max_wind"]]
ARTIST_SPEC = [(c, "l" if c == "num_artists" else "i" if c.startswith("has_") else "d") for c in OF.ARTIST_COLS]
ALL_SPEC = (SALES_SPEC + TIME_SPEC + DEMO_SPEC + TICKET_SPEC + CAP_SPEC + WEATHER_SPEC
            + [("forecast_days", "i")])


def _events(spark, sf_dir):
    t = testbed.tickets_full(spark, sf_dir)
    known = testbed.known_cities(spark, sf_dir)
    bound = table_rows(spark, f"{sf_dir}/supplier.parquet")
    city_bound = table_rows(spark, f"{sf_dir}/nation.parquet")
    rows, fill = pipe.unfilled_tickets(t, known, None, ASOF, name_bound=bound, city_bound=city_bound)
    return pipe.event_table_horizons(rows, (T_H,), LAG, LO, HI, event_bound=bound, fill=fill)


def _block_query(name, spec):
    sql = f"WITH {OF.event_table(T_H, LAG, LO, HI, ASOF)}\n" + typed_select("ev_out", [("event_name", "s")] + spec)

    @register(name, sql)
    def q(spark, sf_dir):
        return finish(_events(spark, sf_dir).select("event_name", *[c for c, _ in spec]))
    q.__name__ = f"q_{name}"
    return q


q_time_block = _block_query("time_block", TIME_SPEC)                # A06 X13-X16 X18 X19
q_sales_block = _block_query("sales_block", SALES_SPEC)             # A01-A05 W01 F08 F09
q_demographics_block = _block_query("demographics_block", DEMO_SPEC)  # A09 A10 X09 J07
q_ticket_block = _block_query("ticket_block", TICKET_SPEC)          # A11 P11
q_capacity_block = _block_query("capacity_block", CAP_SPEC)         # A12 P11
q_weather_day0 = _block_query("weather_day0", WEATHER_SPEC)         # W04 P12 J01


def _artist_inputs(spark, sf_dir):
    lu = with_normalized(with_normalized(testbed.lineup_bridge(spark, sf_dir), "event_name"), "artist")
    snaps = with_normalized(testbed.artist_snapshots(spark, sf_dir), "artist")
    return lu, snaps


ARTIST_ASOF_SQL = ("WITH " + EV + ",\n" + OF.artist_matched(T_H) + "\n"
                   + typed_select("matched", [("event_name", "s"), ("artist", "s"), ("prediction_date", "t"),
                                              ("Date", "t")] + [(m, "d") for m in OF.METRICS]))


@register("artist_asof", ARTIST_ASOF_SQL)
def q_artist_asof(spark, sf_dir):
    """Latest artist snapshot on/before event date - T, per (event, artist)."""
    lu, snaps = _artist_inputs(spark, sf_dir)
    return finish(artist_asof(lu, snaps, T_H))


ARTIST_BLOCK_SQL = ("WITH " + OF.event_table(T_H, LAG, LO, HI, ASOF) + ",\nevk AS (SELECT event_name FROM ev_out),\n"
                    + OF.artist_block(T_H, "evk") + "\n"
                    + typed_select("art", [("event_name", "s")] + ARTIST_SPEC))


@register("artist_block", ARTIST_BLOCK_SQL)
def q_artist_block(spark, sf_dir):
    """A07 A08 W07 (+J04): per-event artist aggregates with the star flag."""
    events = _events(spark, sf_dir).select("event_name")
    lu, snaps = _artist_inputs(spark, sf_dir)
    lu = lu.join(events, "event_name", "left_semi")      # only the kept events' line-ups are searched
    return finish(artist_block(artist_asof(lu, snaps, T_H), events, one_row_each=True))


EVENT_FEATURES_SQL = ("WITH " + OF.event_table(T_H, LAG, LO, HI, ASOF) + ",\n" + OF.artist_block(T_H, "ev_out") + "\n"
                      + typed_select("art", [("event_name", "s")] + ALL_SPEC + ARTIST_SPEC))


@register("event_features", EVENT_FEATURES_SQL)
def q_event_features(spark, sf_dir):
    """The full point-in-time feature table (all blocks, J02 fused)."""
    lu, snaps = _artist_inputs(spark, sf_dir)
    events = _events(spark, sf_dir)
    lu = lu.join(events.select("event_name"), "event_name", "left_semi")
    return finish(artist_block(artist_asof(lu, snaps, T_H), events, one_row_each=True))
