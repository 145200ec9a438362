"""Line-up, horizon grid, weather and source queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescast.functions.dates import fractional_hours
from salescast.functions.text import split_lineup, standardize_city, clean_city
from salescast.operators import features as feat
from salescast.operators import lineup as LU
from salescast.operators import weather as WX
from salescast.operators.asof import horizon_grid
from salescast.plans.oracle_base import EV, LEAD_DAYS, TICKETS, TICKETS_BUYER, WEATHER_DAILY, typed_select
from salescast.plans.oracle_features import clean_city_sql
from salescast.plans.registry import HI, LO, T_H, finish, register
from salescast.session import table_rows
from salescast.sources import testbed

W_ = "WITH " + TICKETS + ",\n"
WB = "WITH " + TICKETS_BUYER + ",\n"
WX_COLS = ["t_max", "t_min", "rain_fall", "max_wind"]


# ----------------------------------------------------------------- X07 X30 U02
LP_SQL = """WITH p AS (SELECT doc_id, list_filter(list_transform(CASE WHEN contains(text, ';') THEN string_split(text, ';')
   ELSE string_split(text, ',') END, lambda x: trim(x)), lambda x: length(x) > 1) AS parts FROM documents)
""" + typed_select("(SELECT doc_id, len(parts) AS n_parts, len(list_distinct(parts)) AS n_distinct, "
                   "array_to_string(list_sort(list_distinct(parts)), ', ') AS lineup_str FROM p)",
                   [("doc_id", "l"), ("n_parts", "i"), ("n_distinct", "i"), ("lineup_str", "s")])


@register("lineup_parse", LP_SQL)
def q_lineup_parse(spark, sf_dir):
    """Split whole texts into line-up entries (';' else ','), trim, drop 1-char parts."""
    d = testbed.read(spark, sf_dir, "documents").select("doc_id", split_lineup(F.col("text")).alias("parts"))
    return finish(d.select("doc_id", F.size("parts").alias("n_parts"),
                           F.size(F.array_distinct("parts")).alias("n_distinct"),
                           F.array_join(F.array_sort(F.array_distinct("parts")), ", ").alias("lineup_str")))


@register("lineup_artists", LP_SQL.replace(typed_select(
    "(SELECT doc_id, len(parts) AS n_parts, len(list_distinct(parts)) AS n_distinct, "
    "array_to_string(list_sort(list_distinct(parts)), ', ') AS lineup_str FROM p)",
    [("doc_id", "l"), ("n_parts", "i"), ("n_distinct", "i"), ("lineup_str", "s")]),
    typed_select("(SELECT DISTINCT doc_id, unnest(parts) AS artist FROM p)", [("doc_id", "l"), ("artist", "s")])))
def q_lineup_artists(spark, sf_dir):
    """The (document, artist) bridge rows, de-duplicated."""
    d = testbed.read(spark, sf_dir, "documents").select("doc_id", "text")
    return finish(LU.parse_lineup(d, "doc_id", "text"))


# ----------------------------------------------------------------- J05 W08
PARTIES_SQL = """parties AS (SELECT l_orderkey AS party_id, max(l_shipdate) + INTERVAL 1 DAY AS archive_ts FROM lineitem
   GROUP BY 1),
p AS (SELECT party_id, archive_ts, CAST(archive_ts AS DATE) - 1 AS est_date FROM parties),
c AS (SELECT p.party_id, ev.event_name, ev.first_event_date_start AS event_start, ev.last_event_date_end AS event_end,
        abs(datediff('day', p.est_date, CAST(ev.first_event_date_start AS DATE))) AS gap_days
      FROM p JOIN ev ON abs(datediff('day', p.est_date, CAST(ev.first_event_date_start AS DATE))) <= 1),
r AS (SELECT *, row_number() OVER (PARTITION BY party_id ORDER BY gap_days, event_start, event_name) AS rn FROM c),
m AS (SELECT * FROM r WHERE rn = 1)"""


def _matched(spark, sf_dir):
    li = testbed.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    parties = li.groupBy(F.col("l_orderkey").alias("party_id")).agg(
        F.timestamp_add("DAY", F.lit(1), F.max("l_shipdate")).alias("archive_ts"))
    ev = testbed.event_dim(spark, sf_dir).select(
        "event_name", F.col("first_event_date_start").alias("event_start"),
        F.col("last_event_date_end").alias("event_end"))
    return LU.match_to_events(parties, ev, 1, events_bound=table_rows(spark, f"{sf_dir}/supplier.parquet"))


@register("lineup_event_match", "WITH " + EV + ",\n" + PARTIES_SQL + "\n"
          + typed_select("m", [("party_id", "l"), ("event_name", "s"), ("event_start", "t"), ("gap_days", "i")]))
def q_lineup_event_match(spark, sf_dir):
    """Nearest-date match of archived line-ups to events (+-1 day, equi-join on date keys)."""
    return finish(_matched(spark, sf_dir).select("party_id", "event_name", "event_start", "gap_days"))


SLOTS_SQL = "WITH " + EV + ",\n" + PARTIES_SQL + """,
a AS (SELECT m.*, list_filter(list_transform(string_split('dj ' || CAST(party_id % 13 AS VARCHAR) || ', mc '
        || CAST(party_id % 5 AS VARCHAR) || ', x', ','), lambda x: trim(x)), lambda x: length(x) > 1) AS artists FROM m),
s AS (SELECT party_id, artists, least(greatest(((epoch_us(event_end) - epoch_us(event_start)) / 3600000000.0)
        / len(artists), 0.5), 2.0) AS slot_hours,
        (epoch_us(event_end) - epoch_us(event_start)) / 3600000000.0 AS total_h FROM a),
u AS (SELECT party_id, slot_hours, total_h, unnest(generate_series(0, len(artists) - 1)) AS slot,
             unnest(artists) AS artist FROM s)
""" + typed_select("(SELECT party_id, CAST(slot AS INTEGER) AS slot, artist, slot_hours, slot * slot_hours AS start_h, "
                   "least(slot * slot_hours + slot_hours, total_h) AS end_h FROM u)",
                   [("party_id", "l"), ("slot", "i"), ("artist", "s"), ("slot_hours", "d"), ("start_h", "d"),
                    ("end_h", "d")])


@register("lineup_slots", SLOTS_SQL)
def q_lineup_slots(spark, sf_dir):
    """Running time slots per matched line-up (clip(total/n, 0.5h, 2h), clipped at the end)."""
    m = _matched(spark, sf_dir)
    lineup = F.concat(F.lit("dj "), (F.col("party_id") % 13).cast("string"), F.lit(", mc "),
                      (F.col("party_id") % 5).cast("string"), F.lit(", x"))
    m = m.withColumn("artists", split_lineup(lineup))
    s = LU.time_slots(m, "artists")
    return finish(s.select("party_id", "slot", "artist", "slot_hours",
                           fractional_hours("event_start", "slot_start").alias("start_h"),
                           fractional_hours("event_start", "slot_end").alias("end_h")))


# ----------------------------------------------------------------- J10 F08 F09 A02 A03
HORIZONS = (7, 14, 30, 90, 180)
H_LAG = 30
MH_SQL = W_ + f"""lt AS (SELECT event_name, {LEAD_DAYS} AS d FROM tickets),
f AS (SELECT event_name, d FROM lt WHERE NOT coalesce(d < 0, false) AND event_name IS NOT NULL),
h AS (SELECT unnest([{", ".join(map(str, HORIZONS))}]) AS forecast_days),
g AS (SELECT f.event_name, h.forecast_days, count(*) AS full_event_tickets,
        count(*) FILTER (WHERE coalesce(d, forecast_days) >= forecast_days) AS cumulative_sales_at_t,
        count(*) FILTER (WHERE coalesce(d, forecast_days) >= forecast_days
                         AND coalesce(d, forecast_days) < forecast_days + {H_LAG}) AS sales_last_{H_LAG}_days
      FROM f CROSS JOIN h GROUP BY ALL HAVING count(*) > {LO} AND count(*) < {HI})
""" + typed_select("g", [("event_name", "s"), ("forecast_days", "i"), ("full_event_tickets", "l"),
                         ("cumulative_sales_at_t", "l"), (f"sales_last_{H_LAG}_days", "l")])


@register("multi_horizon_features", MH_SQL)
def q_multi_horizon_features(spark, sf_dir):
    """All horizons in one pass -- tickets are first reduced to
    (event, lead day) counts, only that small table meets the horizon grid."""
    t = testbed.tickets(spark, sf_dir).withColumn("d", F.floor(
        F.timestamp_diff("MICROSECOND", F.col("verkoopdatum"), F.col("first_event_date_start")) / 86400000000))
    t = t.where(~F.coalesce(F.col("d") < 0, F.lit(False))).where(F.col("event_name").isNotNull())
    per_day = t.groupBy("event_name", "d").agg(F.count(F.lit(1)).alias("n"))
    g = per_day.crossJoin(horizon_grid(spark, HORIZONS))
    dd = F.coalesce(F.col("d"), F.col("forecast_days").cast("long"))
    T = F.col("forecast_days")
    out = g.groupBy("event_name", "forecast_days").agg(
        F.sum("n").alias("full_event_tickets"),
        F.coalesce(F.sum(F.when(dd >= T, F.col("n"))), F.lit(0)).alias("cumulative_sales_at_t"),
        F.coalesce(F.sum(F.when((dd >= T) & (dd < T + H_LAG), F.col("n"))), F.lit(0)).alias(f"sales_last_{H_LAG}_days"))
    return finish(out.where((F.col("full_event_tickets") > LO) & (F.col("full_event_tickets") < HI)))


ACC_SQL = W_ + f"""lt AS (SELECT event_name, {LEAD_DAYS} AS d FROM tickets),
f AS (SELECT event_name, d FROM lt WHERE NOT coalesce(d < 0, false)),
daily AS (SELECT event_name, d, count(*) AS n FROM f WHERE d >= {T_H} AND event_name IS NOT NULL GROUP BY ALL),
a0 AS (SELECT event_name, coalesce(n - lag(n) OVER (PARTITION BY event_name ORDER BY d), 0) AS a FROM daily)
""" + typed_select("(SELECT event_name, avg(a) AS avg_acceleration, count(*) AS sale_days FROM a0 GROUP BY 1)",
                   [("event_name", "s"), ("avg_acceleration", "d"), ("sale_days", "l")])


@register("sales_acceleration", ACC_SQL)
def q_sales_acceleration(spark, sf_dir):
    """Mean day-over-day change of daily sales up to T (telescoped, no window);
    the oracle computes it with an explicit LAG window as a cross-check."""
    t = feat.add_lead_days(testbed.tickets(spark, sf_dir), T_H)
    return finish(feat.sales_acceleration(t, T_H))


# ----------------------------------------------------------------- A16 J01 P10 P12 X23 J09 J11
@register("daily_weather", "WITH " + WEATHER_DAILY + "\n"
          + typed_select("wdaily", [("event_date", "t")] + [(c, "d") for c in WX_COLS]))
def q_daily_weather(spark, sf_dir):
    """Sub-daily observations -> daily max / min / sum / max."""
    return finish(WX.daily_weather(testbed.weather_raw(spark, sf_dir)))


JOIN_SQL = W_ + WEATHER_DAILY + """,
tw AS (SELECT t.event_name, w.t_max, w.t_min, w.rain_fall, w.max_wind FROM tickets t
       LEFT JOIN wdaily w ON make_date(2024, 1, day(t.first_event_date_start)) = w.event_date),
mu AS (SELECT avg(t_max) AS a1, avg(t_min) AS a2, avg(rain_fall) AS a3, avg(max_wind) AS a4 FROM tw),
f AS (SELECT event_name, t_max IS NOT NULL AS had_weather, coalesce(t_max, a1) AS t_max, coalesce(t_min, a2) AS t_min,
             coalesce(rain_fall, a3) AS rain_fall, coalesce(max_wind, a4) AS max_wind FROM tw CROSS JOIN mu)
""" + typed_select("(SELECT event_name, CAST(max(CAST(had_weather AS INTEGER)) AS INTEGER) AS had_weather, "
                   "count(*) AS tickets, max(t_max) AS t_max, max(t_min) AS t_min, max(rain_fall) AS rain_fall, "
                   "max(max_wind) AS max_wind FROM f GROUP BY 1)",
                   [("event_name", "s"), ("had_weather", "i"), ("tickets", "l")] + [(c, "d") for c in WX_COLS])


@register("weather_join_impute", JOIN_SQL)
def q_weather_join_impute(spark, sf_dir):
    """Join the daily weather on the event day (no fan-out), fill with the global mean."""
    t = testbed.tickets(spark, sf_dir).select("event_name", "first_event_date_start")
    daily = WX.daily_weather(testbed.weather_raw(spark, sf_dir))
    j = WX.join_weather(t, daily, testbed.weather_key(F.col("first_event_date_start")))
    j = j.withColumn("had_weather", F.col("t_max").isNotNull().cast("int"))
    f = WX.fill_global_mean(j)
    return finish(f.groupBy("event_name").agg(F.max("had_weather").alias("had_weather"),
                                              F.count(F.lit(1)).alias("tickets"),
                                              *[F.max(c).alias(c) for c in WX_COLS]))


MED_SQL = W_ + WEATHER_DAILY + """,
tw AS (SELECT t.event_name, t.event_date, w.t_max, w.t_min, w.rain_fall, w.max_wind FROM tickets t
       LEFT JOIN wdaily w ON make_date(2024, 1, day(t.first_event_date_start)) = w.event_date),
em AS (SELECT event_name, quantile_cont(t_max, 0.5) e1, quantile_cont(t_min, 0.5) e2, quantile_cont(rain_fall, 0.5) e3,
              quantile_cont(max_wind, 0.5) e4 FROM tw GROUP BY 1),
p1 AS (SELECT tw.event_name, tw.event_date, coalesce(t_max, e1) AS t_max, coalesce(t_min, e2) AS t_min,
              coalesce(rain_fall, e3) AS rain_fall, coalesce(max_wind, e4) AS max_wind
       FROM tw LEFT JOIN em ON tw.event_name = em.event_name),
gm AS (SELECT quantile_cont(t_max, 0.5) g1, quantile_cont(t_min, 0.5) g2, quantile_cont(rain_fall, 0.5) g3,
              quantile_cont(max_wind, 0.5) g4 FROM p1),
p2 AS (SELECT event_name, event_date, coalesce(t_max, g1, 0.0) AS t_max, coalesce(t_min, g2, 0.0) AS t_min,
              coalesce(rain_fall, g3, 0.0) AS rain_fall, coalesce(max_wind, g4, 0.0) AS max_wind FROM p1 CROSS JOIN gm)
""" + typed_select("(SELECT DISTINCT event_name, t_max, t_min, rain_fall, max_wind, t_max - t_min AS temp_contrast, "
                   "CASE WHEN rain_fall > 1.0 THEN 1 ELSE 0 END AS is_rainy, month(event_date) AS event_month, "
                   "CAST(floor((month(event_date) % 12) / 3) AS INTEGER) + 1 AS event_season FROM p2)",
                   [("event_name", "s")] + [(c, "d") for c in WX_COLS + ["temp_contrast"]]
                   + [("is_rainy", "i"), ("event_month", "i"), ("event_season", "i")])


@register("weather_median_impute", MED_SQL)
def q_weather_median_impute(spark, sf_dir):
    """Per-event then global median fill, contrast, rainy flag, month, season."""
    t = testbed.tickets(spark, sf_dir).select("event_name", "event_date", "first_event_date_start")
    daily = WX.daily_weather(testbed.weather_raw(spark, sf_dir))
    j = WX.join_weather(t, daily, testbed.weather_key(F.col("first_event_date_start")))
    f = WX.fill_event_then_global_median(j, "event_name", group_bound=table_rows(spark, f"{sf_dir}/supplier.parquet"))
    f = WX.weather_flags(f, "event_date")
    return finish(f.select("event_name", *WX_COLS, "temp_contrast", "is_rainy", "event_month", "event_season")
                  .distinct())


FC_SQL = "WITH " + EV + ",\n" + WEATHER_DAILY + """,
fc AS (SELECT event_date AS fdate, t_max, t_min, rain_fall, max_wind FROM wdaily),
mu AS (SELECT avg(t_max) a1, avg(t_min) a2, avg(rain_fall) a3, avg(max_wind) a4 FROM fc),
tg AS (SELECT event_name, make_date(2024, 1, day(first_event_date_start)) AS target_date FROM ev)
""" + typed_select("(SELECT tg.event_name, tg.target_date, fc.fdate IS NOT NULL AS exact, coalesce(fc.t_max, a1) AS t_max, "
                   "coalesce(fc.t_min, a2) AS t_min, coalesce(fc.rain_fall, a3) AS rain_fall, "
                   "coalesce(fc.max_wind, a4) AS max_wind FROM tg LEFT JOIN fc ON tg.target_date = fc.fdate "
                   "CROSS JOIN mu)",
                   [("event_name", "s"), ("target_date", "t"), ("exact", "s")] + [(c, "d") for c in WX_COLS])


@register("forecast_lookup", FC_SQL)
def q_forecast_lookup(spark, sf_dir):
    """Forecast of the exact target day, else the mean over all forecast days."""
    fc = WX.daily_weather(testbed.weather_raw(spark, sf_dir))
    targets = testbed.event_dim(spark, sf_dir).select(
        "event_name", testbed.weather_key(F.col("first_event_date_start")).alias("target_date"))
    days = fc.select(F.col("event_date").alias("__d"))
    out = WX.forecast_lookup(targets, fc, "target_date")
    out = out.join(days, out.target_date == days["__d"], "left").withColumn("exact", F.col("__d").isNotNull()).drop("__d")
    return finish(out.select("event_name", "target_date", "exact", *WX_COLS))


PREC_SQL = "WITH " + EV + ",\n" + WEATHER_DAILY + """,
x AS (SELECT ev.event_key, ev.event_name,
        CASE WHEN ev.event_key % 2 = 0 THEN w.t_max END AS live_t_max, CASE WHEN ev.event_key % 2 = 0 THEN w.t_min END AS live_t_min,
        CASE WHEN ev.event_key % 2 = 0 THEN w.rain_fall END AS live_rain_fall,
        CASE WHEN ev.event_key % 2 = 0 THEN w.max_wind END AS live_max_wind,
        CASE WHEN ev.event_key % 3 = 0 THEN 0.0 ELSE w.t_max END AS row_t_max,
        CASE WHEN ev.event_key % 3 = 0 THEN 0.0 ELSE w.t_min END AS row_t_min,
        w.rain_fall AS row_rain_fall, w.max_wind AS row_max_wind
      FROM ev LEFT JOIN wdaily w ON make_date(2024, 1, day(ev.first_event_date_start)) = w.event_date)
""" + typed_select("(SELECT event_name, coalesce(live_t_max, nullif(row_t_max, 0.0), 15.0) AS t_max, "
                   "coalesce(live_t_min, nullif(row_t_min, 0.0), 5.0) AS t_min, "
                   "coalesce(live_rain_fall, row_rain_fall, 0.0) AS rain_fall, "
                   "coalesce(live_max_wind, row_max_wind, 0.0) AS max_wind FROM x)",
                   [("event_name", "s")] + [(c, "d") for c in WX_COLS])


@register("weather_precedence", PREC_SQL)
def q_weather_precedence(spark, sf_dir):
    """Live forecast, else the stored row value (0 = missing for temperatures), else defaults."""
    daily = WX.daily_weather(testbed.weather_raw(spark, sf_dir))
    ev = testbed.event_dim(spark, sf_dir)
    j = WX.join_weather(ev, daily, testbed.weather_key(F.col("first_event_date_start")))
    live = F.col("event_key") % 2 == 0
    zero_row = F.col("event_key") % 3 == 0
    x = j.select("event_name",
                 *[F.when(live, F.col(c)).alias("live_" + c) for c in WX_COLS],
                 F.when(zero_row, F.lit(0.0)).otherwise(F.col("t_max")).alias("row_t_max"),
                 F.when(zero_row, F.lit(0.0)).otherwise(F.col("t_min")).alias("row_t_min"),
                 F.col("rain_fall").alias("row_rain_fall"), F.col("max_wind").alias("row_max_wind"))
    return finish(WX.weather_precedence(x).select("event_name", *WX_COLS))


# ----------------------------------------------------------------- J08 A28
KNOWN_SQL = WB + f"""dc AS (SELECT DISTINCT {clean_city_sql('city')} AS city FROM tb WHERE city IS NOT NULL),
gz AS (SELECT DISTINCT {clean_city_sql('n_name')} AS city FROM nation WHERE n_regionkey < 3),
k AS (SELECT city FROM dc INTERSECT SELECT city FROM gz)
""" + typed_select("(SELECT city FROM k UNION ALL SELECT city FROM dc WHERE NOT EXISTS (SELECT 1 FROM k))",
                   [("city", "s")])


def _known(spark, sf_dir):
    t = testbed.tickets(spark, sf_dir, with_buyer=True)
    dc = t.where(F.col("city").isNotNull()).select(clean_city(F.col("city")).alias("city")).distinct()
    gz = testbed.known_cities(spark, sf_dir).distinct()
    k = dc.intersect(gz)
    fallback = dc.crossJoin(F.broadcast(k.agg(F.count(F.lit(1)).alias("__n")))).where(F.col("__n") == 0).drop("__n")
    return k.unionByName(fallback)


@register("known_cities", KNOWN_SQL)
def q_known_cities(spark, sf_dir):
    """Data cities found in the reference-city table (all data cities if none)."""
    return finish(_known(spark, sf_dir))


MCS_SQL = WB + f"""known AS (SELECT DISTINCT {clean_city_sql('n_name')} AS k FROM nation WHERE n_regionkey < 3),
s AS (SELECT tb.event_name, CASE WHEN known.k IS NOT NULL THEN known.k ELSE 'other' END AS city_standardized
      FROM tb LEFT JOIN known ON {clean_city_sql('tb.city')} = known.k WHERE tb.event_name IS NOT NULL),
c AS (SELECT event_name, city_standardized, count(*) AS n FROM s GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY event_name ORDER BY n DESC, city_standardized) AS rn,
             sum(n) OVER (PARTITION BY event_name) AS tot FROM c)
""" + typed_select("(SELECT event_name, city_standardized AS main_city, n * 1.0 / tot AS main_city_share FROM r "
                   "WHERE rn = 1)", [("event_name", "s"), ("main_city", "s"), ("main_city_share", "d")])


@register("main_city_share", MCS_SQL)
def q_main_city_share(spark, sf_dir):
    """Per event the main standardised buyer city and its share."""
    t = testbed.tickets(spark, sf_dir, with_buyer=True).where(F.col("event_name").isNotNull())
    t = standardize_city(t, testbed.known_cities(spark, sf_dir),
                         bound_rows=table_rows(spark, f"{sf_dir}/nation.parquet"))
    c = t.groupBy("event_name", "city_standardized").agg(F.count(F.lit(1)).alias("n"))
    out = c.groupBy("event_name").agg(
        F.min_by("city_standardized", F.struct((-F.col("n")).alias("a"), F.col("city_standardized").alias("b")))
        .alias("main_city"),
        (F.max("n") / F.sum("n")).alias("main_city_share"))
    return finish(out)
