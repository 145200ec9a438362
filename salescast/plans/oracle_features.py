"""DuckDB text of the feature pipeline (independent re-statement of the
semantics for the oracle; shares only the test-data binding)."""

from __future__ import annotations

from salescast.plans.oracle_base import LEAD_DAYS, TICKETS_BUYER_ONCE, WEATHER_DAILY, norm

W = ["t_max", "t_min", "rain_fall", "max_wind"]
METRICS = ["ChartmetricScore", "SpotifyPopularity", "SpotifyFollowers", "TikTokViews", "DeezerFans"]


def clean_city_sql(c: str) -> str:
    return f"regexp_replace(regexp_replace(lower({c}), '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')"


def gender_sql(c: str = "gender") -> str:
    return (f"CASE WHEN lower({c}) = 'female' THEN 'woman' WHEN lower({c}) = 'male' THEN 'man' "
            f"ELSE coalesce(lower({c}), 'unknown') END")


def prepared(T: int | str, asof: str, keep: str | None = None, routes: str | None = None) -> str:
    """CTEs up to ``lt``: prepared ticket rows with lead days ``d``.  ``keep`` replaces the past-event
    filter; ``routes`` (CTEs over p3, the last one named routes) gives each event a column T and keeps
    negative lead days."""
    keep = keep or f"NOT coalesce(CAST(first_event_date_start AS DATE) > DATE '{asof}', false)"
    routed = "p3" if routes is None else "p3 JOIN routes USING (event_name)"
    late = "WHERE NOT coalesce(d0 < 0, false)" if routes is None else ""
    em = ", ".join(f"quantile_cont({c}, 0.5) AS em_{c}" for c in W)
    rep1 = ", ".join(f"coalesce(p0.{c}, em.em_{c}) AS {c}" for c in W)
    gm = ", ".join(f"quantile_cont({c}, 0.5) AS gm_{c}" for c in W)
    rep2 = ", ".join(f"coalesce(p1.{c}, gm.gm_{c}, 0.0) AS {c}" for c in W)
    return f"""{TICKETS_BUYER_ONCE},
{WEATHER_DAILY},
tw AS (SELECT tb.*, w.t_max, w.t_min, w.rain_fall, w.max_wind FROM tb
       LEFT JOIN wdaily w ON make_date(2024, 1, day(tb.first_event_date_start)) = w.event_date),
p0 AS (SELECT * FROM tw WHERE {keep}),
em AS (SELECT event_name, {em} FROM p0 GROUP BY event_name),
p1 AS (SELECT p0.* REPLACE ({rep1}) FROM p0 LEFT JOIN em ON p0.event_name = em.event_name),
gm AS (SELECT {gm} FROM p1),
p2 AS (SELECT p1.* REPLACE ({rep2}) FROM p1 CROSS JOIN gm),
known AS (SELECT DISTINCT {clean_city_sql('n_name')} AS k FROM nation WHERE n_regionkey < 3),
p3 AS (SELECT p2.* REPLACE ({norm('p2.event_name')} AS event_name),
              CASE WHEN known.k IS NOT NULL THEN known.k ELSE 'other' END AS city_standardized
       FROM p2 LEFT JOIN known ON {clean_city_sql('p2.city')} = known.k),
{routes + "," if routes else ""}
l0 AS (SELECT *, {LEAD_DAYS} AS d0 FROM {routed}),
lt AS (SELECT * EXCLUDE (d0), coalesce(d0, {T}) AS d FROM l0 {late})"""


def event_table(T: int | str, lag: int, lo: int, hi: int, asof: str, keep: str | None = None,
                routes: str | None = None) -> str:
    """CTEs up to ``ev_out``: one row per kept event with all ticket blocks (all events with ``routes``)."""
    sized = f"HAVING count(*) > {lo} AND count(*) < {hi}" if routes is None else ""
    up = f"FILTER (WHERE d >= {T})"
    g = gender_sql()
    day0 = ",\n   ".join(f"arg_max({c}, verkoopdatum) FILTER (WHERE d <= 1) AS {c}" for c in W)
    return prepared(T, asof, keep, routes) + f""",
agg AS (
  SELECT event_name, count(*) AS full_event_tickets,
   count(*) FILTER (WHERE d >= {T} AND d < {T} + {lag}) AS sales_last_{lag}_days,
   count(*) {up} AS cumulative_sales_at_t, min(d) {up} AS dmin, max(d) {up} AS dmax,
   arg_min(first_event_date_start, verkoopdatum) FILTER (WHERE first_event_date_start IS NOT NULL) AS fed,
   arg_min(last_event_date_end, verkoopdatum) FILTER (WHERE last_event_date_end IS NOT NULL) AS led,
   min(verkoopdatum) AS first_sale, max(verkoopdatum) AS last_sale_all, max(verkoopdatum) {up} AS last_sale_upto,
   avg(age) {up} AS avg_age0, stddev_samp(age) {up} AS std_age0,
   avg(CASE WHEN {g} = 'man' THEN 1.0 ELSE 0.0 END) {up} * 100 AS male0,
   avg(CASE WHEN {g} = 'woman' THEN 1.0 ELSE 0.0 END) {up} * 100 AS female0,
   avg(CASE WHEN {g} = 'nonbinary' THEN 1.0 ELSE 0.0 END) {up} * 100 AS nb0,
   count(DISTINCT city_standardized) {up} AS unique_cities,
   avg(product_value) {up} AS apv0, stddev_samp(product_value) {up} AS spv0,
   avg(total_price) {up} AS atp0, avg(CAST(product_is_scanned AS DOUBLE)) {up} AS sp0,
   arg_min(max_capacity, verkoopdatum) FILTER (WHERE max_capacity IS NOT NULL) AS cap0,
   {day0}
   , CAST(max({T}) AS INTEGER) AS horizon
  FROM lt WHERE event_name IS NOT NULL GROUP BY event_name
  {sized}
),
t1 AS (SELECT *, (fed IS NOT NULL AND led IS NOT NULL AND first_sale IS NOT NULL AND last_sale_all IS NOT NULL
                  AND last_sale_upto IS NOT NULL) AS valid,
              (epoch_us(led) - epoch_us(fed)) / 3600000000.0 AS dur0 FROM agg),
t2 AS (SELECT *, CASE WHEN valid AND dur0 >= 0 AND dur0 <= 720 THEN dur0 END AS dur1 FROM t1),
dmed AS (SELECT quantile_cont(dur1, 0.5) AS dm FROM t2 WHERE valid),
daily AS (SELECT event_name, d, count(*) AS n FROM lt WHERE d >= {T} AND event_name IS NOT NULL GROUP BY ALL),
acc0 AS (SELECT event_name, coalesce(n - lag(n) OVER (PARTITION BY event_name ORDER BY d), 0) AS a FROM daily),
acc AS (SELECT event_name, avg(a) AS avg_acceleration FROM acc0 GROUP BY event_name),
cityn AS (SELECT event_name, city_standardized, count(*) AS n FROM lt WHERE d >= {T} AND event_name IS NOT NULL
          GROUP BY ALL),
cshare AS (SELECT event_name, max(n) / sum(n) AS mcr FROM cityn GROUP BY event_name),
meds AS (SELECT quantile_cont(avg_age0, 0.5) AS m_age, quantile_cont(std_age0, 0.5) AS m_std,
                quantile_cont(apv0, 0.5) AS m_apv, quantile_cont(spv0, 0.5) AS m_spv,
                quantile_cont(atp0, 0.5) AS m_atp, quantile_cont(sp0, 0.5) AS m_sp,
                quantile_cont(cap0, 0.5) AS m_cap FROM agg),
ev_out AS (
  SELECT t2.event_name, t2.full_event_tickets, t2.sales_last_{lag}_days,
    ln(1 + t2.sales_last_{lag}_days) AS log_sales_last_{lag}_days,
    CASE WHEN valid THEN fed END AS first_event_date,
    CASE WHEN valid THEN coalesce(dur1, dm, 4.0) END AS event_duration_hours,
    CASE WHEN valid THEN coalesce(greatest((epoch_us(last_sale_upto) - epoch_us(first_sale)) / 3600000000.0, 0.0), 0.0) END
      AS sales_duration_hours_upto_t,
    CASE WHEN valid THEN ln(1 + coalesce(greatest((epoch_us(last_sale_upto) - epoch_us(first_sale)) / 3600000000.0, 0.0), 0.0)) END
      AS log_sales_duration_hours_upto_t,
    CASE WHEN valid THEN coalesce(isodow(fed) - 1, -1) END AS day_of_week,
    CASE WHEN valid THEN coalesce(month(fed), -1) END AS event_month,
    CASE WHEN valid THEN coalesce(year(fed), -1) END AS event_year,
    CASE WHEN valid THEN CASE WHEN coalesce(isodow(fed) - 1, -1) IN (5, 6) THEN 1 ELSE 0 END END AS is_weekend,
    CASE WHEN valid THEN sin(2 * pi() * coalesce(month(fed), -1) / 12) END AS month_sin,
    CASE WHEN valid THEN cos(2 * pi() * coalesce(month(fed), -1) / 12) END AS month_cos,
    CASE WHEN valid THEN sin(2 * pi() * coalesce(isodow(fed) - 1, -1) / 7) END AS day_of_week_sin,
    CASE WHEN valid THEN cos(2 * pi() * coalesce(isodow(fed) - 1, -1) / 7) END AS day_of_week_cos,
    cumulative_sales_at_t, ln(1 + cumulative_sales_at_t) AS log_cumulative_sales_at_t,
    CASE WHEN cumulative_sales_at_t > 0 THEN cumulative_sales_at_t / (dmax - dmin + 1) ELSE 0.0 END
      AS avg_daily_sales_before_t,
    ln(1 + CASE WHEN cumulative_sales_at_t > 0 THEN cumulative_sales_at_t / (dmax - dmin + 1) ELSE 0.0 END)
      AS log_avg_daily_sales_before_t,
    coalesce(acc.avg_acceleration, 0.0) AS avg_acceleration,
    coalesce(avg_age0, m_age) AS avg_age, coalesce(std_age0, m_std) AS std_age,
    coalesce(male0, 0.0) AS male_percentage, coalesce(female0, 0.0) AS female_percentage,
    coalesce(nb0, 0.0) AS nb_percentage, unique_cities, ln(1 + unique_cities) AS log_unique_cities,
    coalesce(cshare.mcr, 0.0) AS main_city_buyer_ratio,
    coalesce(apv0, m_apv, 0.0) AS avg_product_value, coalesce(spv0, m_spv, 0.0) AS std_product_value,
    coalesce(atp0, m_atp, 0.0) AS avg_total_price, coalesce(sp0, m_sp, 0.0) AS scanned_percentage,
    coalesce(cap0, m_cap, 1000.0) AS max_capacity, ln(1 + coalesce(cap0, m_cap, 1000.0)) AS log_max_capacity,
    t_max, t_min, rain_fall, max_wind, horizon AS forecast_days
  FROM t2 CROSS JOIN dmed CROSS JOIN meds
  LEFT JOIN acc ON t2.event_name = acc.event_name
  LEFT JOIN cshare ON t2.event_name = cshare.event_name
)"""


def artist_matched(T: int) -> str:
    """CTEs ``lu``, ``snaps``, ``matched``: as-of matched snapshots per (event, artist)."""
    order = ", ".join(["s.Date DESC"] + [f"s.{m} DESC" for m in METRICS])
    return f"""pairs AS (SELECT DISTINCT l.l_suppkey, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
lu AS (SELECT {norm('ev.event_name')} AS event_name, ev.first_event_date_start AS event_date,
              {norm('c.c_name')} AS artist
       FROM pairs JOIN ev ON pairs.l_suppkey = ev.event_key JOIN customer c ON pairs.o_custkey = c.c_custkey),
snaps AS (SELECT {norm('c.c_name')} AS artist, CAST(o.o_orderdate AS DATE) AS Date,
                 CAST(o.o_orderkey % 100 AS DOUBLE) AS ChartmetricScore,
                 CAST(o.o_custkey % 100 AS DOUBLE) AS SpotifyPopularity,
                 o.o_totalprice AS SpotifyFollowers, o.o_totalprice * 10 AS TikTokViews,
                 o.o_totalprice / 2 AS DeezerFans
          FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
m0 AS (SELECT lu.event_name, lu.artist, CAST(lu.event_date AS DATE) - {T} AS prediction_date,
              s.Date, {", ".join("s." + m for m in METRICS)},
              row_number() OVER (PARTITION BY lu.event_name, lu.artist ORDER BY {order}, lu.event_date DESC) AS rn
       FROM lu JOIN snaps s ON lu.artist = s.artist AND s.Date <= CAST(lu.event_date AS DATE) - {T}),
matched AS (SELECT * EXCLUDE (rn) FROM m0 WHERE rn = 1)"""


def artist_block(T: int, events_cte: str, star: float = 0.8) -> str:
    """CTE ``art``: events (from ``events_cte``) with the 44 artist columns."""
    aggs = ["count(DISTINCT artist) AS num_artists"]
    fn = {"mean": "avg", "max": "max", "sum": "sum", "std": "stddev_samp"}
    for m in METRICS:
        for a, f in fn.items():
            aggs.append(f"{f}({m}) AS {m}_{a}")
    logs = ["ln(1 + coalesce(num_artists, 0)) AS log_num_artists"]
    for m in METRICS:
        for a in fn:
            logs.append(f"ln(1 + coalesce({m}_{a}, 0)) AS log_{m}_{a}")
    cols = ["num_artists", "log_num_artists"] + [f"{m}_{a}" for m in METRICS for a in fn] + \
        [f"log_{m}_{a}" for m in METRICS for a in fn] + ["has_artist_data", "has_star_artist"]
    fills = ", ".join(f"coalesce(c3.{c}, 0) AS {c}" for c in cols)
    return artist_matched(T) + f""",
c1 AS (SELECT event_name, {", ".join(aggs)} FROM matched
       WHERE event_name IN (SELECT event_name FROM {events_cte}) GROUP BY event_name),
c2 AS (SELECT *, {", ".join(logs)},
              CASE WHEN coalesce(SpotifyFollowers_max, 0) > 0 THEN 1 ELSE 0 END AS has_artist_data FROM c1),
thr AS (SELECT coalesce(quantile_cont(log_SpotifyFollowers_max, {star}) FILTER (WHERE has_artist_data = 1), 0.0) AS th
        FROM c2),
c3 AS (SELECT c2.*, CASE WHEN coalesce(log_SpotifyFollowers_max, 0) > th THEN 1 ELSE 0 END AS has_star_artist
       FROM c2 CROSS JOIN thr),
art AS (SELECT e.*, {fills} FROM {events_cte} e LEFT JOIN c3 ON e.event_name = c3.event_name)"""


ARTIST_COLS = (["num_artists", "log_num_artists"] + [f"{m}_{a}" for m in METRICS for a in ["mean", "max", "sum", "std"]]
               + [f"log_{m}_{a}" for m in METRICS for a in ["mean", "max", "sum", "std"]]
               + ["has_artist_data", "has_star_artist"])
