"""Analysis queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescast.functions.dates import floor_days
from salescast.functions.numeric import venue_type
from salescast.operators import analysis as an
from salescast.operators.features import add_lead_days
from salescast.plans.oracle_base import BUYERS, LEAD_DAYS, TICKETS, TICKETS_BUYER, norm, typed_select
from salescast.plans.registry import ASOF, HI, LO, T_H, finish, register
from salescast.sources import testbed

W_ = "WITH " + TICKETS + ",\n"
WB = "WITH " + TICKETS_BUYER + ",\n"

# ----------------------------------------------------------------- A14 F16
NOSHOW_CTE = """ns AS (SELECT event_name, count(*) AS tickets_sold, CAST(sum(product_is_scanned) AS BIGINT) AS showed
  FROM tickets WHERE event_name IS NOT NULL GROUP BY event_name HAVING count(*) >= 10),
ns2 AS (SELECT *, tickets_sold - showed AS no_show, (tickets_sold - showed) * 100.0 / tickets_sold AS no_show_pct,
               showed * 100.0 / tickets_sold AS show_up_pct FROM ns)"""
NOSHOW_SPEC = [("event_name", "s"), ("tickets_sold", "l"), ("showed", "l"), ("no_show", "l"),
               ("no_show_pct", "d"), ("show_up_pct", "d")]


@register("noshow_by_event", W_ + NOSHOW_CTE + "\n" + typed_select("ns2", NOSHOW_SPEC))
def q_noshow_by_event(spark, sf_dir):
    """No-show block per event."""
    return finish(an.noshow_by_event(testbed.tickets(spark, sf_dir)))


@register("noshow_top10", W_ + NOSHOW_CTE + "\n" + typed_select(
    "(SELECT * FROM ns2 ORDER BY no_show_pct DESC, event_name LIMIT 10)", NOSHOW_SPEC))
def q_noshow_top10(spark, sf_dir):
    """Ten events with the highest no-show share (top-k is the feature)."""
    return finish(an.top_k(an.noshow_by_event(testbed.tickets(spark, sf_dir)), "no_show_pct", 10, "event_name"))


# ----------------------------------------------------------------- A15
@register("scan_rate_by_source", W_ + "s AS (SELECT data_source, count(*) AS tickets, "
          "CAST(sum(product_is_scanned) AS BIGINT) AS scanned FROM tickets GROUP BY 1)\n"
          + typed_select("(SELECT *, scanned / tickets AS scan_rate FROM s)",
                         [("data_source", "s"), ("tickets", "l"), ("scanned", "l"), ("scan_rate", "d")]))
def q_scan_rate_by_source(spark, sf_dir):
    return finish(an.scan_rate(testbed.tickets(spark, sf_dir), by="data_source"))


@register("scan_rate_by_month", W_ + "s AS (SELECT date_trunc('month', verkoopdatum) AS month, count(*) AS tickets, "
          "CAST(sum(product_is_scanned) AS BIGINT) AS scanned FROM tickets GROUP BY 1)\n"
          + typed_select("(SELECT *, scanned / tickets AS scan_rate FROM s)",
                         [("month", "t"), ("tickets", "l"), ("scanned", "l"), ("scan_rate", "d")]))
def q_scan_rate_by_month(spark, sf_dir):
    """Scan rate per sale month."""
    return finish(an.scan_rate(testbed.tickets(spark, sf_dir), month_col="verkoopdatum"))


# ----------------------------------------------------------------- A17 A30
@register("noshow_distribution", W_ + NOSHOW_CTE + "\n" + typed_select(
    "(SELECT avg(no_show_pct) AS mean, quantile_cont(no_show_pct, 0.5) AS median, stddev_samp(no_show_pct) AS sd, "
    "min(no_show_pct) AS min, quantile_cont(no_show_pct, 0.25) AS q25, quantile_cont(no_show_pct, 0.75) AS q75, "
    "max(no_show_pct) AS max, count(no_show_pct) AS n FROM ns2)",
    [(c, "d") for c in ["mean", "median", "sd", "min", "q25", "q75", "max"]] + [("n", "l")]))
def q_noshow_distribution(spark, sf_dir):
    """Distribution summary of per-event no-show %."""
    return finish(an.distribution_summary(an.noshow_by_event(testbed.tickets(spark, sf_dir)), "no_show_pct"))


@register("noshow_histogram", W_ + NOSHOW_CTE + """,
rng AS (SELECT min(no_show_pct) AS lo, max(no_show_pct) AS hi FROM ns2),
hb AS (SELECT CAST(CASE WHEN hi - lo = 0 THEN 0 ELSE least(floor((no_show_pct - lo) / (hi - lo) * 30), 29) END AS INTEGER)
              AS bin, lo, hi FROM ns2 CROSS JOIN rng)
""" + typed_select("(SELECT bin, lo + (hi - lo) * bin / 30 AS bin_lo, count(*) AS n FROM hb GROUP BY bin, lo, hi)",
                   [("bin", "i"), ("bin_lo", "d"), ("n", "l")]))
def q_noshow_histogram(spark, sf_dir):
    """30-bin histogram of per-event no-show %."""
    return finish(an.histogram(an.noshow_by_event(testbed.tickets(spark, sf_dir)), "no_show_pct", 30))


# ----------------------------------------------------------------- A21 W09 O03
HS = (1, 5, 10, 20, 30)
_st_aggs = ", ".join(f"count(*) FILTER (WHERE d >= {h}) AS sold_at_{h}" for h in HS)
_st_pcts = ", ".join(f"sold_at_{h} * 100.0 / final_tickets AS pct_at_{h}" for h in HS)
SELL_SQL = (W_ + f"lt AS (SELECT event_name, {LEAD_DAYS} AS d FROM tickets),\n"
            f"st AS (SELECT event_name, count(*) AS final_tickets, {_st_aggs} FROM lt WHERE event_name IS NOT NULL "
            f"GROUP BY event_name HAVING count(*) >= 50)\n"
            + typed_select(f"(SELECT *, {_st_pcts} FROM st)",
                           [("event_name", "s"), ("final_tickets", "l")] + [(f"sold_at_{h}", "l") for h in HS]
                           + [(f"pct_at_{h}", "d") for h in HS]))


@register("sell_through", SELL_SQL)
def q_sell_through(spark, sf_dir):
    """Sell-through at horizons 1/5/10/20/30 days (events with >= 50 tickets)."""
    t = add_lead_days(testbed.tickets(spark, sf_dir), 0, is_prediction=True)
    return finish(an.sell_through(t, HS))


@register("cumulative_curve", W_ + f"lt AS (SELECT event_name, {LEAD_DAYS} AS days_until_event FROM tickets),\n"
          "dd AS (SELECT event_name, days_until_event, count(*) AS daily_sales FROM lt WHERE event_name IS NOT NULL "
          "GROUP BY ALL),\n"
          "cc AS (SELECT *, sum(daily_sales) OVER (PARTITION BY event_name ORDER BY days_until_event DESC "
          "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_sales, "
          "sum(daily_sales) OVER (PARTITION BY event_name) AS tot FROM dd)\n"
          + typed_select("(SELECT *, cumulative_sales * 100.0 / tot AS cumulative_pct FROM cc)",
                         [("event_name", "s"), ("days_until_event", "l"), ("daily_sales", "l"),
                          ("cumulative_sales", "l"), ("cumulative_pct", "d")]))
def q_cumulative_curve(spark, sf_dir):
    """Cumulative sales curve per event and lead day."""
    t = add_lead_days(testbed.tickets(spark, sf_dir), 0, is_prediction=True)
    return finish(an.cumulative_curve(t))


# ----------------------------------------------------------------- A25 A26
QP_SQL = WB + """q AS (SELECT data_source, count(*) AS tickets,
   count(*) FILTER (WHERE product_value < 0) AS negative_price, count(*) FILTER (WHERE product_value = 0) AS zero_price,
   count(*) FILTER (WHERE product_value IS NULL) AS missing_price, count(*) FILTER (WHERE age IS NULL) AS missing_age,
   count(*) FILTER (WHERE gender IS NULL) AS missing_gender,
   avg(CASE WHEN verkoopdatum IS NOT NULL THEN 1.0 ELSE 0.0 END) AS sale_date_parse_rate,
   avg(CASE WHEN event_date IS NOT NULL THEN 1.0 ELSE 0.0 END) AS event_date_parse_rate
 FROM tb GROUP BY data_source)
""" + typed_select("q", [("data_source", "s"), ("tickets", "l"), ("negative_price", "l"), ("zero_price", "l"),
                        ("missing_price", "l"), ("missing_age", "l"), ("missing_gender", "l"),
                        ("sale_date_parse_rate", "d"), ("event_date_parse_rate", "d")])


@register("quality_profile_by_source", QP_SQL)
def q_quality_profile_by_source(spark, sf_dir):
    """Per-source quality profile in one groupBy."""
    t = testbed.tickets(spark, sf_dir, with_buyer=True)
    pv = F.col("product_value")
    ok = lambda c: F.avg(F.when(F.col(c).isNotNull(), 1.0).otherwise(0.0))
    return finish(t.groupBy("data_source").agg(
        F.count(F.lit(1)).alias("tickets"), F.count_if(pv < 0).alias("negative_price"),
        F.count_if(pv == 0).alias("zero_price"), F.count_if(pv.isNull()).alias("missing_price"),
        F.count_if(F.col("age").isNull()).alias("missing_age"),
        F.count_if(F.col("gender").isNull()).alias("missing_gender"),
        ok("verkoopdatum").alias("sale_date_parse_rate"), ok("event_date").alias("event_date_parse_rate")))


NP_COLS = ["gender", "payment_method", "max_capacity", "age", "city"]
NP_SQL = WB + "w AS (SELECT count(*) AS n, " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in NP_COLS) + " FROM tb),\n" + \
    "u AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column, {c} AS nulls, n FROM w" for c in NP_COLS) + ")\n" + \
    typed_select("(SELECT \"column\", nulls, nulls * 100.0 / n AS null_pct FROM u)",
                 [('"column"', "s"), ("nulls", "l"), ("null_pct", "d")])


@register("null_profile", NP_SQL)
def q_null_profile(spark, sf_dir):
    """Null profile per column (one wide aggregate, unpivoted)."""
    return finish(an.null_profile(testbed.tickets(spark, sf_dir, with_buyer=True), NP_COLS))


# ----------------------------------------------------------------- A27 A34
INTEG_SQL = W_ + f"""i AS (SELECT count(*) - count(DISTINCT barcode) AS duplicate_barcodes,
  count(*) FILTER (WHERE barcode IS NULL) AS missing_barcodes,
  count(*) FILTER (WHERE event_name IS NULL) AS missing_names,
  count(*) FILTER (WHERE event_date IS NULL) AS missing_dates,
  count(*) FILTER (WHERE product_is_scanned NOT IN (0, 1)) AS bad_scan_flags,
  count(*) FILTER (WHERE verkoopdatum > first_event_date_start) AS sales_after_event_start,
  count(*) FILTER (WHERE {LEAD_DAYS} < 0) AS negative_lead_days FROM tickets)
""" + typed_select("i", [(c, "l") for c in ["duplicate_barcodes", "missing_barcodes", "missing_names", "missing_dates",
                                           "bad_scan_flags", "sales_after_event_start", "negative_lead_days"]])


@register("integrity_checks", INTEG_SQL)
def q_integrity_checks(spark, sf_dir):
    """Integrity counters (sales after the event are counted, not removed)."""
    t = testbed.tickets(spark, sf_dir)
    d = floor_days("verkoopdatum", "first_event_date_start")
    return finish(t.agg(
        (F.count(F.lit(1)) - F.count_distinct("barcode")).alias("duplicate_barcodes"),
        F.count_if(F.col("barcode").isNull()).alias("missing_barcodes"),
        F.count_if(F.col("event_name").isNull()).alias("missing_names"),
        F.count_if(F.col("event_date").isNull()).alias("missing_dates"),
        F.count_if(~F.col("product_is_scanned").isin(0, 1)).alias("bad_scan_flags"),
        F.count_if(F.col("verkoopdatum") > F.col("first_event_date_start")).alias("sales_after_event_start"),
        F.count_if(d < 0).alias("negative_lead_days")))


DR_COLS = ["verkoopdatum", "first_event_date_start", "last_event_date_end", "event_date"]


@register("date_range", W_ + "r AS (SELECT " + ", ".join(
    f"min({c}) AS min_{c}, max({c}) AS max_{c}" for c in DR_COLS) + " FROM tickets)\n"
    + typed_select("r", [(f"{m}_{c}", "t") for c in DR_COLS for m in ("min", "max")]))
def q_date_range(spark, sf_dir):
    """min/max per date column (latest sale date included)."""
    t = testbed.tickets(spark, sf_dir)
    return finish(t.agg(*[x for c in DR_COLS for x in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))]))


# ----------------------------------------------------------------- A18 A24 X28
@register("value_counts_share", W_ + "v AS (SELECT ticket_type, count(*) AS n FROM tickets "
          "WHERE ticket_type IS NOT NULL GROUP BY 1)\n"
          + typed_select("(SELECT ticket_type, n, n / sum(n) OVER () AS share FROM v)",
                         [("ticket_type", "s"), ("n", "l"), ("share", "d")]))
def q_value_counts_share(spark, sf_dir):
    """Value counts with share."""
    return finish(an.value_counts(testbed.tickets(spark, sf_dir), "ticket_type"))


@register("sale_hour_counts", W_ + "v AS (SELECT CAST(hour(verkoopdatum) AS INTEGER) AS sale_hour, count(*) AS n "
          "FROM tickets GROUP BY 1)\n"
          + typed_select("(SELECT sale_hour, n, n / sum(n) OVER () AS share FROM v)",
                         [("sale_hour", "i"), ("n", "l"), ("share", "d")]))
def q_sale_hour_counts(spark, sf_dir):
    """Value counts of a time-of-day component (sale hour)."""
    t = testbed.tickets(spark, sf_dir).withColumn("sale_hour", F.hour("verkoopdatum"))
    return finish(an.value_counts(t, "sale_hour", dropna=False))


PATTERNS = {"has_1": "1", "has_00": "00", "has_supplier": "supplier"}


@register("name_patterns", W_ + "e AS (SELECT DISTINCT event_name FROM tickets WHERE event_name IS NOT NULL)\n"
          + typed_select("(SELECT count(*) AS events, " + ", ".join(
              f"count(*) FILTER (WHERE contains(lower(event_name), '{p}')) AS {k}" for k, p in PATTERNS.items())
              + ", max(length(event_name)) AS max_name_length, "
              "min(CASE WHEN length(event_name) > 12 THEN substr(event_name, 1, 12) || '...' ELSE event_name END) "
              "AS shortest_label FROM e)",
              [("events", "l")] + [(k, "l") for k in PATTERNS] + [("max_name_length", "i"), ("shortest_label", "s")]))
def q_name_patterns(spark, sf_dir):
    """Name-pattern counts, length and truncated labels."""
    from salescast.functions.text import truncate_ellipsis
    e = testbed.tickets(spark, sf_dir).select("event_name").where(F.col("event_name").isNotNull()).distinct()
    low = F.lower("event_name")
    return finish(e.agg(F.count(F.lit(1)).alias("events"),
                        *[F.count_if(low.contains(p)).alias(k) for k, p in PATTERNS.items()],
                        F.max(F.length("event_name")).alias("max_name_length"),
                        F.min(truncate_ellipsis(F.col("event_name"), 12)).alias("shortest_label")))


# ----------------------------------------------------------------- A23 A19 A35 F18
@register("avg_tickets_per_event", W_ + "c AS (SELECT event_name, count(*) AS n FROM tickets "
          "WHERE event_name IS NOT NULL GROUP BY 1)\n"
          + typed_select("(SELECT avg(n) AS avg_tickets_per_event, count(*) AS events FROM c)",
                         [("avg_tickets_per_event", "d"), ("events", "l")]))
def q_avg_tickets_per_event(spark, sf_dir):
    """Average tickets per event (aggregate of an aggregate)."""
    c = testbed.tickets(spark, sf_dir).where(F.col("event_name").isNotNull()).groupBy("event_name").count()
    return finish(c.agg(F.avg("count").alias("avg_tickets_per_event"), F.count(F.lit(1)).alias("events")))


@register("distinct_counts", WB + """x AS (SELECT data_source, CASE WHEN max_capacity >= 3000 THEN 'festival' ELSE 'club' END
  AS venue_type, event_name, buyer_key FROM tb)
""" + typed_select("(SELECT data_source, venue_type, count(DISTINCT event_name) AS events, "
                   "count(DISTINCT buyer_key) AS buyers FROM x GROUP BY ALL)",
                   [("data_source", "s"), ("venue_type", "s"), ("events", "l"), ("buyers", "l")]))
def q_distinct_counts(spark, sf_dir):
    """Distinct events and buyers per source and venue type."""
    t = testbed.tickets(spark, sf_dir, with_buyer=True).withColumn("venue_type", venue_type(F.col("max_capacity")))
    return finish(t.groupBy("data_source", "venue_type").agg(F.count_distinct("event_name").alias("events"),
                                                             F.count_distinct("buyer_key").alias("buyers")))


# The scanner log of every 25th event is taken as lost, so that events without a scan exist.
LOST_SCANS = "event_key % 25 = 3"


@register("noshow_event_dates", W_ + f"""z AS (SELECT event_name, min(first_event_date_start) AS first_date,
  avg(CASE WHEN {LOST_SCANS} THEN 0 ELSE product_is_scanned END) AS scan_rate
  FROM tickets WHERE event_name IS NOT NULL GROUP BY 1 HAVING scan_rate <= 0)
""" + typed_select(f"(SELECT event_name, first_date, scan_rate, CASE WHEN CAST(first_date AS DATE) > DATE '{ASOF}' "
                   "THEN 1 ELSE 0 END AS is_future FROM z)",
                   [("event_name", "s"), ("first_date", "t"), ("scan_rate", "d"), ("is_future", "i")]))
def q_noshow_event_dates(spark, sf_dir):
    """Events without any scan, their first date and whether they lie after the as-of date."""
    t = testbed.tickets(spark, sf_dir).withColumn(
        "product_is_scanned", F.when(F.expr(LOST_SCANS), 0).otherwise(F.col("product_is_scanned")))
    z = an.unscanned_events(t)
    return finish(z.withColumn("is_future", (F.to_date("first_date") > F.to_date(F.lit(ASOF))).cast("int")))


DRILL = ["Supplier#000000001", "Supplier#000000002", "Supplier#000000003", "Supplier#000000042"]


@register("event_drilldown", W_ + "d AS (SELECT * FROM tickets WHERE event_name IN ("
          + ", ".join(f"'{n}'" for n in DRILL) + "))\n"
          + typed_select("(SELECT event_name, data_source, product_is_scanned, count(*) AS tickets, "
                         "min(event_date) AS event_date, sum(product_value) AS value FROM d GROUP BY ALL)",
                         [("event_name", "s"), ("data_source", "s"), ("product_is_scanned", "i"), ("tickets", "l"),
                          ("event_date", "t"), ("value", "d")]))
def q_event_drilldown(spark, sf_dir):
    """Drill-down on a named event list (left-semi on a broadcast list)."""
    names = F.broadcast(spark.createDataFrame([(n,) for n in DRILL], "event_name string"))
    d = testbed.tickets(spark, sf_dir).join(names, "event_name", "left_semi")
    return finish(d.groupBy("event_name", "data_source", "product_is_scanned").agg(
        F.count(F.lit(1)).alias("tickets"), F.min("event_date").alias("event_date"),
        F.sum("product_value").alias("value")))


# ----------------------------------------------------------------- A31 U03 U04
COV_SQL = ("WITH " + TICKETS.split(",\ntickets AS")[0] + ",\n" + """pairs AS (SELECT DISTINCT l.l_suppkey, o.o_custkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
a AS (SELECT DISTINCT """ + norm("c.c_name") + """ AS artist FROM pairs JOIN customer c ON pairs.o_custkey = c.c_custkey),
b AS (SELECT DISTINCT """ + norm("c.c_name") + """ AS artist FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
s AS (SELECT (SELECT count(*) FROM a) AS n_left, (SELECT count(*) FROM b) AS n_right,
             (SELECT count(*) FROM (SELECT artist FROM a INTERSECT SELECT artist FROM b)) AS n_both,
             (SELECT count(*) FROM (SELECT artist FROM a EXCEPT SELECT artist FROM b)) AS n_left_only)
""" + typed_select("(SELECT *, n_both * 100.0 / n_left AS pct_left_covered FROM s)",
                   [("n_left", "l"), ("n_right", "l"), ("n_both", "l"), ("n_left_only", "l"),
                    ("pct_left_covered", "d")]))


@register("artist_coverage", COV_SQL)
def q_artist_coverage(spark, sf_dir):
    """Line-up artists covered by metric snapshots."""
    from salescast.functions.text import with_normalized
    lu = with_normalized(testbed.lineup_bridge(spark, sf_dir), "artist")
    snaps = with_normalized(testbed.artist_snapshots(spark, sf_dir), "artist")
    return finish(an.coverage(lu, snaps, "artist"))


COV_KEPT_SQL = COV_SQL.replace("FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)", f"""FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_suppkey IN
    (SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING count(*) > {LO} AND count(*) < {HI}))""")


@register("artist_coverage_filtered", COV_KEPT_SQL)
def q_artist_coverage_filtered(spark, sf_dir):
    """The same coverage for the line-ups of the events that the size filter keeps."""
    from salescast.functions.text import with_normalized
    from salescast.session import broadcast_bounded, table_rows
    sizes = testbed.tickets(spark, sf_dir).groupBy("event_name").agg(F.count(F.lit(1)).alias("n"))
    kept = sizes.where((F.col("n") > LO) & (F.col("n") < HI)).select("event_name")
    kept = broadcast_bounded(kept, table_rows(spark, f"{sf_dir}/supplier.parquet"))
    lu = testbed.lineup_bridge(spark, sf_dir).join(kept, "event_name", "left_semi")
    snaps = with_normalized(testbed.artist_snapshots(spark, sf_dir), "artist")
    return finish(an.coverage(with_normalized(lu, "artist"), snaps, "artist"))


# ----------------------------------------------------------------- A33 A20
@register("date_overlap", W_ + """a AS (SELECT DISTINCT CAST(verkoopdatum AS DATE) AS d FROM tickets),
b AS (SELECT DISTINCT CAST(event_date AS DATE) AS d FROM tickets)
""" + typed_select("(SELECT (SELECT count(*) FROM a) AS sale_days, (SELECT count(*) FROM b) AS event_days, "
                   "(SELECT count(*) FROM (SELECT d FROM a INTERSECT SELECT d FROM b)) AS overlap_days)",
                   [("sale_days", "l"), ("event_days", "l"), ("overlap_days", "l")]))
def q_date_overlap(spark, sf_dir):
    """Overlap of sale days and event days."""
    t = testbed.tickets(spark, sf_dir)
    days = t.select(F.posexplode(F.array(F.to_date("verkoopdatum"), F.to_date("event_date"))).alias("kind", "d"))
    d = days.groupBy("d").agg(F.max(F.col("kind") == 0).alias("sale"), F.max(F.col("kind") == 1).alias("event"))
    return finish(d.agg(F.count_if("sale").alias("sale_days"), F.count_if("event").alias("event_days"),
                        F.count_if(F.col("sale") & F.col("event")).alias("overlap_days")))


@register("mode_city", WB + """c AS (SELECT event_name, city, count(*) AS n FROM tb
  WHERE city IS NOT NULL AND event_name IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY event_name ORDER BY n DESC, city) AS rn,
             max(n) OVER (PARTITION BY event_name) AS mode_count FROM c)
""" + typed_select("(SELECT event_name, city AS mode_city, mode_count FROM r WHERE rn = 1)",
                   [("event_name", "s"), ("mode_city", "s"), ("mode_count", "l")]))
def q_mode_city(spark, sf_dir):
    """Most frequent buyer city per event (ties -> smallest name)."""
    t = testbed.tickets(spark, sf_dir, with_buyer=True).where(F.col("event_name").isNotNull())
    return finish(an.mode_per_group(t, "event_name", "city"))


# ----------------------------------------------------------------- F04 W05
FUT_ASOF = "2001-10-25"


@register("future_events", W_ + f"""f AS (SELECT event_name, min(first_event_date_start) AS event_start FROM tickets
  WHERE CAST(first_event_date_start AS DATE) > DATE '{FUT_ASOF}' AND event_name IS NOT NULL GROUP BY 1)
""" + typed_select(f"(SELECT event_name, event_start, CAST(datediff('day', DATE '{FUT_ASOF}', "
                   "CAST(event_start AS DATE)) AS INTEGER) AS days_until_event FROM f)",
                   [("event_name", "s"), ("event_start", "t"), ("days_until_event", "i")]))
def q_future_events(spark, sf_dir):
    """Upcoming events (first occurrence) with whole days until the start."""
    t = testbed.tickets(spark, sf_dir)
    f = (t.where(F.to_date("first_event_date_start") > F.to_date(F.lit(FUT_ASOF)))
         .where(F.col("event_name").isNotNull())
         .groupBy("event_name").agg(F.min("first_event_date_start").alias("event_start")))
    return finish(f.withColumn("days_until_event",
                               F.datediff(F.to_date("event_start"), F.to_date(F.lit(FUT_ASOF)))))


__all__ = ["BUYERS"]
