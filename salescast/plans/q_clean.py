"""Cleaning, filtering and scalar-function queries."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from salescast.functions import numeric as N
from salescast.functions.dates import to_midnight
from salescast.functions.text import canonical_event_name, normalize_text
from salescast.operators import analysis as an
from salescast.operators import clean as C
from salescast.operators.stats import attach_one_row
from salescast.plans.oracle_base import TICKETS, TICKETS_BUYER, TICKETS_BUYER_ONCE, norm, typed_select
from salescast.plans.registry import ASOF, finish, register
from salescast.session import ensure_checkpoint_dir, materialize, row_width, table_rows
from salescast.sources import testbed
from salescast.sources.storage import bucket_count, read_current, write_bucketed, write_ordered

W_ = "WITH " + TICKETS + ",\n"
WB = "WITH " + TICKETS_BUYER + ",\n"


# ----------------------------------------------------------------- W02 W06
DEDUP_SQL = W_ + """r AS (SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY
      CASE data_source WHEN 'shop_f' THEN 0 ELSE 1 END, verkoopdatum, product_value, event_name, line_no) AS rn
   FROM (SELECT * REPLACE (CASE WHEN order_key % 97 = 5 THEN NULL ELSE barcode END AS barcode) FROM tickets))
""" + typed_select("(SELECT * FROM r WHERE rn = 1)", [("barcode", "s"), ("event_name", "s"), ("verkoopdatum", "t"),
                                                      ("product_value", "d"), ("data_source", "s")])


@register("dedup_barcode", DEDUP_SQL)
def q_dedup_barcode(spark, sf_dir):
    """Keep-first per barcode by source priority, sale time, then a total order;
    some tickets are read without a barcode and count as one."""
    missing = F.when(F.col("order_key") % 97 != 5, F.col("barcode"))
    t = testbed.tickets(spark, sf_dir).withColumn("barcode", missing).select(
        "barcode", "event_name", "verkoopdatum", "product_value", "data_source", "line_no")
    return finish(C.dedup_tickets(t).drop("line_no"))


@register("tickets_in_order", W_ + """g AS (SELECT count(*) OVER (PARTITION BY order_id) AS tickets_in_order FROM tickets
   WHERE order_id IS NOT NULL)
""" + typed_select("(SELECT tickets_in_order, count(*) AS n_tickets FROM g GROUP BY 1)",
                   [("tickets_in_order", "l"), ("n_tickets", "l")]))
def q_tickets_in_order(spark, sf_dir):
    """Tickets per order broadcast to ticket rows (distribution of the result)."""
    t = C.group_size(testbed.tickets(spark, sf_dir).select("order_id"), "order_id", "tickets_in_order")
    return finish(t.where(F.col("order_id").isNotNull()).groupBy("tickets_in_order")
                  .agg(F.count(F.lit(1)).alias("n_tickets")))


# ----------------------------------------------------------------- F12 F13 F14
def _outlier_sql(method: str, cols=("product_value", "quantity"), factor: float = 1.5) -> str:
    ctes = ["s0 AS (SELECT event_name, product_value, quantity FROM tickets)"]
    for i, c in enumerate(cols):
        prev, cur = f"s{i}", f"s{i + 1}"
        conds = ["TRUE"]
        stats = []
        if method in ("IQR", "combined"):
            stats += [f"quantile_cont({c}, 0.25) AS q1", f"quantile_cont({c}, 0.75) AS q3"]
            conds.append(f"({c} IS NULL OR {c} BETWEEN q1 - {factor} * (q3 - q1) AND q3 + {factor} * (q3 - q1))")
        if method in ("zscore", "combined"):
            stats += [f"avg({c}) AS mu", f"stddev_samp({c}) AS sd"]
            conds.append(f"(CASE WHEN coalesce(sd, 0) > 0 THEN ({c} IS NULL OR (({c} - mu) / sd >= -{factor} "
                         f"AND ({c} - mu) / sd <= {factor})) ELSE TRUE END)")
        ctes.append(f"st{i} AS (SELECT {', '.join(stats)} FROM {prev})")
        ctes.append(f"{cur} AS (SELECT {prev}.* FROM {prev} CROSS JOIN st{i} WHERE {' AND '.join(conds)})")
    last = f"s{len(cols)}"
    return (W_ + ",\n".join(ctes) + "\n"
            + typed_select(f"(SELECT event_name, count(*) AS kept, sum(product_value) AS kept_value FROM {last} "
                           "GROUP BY event_name)", [("event_name", "s"), ("kept", "l"), ("kept_value", "d")]))


def _outlier_query(name, method):
    @register(name, _outlier_sql(method))
    def q(spark, sf_dir):
        t = testbed.tickets(spark, sf_dir).select("event_name", "product_value", "quantity")
        kept = C.remove_outliers(t, ["product_value", "quantity"], method, 1.5)
        return finish(kept.groupBy("event_name").agg(F.count(F.lit(1)).alias("kept"),
                                                     F.sum("product_value").alias("kept_value")))
    q.__name__ = f"q_{name}"
    return q


q_outliers_iqr = _outlier_query("outliers_iqr", "IQR")            # F12
q_outliers_zscore = _outlier_query("outliers_zscore", "zscore")   # F13
q_outliers_combined = _outlier_query("outliers_combined", "combined")  # F14


# ----------------------------------------------------------------- F15
PRICE_SQL = W_ + """m AS (SELECT event_name, quantile_cont(product_value, 0.5) AS med FROM tickets GROUP BY 1),
u AS (SELECT t.event_name, CASE WHEN m.med > 250 THEN t.product_value / 100 ELSE t.product_value END
             / CASE WHEN coalesce(t.quantity, 1) = 0 THEN 1.0 ELSE coalesce(t.quantity, 1) END AS unit_price
      FROM (SELECT * REPLACE (CASE WHEN line_no % 7 = 3 THEN NULL ELSE quantity END AS quantity) FROM tickets) t LEFT JOIN m ON t.event_name = m.event_name)
""" + typed_select("(SELECT event_name, count(*) AS kept, avg(unit_price) AS avg_unit_price FROM u "
                   "WHERE unit_price > 0 AND unit_price < 200 GROUP BY 1)",
                   [("event_name", "s"), ("kept", "l"), ("avg_unit_price", "d")])


@register("price_sanity", PRICE_SQL)
def q_price_sanity(spark, sf_dir):
    """cents rule by per-event median, per-unit price, plausible band; some tickets are
    read without a quantity and count as one piece."""
    given = F.when(F.col("line_no") % 7 != 3, F.col("quantity")).alias("quantity")
    t = testbed.tickets(spark, sf_dir).select("event_name", "product_value", given)
    kept = C.price_sanity(t, group_bound=table_rows(spark, f"{sf_dir}/supplier.parquet"))
    return finish(kept.groupBy("event_name").agg(F.count(F.lit(1)).alias("kept"),
                                                 F.avg("unit_price").alias("avg_unit_price")))


# ----------------------------------------------------------------- F10 F11 X09 X21 X22 X29
CAREFUL_SQL = WB + """c AS (SELECT
   CASE WHEN lower(gender) IN ('male', 'man') THEN 'man' WHEN lower(gender) IN ('female', 'woman', 'vrouw') THEN 'woman'
        WHEN lower(gender) = 'nonbinary' THEN 'nonbinary' END AS gender_clean,
   CASE WHEN age > 0 AND age <= 25 THEN '<25' WHEN age > 25 AND age <= 35 THEN '25-35'
        WHEN age > 35 AND age <= 45 THEN '35-45' WHEN age > 45 AND age <= 55 THEN '45-55'
        WHEN age > 55 AND age <= 100 THEN '55+' END AS age_category,
   CASE WHEN max_capacity >= 3000 THEN 'festival' ELSE 'club' END AS venue_type,
   CAST(month(verkoopdatum) AS INTEGER) AS sale_month, CAST(month(event_date) AS INTEGER) AS event_month
  FROM tb WHERE NOT coalesce(product_value < 0, false) AND NOT (verkoopdatum IS NULL AND event_date IS NULL))
""" + typed_select("(SELECT gender_clean, age_category, venue_type, sale_month, event_month, count(*) AS n FROM c "
                   "GROUP BY ALL)", [("gender_clean", "s"), ("age_category", "s"), ("venue_type", "s"),
                                     ("sale_month", "i"), ("event_month", "i"), ("n", "l")])


@register("clean_careful", CAREFUL_SQL)
def q_clean_careful(spark, sf_dir):
    """F10 F11 X09(clean) X21 X22 X29: careful cleaning profile."""
    t = testbed.tickets(spark, sf_dir, with_buyer=True)
    t = t.where(C.drop_negative(F.col("product_value"))).where(
        ~C.both_missing(F.col("verkoopdatum"), F.col("event_date")))
    t = t.select(N.gender_std(F.col("gender"), "clean").alias("gender_clean"),
                 N.age_category(F.col("age")).alias("age_category"),
                 N.venue_type(F.col("max_capacity")).alias("venue_type"),
                 F.month("verkoopdatum").alias("sale_month"), F.month("event_date").alias("event_month"))
    return finish(t.groupBy(*t.columns).agg(F.count(F.lit(1)).alias("n")))


# ----------------------------------------------------------------- X03 X01 X02
@register("canonical_event_name", W_ + typed_select(
    "(SELECT DISTINCT event_name, split_part(event_name, ' - ', 1) || ' - ' || strftime(event_date, '%Y-%m-%d') "
    "AS canonical_name FROM tickets)", [("event_name", "s"), ("canonical_name", "s")]))
def q_canonical_event_name(spark, sf_dir):
    """Canonical event name = name before ' - ' + ' - ' + ISO date."""
    t = testbed.tickets(spark, sf_dir)
    return finish(t.select("event_name", canonical_event_name(F.col("event_name"), F.col("event_date"))
                           .alias("canonical_name")).distinct())


@register("normalize_text", "WITH d AS (SELECT doc_id, " + norm("text") + " AS text_norm FROM documents)\n"
          + typed_select("d", [("doc_id", "l"), ("text_norm", "s")]))
def q_normalize_text(spark, sf_dir):
    """NFKD/ASCII/lower/strip over whole documents; Python gets only texts beyond ASCII, a few at a time."""
    d = testbed.read(spark, sf_dir, "documents").select("doc_id", "text")
    return finish(d.select("doc_id", normalize_text(F.col("text")).alias("text_norm")))


# ----------------------------------------------------------------- X04-X06 X10 X12 X24
COERCE_SQL = W_ + """c AS (SELECT event_name,
   CAST(replace(printf('%.2f', product_value), '.', ',') AS VARCHAR) AS price_str,
   CAST(quantity AS INTEGER) || ',5°C' AS temp_str,
   strftime(verkoopdatum, '%Y-%m-%d %H:%M:%S') AS sale_str, verkoopdatum, product_value, product_fees FROM tickets)
""" + typed_select("""(SELECT event_name,
   sum(TRY_CAST(replace(price_str, ',', '.') AS DOUBLE)) AS parsed_price_sum,
   sum(TRY_CAST(trim(replace(regexp_replace(temp_str, '°C|mm|km/u', '', 'g'), ',', '.')) AS DOUBLE)) AS parsed_temp_sum,
   count(TRY_CAST(sale_str AS TIMESTAMP)) AS parsed_sale_ts,
   count(*) FILTER (WHERE date_trunc('day', verkoopdatum) = verkoopdatum) AS midnight_sales,
   count(TRY_CAST(replace(CASE WHEN product_value > 50000 THEN 'n/a' ELSE price_str END, ',', '.') AS DOUBLE)) AS bad_strings_as_null,
   sum(product_value + product_fees) AS total_price_sum
  FROM c GROUP BY event_name)""", [("event_name", "s"), ("parsed_price_sum", "d"), ("parsed_temp_sum", "d"),
                                   ("parsed_sale_ts", "l"), ("midnight_sales", "l"), ("bad_strings_as_null", "l"),
                                   ("total_price_sum", "d")])


@register("coerce_types", COERCE_SQL)
def q_coerce_types(spark, sf_dir):
    """Text-to-type coercions that never raise."""
    from salescast.functions.dates import parse_ts
    t = testbed.tickets(spark, sf_dir)
    price_str = F.regexp_replace(F.format_string("%.2f", F.col("product_value")), r"\.", ",")
    c = t.select("event_name", "verkoopdatum", "product_value", "product_fees",
                 price_str.alias("price_str"),
                 F.concat(F.col("quantity").cast("int").cast("string"), F.lit(",5°C")).alias("temp_str"),
                 F.date_format("verkoopdatum", "yyyy-MM-dd HH:mm:ss").alias("sale_str"))
    bad = F.when(F.col("product_value") > 50000, F.lit("n/a")).otherwise(F.col("price_str"))
    return finish(c.groupBy("event_name").agg(
        F.sum(N.european_decimal(F.col("price_str"))).alias("parsed_price_sum"),
        F.sum(N.strip_units(F.col("temp_str"))).alias("parsed_temp_sum"),
        F.count(parse_ts(F.col("sale_str"))).alias("parsed_sale_ts"),
        F.count_if(to_midnight(F.col("verkoopdatum")) == F.col("verkoopdatum")).alias("midnight_sales"),
        F.count(N.european_decimal(bad)).alias("bad_strings_as_null"),
        F.sum(F.col("product_value") + F.col("product_fees")).alias("total_price_sum")))


AGE_SQL = WB + """a AS (SELECT verkoopdatum,
   make_date(CAST(1950 + buyer_key % 50 AS BIGINT), CAST(1 + buyer_key % 12 AS BIGINT), CAST(1 + buyer_key % 28 AS BIGINT)) AS dob
   FROM tb),
b AS (SELECT year(verkoopdatum) - year(dob) AS age_years,
             round(datediff('day', dob, CAST(verkoopdatum AS DATE)) / 365.25, 2) AS age_exact FROM a)
""" + typed_select("""(SELECT CASE WHEN age_exact >= 0 AND age_exact < 18 THEN '0-17' WHEN age_exact >= 18 AND age_exact < 25 THEN '18-24'
   WHEN age_exact >= 25 AND age_exact < 35 THEN '25-34' WHEN age_exact >= 35 AND age_exact < 45 THEN '35-44'
   WHEN age_exact >= 45 AND age_exact < 60 THEN '45-59' WHEN age_exact >= 60 AND age_exact < 120 THEN '60+' END AS age_bin,
   CASE WHEN age_years > 0 AND age_years <= 25 THEN '<25' WHEN age_years > 25 AND age_years <= 35 THEN '25-35'
   WHEN age_years > 35 AND age_years <= 45 THEN '35-45' WHEN age_years > 45 AND age_years <= 55 THEN '45-55'
   WHEN age_years > 55 AND age_years <= 100 THEN '55+' END AS age_category, count(*) AS n FROM b GROUP BY ALL)""",
                   [("age_bin", "s"), ("age_category", "s"), ("n", "l")])


@register("age_bins", AGE_SQL)
def q_age_bins(spark, sf_dir):
    """Both age definitions (year difference / fractional years) and their bins."""
    t = testbed.tickets(spark, sf_dir, with_buyer=True)
    k = F.col("buyer_key")
    dob = F.make_date((F.lit(1950) + k % 50).cast("int"), (F.lit(1) + k % 12).cast("int"),
                      (F.lit(1) + k % 28).cast("int"))
    a = t.select("verkoopdatum", dob.alias("dob"))
    b = a.select((F.year("verkoopdatum") - F.year("dob")).alias("age_years"),
                 F.round(F.datediff(F.to_date("verkoopdatum"), F.col("dob")) / 365.25, 2).alias("age_exact"))
    out = b.select(N.age_bin(F.col("age_exact")).alias("age_bin"),
                   N.age_category(F.col("age_years")).alias("age_category"))
    return finish(out.groupBy("age_bin", "age_category").agg(F.count(F.lit(1)).alias("n")))


@register("payment_map", WB + typed_select("""(SELECT CASE lower(payment_method) WHEN 'ideal' THEN 'iDeal'
   WHEN 'creditcard' THEN 'Card' WHEN 'paypal' THEN 'PayPal' ELSE 'Other' END AS payment_category,
   count(*) AS n, count(*) FILTER (WHERE coalesce(product_refunded_amount > 0, false)) AS refunded,
   sum(product_value + product_fees) AS total_price FROM tb GROUP BY 1)""",
    [("payment_category", "s"), ("n", "l"), ("refunded", "l"), ("total_price", "d")]))
def q_payment_map(spark, sf_dir):
    """Payment categories, refunded flag, total price."""
    t = testbed.tickets(spark, sf_dir, with_buyer=True)
    refunded = F.coalesce(F.col("product_refunded_amount") > 0, F.lit(False))
    return finish(t.groupBy(N.payment_category(F.col("payment_method")).alias("payment_category")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(refunded).alias("refunded"),
        F.sum(F.col("product_value") + F.col("product_fees")).alias("total_price")))


# ----------------------------------------------------------------- F05 F03 F17 F01 F02
@register("plausible_range", W_ + typed_select(
    "(SELECT data_source, count(*) AS n FROM tickets WHERE verkoopdatum IS NOT NULL AND verkoopdatum BETWEEN "
    "TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-01-01' GROUP BY 1)", [("data_source", "s"), ("n", "l")]))
def q_plausible_range(spark, sf_dir):
    """plausible sale-date range and non-null."""
    t = testbed.tickets(spark, sf_dir).where(C.in_range(F.col("verkoopdatum"), "1996-01-01", "2000-01-01"))
    return finish(t.groupBy("data_source").agg(F.count(F.lit(1)).alias("n")))


SENTINEL = "2001-06-30"


@register("past_cutoff", W_ + typed_select(
    f"(SELECT event_name, count(*) AS n FROM tickets WHERE NOT coalesce(CAST(first_event_date_start AS DATE) > "
    f"DATE '{ASOF}', false) AND verkoopdatum <= TIMESTAMP '{SENTINEL}' GROUP BY 1)", [("event_name", "s"), ("n", "l")]))
def q_past_cutoff(spark, sf_dir):
    """Past events at the as-of date and sales up to a sentinel date."""
    from salescast.operators.features import past_events
    t = past_events(testbed.tickets(spark, sf_dir), ASOF)
    t = t.where(F.col("verkoopdatum") <= F.lit(SENTINEL).cast("timestamp_ntz"))
    return finish(t.groupBy("event_name").agg(F.count(F.lit(1)).alias("n")))


@register("text_filters", "WITH d AS (SELECT lang FROM documents WHERE text IS NOT NULL AND text <> '' AND "
          "NOT coalesce(contains(lower(text), 'license'), false))\n"
          + typed_select("(SELECT lang, count(*) AS n FROM d GROUP BY 1)", [("lang", "s"), ("n", "l")]))
def q_text_filters(spark, sf_dir):
    """Non-empty texts that do not mention 'license' (case-insensitive)."""
    d = testbed.read(spark, sf_dir, "documents")
    d = d.where(C.non_empty(F.col("text"))).where(C.not_contains_ci(F.col("text"), "license"))
    return finish(d.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))


# ----------------------------------------------------------------- P15 O04
CONST_COLS = ["data_source", "ticket_type", "gender", "payment_method", "max_capacity", "product_is_scanned"]


@register("constant_columns", WB + "w AS (SELECT " + ", ".join(
    f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS {c}" for c in CONST_COLS)
    + " FROM tb),\nu AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column, {c} AS n_unique FROM w" for c in CONST_COLS)
    + ")\n" + typed_select("(SELECT \"column\", n_unique, CASE WHEN n_unique <= 1 THEN 1 ELSE 0 END AS is_constant "
                           "FROM u)", [('"column"', "s"), ("n_unique", "l"), ("is_constant", "i")]))
def q_constant_columns(spark, sf_dir):
    """Constant-column detector (nunique with nulls counted)."""
    return finish(an.constant_columns(testbed.tickets(spark, sf_dir, with_buyer=True), CONST_COLS))


@register("sample_rows", W_ + typed_select(
    "(SELECT barcode, event_name, product_value FROM tickets ORDER BY md5('42|' || barcode || '|' || event_name), product_value LIMIT 20)",
    [("barcode", "s"), ("event_name", "s"), ("product_value", "d")]))
def q_sample_rows(spark, sf_dir):
    """Random sample of 20 tickets (sampling is the feature), the same however the rows are dealt."""
    t = testbed.tickets(spark, sf_dir).select("barcode", "event_name", "product_value")
    return finish(C.sample_rows(t, 20, ["barcode", "event_name"], 42, ["product_value"]))


# ----------------------------------------------------------------- S08 O01 P08 P13 X11 X12 P10 A32 O03 X18
from salescast.functions.dates import event_duration_hours  # noqa: E402
from salescast.functions.numeric import inf_to_null  # noqa: E402
from salescast.plans.oracle_base import WEATHER_DAILY  # noqa: E402
from salescast.sources import readers as R  # noqa: E402

PROC_COLS = ["barcode", "event_name", "event_date", "first_event_date_start", "first_event_date_start_with_time",
             "verkoopdatum", "product_value", "total_price", "product_is_scanned", "age", "gender", "city",
             "t_max", "t_min", "rain_fall", "max_wind", "data_source"]
PROC_SPEC = [("barcode", "s"), ("event_name", "s"), ("event_date", "t"), ("first_event_date_start", "t"),
             ("first_event_date_start_with_time", "t"), ("verkoopdatum", "t"), ("product_value", "d"),
             ("total_price", "d"), ("product_is_scanned", "i"), ("age", "d"), ("gender", "s"), ("city", "s"),
             ("t_max", "d"), ("t_min", "d"), ("rain_fall", "d"), ("max_wind", "d"), ("data_source", "s")]
PROC_SQL = "WITH " + TICKETS_BUYER_ONCE + ",\n" + WEATHER_DAILY + """,
tw AS (SELECT tb.*, w.t_max, w.t_min, w.rain_fall, w.max_wind FROM tb
       LEFT JOIN wdaily w ON make_date(2024, 1, day(tb.first_event_date_start)) = w.event_date),
mu AS (SELECT avg(t_max) a1, avg(t_min) a2, avg(rain_fall) a3, avg(max_wind) a4 FROM tw),
p AS (SELECT barcode, event_name, coalesce(event_date, first_event_date_start) AS event_date,
        date_trunc('day', first_event_date_start) AS first_event_date_start,
        first_event_date_start AS first_event_date_start_with_time, verkoopdatum,
        CASE WHEN isinf(product_value) THEN NULL ELSE product_value END AS product_value,
        CASE WHEN isinf(total_price) THEN NULL ELSE total_price END AS total_price,
        product_is_scanned, age, gender, city, coalesce(t_max, a1) AS t_max, coalesce(t_min, a2) AS t_min,
        coalesce(rain_fall, a3) AS rain_fall, coalesce(max_wind, a4) AS max_wind, data_source
      FROM tw CROSS JOIN mu WHERE verkoopdatum IS NOT NULL AND first_event_date_start IS NOT NULL)
""" + typed_select("(SELECT * FROM p ORDER BY verkoopdatum, event_name)", PROC_SPEC)


def processed_tickets(spark, sf_dir):
    """Training-side ETL tail: required columns (S12), event date from the start (P08),
    midnight start with the original kept (X11 X12), +/-inf -> null (P13), weather
    mean fill (J01 P10), non-null dates (F05), sorted at the sink (O01)."""
    from salescast.operators.weather import daily_weather, fill_global_mean, join_weather
    t = testbed.tickets(spark, sf_dir, with_buyer=True, dedup=True)
    R.require_columns(t, ["event_name", "event_date", "barcode", "product_value", "first_event_date_start"])
    daily = daily_weather(testbed.weather_raw(spark, sf_dir))
    t = join_weather(t, daily, testbed.weather_key(F.col("first_event_date_start")))
    t = t.select(*[c for c in PROC_COLS if c in t.columns])
    t = fill_global_mean(materialize(t, "weather_joined"))  # read for the means and for the rows
    t = (t.withColumn("event_date", F.coalesce("event_date", "first_event_date_start"))
         .withColumn("first_event_date_start_with_time", F.col("first_event_date_start"))
         .withColumn("first_event_date_start", to_midnight(F.col("first_event_date_start")))
         .withColumn("product_value", inf_to_null(F.col("product_value")))
         .withColumn("total_price", inf_to_null(F.col("total_price"))))
    t = t.where(F.col("verkoopdatum").isNotNull() & F.col("first_event_date_start").isNotNull())
    return t.select(*PROC_COLS)


@register("processed_tickets", PROC_SQL)
def q_processed_tickets(spark, sf_dir):
    """The processed ticket table, written in order of sale, one folder a
    month, and read back."""
    root = os.path.join(ensure_checkpoint_dir(spark), "tables", f"processed-{uuid.uuid4().hex}")
    write_ordered(processed_tickets(spark, sf_dir), root, "verkoopdatum", ["verkoopdatum", "event_name", "barcode"])
    return finish(read_current(spark, root).select(*PROC_COLS))


@register("processed_months", PROC_SQL.rsplit("\nSELECT", 1)[0] + "\n" + typed_select(
    "(SELECT strftime(verkoopdatum, '%Y-%m') AS month, count(*) AS tickets, sum(product_value) AS value, "
    "min(verkoopdatum) AS first_sale, max(verkoopdatum) AS last_sale FROM p "
    "WHERE verkoopdatum >= TIMESTAMP '1999-06-01' AND verkoopdatum < TIMESTAMP '1999-09-01' GROUP BY 1)",
    [("month", "s"), ("tickets", "l"), ("value", "d"), ("first_sale", "t"), ("last_sale", "t")]))
def q_processed_months(spark, sf_dir):
    """Three months of the stored ticket table; only their folders are read."""
    root = os.path.join(ensure_checkpoint_dir(spark), "tables", f"processed-{uuid.uuid4().hex}")
    write_ordered(processed_tickets(spark, sf_dir), root, "verkoopdatum", ["verkoopdatum", "event_name", "barcode"])
    t = read_current(spark, root).where(F.col("month").between("1999-06", "1999-08"))
    return finish(t.groupBy("month").agg(
        F.count(F.lit(1)).alias("tickets"), F.sum("product_value").alias("value"),
        F.min("verkoopdatum").alias("first_sale"), F.max("verkoopdatum").alias("last_sale")))


BUCKET_SQL = WB + """b AS (SELECT city, count(*) AS tickets, count(DISTINCT order_id) AS orders, sum(product_value) AS value FROM tb GROUP BY 1)
""" + typed_select("b", [("city", "s"), ("tickets", "l"), ("orders", "l"), ("value", "d")])


def bucketed_ticket_buyers(spark, sf_dir):
    """Tickets with their buyer, both stored in buckets of the order: the join moves no rows."""
    t = testbed.tickets(spark, sf_dir).select("order_key", "order_id", "event_name", "verkoopdatum", "product_value")
    n = bucket_count(table_rows(spark, f"{sf_dir}/lineitem.parquet"), row_width(t))
    root, tag = os.path.join(ensure_checkpoint_dir(spark), "buckets", uuid.uuid4().hex), uuid.uuid4().hex
    t = write_bucketed(t, f"tickets_{tag}", f"{root}/tickets", "order_key", n)
    b = write_bucketed(testbed.buyers(spark, sf_dir), f"buyers_{tag}", f"{root}/buyers", "o_orderkey", n)
    return t.join(b.hint("merge"), t["order_key"] == b["o_orderkey"])


@register("bucketed_ticket_buyers", BUCKET_SQL)
def q_bucketed_ticket_buyers(spark, sf_dir):
    """Tickets joined with buyers from bucketed tables without an exchange; per buyer city."""
    per_order = bucketed_ticket_buyers(spark, sf_dir).groupBy("order_key", "city").agg(
        F.count(F.lit(1)).alias("tickets"), F.sum("product_value").alias("value"))
    return finish(per_order.groupBy("city").agg(F.sum("tickets").alias("tickets"), F.count(F.lit(1)).alias("orders"),
                                                F.sum("value").alias("value")))


REMOVAL_SQL = W_ + """d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY
      CASE data_source WHEN 'shop_f' THEN 0 ELSE 1 END, verkoopdatum, product_value, event_name, line_no) AS rn
      FROM tickets) WHERE rn = 1),
k AS (SELECT * FROM d WHERE verkoopdatum IS NOT NULL AND verkoopdatum BETWEEN TIMESTAMP '1996-01-01'
      AND TIMESTAMP '2000-01-01' AND NOT coalesce(product_value < 0, false))
""" + typed_select("(SELECT (SELECT count(*) FROM tickets) AS before, (SELECT count(*) FROM d) AS after_dedup, "
                   "(SELECT count(*) FROM k) AS after_filters, 100.0 * (1 - (SELECT count(*) FROM k) / "
                   "(SELECT count(*) FROM tickets)) AS removed_pct)",
                   [("before", "l"), ("after_dedup", "l"), ("after_filters", "l"), ("removed_pct", "d")])


@register("removal_counts", REMOVAL_SQL)
def q_removal_counts(spark, sf_dir):
    """before/after record counts and removal % through dedup and range/price filters."""
    t = testbed.tickets(spark, sf_dir).select("barcode", "event_name", "verkoopdatum", "product_value",
                                              "data_source", "line_no")
    kept = C.dedup_tickets(t)
    stays = C.in_range(F.col("verkoopdatum"), "1996-01-01", "2000-01-01") & C.drop_negative(F.col("product_value"))
    after = kept.agg(F.count(F.lit(1)).alias("after_dedup"), F.count_if(stays).alias("after_filters"))
    out = attach_one_row(t.agg(F.count(F.lit(1)).alias("before")), after)
    return finish(out.withColumn("removed_pct", F.lit(100.0) * (F.lit(1.0) - F.col("after_filters") / F.col("before"))))


@register("top_selling_events", W_ + typed_select(
    "(SELECT event_name, count(*) AS tickets FROM tickets WHERE event_name IS NOT NULL GROUP BY 1 "
    "HAVING count(*) >= 50 ORDER BY tickets DESC, event_name LIMIT 10)", [("event_name", "s"), ("tickets", "l")]))
def q_top_selling_events(spark, sf_dir):
    """The ten best-selling events with at least 50 tickets (top-k is the feature)."""
    t = testbed.tickets(spark, sf_dir).where(F.col("event_name").isNotNull())
    c = t.groupBy("event_name").agg(F.count(F.lit(1)).alias("tickets")).where(F.col("tickets") >= 50)
    return finish(an.top_k(c, "tickets", 10, "event_name"))


@register("event_duration_modes", "WITH " + TICKETS.split(",\ntickets AS")[0] + """,
h AS (SELECT event_name, (epoch_us(last_event_date_end) - epoch_us(first_event_date_start)) / 3600000000.0 AS hrs FROM ev)
""" + typed_select("(SELECT event_name, CASE WHEN hrs < 0 OR hrs > 720 THEN NULL ELSE hrs END AS duration_batch, "
                   "coalesce(least(greatest(hrs, 1.0), 720.0), 4.0) AS duration_live FROM h)",
                   [("event_name", "s"), ("duration_batch", "d"), ("duration_live", "d")]))
def q_event_duration_modes(spark, sf_dir):
    """Event duration, batch rule (null outside [0, 720] h) and live rule (clip [1, 720], default 4)."""
    ev = testbed.event_dim(spark, sf_dir)
    return finish(ev.select("event_name",
                            event_duration_hours("first_event_date_start", "last_event_date_end").alias("duration_batch"),
                            event_duration_hours("first_event_date_start", "last_event_date_end", "live")
                            .alias("duration_live")))
