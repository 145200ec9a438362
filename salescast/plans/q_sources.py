"""Source / sink queries."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.sources import readers as R
from salescast.plans.oracle_base import TICKETS, typed_select
from salescast.plans.registry import finish, register
from salescast.session import ensure_checkpoint_dir
from salescast.sources import testbed

CANON = T.StructType([T.StructField(n, t) for n, t in [
    ("barcode", T.StringType()), ("event_name", T.StringType()), ("verkoopdatum", T.TimestampNTZType()),
    ("ticket_type", T.StringType()), ("product_value", T.DoubleType()), ("product_fees", T.DoubleType()),
    ("data_source", T.StringType())]])

# Per-source rename maps (P01): source column -> canonical column.
RENAMES_F = {"created_at": "verkoopdatum", "ticket_name": "ticket_type"}
RENAMES_O = {"Sale Date": "verkoopdatum", "Ticket Type": "ticket_type", "Price": "product_value"}


# Lines that the exports spoil: a price that is no number; too few and too many columns.
SPOILED = {"value": "data_source = 'shop_f' AND line_no = 6", "short": "data_source = 'shop_o' AND line_no = 7",
           "long": "data_source = 'shop_o' AND line_no = 6"}


def _ingest_exports(spark, sf_dir):
    """Two differently shaped exports with some broken lines are written and read as configured
    sources; the second one's separator is declared wrong, a third source is missing."""
    root = os.path.join(ensure_checkpoint_dir(spark), "exports", uuid.uuid4().hex)
    t = testbed.tickets(spark, sf_dir)
    names_a = ["barcode", "event_name", "created_at", "ticket_name", "product_value", "product_fees"]
    a = t.where(F.col("data_source") == "shop_f").select(
        "barcode", "event_name", F.col("verkoopdatum").cast("string").alias("created_at"),
        F.col("ticket_type").alias("ticket_name"),
        F.when(F.expr(SPOILED["value"]), F.lit("n/a")).otherwise(F.col("product_value").cast("string")).alias("product_value"),
        "product_fees")
    R.write_table(a, f"{root}/f", "csv")
    # second export: text lines without header, other separator and names, no fee column
    names_b = ["barcode", "event_name", "Sale Date", "Ticket Type", "Price"]
    full = F.concat_ws(";", "barcode", "event_name", F.col("verkoopdatum").cast("string"), "ticket_type", "product_value")
    b = t.where(F.col("data_source") == "shop_o").select(
        F.when(F.expr(SPOILED["short"]), F.concat_ws(";", "barcode", "event_name"))
        .when(F.expr(SPOILED["long"]), F.concat(full, F.lit(";more;columns"))).otherwise(full).alias("value"))
    b.write.text(f"{root}/o")

    def schema(names, numbers):
        return T.StructType([T.StructField(n, T.DoubleType() if n in numbers else T.StringType()) for n in names])

    schema_b = schema(names_b, {"Price"})
    return R.ingest_sources(spark, [
        R.SourceSpec("shop_f", f"{root}/f", renames=RENAMES_F, primary=True, schema=schema(names_a, {"product_value", "product_fees"})),
        R.SourceSpec("shop_o", f"{root}/o", sep=",", renames=RENAMES_O, schema=schema_b, header=False),
        R.SourceSpec("shop_x", f"{root}/x", renames=RENAMES_O, schema=schema_b)])


_GOOD = "(SELECT * FROM tickets WHERE NOT (" + " OR ".join(f"({c})" for c in SPOILED.values()) + "))"


@register("union_sources", "WITH " + TICKETS + "\n" + typed_select(
    "(SELECT data_source, count(*) AS n, count(CASE WHEN data_source = 'shop_f' THEN product_fees END) AS with_fees, "
    f"count(ticket_type) AS with_type, sum(product_value) AS value FROM {_GOOD} GROUP BY 1)",
    [("data_source", "s"), ("n", "l"), ("with_fees", "l"), ("with_type", "l"), ("value", "d")]))
def q_union_sources(spark, sf_dir):
    """Two differently shaped exports with broken lines are
    read in the dialect their lines support, without the rejected lines, standardised, unioned
    by name (missing columns null) and conformed; a missing source adds nothing."""
    u = R.conform(_ingest_exports(spark, sf_dir).good, CANON)
    R.require_columns(u, ["event_name", "barcode", "product_value"])
    return finish(u.groupBy("data_source").agg(F.count(F.lit(1)).alias("n"), F.count("product_fees").alias("with_fees"),
                                               F.count("ticket_type").alias("with_type"),
                                               F.sum("product_value").alias("value")))


@register("rejected_lines", "WITH " + TICKETS + ",\nr AS (SELECT data_source, barcode, CASE WHEN " + SPOILED["value"]
          + " THEN 'value' ELSE 'columns' END AS reason FROM tickets WHERE " + " OR ".join(f"({c})" for c in SPOILED.values())
          + ")\nSELECT data_source, reason, barcode, count(*) AS lines FROM r GROUP BY ALL")
def q_rejected_lines(spark, sf_dir):
    """The lines that the scans of union_sources rejected, with source and reason."""
    bad = _ingest_exports(spark, sf_dir).rejected
    return finish(bad.groupBy("data_source", "reason", F.regexp_extract("line", "^[^,;]*", 0).alias("barcode")).agg(
        F.count(F.lit(1)).alias("lines")))


LOADER_SQL = "WITH " + TICKETS + """,
t AS (SELECT lower(event_name) AS event_name, count(*) AS tickets, min(verkoopdatum) AS first_sale FROM tickets GROUP BY 1)
""" + typed_select("(SELECT *, 0 AS lineup_rows FROM t)", [("event_name", "s"), ("tickets", "l"), ("first_sale", "t"),
                                                            ("lineup_rows", "l")])


@register("normalising_loader", LOADER_SQL)
def q_normalising_loader(spark, sf_dir):
    """The ticket table written as CSV by month and loaded again with folded keys
    and parsed dates; the line-up table is missing and loads as an empty one."""
    root = os.path.join(ensure_checkpoint_dir(spark), "exports", uuid.uuid4().hex)
    t = testbed.tickets(spark, sf_dir).select(
        "barcode", "event_name", "verkoopdatum", F.date_format("verkoopdatum", "yyyy-MM").alias("month"))
    R.write_table(t, f"{root}/tickets", "csv", ["month"])
    kinds = {"tickets": "barcode string, event_name string, verkoopdatum string, month string",
             "line_up": "event_name string, event_date string, artist string"}
    schemas = {k: T._parse_datatype_string(v) for k, v in kinds.items()}
    tickets, line_up, _ = R.load_normalised(spark, f"{root}/tickets", f"{root}/line_up", schemas=schemas)
    n = line_up.groupBy("event_name").agg(F.count(F.lit(1)).alias("lineup_rows"))
    out = tickets.groupBy("event_name").agg(F.count(F.lit(1)).alias("tickets"),
                                            F.min(F.col("verkoopdatum").cast("timestamp_ntz")).alias("first_sale"))
    return finish(out.join(n, "event_name", "left").fillna(0, ["lineup_rows"]))


JSON_SQL = """WITH r AS (SELECT CAST(ts AS DATE) AS event_date, value / 10 AS temp,
   CASE WHEN event_type IN ('click', 'view') THEN value / 100 END AS rain,
   CASE WHEN event_type = 'error' THEN value / 20 END AS gust, value / 40 AS speed FROM events)
""" + typed_select("(SELECT event_date, max(temp) AS t_max, min(temp) AS t_min, sum(coalesce(rain, 0.0)) AS rain_fall, "
                   "max(coalesce(gust, speed, 0.0) * 3.6) AS max_wind FROM r GROUP BY 1)",
                   [("event_date", "t"), ("t_max", "d"), ("t_min", "d"), ("rain_fall", "d"), ("max_wind", "d")])


@register("json_payload", JSON_SQL)
def q_json_payload(spark, sf_dir):
    """Landed JSON forecast entries (one document per observation, optional
    rain/gust) parsed with an explicit schema, flattened and rolled up per day."""
    ev = testbed.read(spark, sf_dir, "events")
    payload = F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("dt_txt"),
        F.struct((F.col("value") / 10).alias("temp_max"), (F.col("value") / 10).alias("temp_min")).alias("main"),
        F.when(F.col("event_type").isin("click", "view"), F.struct((F.col("value") / 100).alias("3h"))).alias("rain"),
        F.struct(F.when(F.col("event_type") == "error", F.col("value") / 20).alias("gust"),
                 (F.col("value") / 40).alias("speed")).alias("wind")))
    # Every third observation comes in an envelope, and unreadable answers lie between them.
    entry = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"list": ['), payload, F.lit("]}"))).otherwise(payload)
    bad = ev.where(F.col("event_id") % 50 == 0).select(F.lit('{"cod": 500}').alias("payload"))
    flat = R.flatten_forecast(ev.select(entry.alias("payload")).unionByName(bad))
    daily = (flat.groupBy(F.to_date("obs_ts").alias("event_date"))
             .agg(F.max("temp_max").alias("t_max"), F.min("temp_min").alias("t_min"),
                  F.sum("rain_mm").alias("rain_fall"), F.max("wind_kmh").alias("max_wind")))
    return finish(daily)


@register("artist_payload", "WITH r AS (SELECT c_name AS artist, CAST(c_custkey % 100 AS DOUBLE) AS SpotifyPopularity, "
          "c_acctbal AS SpotifyFollowers, lower(c_mktsegment) || ', nation ' || CAST(c_nationkey AS VARCHAR) AS genres "
          "FROM customer)\n" + typed_select("r", [("artist", "s"), ("SpotifyPopularity", "d"),
                                                  ("SpotifyFollowers", "d"), ("genres", "s")]))
def q_artist_payload(spark, sf_dir):
    """Artist API JSON -> metrics row, genres list joined with ', '."""
    c = testbed.read(spark, sf_dir, "customer")
    payload = F.to_json(F.struct(
        F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("id"),
        (F.col("c_custkey") % 100).cast("double").alias("popularity"),
        F.struct(F.col("c_acctbal").alias("total")).alias("followers"),
        F.array(F.lower("c_mktsegment"), F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")))
        .alias("genres")))
    found = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit('{"artists": {"items": ['), payload, F.lit("]}}")))
    return finish(R.flatten_artist(c.select(F.coalesce(found, payload).alias("payload"))))


RAGGED_CSV_SQL = f"""
WITH {TICKETS}
SELECT CASE WHEN line_no = 1 THEN '' ELSE ticket_type END AS ticket_type,
       CASE WHEN line_no = 1 THEN '' ELSE data_source END AS data_source,
       count(*) AS n, count(*) FILTER (WHERE line_no <= 2) AS malformed
FROM tickets GROUP BY 1, 2
"""


@register("ragged_csv", RAGGED_CSV_SQL)
def q_ragged_csv(spark, sf_dir):
    """Write an export as ';'-separated text with short and
    long lines, read it back with an explicit schema in PERMISSIVE mode, pad short
    rows with ''.  The export is written under the shared checkpoint folder
    without a header line: the text writer emits one file per task, and a
    header read would drop the first line of each of them."""
    out = os.path.join(ensure_checkpoint_dir(spark), "exports", uuid.uuid4().hex)
    t = testbed.tickets(spark, sf_dir)
    line = (F.when(F.col("line_no") == 1, F.concat_ws(";", "barcode", "event_name"))          # short row
            .when(F.col("line_no") == 2, F.concat_ws(";", "barcode", "event_name", "ticket_type", "data_source",
                                                     F.lit("extra")))                          # long row
            .otherwise(F.concat_ws(";", "barcode", "event_name", "ticket_type", "data_source")))
    t.select(line.alias("value")).write.mode("overwrite").text(out)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in
                           ["barcode", "event_name", "ticket_type", "data_source"]])
    df = R.read_csv(spark, out, schema, sep=";", header=False)
    df = R.pad_missing(df, ["ticket_type", "data_source"])
    return finish(df.groupBy("ticket_type", "data_source").agg(F.count(F.lit(1)).alias("n"),
                                                               F.count("_corrupt").alias("malformed")))
