"""SQL text of the test-data binding for the DuckDB oracle.

Mirrors ``salescast.sources.testbed`` line by line; every oracle query starts
from these CTEs so the Spark and SQL sides read the same canonical rows.
"""

EV = """ev AS (
  SELECT s.s_suppkey AS event_key, s.s_name AS event_name, st.first_event_date_start,
         st.first_event_date_start + to_hours(CAST(4 + s.s_suppkey % 20 AS BIGINT)) AS last_event_date_end,
         CASE WHEN s.s_acctbal > 2000 THEN s.s_acctbal END AS max_capacity
  FROM (SELECT l_suppkey, max(l_shipdate) AS first_event_date_start FROM lineitem GROUP BY l_suppkey) st
  JOIN supplier s ON st.l_suppkey = s.s_suppkey
)"""

TICKETS = EV + """,
tickets AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS order_id,
         CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS barcode,
         ev.event_key, ev.event_name, ev.first_event_date_start, ev.last_event_date_end,
         ev.first_event_date_start AS event_date,
         l.l_shipdate + to_hours(CAST(3 * l.l_linenumber AS BIGINT)) AS verkoopdatum,
         l.l_extendedprice AS product_value,
         l.l_extendedprice * l.l_tax AS product_fees,
         l.l_extendedprice + l.l_extendedprice * l.l_tax AS total_price,
         CASE WHEN l.l_returnflag = 'R' THEN l.l_extendedprice * l.l_discount ELSE 0.0 END AS product_refunded_amount,
         CASE WHEN l.l_returnflag <> 'R' THEN 1 ELSE 0 END AS product_is_scanned,
         l.l_quantity AS quantity,
         CASE WHEN l.l_linestatus = 'F' THEN 'shop_f' ELSE 'shop_o' END AS data_source,
         CASE WHEN l.l_linenumber <= 2 THEN 'early bird' WHEN l.l_linenumber <= 5 THEN 'regular'
              ELSE 'late' END AS ticket_type,
         ev.max_capacity, l.l_orderkey AS order_key, l.l_linenumber AS line_no
  FROM lineitem l JOIN ev ON l.l_suppkey = ev.event_key
)"""

BUYERS = """buyers AS (
  SELECT o.o_orderkey, o.o_custkey AS buyer_key, n.n_name AS city, n.n_regionkey AS region_key,
         CAST(18 + c.c_custkey % 50 AS DOUBLE) AS age,
         CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'male' WHEN 'BUILDING' THEN 'Female'
              WHEN 'AUTOMOBILE' THEN 'nonbinary' WHEN 'FURNITURE' THEN 'Woman' END AS gender,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'ideal' WHEN '2-HIGH' THEN 'creditcard'
              WHEN '3-MEDIUM' THEN 'paypal' WHEN '5-LOW' THEN 'banktransfer' END AS payment_method
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

TICKETS_BUYER = TICKETS + ",\n" + BUYERS + """,
tb AS (SELECT t.*, b.* EXCLUDE (o_orderkey) FROM tickets t JOIN buyers b ON t.order_key = b.o_orderkey)"""

# the same after keep-first de-duplication on the barcode
TICKETS_BUYER_ONCE = TICKETS + ",\n" + BUYERS + """,
td AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY
         CASE data_source WHEN 'shop_f' THEN 0 ELSE 1 END, verkoopdatum, product_value, event_name, line_no) AS rn
       FROM tickets) WHERE rn = 1),
tb AS (SELECT t.*, b.* EXCLUDE (o_orderkey) FROM td t JOIN buyers b ON t.order_key = b.o_orderkey)"""

# floored lead days (trap T1) in DuckDB
LEAD_DAYS = "CAST(floor((epoch_us(first_event_date_start) - epoch_us(verkoopdatum)) / 86400000000.0) AS BIGINT)"

WEATHER_DAILY = """wraw AS (
  SELECT ts AS obs_ts, value / 10 AS temp,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / 10 AS rain_mm, value / 5 AS wind_kmh
  FROM events
),
wdaily AS (
  SELECT CAST(obs_ts AS DATE) AS event_date, max(temp) AS t_max, min(temp) AS t_min,
         sum(rain_mm) AS rain_fall, max(wind_kmh) AS max_wind
  FROM wraw GROUP BY 1
)"""

# X01 normalize_text in DuckDB (strip_accents keeps a few letters, hence the regex).
def norm(expr: str) -> str:
    ws = " || ".join(f"chr({i})" for i in (32, 9, 10, 11, 12, 13, 28, 29, 30, 31))
    return ("lower(trim(regexp_replace(strip_accents(" + expr + "), '[^\\x00-\\x7F]', '', 'g'), "
            + ws + "))")


def r4(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 4) AS {alias}"


def typed_select(source: str, spec: list[tuple[str, str]]) -> str:
    """Final SELECT with types pinned to the Spark side: d=double rounded to 4,
    i=INTEGER, l=BIGINT, anything else as is."""
    parts = []
    for name, kind in spec:
        if kind == "d":
            parts.append(f"round(CAST({name} AS DOUBLE), 4) AS {name}")
        elif kind == "i":
            parts.append(f"CAST({name} AS INTEGER) AS {name}")
        elif kind == "t":
            parts.append(f"CAST({name} AS TIMESTAMP) AS {name}")
        elif kind == "l":
            parts.append(f"CAST({name} AS BIGINT) AS {name}")
        else:
            parts.append(name)
    return f"SELECT {', '.join(parts)} FROM {source}"
