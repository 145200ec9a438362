"""Steps whose memory, shuffles and writes may not outgrow the input."""

import datetime as dt
import random
import unicodedata

from pyspark.sql import functions as F

from salescast.functions.text import clean_city, normalize_text, with_normalized
from salescast.operators import clean as C
from salescast.operators import cube
from salescast.operators import pipeline as pipe
from salescast.operators.artists import artist_asof, artist_block
from salescast.sources import testbed

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- names and texts

def test_texts_are_normalised_in_small_batches(spark):
    odd = ["", "  plain\t", "\x1c\x0bAB c\x85", " Caf\u00e9 \u00d8\n", "\ufb01ne \u00bd", "\u00a0x\u00a0", "\uac00b", "e\u0301\u0327", None]
    df = spark.createDataFrame([(s,) for s in odd], "s string")
    want = ["" if s is None else unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode().strip().lower() for s in odd]
    got = df.select(normalize_text("s").alias("n"))
    assert [r["n"] for r in got.collect()] == want
    # an Arrow batch holds 10,000 whole texts at once
    assert "BatchEvalPython" in plan(got) and "ArrowEvalPython" not in plan(got)


def test_names_are_normalised_without_shuffle(spark):
    df = spark.createDataFrame([("A ", 1), ("\u00c9lan", 2), (None, 3)], "name string, i int")
    got = with_normalized(df, "name")
    assert sorted(tuple(r) for r in got.select("i", "name").collect()) == [(1, "a"), (2, "elan"), (3, None)]
    assert "Exchange" not in plan(got) and "Join" not in plan(got)


def test_names_do_not_pass_through_python(spark):
    rng = random.Random(7)
    pool = [chr(c) for c in (*range(1, 0xD800), *range(0xE000, 0x30000))]
    odd = [c for c in pool if ord(c) > 127 and unicodedata.decomposition(c)]
    names = [f"A{c}b" for c in odd] + ["".join(rng.choices(pool + odd, k=7)) for _ in range(500)] + ["", " x\t", None]
    got = with_normalized(spark.createDataFrame(list(enumerate(names)), "i int, name string"), "name")
    want = [None if s is None else unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode().strip().lower() for s in names]
    assert [r["name"] for r in got.orderBy("i").collect()] == want
    assert "EvalPython" not in plan(got)


def test_cities_are_cleaned_as_by_patterns_alone(spark):
    cities = ["Rome", " New  York\t", "\nA\x0bB\fc\r", "\u00a0x", "", "  ", None]
    df = spark.createDataFrame([(c,) for c in cities], "c string")
    plain = F.regexp_replace(F.regexp_replace(F.lower("c"), r"^\s+|\s+$", ""), r"\s+", " ")
    assert [r[0] for r in df.select(clean_city(F.col("c"))).collect()] == [r[0] for r in df.select(plain).collect()]


# ---- ticket rows

def test_dealt_tickets_keep_the_same_rows(spark):
    rng = random.Random(5)
    rows = [(f"{i % 40}-{rng.randrange(3)}", str(i % 40), rng.choice(["shop_f", "shop_o", None]),
             rng.choice([None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)]), rng.choice([None, 1.0, 2.0]), "e", i)
            for i in range(400)]
    df = spark.createDataFrame(rows, "barcode string, __order string, data_source string, verkoopdatum timestamp_ntz, "
                                     "product_value double, event_name string, line_no int")
    want = C.dedup_tickets(df)
    got = C.dedup_tickets(df.repartition("__order"), dealt_by="__order")
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert plan(got).count("Exchange") == 1  # the given one


def ticket_files(spark, folder, orders, lines):
    ts = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(o, n, 1, ts, 1.0, p, 0.1, 0.1, "N", "F") for o, n, p in lines],
                          "l_orderkey long, l_linenumber int, l_suppkey long, l_shipdate timestamp_ntz, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
                          ).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(o, 1, "1-URGENT") for o in orders], "o_orderkey long, o_custkey long, o_orderpriority string"
                          ).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(1, 1, "MACHINERY")], "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(1, "N", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(1, "s", 3000.0)], "s_suppkey long, s_name string, s_acctbal double").write.parquet(f"{folder}/supplier.parquet")


def test_odd_order_keys_meet_their_buyers(spark, tmp_path):
    """Null and negative keys, copies of a barcode, a repeated order: as by two separate steps."""
    lines = [(5, None, 9.0), (None, 5, 1.0), (None, None, 1.0), (-5, 1, 2.0), (-5, 1, 1.0), (None, -5, 1.0), (7, 1, 3.0),
             (7, 1, 3.5), (7, 2, 1.0), (8, 1, 1.0)]
    ticket_files(spark, tmp_path, [5, -5, 7, 7, None], lines)
    got = testbed.tickets(spark, str(tmp_path), with_buyer=True, dedup=True)
    apart, b = testbed.tickets(spark, str(tmp_path), dedup=True), testbed.buyers(spark, str(tmp_path))
    want = apart.join(b, apart.order_key == b.o_orderkey).drop("o_orderkey")
    assert set(got.columns) == set(want.columns)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())) and got.count() >= 5


def test_ticket_rows_are_moved_once_and_written_once(spark, monkeypatch):
    t = testbed.tickets(spark, SF, with_buyer=True, dedup=True)
    assert "SinglePartition" not in plan(t) and plan(t).count("REPARTITION_BY_COL") == 1
    assert not [line for line in plan(t).splitlines() if "Exchange hashpartitioning(barcode" in line]
    written = []
    keep = pipe.materialize
    monkeypatch.setattr(pipe, "materialize", lambda df, label="t": written.append(label) or keep(df, label))
    pipe.prepare_tickets(testbed.tickets_full(spark, SF), testbed.known_cities(spark, SF), None, None, name_bound=10, city_bound=25)
    assert written == ["tickets_in"]


def test_dealt_tickets_are_sorted_by_numbers(spark):
    t = plan(testbed.tickets(spark, SF, with_buyer=True, dedup=True))
    ranked = next(line for line in t.splitlines() if "Window [" in line)
    assert "barcode" not in ranked and "__line" in ranked and "regexp_extract" not in t


# ---- horizon cube

def odd_tickets(spark, n=600):
    rng, rows = random.Random(11), []
    for i in range(n):
        lead = rng.choice([None, -3, *range(60)])
        start = dt.datetime(2024, 7, 20)
        rows.append((f"e{i % 3}", None if lead is None else start - dt.timedelta(days=lead), f"b{i}", start, start, rng.choice([None, 20.0, 35.5]),
                     rng.choice(["male", "female", None]), rng.choice(["x", "y"]), float(i % 7), 2.0, i % 2, None, rng.choice([None, 20.0 + i % 3]),
                     10.0, 0.0, 5.0, lead))
    return spark.createDataFrame(rows, "event_name string, verkoopdatum timestamp_ntz, barcode string, first_event_date_start timestamp_ntz, "
                                       "last_event_date_end timestamp_ntz, age double, gender string, city_standardized string, product_value double, "
                                       "total_price double, product_is_scanned int, max_capacity double, t_max double, t_min double, rain_fall double, "
                                       "max_wind double, days_until_event long")


def test_the_cube_keeps_only_counts_by_day(spark):
    made = cube.build_cube(odd_tickets(spark), (30, 7))
    assert made.days.columns == ["event_name", "d", "n"] and made.spans.count() <= 3 * 3  # two horizons and none
    assert made.days.where("d < 7").count() == 0 and made.days.where("d IS NULL").count() == 3


def test_figures_by_day_of_unknown_and_late_sales(spark):
    """Against the day-by-day definition: unknown lead days lie on day T, earlier spans count for later horizons."""
    t, lag = odd_tickets(spark), 40
    got = {(r["event_name"], r["T"]): r for r in cube.features_at(cube.build_cube(t, (7, 30)), lag).collect()}
    leads = {}
    for r in t.select("event_name", "days_until_event").collect():
        leads.setdefault(r[0], []).append(r[1])
    for (e, T), r in got.items():
        days = {}
        for d in leads[e]:
            if d is None or d >= T:
                days[T if d is None else d] = days.get(T if d is None else d, 0) + 1
        assert (r["__dmin"], r["__dmax"], r["cumulative_sales_at_t"]) == (min(days), max(days), sum(days.values()))
        assert r[f"sales_last_{lag}_days"] == sum(n for d, n in days.items() if d < T + lag)
        assert abs(r["avg_acceleration"] - (days[max(days)] - days[min(days)]) / len(days)) < 1e-12
        assert r["full_event_tickets"] == len(leads[e])
    assert len(got) == 6


def test_only_rows_whose_weather_is_read_are_filled(spark):
    args = (testbed.tickets_full(spark, SF), testbed.known_cities(spark, SF), None, None, 10, 25)
    rows, fill = pipe.unfilled_tickets(*args)
    made = cube.build_cube(rows, (90,), 10, fill)
    whole = cube.build_cube(pipe.prepare_tickets(*args), (90,), 10)
    assert "gmed" in plan(made.values) and "gmed" not in plan(made.days) + plan(made.cities)
    assert sorted(map(str, made.values.collect())) == sorted(map(str, whole.values.collect()))


# ---- artists

def test_artist_matches_are_not_moved_by_artist(spark):
    d = dt.date
    lineup = spark.createDataFrame([("e", "x", d(2024, 7, 20)), ("e", "x", d(2024, 1, 20)), ("e", "y", d(2024, 7, 20)),
                                    ("f", "x", d(2023, 2, 20)), ("f", None, d(2024, 7, 20)), ("f", "y", None)],
                                   "event_name string, artist string, event_date date")
    snaps = spark.createDataFrame([("x", d(2024, 6, 1), 200.0), ("x", d(2023, 1, 1), 1.0), ("y", d(2024, 1, 1), 300.0)],
                                  "artist string, Date date, SpotifyFollowers double")
    matched = artist_asof(lineup, snaps, 7)
    got = {tuple(r) for r in matched.select("event_name", "artist", "prediction_date", "SpotifyFollowers").collect()}
    assert got == {("e", "x", d(2024, 7, 13), 200.0), ("e", "y", d(2024, 7, 13), 300.0), ("f", "x", d(2023, 2, 13), 1.0)}
    assert "Exchange hashpartitioning(event_name" not in plan(matched)
    events = spark.createDataFrame([("e",), ("f",)], "event_name string")
    a, b = (sorted(map(tuple, artist_block(matched, events, one_row_each=one).collect())) for one in (False, True))
    assert a == b
