"""Unit tests per operator on tiny hand-written frames (edge rows of FIXTURES.md)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from salescast.functions import numeric as N
from salescast.functions.dates import floor_days, weekday_mon0
from salescast.functions.text import normalize_text, split_lineup
from salescast.operators import clean as C
from salescast.operators import features as feat
from salescast.operators.asof import asof_join
from salescast.operators.lineup import match_to_events
from salescast.operators.ml import nearest_horizon, postprocess
from salescast.operators.weather import fill_event_then_global_median

TS = dt.datetime


def test_floor_days_same_day_sale_is_minus_one(spark):
    df = spark.createDataFrame([(TS(2024, 7, 20, 14), TS(2024, 7, 20)), (TS(2024, 7, 6), TS(2024, 7, 20))],
                               "sale timestamp_ntz, start timestamp_ntz")
    got = [r[0] for r in df.select(floor_days("sale", "start")).collect()]
    assert got == [-1, 14]


def test_lead_days_drop_negative_keep_null(spark):
    df = spark.createDataFrame([("e", TS(2024, 7, 20, 14), TS(2024, 7, 20)), ("e", None, TS(2024, 7, 20)),
                                ("e", TS(2024, 7, 1), TS(2024, 7, 20))],
                               "event_name string, verkoopdatum timestamp_ntz, first_event_date_start timestamp_ntz")
    got = sorted(r[0] for r in feat.add_lead_days(df, 14).select("days_until_event").collect())
    assert got == [14, 19]


def test_weekday_monday_zero_and_bround(spark):
    df = spark.createDataFrame([(dt.date(2024, 7, 22), 2.5, 3.5)], "d date, a double, b double")
    r = df.select(weekday_mon0(F.col("d")), F.bround("a", 0), F.bround("b", 0)).first()
    assert (r[0], r[1], r[2]) == (0, 2.0, 4.0)


def test_normalize_text_accents_and_padding(spark):
    df = spark.createDataFrame([(" Café Ø\n",), (None,), ("ÉLAN",)], "s string")
    got = [r[0] for r in df.select(normalize_text("s")).collect()]
    assert got == ["cafe", "", "elan"]


def test_age_bins_edges(spark):
    df = spark.createDataFrame([(0.0,), (18.0,), (25.0,), (120.0,)], "a double")
    got = [tuple(r) for r in df.select(N.age_bin(F.col("a")), N.age_category(F.col("a"))).collect()]
    assert got == [("0-17", None), ("18-24", "<25"), ("25-34", "<25"), (None, None)]


def test_gender_modes(spark):
    df = spark.createDataFrame([("Female",), ("male",), (None,), ("vrouw",)], "g string")
    batch = [r[0] for r in df.select(N.gender_std(F.col("g"))).collect()]
    clean = [r[0] for r in df.select(N.gender_std(F.col("g"), "clean")).collect()]
    assert batch == ["woman", "man", "unknown", "vrouw"]
    assert clean == ["woman", "man", None, "woman"]


def test_split_lineup_semicolon_first(spark):
    got = [r[0] for r in spark.createDataFrame([("Abc; De ;F",), ("Xy, Yz, z",)], "s string")
           .select(split_lineup(F.col("s"))).collect()]
    assert got == [["Abc", "De"], ["Xy", "Yz"]]


def test_dedup_keep_first_is_deterministic(spark):
    df = spark.createDataFrame([("b1", 2, "late"), ("b1", 1, "early"), ("b2", 5, "only")], "barcode string, o int, v string")
    got = sorted(tuple(r) for r in C.dedup_keep_first(df, "barcode", [F.col("o")]).collect())
    assert got == [("b1", 1, "early"), ("b2", 5, "only")]


def test_outliers_keep_nulls_and_sd_zero(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (None,)], "x double")
    assert C.remove_outliers(df, ["x"], "zscore").count() == 4
    df2 = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]] + [(None,)], "x double")
    assert C.remove_outliers(df2, ["x"], "IQR").count() == 5


def test_asof_no_leak_and_latest(spark):
    left = spark.createDataFrame([("e1", "a", dt.date(2024, 6, 1)), ("e2", "b", dt.date(2024, 6, 1))],
                                 "event_name string, artist string, cut date")
    right = spark.createDataFrame([("a", dt.date(2024, 5, 1), 1.0), ("a", dt.date(2024, 6, 1), 2.0),
                                   ("a", dt.date(2024, 6, 2), 9.0), ("b", dt.date(2024, 7, 1), 5.0)],
                                  "artist string, Date date, m double")
    got = [tuple(r) for r in asof_join(left, right, "artist", "cut", "Date", ["m"]).collect()]
    assert got == [("e1", "a", dt.date(2024, 6, 1), 2.0)]


def test_match_to_events_tie_rules(spark):
    parties = spark.createDataFrame([(1, TS(2024, 7, 21, 3))], "party_id long, archive_ts timestamp_ntz")
    events = spark.createDataFrame([("b", TS(2024, 7, 20), TS(2024, 7, 21)), ("a", TS(2024, 7, 20), TS(2024, 7, 21)),
                                    ("c", TS(2024, 7, 19), TS(2024, 7, 20))],
                                   "event_name string, event_start timestamp_ntz, event_end timestamp_ntz")
    r = match_to_events(parties, events).first()
    assert (r["event_name"], r["gap_days"]) == ("a", 0)
    plan = match_to_events(parties, events)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_nearest_horizon_and_postprocess(spark):
    df = spark.createDataFrame([(-3,), (7,), (12,), (99,)], "d int")
    got = sorted(tuple(r) for r in nearest_horizon(df, "d", [1, 5, 10, 15, 30]).collect())
    assert got == [(-3, 1), (7, 5), (12, 10), (99, 30)]
    p = spark.createDataFrame([(2.5, 0), (1.0, 7)], "raw double, sold long")
    out = [r["predicted_tickets"] for r in postprocess(p, "raw", "sold", False).collect()]
    assert out == [2.0, 7.0]


def test_median_fill_event_then_global(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None), ("c", 10.0)],
                               "event_name string, t_max double")
    got = sorted((r[0], r[1]) for r in fill_event_then_global_median(df, "event_name", ["t_max"]).collect())
    assert got == [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 2.5), ("c", 10.0)]


def test_flagship_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert set(["event_name", "full_event_tickets", "cumulative_sales_at_t"]) <= set(df.columns)
    df.collect()


def test_asof_matches_brute_force_across_buckets(spark):
    import random
    rnd = random.Random(7)
    base = dt.date(2024, 1, 1)
    snaps = [(f"k{rnd.randint(0, 3)}", base + dt.timedelta(days=rnd.randint(0, 400)), float(rnd.randint(0, 5)))
             for _ in range(300)]
    probes = [(i, f"k{rnd.randint(0, 4)}", base + dt.timedelta(days=rnd.randint(-20, 420))) for i in range(200)]
    left = spark.createDataFrame(probes, "pid int, key string, cut date")
    right = spark.createDataFrame(snaps, "key string, Date date, m double")
    got = {r["pid"]: (r["Date"], r["m"]) for r in
           asof_join(left, right, "key", "cut", "Date", ["Date", "m"], bucket_days=30).collect()}
    want = {}
    for pid, key, cut in probes:
        cands = [(d, m) for k, d, m in snaps if k == key and d <= cut]
        if cands:
            want[pid] = max(cands)
    assert got == want


def test_asof_outer_hot_key_and_nulls(spark):
    import random
    rnd = random.Random(11)
    base = dt.date(2024, 1, 1)
    # one hot key holds most snapshots and probes, all inside one 30-day bucket
    snaps = [("hot", base + dt.timedelta(days=rnd.randint(0, 20)), float(rnd.randint(0, 9))) for _ in range(400)]
    snaps += [("cold", base + dt.timedelta(days=rnd.randint(0, 200)), float(rnd.randint(0, 9))) for _ in range(20)]
    snaps += [(None, base, 1.0)]
    probes = [(i, "hot", base + dt.timedelta(days=rnd.randint(-5, 25))) for i in range(300)]
    probes += [(300 + i, "cold", base + dt.timedelta(days=rnd.randint(0, 250))) for i in range(30)]
    probes += [(400, None, base), (401, "hot", None)]
    left = spark.createDataFrame(probes, "pid int, key string, cut date")
    right = spark.createDataFrame(snaps, "key string, Date date, m double")
    rows = asof_join(left, right, "key", "cut", "Date", ["Date", "m"], inner=False).collect()
    assert len(rows) == len(probes)
    got = {r["pid"]: (r["Date"], r["m"]) for r in rows}
    for pid, key, cut in probes:
        cands = [(d, m) for k, d, m in snaps if key is not None and cut is not None and k == key and d <= cut]
        assert got[pid] == (max(cands) if cands else (None, None)), pid


def test_exact_percentiles_match_spark_percentile(spark):
    import random
    from salescast.operators.stats import exact_percentiles
    rnd = random.Random(3)
    rows = [("hot", float(rnd.randint(0, 300)) / 7) for _ in range(3000)]
    rows += [(f"g{rnd.randint(0, 20)}", rnd.choice([None, float(rnd.randint(-50, 50))])) for _ in range(600)]
    rows += [("single", 4.0), ("nulls", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    ps = [0.0, 0.25, 0.5, 0.9, 1.0]
    want = {r["g"]: tuple(r[f"q{i}"] for i in range(len(ps))) for r in
            df.groupBy("g").agg(*[F.percentile("v", p).alias(f"q{i}") for i, p in enumerate(ps)]).collect()}
    outs = [f"q{i}" for i in range(len(ps))]
    # coarse sketches and small brackets: fallbacks and repeated narrowing are exercised
    for acc, most in ((10, 50000), (10000, 50000), (10, 7)):
        got = {r["g"]: tuple(r[o] for o in outs) for r in
               exact_percentiles(df, "v", ps, ["g"], outs=outs, accuracy=acc, most=most).collect()}
        for g, w in want.items():
            if all(x is None for x in w):
                assert g not in got or all(x is None for x in got[g])
                continue
            assert got[g] == pytest.approx(w, rel=1e-9, abs=1e-9), (acc, g)
    glob = exact_percentiles(df, "v", [0.25, 0.75], outs=["a", "b"], accuracy=10).collect()
    exp = df.agg(F.percentile("v", 0.25).alias("a"), F.percentile("v", 0.75).alias("b")).collect()
    assert len(glob) == 1 and (glob[0]["a"], glob[0]["b"]) == pytest.approx((exp[0]["a"], exp[0]["b"]))
    empty = exact_percentiles(df.where("false"), "v", [0.5], outs=["m"]).collect()
    assert len(empty) == 1 and empty[0]["m"] is None


def test_ragged_csv_flags_short_and_long_rows_under_pruning(spark, tmp_path):
    from pyspark.sql import types as T
    from salescast.sources import readers as R
    p = str(tmp_path / "ragged")
    lines = ["a;b;c;d", "a;b", "a;b;c;d;e", "a;b;;"]
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(p)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "wxyz"])
    df = R.pad_missing(R.read_csv(spark, p, schema, sep=";", header=False), ["y", "z"])
    got = sorted((r["y"], r["z"], r["_corrupt"] or "") for r in df.select("y", "z", "_corrupt").collect())
    assert got == sorted([("c", "d", ""), ("", "", "a;b"), ("c", "d", "a;b;c;d;e"), ("", "", "")])


def test_nearest_horizon_keeps_duplicate_rows(spark):
    df = spark.createDataFrame([(7,), (7,), (-3,), (None,)], "d int")
    got = sorted((r["d"] is None, r["d"], r["model_T"]) for r in nearest_horizon(df, "d", [5, 10]).collect())
    assert got == [(False, -3, 5), (False, 7, 5), (False, 7, 5), (True, None, 5)]
