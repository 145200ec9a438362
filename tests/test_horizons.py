"""Horizon cube, moment matrices, rolling origins, model store, quarantine and two-step de-duplication."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.operators import clean as C
from salescast.operators import cube, gram, ml
from salescast.operators import pipeline as pipe
from salescast.plans import q_ml
from salescast.sources import readers as R

SF = "/root/testdata/sf0.001"
TICKET = ("event_name string, verkoopdatum timestamp_ntz, barcode string, first_event_date_start timestamp_ntz, "
          "last_event_date_end timestamp_ntz, age double, gender string, city_standardized string, product_value double, "
          "total_price double, product_is_scanned int, max_capacity double, t_max double, t_min double, rain_fall double, "
          "max_wind double, days_until_event long")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ticket_rows(n, seed, unknown=0.0):
    rng, out = random.Random(seed), []
    for i in range(n):
        e = rng.randrange(5)
        start = dt.datetime(2024, 7, 20, 12) + dt.timedelta(days=e)
        lead = None if rng.random() < unknown else rng.choice([0, 1, 2, 5, 5, 6, 7, 9, 14, 30])
        sale = None if lead is None else start - dt.timedelta(days=lead, hours=rng.randrange(20))
        out.append((f"e{e}", sale, f"b{i:04d}", start, start + dt.timedelta(hours=5), rng.choice([None, 20.0, 31.5, 47.0]),
                    rng.choice(["male", "female", "nonbinary", None]), rng.choice(["x", "y", "z", "other"]),
                    float(rng.randrange(10, 90)), float(rng.randrange(10, 90)), rng.choice([0, 1, None]),
                    500.0 if e % 2 else None, 20.0 + e, 10.0, float(i % 3), 5.0, lead))
    return out


def rounded(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=str)


@pytest.mark.parametrize("unknown", [0.0, 0.2])
def test_cube_equals_one_table_per_horizon(spark, unknown):
    df = spark.createDataFrame(ticket_rows(400, 3, unknown), TICKET)
    horizons = (1, 5, 7, 14, 60)
    got = pipe.event_table_horizons(df, horizons, 3, 0, 10 ** 9)
    want = None
    for h in horizons:  # a ticket with an unknown lead day counts as sold h days ahead
        rows = df.withColumn("days_until_event", F.coalesce("days_until_event", F.lit(h).cast("long")))
        part = pipe.event_table(rows, h, 3, 0, 10 ** 9, reuse=False)
        want = part if want is None else want.unionByName(part)
    if unknown:  # the last day's weather is read from tickets with a known lead day
        got, want = got.drop("t_max", "t_min", "rain_fall", "max_wind"), want.drop("t_max", "t_min", "rain_fall", "max_wind")
    assert got.columns == want.columns
    assert rounded(got.collect()) == rounded(want.collect())


def test_number_of_horizons_does_not_change_the_passes_over_tickets(spark, tmp_path):
    spark.createDataFrame(ticket_rows(50, 4), TICKET).write.parquet(f"{tmp_path}/tickets")
    df = spark.read.parquet(f"{tmp_path}/tickets")
    counts = []
    for horizons in ((7,), (1, 5, 7, 14, 30, 60)):
        c = cube.build_cube(df, horizons)
        counts.append([plan(x).count(f"{tmp_path}/tickets") for x in (c.days, c.cities, c.values)])
    assert counts[0] == counts[1] and sum(counts[0]) <= 3


def test_events_without_a_sale_time_keep_their_capacity(spark):
    start = dt.datetime(2024, 7, 20)
    row = ["e", None, "b1", start, start, 30.0, "male", "x", 10.0, 10.0, 1, 750.0, 1.0, 1.0, 0.0, 1.0, 14]
    empty = ["e", None, "b0", start, start, 30.0, "male", "x", 10.0, 10.0, 1, None, 1.0, 1.0, 0.0, 1.0, 14]
    other = ["f", start - dt.timedelta(days=20), "b2", start, start, 30.0, "male", "x", 10.0, 10.0, 1, 90.0, 1.0, 1.0, 0.0, 1.0, 20]
    df = spark.createDataFrame([empty, row, other], TICKET)
    for table in (pipe.event_table(df, 14, 3, 0, 10), pipe.event_table_horizons(df, (14, 7), 3, 0, 10)):
        assert {(r["event_name"], r["max_capacity"]) for r in table.collect()} == {("e", 750.0), ("f", 90.0)}


def test_routed_rows_equal_the_rows_of_their_horizon(spark):
    df = spark.createDataFrame(ticket_rows(300, 5), TICKET)
    routes = spark.createDataFrame([(f"e{i}", (1, 7, 14)[i % 3]) for i in range(5)], "event_name string, T int")
    raw = cube.build_cube(df, (1, 7, 14))
    all_rows = cube.features_at(raw, 3).join(routes, ["event_name", "T"], "left_semi")
    routed = cube.features_at(raw, 3, routes)
    assert rounded(routed.select(all_rows.columns).collect()) == rounded(all_rows.collect())
    assert pipe.event_table_routed(df, routes, (1, 7, 14), 3).count() == 5


def ml_rows(spark, n=200, seed=6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.gauss(100, 20), rng.random(), float(rng.randrange(4))
        rows.append((f"e{i}", i % 4, a, b, c, 1.0, 3 * a - 40 * b + rng.gauss(0, 5)))
    return spark.createDataFrame(rows, "event_name string, fold int, a double, b double, c double, one double, y double")


@pytest.mark.parametrize("penalty, share", [(0.0, 0.0), (0.1, 0.0), (0.1, 1.0), (0.1, 0.5), (3.0, 0.5)])
def test_solved_matrices_equal_fitted_models(spark, penalty, share):
    df = ml_rows(spark)
    names = ["a", "b", "c", "one"]
    moments = sum(gram.moment_matrices(df, F.col("fold"), names, "y").values())
    coef, intercept = gram.solve(moments, penalty, share)
    data = VectorAssembler(inputCols=names, outputCol="x").transform(df)
    model = LinearRegression(featuresCol="x", labelCol="y", regParam=penalty, elasticNetParam=share, maxIter=500, tol=1e-10).fit(data)
    assert np.allclose(coef, model.coefficients.toArray(), atol=2e-3 * (1 + abs(coef).max()))
    assert abs(intercept - model.intercept) < 0.3


def test_folds_leave_their_own_rows_out(spark):
    df = ml_rows(spark)
    models = {r["fold"]: r for r in gram.fold_models(spark, df, F.col("fold"), ["a", "b"], "y", {"Ridge": (0.1, 0.0)}).collect()}
    assert set(models) == {0, 1, 2, 3}
    for k, m in models.items():
        coef, _ = gram.solve(sum(gram.moment_matrices(df.where(F.col("fold") != k), F.lit(0), ["a", "b"], "y").values()), 0.1)
        assert np.allclose(m["coefficients"], coef)


def test_rolling_models_do_not_learn_from_what_was_not_over(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(f"e{i}", T_, float(i), 2.0 * i + 5, day + dt.timedelta(days=i), day + dt.timedelta(days=i, hours=6))
            for i in range(40) for T_ in (1, 5)]
    schema = "event_name string, T int, a double, y double, start timestamp_ntz, over timestamp_ntz"
    origins = ["2024-01-10", "2024-01-20", "2024-01-30"]

    def scored(data):
        df = spark.createDataFrame(data, schema)
        models = gram.rolling_models(spark, df, (1, 5), origins, "over", ["a"], "y")
        return {(r["event_name"], r["T"]): (r["cut"], r["trained_on"], round(r["prediction"], 6))
                for r in gram.rolling_scores(df, models, ["a"], "start").collect()}
    got = scored(rows)
    assert got["e15", 5] == (dt.date(2024, 1, 10), 9, 35.0)
    assert ("e8", 1) not in got and got["e19", 1][0] == dt.date(2024, 1, 10) and got["e20", 1][0] == dt.date(2024, 1, 20)
    # wild results of events that end after the 10th must not reach what was predicted on the 10th
    wild = [r[:3] + ((1e6,) if r[5] > dt.datetime(2024, 1, 10) else (r[3],)) + r[4:] for r in rows]
    later = scored(wild)
    early = [k for k, v in got.items() if v[0] == dt.date(2024, 1, 10)]
    assert early and all(got[k] == later[k] for k in early) and got != later


def test_two_runs_keep_their_own_models(spark, tmp_path):
    df = ml_rows(spark)
    store, other = ml.ModelStore(spark, str(tmp_path)), ml.ModelStore(spark, str(tmp_path))
    with pytest.raises(LookupError):
        store.current()
    first, second = store.begin(), other.begin()
    for version, names in ((first, ["a", "b"]), (second, ["a"])):
        model = ml.fit_family(df, "Ridge", names, "y")
        store.save(version, model, 7, names, True)
    store.publish(first)
    assert store.current() == first
    other.publish(second)
    assert store.current() == second
    assert len(store.load(7, first)[0].stages[-1].coefficients) == 2 and len(store.load(7)[0].stages[-1].coefficients) == 1
    with pytest.raises(ValueError):
        store.load(7, first, ["a"])


def test_routed_scores_come_from_the_model_of_the_row(spark):
    df = ml_rows(spark)
    models = {1: ml.fit_family(df, "Ridge", ["a", "b"], "y"), 7: ml.fit_family(df.where("fold > 1"), "RandomForest", ["a", "b"], "y")}
    rows = df.withColumn("model_T", F.when(F.col("fold") == 0, 1).otherwise(7))
    got = {r["event_name"]: r["prediction"] for r in ml.score_routed(rows, models, ["a", "b"], ["event_name", "model_T"]).collect()}
    for h, model in models.items():
        for r in model.transform(rows.where(F.col("model_T") == h)).collect():
            assert abs(got[r["event_name"]] - r["prediction"]) < 1e-9


def test_sensitivity_of_any_feature(spark):
    df = spark.createDataFrame([(float(i), float(i * i), 0.0) for i in range(6)], "a double, b double, log_b double")
    rows = ml.sensitivity_rows(df, ["a", "b", "log_b"], "b", 5).orderBy("step").collect()
    assert [r["b"] for r in rows] == [0.0, 5.0, 10.0, 15.0, 20.0, 25.0] and {r["a"] for r in rows} == {2.5}
    assert all(abs(r["log_b"] - np.log1p(r["b"])) < 1e-12 for r in rows)


def test_predictions_cover_every_routed_event_once(spark):
    rows = q_ml.q_routed_features(spark, SF).collect()
    assert rows and len({r["event_name"] for r in rows}) == len(rows)


# ---- scans

SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("price", T.DoubleType()), T.StructField("n", T.IntegerType())])


def source(tmp_path, lines, **more):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join(lines) + "\n")
    return R.SourceSpec("shop", str(tmp_path / "in"), schema=SCHEMA, **more)


def test_rejected_lines_are_split_off_with_a_reason(spark, tmp_path):
    spec = source(tmp_path, ["name,price,n", "a,1.5,1", '"x, y",2.0,2', "b,oops,3", "c,1.0", "d,1.0,2,3,4", "e,,", "f,3.0,4", "g,3,5",
                             "h,3,5", "i,3,5", "j,3,5", "k,3,5", "l,3,5", "m,3,5", "n,3,5", "o,3,5"])
    got = R.ingest_sources(spark, [spec])
    assert got.dialects["shop"].step == "typed" and got.counts["shop"] == (16, 3)
    assert {(r["line"], r["reason"]) for r in got.rejected.collect()} == {
        ("b,oops,3", "value"), ("c,1.0", "columns"), ("d,1.0,2,3,4", "columns")}
    good = {r["name"]: r["price"] for r in got.good.collect()}
    assert len(good) == 13 and good["x, y"] == 2.0 and good["e"] is None and "_corrupt" not in got.good.columns
    with pytest.raises(R.TooManyRejected):
        R.ingest_sources(spark, [spec], limit=0.1)


@pytest.mark.parametrize("lines, step, sep", [
    (["name;price;n"] + ["a;1.5;1", "b;2.5;2"] * 4, "other", ";"),
    (["name\tprice\tn"] + ["a, b\t1.5\t1", "c\t2.5\t2"] * 4, "other", "\t"),
    (["name,price,n"] + ["a,EUR 1,1", "b,EUR 2,2"] * 4, "strings", ","),
    (["name,price,n"] + ["a,1.5,1"] * 9 + ["b,bad,2"], "typed", ","),
    (["name,price,n"], "typed", ",")])
def test_dialect_follows_the_lines(spark, tmp_path, lines, step, sep):
    spec = source(tmp_path, lines)
    d = R.choose_dialect(spark, spec)
    assert (d.step, d.sep) == (step, sep)
    df = R.ingest_sources(spark, [spec]).good
    assert df.columns == ["name", "price", "n", "data_source"] and df.count() == len(lines) - 1 - (step == "typed" and len(lines) > 1)


def test_escaped_quotes_are_found(spark, tmp_path):
    spec = source(tmp_path, ["name,price,n"] + ['"say \\"hi, you\\" now",1.5,1'] * 6)
    d = R.choose_dialect(spark, spec)
    assert (d.step, d.escape) == ("other", "\\")
    assert R.read_source(spark, spec, d).first()["name"] == 'say "hi, you" now'


# ---- two-step de-duplication

def test_two_step_keeps_the_same_rows(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, "a", "b", "c", f"k{i}"]), rng.choice(["shop_f", "shop_o", "x", None]),
             rng.choice([None, dt.datetime(2024, 1, 1), dt.datetime(1969, 5, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 1)]),
             rng.choice([None, 1.0, -2.0]), rng.choice(["e", "f"]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "barcode string, data_source string, verkoopdatum timestamp_ntz, product_value double, "
                                     "event_name string, line_no int")
    order = [F.when(F.col("data_source") == "shop_f", 0).when(F.col("data_source") == "shop_o", 1).otherwise(2),
             "verkoopdatum", "product_value", "event_name", "line_no"]
    want = C.dedup_keep_first(df, "barcode", [c if not isinstance(c, str) else F.col(c) for c in order])
    got = C.dedup_tickets(df)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert C.dedup_tickets(df.limit(0)).count() == 0


def test_no_sort_of_all_tickets(spark):
    from salescast.sources import testbed
    text = plan(C.dedup_tickets(testbed.tickets(spark, SF)))
    # only rows that tie for a repeated barcode are compared by the whole order
    assert text.count("SortAggregate") <= 2 and "SortMergeJoin" not in text and "Window" not in text


# ---- stored tables

def test_ordered_table_has_months_order_and_bounded_files(spark, tmp_path):
    from salescast.sources.storage import current, new_version, read_current, version_path, write_ordered
    day = dt.datetime(2024, 1, 1)
    rows = [(i, day + dt.timedelta(hours=7 * (i * 37 % 400))) for i in range(400)] + [(400, None)]
    df = spark.createDataFrame(rows, "id long, t timestamp_ntz")
    first = write_ordered(df, str(tmp_path), "t", ["t", "id"], rows_per_file=30, ranges=3)
    got = read_current(spark, str(tmp_path))
    assert sorted(r["id"] for r in got.collect()) == list(range(401))
    sizes = got.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()
    assert max(r["n"] for r in sizes) <= 30
    jan = got.where(F.col("month") == "2024-01")
    assert "PartitionFilters: [isnotnull(month" in plan(jan) or "month" in plan(jan).split("PartitionFilters")[1].split("]")[0]
    ordered = got.withColumn("f", F.input_file_name()).withColumn("i", F.monotonically_increasing_id()).collect()
    for f in {r["f"] for r in ordered}:
        times = [str(r["t"]) for r in sorted((r for r in ordered if r["f"] == f), key=lambda r: r["i"])]
        assert times == sorted(times)
    # a run that fails before it publishes changes nothing
    df.limit(1).withColumn("month", F.lit("x")).write.parquet(version_path(str(tmp_path), new_version()))
    assert current(spark, str(tmp_path)) == first and read_current(spark, str(tmp_path)).count() == 401
    write_ordered(df.limit(5), str(tmp_path), "t", ["t", "id"])
    assert read_current(spark, str(tmp_path)).count() == 5


def test_bucketed_tables_join_without_exchange(spark):
    from salescast.plans.q_clean import bucketed_ticket_buyers
    joined = bucketed_ticket_buyers(spark, SF)
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
