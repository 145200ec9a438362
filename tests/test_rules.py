"""Rules that no row may break, and plans that must not come back."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast import session
from salescast.operators import clean as C
from salescast.operators.artists import artist_asof, artist_block, find_column
from salescast.operators.lineup import match_to_events
from salescast.operators.ml import compare_models
from salescast.plans import q_ml
from salescast.sources import readers as R

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tickets_without_barcode_count_as_one(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3), ("a", 1)], "barcode string, x int")
    got = sorted(map(tuple, C.dedup_keep_first(df, "barcode", [F.col("x")]).collect()), key=str)
    assert got == [("a", 1), (None, 1)]


def test_price_sanity_keeps_rows_without_quantity(spark):
    df = spark.createDataFrame([("e", 20.0, None), ("e", 30.0, 0.0), ("e", 40.0, 2.0)],
                               "event_name string, product_value double, quantity double")
    assert sorted(r["unit_price"] for r in C.price_sanity(df).collect()) == [20.0, 20.0, 30.0]


def test_artist_named_twice_counts_once(spark):
    d = dt.date
    lineup = spark.createDataFrame([("e", "x", d(2024, 7, 20)), ("e", "x", d(2024, 7, 20)), ("e", "x", d(2024, 7, 18)),
                                    ("e", "y", d(2024, 7, 20))], "event_name string, artist string, event_date date")
    snaps = spark.createDataFrame([("x", d(2024, 1, 1), 200.0), ("y", d(2024, 1, 1), 300.0), ("x", d(2023, 1, 1), 1.0)],
                                  "artist string, Date date, SpotifyFollowers double")
    matched = artist_asof(lineup, snaps, 7)
    assert matched.count() == 2
    r = artist_block(matched, spark.createDataFrame([("e",)], "event_name string")).first()
    assert (r["num_artists"], r["SpotifyFollowers_sum"], r["SpotifyFollowers_mean"]) == (2, 500.0, 250.0)


def test_artist_column_lookup_ranks_exact_names_first():
    assert find_column(["event name", "Artist"]) == "Artist"
    assert find_column(["id", "Artist Name (main)"]) == "Artist Name (main)"
    assert find_column(["id", "value"]) is None


def test_nearest_date_match_has_three_candidates_per_party_at_most(spark):
    events = spark.createDataFrame([(f"e{i}", dt.datetime(2024, 7, 19 + i % 3, 20), dt.datetime(2024, 7, 22)) for i in range(300)],
                                   "event_name string, event_start timestamp_ntz, event_end timestamp_ntz")
    parties = spark.createDataFrame([(i, dt.datetime(2024, 7, 21, 12)) for i in range(50)],
                                    "party_id long, archive_ts timestamp_ntz")
    out = match_to_events(parties, events)
    assert {r["event_name"] for r in out.collect()} == {"e1"} and out.count() == 50
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)


def test_outlier_filters_have_no_join(spark):
    df = spark.range(1000).select((F.col("id") % 100).cast("double").alias("v"))
    out = C.remove_outliers(df, ["v"], "combined")
    assert "Join" not in plan(out) and "Cartesian" not in plan(out)


@pytest.mark.parametrize("names, want", [
    (["x", "x"], ["x_0", "x_1"]), (["x", "x_1", "x"], ["x_0", "x_1", "x_2"]), (["a", "b"], ["a", "b"]),
    (["x", "x_0", "x", "x_1"], ["x_2", "x_0", "x_3", "x_1"])])
def test_repeated_column_names_become_unique(names, want):
    got = R.unique_names(names)
    assert got == want and len(set(got)) == len(names)


def test_forecast_skips_bad_entries_and_opens_envelopes(spark):
    entry = '{"dt_txt": "2024-07-01 12:00:00", "main": {"temp_max": 20.0, "temp_min": 10.0}, "wind": {"speed": 10}}'
    rows = [(entry,), ('{"list": [' + entry + ', {"main": {"temp_max": 1}}]}',), ("not json",), ("{}",), (None,)]
    out = R.flatten_forecast(spark.createDataFrame(rows, "payload string")).collect()
    assert len(out) == 2 and all((r["rain_mm"], r["wind_kmh"]) == (0.0, 36.0) for r in out)


def test_missing_optional_table_is_empty_and_missing_primary_is_an_error(spark, tmp_path):
    schema = T.StructType([T.StructField("event_name", T.StringType())])
    spark.createDataFrame([("E ",)], schema).write.option("header", True).csv(str(tmp_path / "t"))
    t, lu, a = R.load_normalised(spark, str(tmp_path / "t"), str(tmp_path / "none"), schemas={"line_up": schema})
    assert t.first()["event_name"] == "e" and lu.count() == 0 and lu.columns == ["event_name"] and a.count() == 0
    assert R.read_source(spark, R.SourceSpec("x", str(tmp_path / "none"), schema=schema)).count() == 0
    with pytest.raises(ValueError):
        R.read_source(spark, R.SourceSpec("x", str(tmp_path / "none"), primary=True))


def test_csv_read_leaves_the_session_alone(spark, tmp_path):
    key = "spark.sql.csv.parser.columnPruning.enabled"
    before = spark.conf.get(key)
    spark.range(1).write.csv(str(tmp_path / "c"))
    R.read_csv(spark, str(tmp_path / "c"), T.StructType([T.StructField("id", T.LongType())]), header=False).count()
    assert spark.conf.get(key) == before


def test_intermediates_can_be_removed(spark):
    df = session.materialize(spark.range(3))
    assert df.count() == 3 and session.drop_intermediates(spark) >= 1
    with pytest.raises(Exception):
        spark.read.parquet(df.inputFiles()[0])


def test_no_checkpoint_folder_on_a_cluster_is_an_error():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_winner_has_the_lowest_cross_validated_error(spark):
    rows = [(f"e{i}", float(i % 37), float(i % 11), 400.0 + 10 * (i % 37)) for i in range(120)]
    table = spark.createDataFrame(rows, "event_name string, a double, b double, y double")
    summary, best, _ = compare_models(spark, table, ["a", "b"], "y", folds=3, families=("Lasso", "Ridge", "RandomForest"))
    by = {r["model"]: r["rmse_mean"] for r in summary.collect()}
    assert best == min(by, key=by.get) and len(by) == 3


def test_training_and_scoring_do_not_share_events(spark):
    train = {r["event_name"] for r in q_ml.training_table(spark, SF, (5,)).select("event_name").collect()}
    rows = q_ml.scoring_table(spark, SF, (1, 5)).select("event_name", "model_T", "days_until_event").collect()
    assert train and rows and not train & {r["event_name"] for r in rows}
    assert len(rows) == len({r["event_name"] for r in rows})
    assert all(r["days_until_event"] > 0 and r["model_T"] in (1, 5) for r in rows)


def test_predictions_are_not_below_and_not_all_at_the_tickets_sold(spark):
    rows = q_ml.q_predict_future(spark, "/root/testdata/sf0.01").collect()
    assert all(r["predicted_tickets"] >= r["sold_so_far"] for r in rows)
    assert any(r["predicted_tickets"] > r["sold_so_far"] for r in rows)


def test_features_do_not_depend_on_later_sales(spark):
    """Tickets sold after the horizon change the target, never the features."""
    from salescast.operators import pipeline as pipe
    from salescast.sources import testbed
    t = testbed.tickets_full(spark, SF)
    lead = F.datediff(F.to_date("first_event_date_start"), F.to_date("verkoopdatum"))
    fewer = t.where((lead >= 200) | (F.col("line_no") % 2 == 0))
    known = testbed.known_cities(spark, SF)
    cols = ["event_name", "cumulative_sales_at_t", "avg_daily_sales_before_t", "avg_age", "avg_product_value"]
    a, b = ({tuple(r) for r in pipe.event_table(pipe.prepare_tickets(x, known, 201, None), 201, 3, 0, 10 ** 9)
             .select(*cols).collect()} for x in (t, fewer))
    assert len(a) == len(b) == 10 and {r[:3] for r in a} == {r[:3] for r in b}


def test_tickets_sold_column_event_type_and_weather_defaults(spark):
    from salescast.operators import features as feat
    ts = dt.datetime
    rows = [("e", ts(2024, 7, 1), f"b{i}", ts(2024, 7, 20), ts(2024, 7, 21), 30.0, "man", "x", 10.0, 11.0, 1, 100.0,
             20.0, 10.0, 0.0, 5.0, 3, "club", 19) for i in range(2)]
    names = ("event_name verkoopdatum barcode first_event_date_start last_event_date_end age gender city_standardized "
             "product_value total_price product_is_scanned max_capacity t_max t_min rain_fall max_wind tickets_sold "
             "event_type days_until_event").split()
    df = spark.createDataFrame(rows, names)
    agg = feat.fused_event_aggregate(df, 14, 3)
    assert agg.first()["full_event_tickets"] == 6
    late = feat.weather_block(agg).first()  # no sale on the last day: the defaults
    assert (late["t_max"], late["event_type"]) == (15.0, "other")
    now = feat.weather_block(feat.fused_event_aggregate(df.withColumn("days_until_event", F.lit(1)), 0, 3)).first()
    assert (now["t_max"], now["event_type"]) == (20.0, "club")


def test_small_column_helpers(spark):
    from salescast.functions.dates import fractional_days
    from salescast.functions.numeric import coerce_double
    from salescast.functions.text import list_to_string, string_to_list
    df = spark.createDataFrame([(dt.datetime(2024, 7, 1), dt.datetime(2024, 7, 2, 12), "1.5", "x", "a, b")],
                               "s timestamp_ntz, e timestamp_ntz, n string, bad string, l string")
    r = df.select(fractional_days("s", "e"), coerce_double(F.col("n")), coerce_double(F.col("bad")),
                  list_to_string(string_to_list(F.col("l")))).first()
    assert tuple(r) == (1.5, 1.5, None, "a, b")
