"""Model training / scoring / evaluation queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from salescast.functions.numeric import safe_pct_error, ticket_range
from salescast.operators import gram, ml
from salescast.operators import pipeline as pipe
from salescast.operators.asof import horizon_grid
from salescast.operators.stats import attach_one_row, exact_percentiles
from salescast.plans.oracle_base import LEAD_DAYS, TICKETS, typed_select
from salescast.plans import oracle_features as OF
from salescast.plans.registry import finish, register
from salescast.session import materialize, table_rows
from salescast.sources import testbed

HZ = (1, 5, 10, 15, 20, 30)
LO_REF, HI_REF = 400, 3500   # event-size bounds of the reference's training filter
T_EVAL = 30
# Models learn from events up to this date and score the later ones.
SPLIT = "2001-11-01"

BASE_SQL = "WITH " + TICKETS + f""",
lt AS (SELECT event_name, first_event_date_start, last_event_date_end, {LEAD_DAYS} AS d FROM tickets),
f AS (SELECT event_name, first_event_date_start, last_event_date_end, d FROM lt WHERE NOT coalesce(d < 0, false) AND event_name IS NOT NULL),
h AS (SELECT unnest([{", ".join(map(str, HZ))}]) AS T),
g AS (SELECT event_name, T, max(first_event_date_start) AS start, max(last_event_date_end) AS over_at, CAST(max(first_event_date_start) AS DATE) <= DATE '{SPLIT}' AS past, count(*) AS y_true, count(*) FILTER (WHERE d >= T) AS cum,
             min(d) FILTER (WHERE d >= T) AS dmin, max(d) FILTER (WHERE d >= T) AS dmax
      FROM f CROSS JOIN h GROUP BY ALL HAVING count(*) > {LO_REF} AND count(*) < {HI_REF}),
b AS (SELECT *, CASE WHEN cum > 0 THEN cum / (dmax - dmin + 1) ELSE 0.0 END AS vel FROM g)"""


def base_table(spark, sf_dir):
    """Per (event, T) target and sales features for every horizon in one pass."""
    t = testbed.tickets(spark, sf_dir)
    d = F.floor(F.timestamp_diff("MICROSECOND", F.col("verkoopdatum"), F.col("first_event_date_start")) / 86400000000)
    t = t.withColumn("d", d).where(~F.coalesce(F.col("d") < 0, F.lit(False))).where(F.col("event_name").isNotNull())
    per_day = t.groupBy("event_name", "d").agg(F.count(F.lit(1)).alias("n"),
                                               F.max("first_event_date_start").alias("start"),
                                               F.max("last_event_date_end").alias("over_at"))
    g = per_day.crossJoin(horizon_grid(spark, HZ).withColumnRenamed("forecast_days", "T"))
    up = F.col("d") >= F.col("T")
    out = (g.groupBy("event_name", "T")
           .agg(F.sum("n").alias("y_true"), F.max("start").alias("start"), F.max("over_at").alias("over_at"), (F.to_date(F.max("start")) <= F.to_date(F.lit(SPLIT))).alias("past"),
                F.coalesce(F.sum(F.when(up, F.col("n"))), F.lit(0)).alias("cum"),
                F.min(F.when(up, F.col("d"))).alias("dmin"), F.max(F.when(up, F.col("d"))).alias("dmax"))
           .where((F.col("y_true") > LO_REF) & (F.col("y_true") < HI_REF)))
    vel = F.when(F.col("cum") > 0, F.col("cum") / (F.col("dmax") - F.col("dmin") + 1)).otherwise(F.lit(0.0))
    return out.withColumn("vel", vel)


OLS_SPEC = [("T", "i"), ("slope", "d"), ("intercept", "d"), ("r2", "d"), ("events", "l")]


@register("ols_baseline", BASE_SQL + "\n" + typed_select(
    "(SELECT T, regr_slope(y_true, cum) AS slope, regr_intercept(y_true, cum) AS intercept, "
    "regr_r2(y_true, cum) AS r2, count(*) AS events FROM b GROUP BY T)", OLS_SPEC))
def q_ols_baseline(spark, sf_dir):
    """M02 (closed form): per-horizon least squares of final tickets on cumulative sales."""
    b = base_table(spark, sf_dir)
    return finish(b.groupBy("T").agg(F.regr_slope("y_true", "cum").alias("slope"),
                                     F.regr_intercept("y_true", "cum").alias("intercept"),
                                     F.regr_r2("y_true", "cum").alias("r2"), F.count(F.lit(1)).alias("events")))


def _ols_pred(spark, sf_dir):
    """Later events scored by a line fitted on the events up to SPLIT."""
    b = base_table(spark, sf_dir)
    coef = b.where("past").groupBy("T").agg(F.regr_slope("y_true", "cum").alias("slope"),
                              F.regr_intercept("y_true", "cum").alias("intercept"))
    # one row per horizon: a fixed-size side
    return b.where(~F.col("past")).join(F.broadcast(coef), "T").withColumn("pred", F.col("intercept") + F.col("slope") * F.col("cum"))


PRED_SQL = BASE_SQL + """,
c AS (SELECT T, regr_slope(y_true, cum) AS slope, regr_intercept(y_true, cum) AS intercept FROM b
      WHERE past GROUP BY T),
p AS (SELECT b.*, c.intercept + c.slope * b.cum AS pred FROM b JOIN c ON b.T = c.T WHERE NOT past)"""


@register("backtest_problem_rate", PRED_SQL + "\n" + typed_select(
    "(SELECT T, count(*) AS events, avg(CASE WHEN pred < cum THEN 1.0 ELSE 0.0 END) AS problem_rate, "
    "sqrt(avg((pred - y_true) * (pred - y_true))) AS rmse FROM p GROUP BY T)",
    [("T", "i"), ("events", "l"), ("problem_rate", "d"), ("rmse", "d")]))
def q_backtest_problem_rate(spark, sf_dir):
    """Back-test of later events x horizons with the real T, by a model of the past
    events; share of predictions below sold-so-far."""
    p = _ols_pred(spark, sf_dir)
    return finish(p.groupBy("T").agg(
        F.count(F.lit(1)).alias("events"),
        F.avg(F.when(F.col("pred") < F.col("cum"), 1.0).otherwise(0.0)).alias("problem_rate"),
        F.sqrt(F.avg((F.col("pred") - F.col("y_true")) ** 2)).alias("rmse")))


@register("regression_metrics", BASE_SQL + """,
p AS (SELECT *, cum + vel * T AS pred FROM b),
m AS (SELECT T, avg(y_true) AS ybar FROM p GROUP BY T)
""" + typed_select("(SELECT p.T, sqrt(avg((y_true - pred) * (y_true - pred))) AS rmse, avg(abs(y_true - pred)) AS mae, "
                   "1 - sum((y_true - pred) * (y_true - pred)) / sum((y_true - ybar) * (y_true - ybar)) AS r2 "
                   "FROM p JOIN m ON p.T = m.T GROUP BY p.T)", [("T", "i"), ("rmse", "d"), ("mae", "d"), ("r2", "d")]))
def q_regression_metrics(spark, sf_dir):
    """RMSE, MAE, R^2 per horizon of the velocity-extrapolation baseline."""
    p = base_table(spark, sf_dir).withColumn("pred", F.col("cum") + F.col("vel") * F.col("T"))
    ybar = p.groupBy("T").agg(F.avg("y_true").alias("ybar"))
    p = p.join(F.broadcast(ybar), "T")
    err = F.col("y_true") - F.col("pred")
    return finish(p.groupBy("T").agg(
        F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
        (F.lit(1.0) - F.sum(err * err) / F.sum((F.col("y_true") - F.col("ybar")) ** 2)).alias("r2")))


ERR_SQL = BASE_SQL + f""",
p AS (SELECT *, cum + vel * T AS pred FROM b WHERE T = {T_EVAL}),
e AS (SELECT CASE WHEN y_true >= 400 AND y_true < 800 THEN '400-800' WHEN y_true >= 800 AND y_true < 1200 THEN '800-1200'
                  WHEN y_true >= 1200 AND y_true < 1700 THEN '1200-1700' WHEN y_true >= 1700 THEN '1700+' END AS ticket_range,
             abs(y_true - pred) AS abs_error,
             CASE WHEN y_true = 0 THEN NULL ELSE 100.0 * abs(y_true - pred) / y_true END AS pct_error FROM p)
"""
ERR_SPEC = [("ticket_range", "s"), ("n", "l"), ("abs_min", "d"), ("abs_q1", "d"), ("abs_median", "d"),
            ("abs_q3", "d"), ("abs_max", "d"), ("pct_median", "d"), ("pct_mean", "d")]


@register("error_by_range", ERR_SQL + typed_select(
    "(SELECT ticket_range, count(*) AS n, min(abs_error) AS abs_min, quantile_cont(abs_error, 0.25) AS abs_q1, "
    "quantile_cont(abs_error, 0.5) AS abs_median, quantile_cont(abs_error, 0.75) AS abs_q3, max(abs_error) AS abs_max, "
    "quantile_cont(pct_error, 0.5) AS pct_median, avg(pct_error) AS pct_mean FROM e GROUP BY 1)", ERR_SPEC))
def q_error_by_range(spark, sf_dir):
    """Box-plot statistics of absolute and % error per ticket range."""
    p = base_table(spark, sf_dir).where(F.col("T") == T_EVAL)
    p = p.withColumn("pred", F.col("cum") + F.col("vel") * F.col("T"))
    e = p.select(ticket_range(F.col("y_true")).alias("ticket_range"),
                 F.abs(F.col("y_true") - F.col("pred")).alias("abs_error"),
                 safe_pct_error(F.col("y_true").cast("double"), F.col("pred")).alias("pct_error"))
    e = materialize(e, "errors")
    a = F.col("abs_error")
    figures = e.groupBy("ticket_range").agg(
        F.count(F.lit(1)).alias("n"), F.min(a).alias("abs_min"), F.max(a).alias("abs_max"), F.avg("pct_error").alias("pct_mean"))
    ranges = 5  # four ranges and none
    at = {"abs_error": ((0.25, 0.5, 0.75), ["abs_q1", "abs_median", "abs_q3"]), "pct_error": ((0.5,), ["pct_median"])}
    for c, (ps, outs) in at.items():
        rows = e.where(F.col("ticket_range").isNotNull())
        figures = figures.join(exact_percentiles(rows, c, ps, ["ticket_range"], outs, group_bound=ranges), "ticket_range", "left")
    return finish(figures.select("ticket_range", "n", "abs_min", "abs_q1", "abs_median", "abs_q3", "abs_max",
                                 "pct_median", "pct_mean"))


@register("residual_rows", PRED_SQL + "\n" + typed_select(
    "(SELECT event_name, T, y_true, pred AS y_pred, y_true - pred AS residual, abs(y_true - pred) AS abs_error, "
    "CASE WHEN y_true = 0 THEN NULL ELSE 100.0 * abs(y_true - pred) / y_true END AS pct_error, pred < cum AS below_sold FROM p)",
    [("event_name", "s"), ("T", "i"), ("y_true", "l"), ("y_pred", "d"), ("residual", "d"), ("abs_error", "d"),
     ("pct_error", "d"), ("below_sold", "b")]))
def q_residual_rows(spark, sf_dir):
    """One row per scored (event, T): actual, predicted, residual and errors."""
    p = _ols_pred(spark, sf_dir).withColumn("below_sold", F.col("pred") < F.col("cum"))
    return finish(ml.residuals(p, "y_true", "pred").select(
        "event_name", "T", "y_true", F.col("pred").alias("y_pred"), "residual", "abs_error", "pct_error", "below_sold"))


@register("score_postprocess", PRED_SQL + f"""
""" + typed_select(f"(SELECT event_name, T, cum, cum AS cumulative_sales_at_t, vel AS avg_daily_sales_before_t, "
                   "0.0 AS capacity_missing, round_even(greatest(greatest(coalesce(exp(ln(1 + greatest(pred, 0.0))) - 1, "
                   "0.0), 0.0), cum), 0) AS predicted_tickets FROM p WHERE T = " + str(T_EVAL) + ")",
                   [("event_name", "s"), ("T", "i"), ("cum", "l"), ("cumulative_sales_at_t", "d"),
                    ("avg_daily_sales_before_t", "d"), ("capacity_missing", "d"), ("predicted_tickets", "d")]))
def q_score_postprocess(spark, sf_dir):
    """Align features, back-transform a log-scale output, clip at 0 and at
    tickets already sold, round half-to-even."""
    p = _ols_pred(spark, sf_dir).where(F.col("T") == T_EVAL)
    p = p.withColumn("raw", F.log1p(F.greatest(F.col("pred"), F.lit(0.0))))
    p = p.withColumn("cumulative_sales_at_t", F.col("cum")).withColumn("avg_daily_sales_before_t", F.col("vel"))
    p = ml.align_features(p, ["cumulative_sales_at_t", "avg_daily_sales_before_t", "capacity_missing"],
                          keep=["event_name", "T", "cum", "raw"])
    out = ml.postprocess(p, "raw", "cum", log_target=True)
    return finish(out.select("event_name", "T", "cum", "cumulative_sales_at_t", "avg_daily_sales_before_t",
                             "capacity_missing", "predicted_tickets"))


NH_ASOF = "2001-10-01"


@register("nearest_horizon", "WITH " + TICKETS + f""",
e AS (SELECT event_name, CAST(datediff('day', DATE '{NH_ASOF}', CAST(min(first_event_date_start) AS DATE)) AS INTEGER)
        AS days_until_event FROM tickets WHERE event_name IS NOT NULL GROUP BY 1),
h AS (SELECT unnest([{", ".join(map(str, HZ))}]) AS T),
r AS (SELECT e.*, h.T, row_number() OVER (PARTITION BY e.event_name ORDER BY abs(h.T - greatest(days_until_event, 0)), h.T)
        AS rn FROM e CROSS JOIN h)
""" + typed_select("(SELECT event_name, days_until_event, T AS model_T FROM r WHERE rn = 1)",
                   [("event_name", "s"), ("days_until_event", "i"), ("model_T", "i")]))
def q_nearest_horizon(spark, sf_dir):
    """Nearest trained horizon per upcoming event (negative -> 0, clamp, ties -> smaller T)."""
    t = testbed.tickets(spark, sf_dir).where(F.col("event_name").isNotNull())
    e = t.groupBy("event_name").agg(F.datediff(F.to_date(F.min("first_event_date_start")),
                                               F.to_date(F.lit(NH_ASOF))).alias("days_until_event"))
    return finish(ml.nearest_horizon(e, "days_until_event", HZ))


# ----------------------------------------------------------------- rows-only (iterative / model objects)
ML_LAG = 3
ML_FEATURES = pipe.model_features(ML_LAG)
TARGET = "full_event_tickets"


def _inputs(spark, sf_dir):
    """Tickets with buyer and weather, known cities, and the proven row bounds."""
    return (testbed.tickets_full(spark, sf_dir), testbed.known_cities(spark, sf_dir),
            dict(name_bound=table_rows(spark, f"{sf_dir}/supplier.parquet"),
                 city_bound=table_rows(spark, f"{sf_dir}/nation.parquet")))


def training_table(spark, sf_dir, horizons=HZ, asof=SPLIT, inputs=None):
    """(event, T) feature rows of the events that started up to ``asof``."""
    tickets, known, bounds = inputs or _inputs(spark, sf_dir)
    rows, fill = pipe.unfilled_tickets(tickets, known, None, asof, **bounds, landed=inputs is not None)
    return pipe.event_table_horizons(rows, horizons, ML_LAG, LO_REF, HI_REF, event_bound=bounds["name_bound"], fill=fill)


def scoring_table(spark, sf_dir, horizons=HZ, asof=SPLIT, inputs=None):
    """The same features for the events after ``asof``, from the tickets sold until then.
    Each event is routed to its nearest model horizon first, so it is aggregated once."""
    tickets, known, bounds = inputs or _inputs(spark, sf_dir)
    sold = F.to_date("verkoopdatum") <= F.to_date(F.lit(asof))
    upcoming = tickets.where((F.to_date("first_event_date_start") > F.to_date(F.lit(asof))) & sold)
    sales, fill = pipe.unfilled_tickets(upcoming, known, None, None, is_prediction=True, **bounds, landed=inputs is not None)
    routes = ml.route_events(sales, horizons, asof)
    rows = pipe.event_table_routed(sales, routes.withColumnRenamed("model_T", "T"), horizons, ML_LAG,
                                   event_bound=bounds["name_bound"], fill=fill)
    return rows.join(routes, "event_name").drop("forecast_days")


HZ_CHECK = (90, 180)
_HZ_SPEC = [("event_name", "s"), ("full_event_tickets", "l"), ("forecast_days", "i"), ("cumulative_sales_at_t", "l"),
            ("avg_acceleration", "d"), ("avg_age", "d"), ("main_city_buyer_ratio", "d"), ("avg_product_value", "d"),
            ("max_capacity", "d"), ("event_duration_hours", "d"), ("sales_duration_hours_upto_t", "d")]
_HZ_SQL = " UNION ALL ".join(
    f"SELECT * FROM (WITH {OF.event_table(T, ML_LAG, LO_REF, HI_REF, SPLIT)}\n{typed_select('ev_out', _HZ_SPEC)})"
    for T in HZ_CHECK)


@register("event_features_horizons", _HZ_SQL)
def q_event_features_horizons(spark, sf_dir):
    """The event table for several horizons over one prepared ticket table, at the
    reference's size bounds."""
    rows = training_table(spark, sf_dir, HZ_CHECK)
    return finish(rows.select(*[c for c, _ in _HZ_SPEC]))


KEEP_UPCOMING = (f"CAST(first_event_date_start AS DATE) > DATE '{SPLIT}' AND CAST(verkoopdatum AS DATE) <= DATE '{SPLIT}'")
ROUTES = f"""starts AS (
  SELECT event_name, CAST(datediff('day', DATE '{SPLIT}', CAST(max(first_event_date_start) AS DATE)) AS INTEGER) AS days_until_event
  FROM p3 WHERE event_name IS NOT NULL GROUP BY event_name),
routes AS (
  SELECT event_name, days_until_event, T FROM starts, (SELECT unnest([{", ".join(map(str, HZ))}]) AS T) hz
  QUALIFY row_number() OVER (PARTITION BY event_name ORDER BY abs(T - greatest(days_until_event, 0)), T) = 1)"""
ROUTED_SPEC = ([("event_name", "s"), ("model_T", "i"), ("days_until_event", "i"), ("cumulative_sales_at_t", "l"),
                (f"sales_last_{ML_LAG}_days", "l")]
               + [(c, "d") for c in ["sales_duration_hours_upto_t", "event_duration_hours", "avg_daily_sales_before_t",
                                     "avg_acceleration", "avg_age", "std_age", "male_percentage", "female_percentage",
                                     "main_city_buyer_ratio", "avg_product_value", "std_product_value", "avg_total_price",
                                     "scanned_percentage", "max_capacity"]]
               + [("unique_cities", "l"), ("day_of_week", "i"), ("event_month", "i")])


@register("routed_features", "WITH " + OF.event_table("T", ML_LAG, LO_REF, HI_REF, SPLIT, KEEP_UPCOMING, ROUTES)
          + "\n" + typed_select("(SELECT ev_out.*, forecast_days AS model_T, days_until_event FROM ev_out JOIN routes USING (event_name))",
                                ROUTED_SPEC))
def q_routed_features(spark, sf_dir):
    """The rows that predict_future scores: every upcoming event once, its features at the
    horizon it is routed to."""
    return finish(scoring_table(spark, sf_dir).select(
        *[F.col(c).cast("int").alias(c) if k == "i" else F.col(c) for c, k in ROUTED_SPEC]))


FOLDS = 5
RIDGE_FEATURES = ["cum", "vel"]
# Ridge with two features in closed form, on standardised columns, penalty 0.1 / sd of the target.
RIDGE_SQL = BASE_SQL + f""",
r AS (SELECT event_name, CAST(regexp_extract(event_name, '[0-9]+$') AS BIGINT) % {FOLDS} AS fold, y_true::DOUBLE AS y,
        cum::DOUBLE AS a, vel::DOUBLE AS v FROM b WHERE T = {T_EVAL}),
s AS (SELECT k.fold, avg(y) AS my, avg(a) AS ma, avg(v) AS mv, stddev_pop(y) AS sy, stddev_pop(a) AS sa, stddev_pop(v) AS sv,
        corr(a, v) AS c, corr(a, y) AS ca, corr(v, y) AS cv
      FROM (SELECT DISTINCT fold FROM r) k JOIN r ON r.fold <> k.fold GROUP BY k.fold),
w AS (SELECT *, 1 + 0.1 / sy AS d FROM s),
u AS (SELECT *, (d * ca - c * cv) / (d * d - c * c) * sy / sa AS ba, (d * cv - c * ca) / (d * d - c * c) * sy / sv AS bv FROM w),
q AS (SELECT u.fold, y, my + ba * (a - ma) + bv * (v - mv) AS p FROM r JOIN u ON r.fold = u.fold),
"""


@register("ridge_folds", RIDGE_SQL + "out AS (SELECT fold, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae, "
          "1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(*), 0) AS r2 FROM q GROUP BY fold)\n"
          + typed_select("out", [("fold", "l"), ("rmse", "d"), ("mae", "d"), ("r2", "d")]))
def q_ridge_folds(spark, sf_dir):
    """Ridge figures of each fold; all folds are solved from one pass over the rows."""
    fold = F.regexp_extract("event_name", "[0-9]+$", 0).cast("long") % FOLDS
    rows = base_table(spark, sf_dir).where(F.col("T") == T_EVAL).withColumn("__fold", fold)
    data = materialize(ml.training_rows(rows, "event_name", RIDGE_FEATURES, "y_true", False, ["__fold"]), "folds")
    models = gram.fold_models(spark, data, F.col("__fold"), RIDGE_FEATURES, "label", {"Ridge": ml.LINEAR["Ridge"]})
    scored = data.join(F.broadcast(models), F.col("__fold") == F.col("fold"))
    scored = scored.withColumn("prediction", gram.linear_score(RIDGE_FEATURES, "coefficients", "intercept"))
    return finish(ml.fold_figures(scored, False).select(F.col("__fold").alias("fold"), "rmse", "mae", "r2"))


LOG_RIDGE_SQL = BASE_SQL + f""",
r AS (SELECT ln(1 + y_true::DOUBLE) AS y, cum::DOUBLE AS a, vel::DOUBLE AS v FROM b WHERE T = {T_EVAL}),
s AS (SELECT stddev_pop(y) AS sy, stddev_pop(a) AS sa, stddev_pop(v) AS sv, corr(a, v) AS c, corr(a, y) AS ca, corr(v, y) AS cv FROM r),
w AS (SELECT *, 1 + 0.1 / sy AS d FROM s),
u AS (SELECT 'cum' AS feature, (d * ca - c * cv) / (d * d - c * c) * sy / sa AS value FROM w
      UNION ALL SELECT 'vel', (d * cv - c * ca) / (d * d - c * c) * sy / sv FROM w)
"""


@register("ridge_coefficients", LOG_RIDGE_SQL + typed_select(
    "(SELECT feature, value * 1000 AS value, row_number() OVER (ORDER BY abs(value) DESC, feature) AS rank FROM u)",
    [("feature", "s"), ("value", "d"), ("rank", "i")]))
def q_ridge_coefficients(spark, sf_dir):
    """Ridge on the log target: coefficients (per mille) by absolute size."""
    rows = base_table(spark, sf_dir).where(F.col("T") == T_EVAL)
    data = ml.training_rows(rows, "event_name", RIDGE_FEATURES, "y_true", True)
    moments = gram.moment_matrices(data, F.lit(0), RIDGE_FEATURES, "label")
    coef, _ = gram.solve(moments[0], *ml.LINEAR["Ridge"])
    return finish(ml.ranked_values(spark, dict(zip(RIDGE_FEATURES, (1000 * coef).tolist())), 20))


# Rolling origins: one a day, so that the last origin before a cut is the cut itself.
ORIGINS = [str(dt.date(2001, 9, 20) + dt.timedelta(days=i)) for i in range(46)]
ROLLING_SQL = BASE_SQL + f""",
o AS (SELECT unnest([{", ".join(f"DATE '{d}'" for d in ORIGINS)}]) AS cut),
m AS (SELECT T, cut, count(*) AS trained_on, coalesce(regr_slope(y_true, cum), 0) AS slope,
        coalesce(regr_intercept(y_true, cum), avg(y_true)) AS intercept
      FROM b JOIN o ON b.over_at <= o.cut GROUP BY T, cut HAVING count(*) >= 2),
k AS (SELECT b.*, (SELECT max(m.cut) FROM m WHERE m.T = b.T AND m.cut <= CAST(b.start AS DATE) - b.T) AS cut FROM b),
p AS (SELECT k.*, trained_on, intercept + slope * cum AS pred FROM k JOIN m ON k.T = m.T AND k.cut = m.cut)
"""


@register("rolling_backtest", ROLLING_SQL + typed_select(
    "(SELECT event_name, T, CAST(cut AS TIMESTAMP) AS cut, trained_on, y_true, cum, pred, pred < cum AS problem FROM p)",
    [("event_name", "s"), ("T", "i"), ("cut", "t"), ("trained_on", "l"), ("y_true", "l"), ("cum", "l"), ("pred", "d"),
     ("problem", "b")]))
def q_rolling_backtest(spark, sf_dir):
    """Rolling-origin back-test: every (event, T) scored by a saved model that learned only from
    events that were over T days before it."""
    b = materialize(base_table(spark, sf_dir), "base")
    store = ml.ModelStore(spark, ml.model_root(spark))
    version = store.begin()
    store.save_table(version, gram.rolling_models(spark, b, HZ, ORIGINS, "over_at", ["cum"], "y_true"), ["cum"], False)
    store.publish(version)
    models, meta = store.load_table(version, ["cum"])
    p = gram.rolling_scores(b, models, meta["features"], "start")
    return finish(p.select("event_name", "T", "cut", "trained_on", "y_true", "cum", F.col("prediction").alias("pred"),
                           (F.col("prediction") < F.col("cum")).alias("problem")))


@register("rolling_problem_rate", ROLLING_SQL + typed_select(
    "(SELECT T, count(*) AS events, avg(CASE WHEN pred < cum THEN 1.0 ELSE 0.0 END) AS problem_rate, "
    "sqrt(avg((pred - y_true) * (pred - y_true))) AS rmse FROM p GROUP BY T)",
    [("T", "i"), ("events", "l"), ("problem_rate", "d"), ("rmse", "d")]))
def q_rolling_problem_rate(spark, sf_dir):
    """Problem rate and error per horizon of the rolling-origin back-test."""
    p = q_rolling_backtest(spark, sf_dir)
    return finish(p.groupBy("T").agg(F.count(F.lit(1)).alias("events"),
                                     F.avg(F.col("problem").cast("double")).alias("problem_rate"),
                                     F.sqrt(F.avg((F.col("pred") - F.col("y_true")) ** 2)).alias("rmse")))


@register("model_compare")
def q_model_compare(spark, sf_dir):
    """5-fold comparison of the model families on the event features (rows-only check)."""
    summary, _, _ = ml.compare_models(spark, training_table(spark, sf_dir, (T_EVAL,)), ML_FEATURES, TARGET, fit_winner=False)
    return finish(summary)


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    """Ridge coefficients and random-forest importances, top 20 by absolute value
    (rows-only check)."""
    table = training_table(spark, sf_dir, (T_EVAL,))
    out = None
    for name in ("Ridge", "RandomForest"):
        model = ml.fit_family(table, name, ML_FEATURES, TARGET)
        part = ml.feature_importance(spark, model, ML_FEATURES, 20).withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return finish(out)


@register("predict_future")
def q_predict_future(spark, sf_dir):
    """The family with the lowest cross-validated RMSE, fitted per horizon on
    past events, saved and reloaded with metadata, scores every upcoming event with its
    nearest-horizon model (rows-only check; routed_features checks the rows it scores)."""
    tickets, known, bounds = _inputs(spark, sf_dir)
    inputs = materialize(pipe.input_columns(tickets, known, bounds["city_bound"]), "tickets_full"), known, bounds
    train = training_table(spark, sf_dir, inputs=inputs)
    rows = scoring_table(spark, sf_dir, inputs=inputs).withColumn("sold_so_far", F.col("cumulative_sales_at_t"))
    _, best, _ = ml.compare_models(spark, train.where(F.col("forecast_days") == T_EVAL), ML_FEATURES, TARGET, fit_winner=False)
    store = ml.ModelStore(spark, ml.model_root(spark))
    version = store.begin()

    def fit(T):
        model = ml.fit_family(train.where(F.col("forecast_days") == T), best, ML_FEATURES, TARGET)
        return store.save(version, model, T, ML_FEATURES, True)
    ml.side_by_side([lambda T=T: fit(T) for T in HZ])  # the fixed list of horizons
    store.publish(version)
    models = ml.side_by_side([lambda T=T: store.load(T, version, ML_FEATURES)[0] for T in HZ])
    scored = ml.score_routed(rows, dict(zip(HZ, models)), ML_FEATURES,
                             ["event_name", "sold_so_far", "days_until_event", "model_T"])
    out = ml.postprocess(scored, "prediction", "sold_so_far", True)
    return finish(out.select("event_name", "days_until_event", "model_T", "sold_so_far", "predicted_tickets"))


SENS_SQL = BASE_SQL + f""",
e AS (SELECT cum, vel, y_true FROM b WHERE T = {T_EVAL}),
m AS (SELECT quantile_cont(cum, 0.5) AS mc, quantile_cont(vel, 0.5) AS mv, min(cum) AS c0, max(cum) AS c1, min(vel) AS v0, max(vel) AS v1 FROM e),
st AS (SELECT unnest(range(11)) AS step),
grid AS (SELECT 'cum' AS feature, step, c0 + (c1 - c0) * step / 10.0 AS cum, mv AS vel FROM m, st
      UNION ALL SELECT 'vel', step, mc, v0 + (v1 - v0) * step / 10.0 FROM m, st),
l AS (SELECT regr_slope(y_true, cum) AS slope, regr_intercept(y_true, cum) AS intercept FROM e)
"""


@register("sensitivity_steps", SENS_SQL + typed_select(
    "(SELECT feature, step, cum, vel, intercept + slope * cum AS pred FROM grid, l)",
    [("feature", "s"), ("step", "i"), ("cum", "d"), ("vel", "d"), ("pred", "d")]))
def q_sensitivity_steps(spark, sf_dir):
    """Each feature varied in turn over its range, the other at its exact median, scored by a line."""
    table = materialize(base_table(spark, sf_dir).where(F.col("T") == T_EVAL), "base")
    line = table.agg(F.regr_slope("y_true", "cum").alias("slope"), F.regr_intercept("y_true", "cum").alias("intercept"))
    out = None
    for vary in ("cum", "vel"):
        part = ml.sensitivity_rows(table, ["cum", "vel"], vary).select(F.lit(vary).alias("feature"), "step", "cum", "vel")
        out = part if out is None else out.unionByName(part)
    out = attach_one_row(out, line)
    return finish(out.select("feature", "step", "cum", "vel", (F.col("intercept") + F.col("slope") * F.col("cum")).alias("pred")))


@register("sensitivity_grid")
def q_sensitivity_grid(spark, sf_dir):
    """Cumulative sales, ticket price and buyer age varied in turn over ten steps of the training
    range, other features held at their exact medians, scored by Ridge (rows-only)."""
    table = training_table(spark, sf_dir, (T_EVAL,))
    model = ml.fit_family(table, "Ridge", ML_FEATURES, TARGET)
    out = None
    for vary in ("cumulative_sales_at_t", "avg_product_value", "avg_age"):
        rows = ml.sensitivity_rows(table, ML_FEATURES, vary).withColumn("value", F.col(vary))
        rows = rows.withColumn("sold", F.col("cumulative_sales_at_t"))
        scored = model.transform(ml.align_features(rows, ML_FEATURES, keep=["step", "value", "sold"]))
        part = ml.postprocess(scored, "prediction", "sold", True).select(F.lit(vary).alias("feature"), "step", "value", "predicted_tickets")
        out = part if out is None else out.unionByName(part)
    return finish(out)
