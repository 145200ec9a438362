"""Distributed batch ML (M01-M11, O05, O06, P14) on pyspark.ml.

The model family list of the reference (Lasso, Ridge, ElasticNet, random
forest, gradient boosting and two boosting libraries) maps to
``LinearRegression`` with elasticNetParam 1 / 0 / 0.5, ``RandomForestRegressor``
and ``GBTRegressor`` (which stands in for both boosting libraries).  The
selection rule is not in the reference; we pick the lowest mean CV RMSE on the
original ticket scale (seed 42).
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.functions.numeric import safe_pct_error
from salescast.operators import gram
from salescast.operators.stats import global_percentiles
from salescast.sources import storage

SEED = 42  # fixed value: global random state of the reference


def align_features(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Expected feature columns in order, missing (or null) ones as 0.0, extras
    dropped; ``keep`` columns (keys) are carried in front."""
    have = set(df.columns)
    feats = [(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in have else F.lit(0.0)).alias(c)
             for c in expected]
    return df.select(*keep, *feats)


def model_families(label: str = "label") -> dict:
    return {
        "Lasso": LinearRegression(labelCol=label, elasticNetParam=1.0, regParam=0.1),
        "Ridge": LinearRegression(labelCol=label, elasticNetParam=0.0, regParam=0.1),
        "ElasticNet": LinearRegression(labelCol=label, elasticNetParam=0.5, regParam=0.1),
        "RandomForest": RandomForestRegressor(labelCol=label, numTrees=20, seed=SEED),
        "GradientBoost": GBTRegressor(labelCol=label, maxIter=10, seed=SEED),
    }


def _fit(data: DataFrame, features: Sequence[str], estimator) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[assembler, estimator]).fit(data)


def training_rows(table: DataFrame, key: str, features: Sequence[str], target: str, log_target: bool,
                  more: Sequence[str] = ()) -> DataFrame:
    """Key, features (null as 0), target ``__y`` and the label models are fitted to."""
    y = F.col(target).cast("double")
    return table.select(F.col(key).alias("__key"), *more,
                        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features],
                        y.alias("__y"), (F.log1p(y) if log_target else y).alias("label"))


def fit_family(table: DataFrame, name: str, features: Sequence[str], target: str, key: str = "event_name",
               log_target: bool = True) -> PipelineModel:
    """One family of :func:`model_families` on all rows of a training table."""
    return _fit(training_rows(table, key, features, target, log_target), features, model_families()[name])


# Penalty and L1 share of the linear families of :func:`model_families`.
LINEAR = {"Lasso": (0.1, 1.0), "Ridge": (0.1, 0.0), "ElasticNet": (0.1, 0.5)}
# Spark jobs that fit models side by side.
AT_ONCE = 8


def side_by_side(jobs: Sequence[Callable]) -> list:
    """Results of independent Spark actions, run a few at a time."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(lambda job: job(), jobs))


def compare_models(spark: SparkSession, table: DataFrame, features: Sequence[str], target: str,
                   log_target: bool = True, folds: int = 5, key: str = "event_name",
                   families: Sequence[str] | None = None, fold: Column | None = None,
                   fit_winner: bool = True) -> tuple[DataFrame, str, PipelineModel | None]:
    """M02 + M03 + M07: k-fold comparison; (summary, name of the winner, winner fitted on all rows).

    Folds are dealt by a hash of the key, or by ``fold``, a number per row.  The linear
    families are solved for all folds from one pass (:mod:`salescast.operators.gram`);
    tree families are fitted without a fold each, several at a time.  RMSE, MAE and R2 are
    measured on the held-out rows, on the ticket scale (after expm1 for a log target); one
    aggregate gives all figures, and the winner is the lowest mean RMSE over the folds.
    """
    from salescast.session import materialize

    data = training_rows(table if fold is None else table.withColumn("__fold", fold), key, features, target, log_target,
                         [] if fold is None else ["__fold"])
    if fold is None:
        data = data.withColumn("__fold", F.pmod(F.xxhash64("__key", F.lit(SEED)), F.lit(folds)))
    data = materialize(data, "folds")
    names = list(families or model_families())
    linear = {n: LINEAR[n] for n in names if n in LINEAR}
    parts = []
    if linear:
        models = gram.fold_models(spark, data, F.col("__fold"), features, "label", linear)
        parts.append(data.join(F.broadcast(models), F.col("__fold") == F.col("fold")).select(
            "model", "__fold", "__y", gram.linear_score(features, "coefficients", "intercept").alias("prediction")))
    others = [n for n in names if n not in linear]
    if others:
        used = [r["__fold"] for r in data.select("__fold").distinct().collect()]  # at most ``folds`` numbers
        jobs = [(n, k) for n in others for k in (used if len(used) > 1 else [])]
        fitted = side_by_side([lambda n=n, k=k: _fit(data.where(F.col("__fold") != k), features, model_families()[n])
                               for n, k in jobs])
        parts += [m.transform(data.where(F.col("__fold") == k)).select(F.lit(n).alias("model"), "__fold", "__y", "prediction")
                  for (n, k), m in zip(jobs, fitted)]
    schema = ("model string, rmse_mean double, rmse_sd double, mae_mean double, mae_sd double, r2_mean double, "
              "r2_sd double, folds long, target_transformed boolean")
    summary = spark.createDataFrame([], schema)
    if parts:
        summary = materialize(summarise(fold_figures(reduce(DataFrame.unionByName, parts), log_target), log_target), "models")
    top = summary.orderBy("rmse_mean", "model").first()  # one row per family
    best = top["model"] if top else names[0]
    return summary, best, _fit(data, features, model_families()[best]) if fit_winner else None


def fold_figures(scored: DataFrame, log_target: bool) -> DataFrame:
    """RMSE, MAE and R2 per (model, fold) of held-out predictions."""
    p = F.expm1("prediction") if log_target else F.col("prediction")
    err = F.col("__y") - p
    return scored.groupBy("model", "__fold").agg(
        F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
        (1 - F.sum(err * err) / F.nullif(F.var_pop("__y") * F.count("__y"), F.lit(0.0))).alias("r2"))


def summarise(figures: DataFrame, log_target: bool) -> DataFrame:
    """Mean and standard deviation over the folds of each family."""
    return figures.groupBy("model").agg(
        *[f(m).alias(f"{m}_{s}") for m in ("rmse", "mae", "r2") for f, s in ((F.avg, "mean"), (F.stddev_samp, "sd"))],
        F.count(F.lit(1)).alias("folds")).withColumn("target_transformed", F.lit(log_target))


def feature_importance(spark: SparkSession, model: PipelineModel, features: Sequence[str], k: int = 20) -> DataFrame:
    """M08 + O05: coefficients or importances, top-k by absolute value."""
    last = model.stages[-1]
    if hasattr(last, "coefficients"):
        vals = list(last.coefficients.toArray())
        kind = "coefficient"
    else:
        vals = list(last.featureImportances.toArray())
        kind = "importance"
    df = spark.createDataFrame([(f, float(v), kind) for f, v in zip(features, vals)],
                               "feature string, value double, kind string")
    return df.orderBy(F.abs("value").desc(), F.col("feature")).limit(k)


def ranked_values(spark: SparkSession, values: dict[str, float], k: int) -> DataFrame:
    """The ``k`` features (a list as long as the model is wide) of the largest absolute value, with their rank."""
    top = sorted(values, key=lambda f: (-abs(values[f]), f))[:k]
    return spark.createDataFrame([(f, float(values[f]), i) for i, f in enumerate(top, 1)], "feature string, value double, rank int")


def feature_hash(features: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(features).encode()).hexdigest()


class ModelStore:
    """Trained models in versions of their own.

    A run calls :meth:`begin`, saves all its models into that version and publishes it
    last: a pointer that names the version is written when everything else is there.
    Readers follow the newest pointer, so they never see a half-written set, and runs
    at the same time keep their own models.  Loading checks horizon and feature hash.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def begin(self) -> str:
        return storage.new_version()

    def _path(self, version: str, T: int) -> str:
        return f"{storage.version_path(self.root, version)}/T={T}"

    def _write_json(self, path: str, value: dict) -> None:
        self.spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.text(path)

    def _meta(self, T: int, features: Sequence[str], log_target: bool) -> dict:
        return {"forecast_days": T, "features": list(features), "feature_hash": feature_hash(features),
                "target_transformed": log_target}

    def save(self, version: str, model: PipelineModel, T: int, features: Sequence[str], log_target: bool) -> str:
        path = self._path(version, T)
        model.write().save(f"{path}/model")
        self._write_json(f"{path}/meta", self._meta(T, features, log_target))
        return path

    def save_table(self, version: str, models: DataFrame, features: Sequence[str], log_target: bool) -> None:
        """A table of linear models (:mod:`salescast.operators.gram`) as one entry, under horizon 0."""
        models.write.parquet(f"{self._path(version, 0)}/table")
        self._write_json(f"{self._path(version, 0)}/meta", self._meta(0, features, log_target))

    def publish(self, version: str) -> None:
        storage.publish(self.spark, self.root, version)

    def current(self) -> str:
        """The version published last."""
        return storage.current(self.spark, self.root)

    def _checked(self, version: str, T: int, features: Sequence[str] | None) -> dict:
        meta = json.loads(self.spark.read.text(f"{self._path(version, T)}/meta").first()[0])
        if meta.get("forecast_days") != T or feature_hash(meta.get("features") or []) != meta.get("feature_hash"):
            raise ValueError(f"model metadata for T={T} is invalid: {meta}")
        if features is not None and feature_hash(features) != meta["feature_hash"]:
            raise ValueError(f"the model for T={T} was trained on other features")
        return meta

    def load(self, T: int, version: str | None = None, features: Sequence[str] | None = None) -> tuple[PipelineModel, dict]:
        version = version or self.current()
        meta = self._checked(version, T, features)
        return PipelineModel.load(f"{self._path(version, T)}/model"), meta

    def load_table(self, version: str | None = None, features: Sequence[str] | None = None) -> tuple[DataFrame, dict]:
        version = version or self.current()
        meta = self._checked(version, 0, features)
        return self.spark.read.parquet(f"{self._path(version, 0)}/table"), meta


def score_routed(rows: DataFrame, models: dict[int, PipelineModel], features: Sequence[str], keep: Sequence[str],
                 horizon: str = "model_T") -> DataFrame:
    """Every row scored by the model of its own horizon, all models in one pass: ``keep``, then ``prediction``."""
    out = align_features(rows, features, keep=list(keep))
    for T, model in models.items():
        assembler, last = model.stages
        assembler = assembler.copy().setOutputCol(f"__x{T}")
        last = last.copy().setFeaturesCol(f"__x{T}").setPredictionCol(f"__p{T}")
        out = last.transform(assembler.transform(out))
    value = F.coalesce(F.lit(None).cast("double"), *[F.when(F.col(horizon) == T, F.col(f"__p{T}")) for T in models])
    return out.select(*keep, value.alias("prediction"))


def sensitivity_rows(table: DataFrame, features: Sequence[str], vary: str, steps: int = 10) -> DataFrame:
    """``vary`` in equal steps over its range in ``table``, all other features at their exact
    medians; ``log_<vary>`` follows it.  One row per step."""
    spark, logged = table.sparkSession, f"log_{vary}"
    others = [c for c in features if c not in (vary, logged)]
    low, high, *medians = global_percentiles(table, [(vary, 0.0), (vary, 1.0)] + [(c, 0.5) for c in others])
    value = F.lit(low).cast("double") + F.lit((high or 0.0) - (low or 0.0)) * F.col("step") / steps
    rows = spark.range(0, steps + 1).select(F.col("id").cast("int").alias("step"))
    rows = rows.withColumn(vary, value).withColumns({c: F.lit(m).cast("double") for c, m in zip(others, medians)})
    return rows.withColumn(logged, F.log1p(vary)) if logged in features else rows


def nearest_horizon(df: DataFrame, days_col: str, horizons: Sequence[int]) -> DataFrame:
    """Nearest trained horizon: negative days count as 0; ties -> smaller T.

    The horizon list is the small, fixed set of trained models, so the choice
    is a per-row expression (``array_min`` over (distance, T) structs): no
    join, no shuffle, and duplicate input rows stay as they are."""
    d = F.greatest(F.col(days_col), F.lit(0))
    options = F.array(*[F.struct(F.abs(F.lit(int(h)) - d).alias("dist"), F.lit(int(h)).alias("T"))
                        for h in horizons])
    return df.withColumn("model_T", F.array_min(options).getField("T"))


def route_events(tickets: DataFrame, horizons: Sequence[int], asof: str) -> DataFrame:
    """Per event the days until it starts, counted from ``asof``, and the nearest trained horizon."""
    starts = tickets.where(F.col("event_name").isNotNull()).groupBy("event_name").agg(
        F.max("first_event_date_start").alias("start"))
    starts = starts.withColumn("days_until_event", F.datediff(F.to_date("start"), F.to_date(F.lit(asof))))
    return nearest_horizon(starts, "days_until_event", horizons).select("event_name", "days_until_event", "model_T")


def residuals(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Residual (actual - predicted), absolute and % error per row; no % error for actual 0."""
    err = F.col(actual) - F.col(predicted)
    return scored.withColumns({"residual": err, "abs_error": F.abs(err),
                               "pct_error": safe_pct_error(F.col(actual).cast("double"), F.col(predicted))})


def postprocess(pred: DataFrame, raw_col: str, floor_col: str, log_target: bool) -> DataFrame:
    """M04 + X27 + T7: back-transform, clip at 0, never below tickets already sold,
    round half-to-even."""
    p = F.expm1(F.col(raw_col)) if log_target else F.col(raw_col)
    p = F.greatest(F.coalesce(p, F.lit(0.0)), F.lit(0.0))
    p = F.greatest(p, F.col(floor_col).cast("double"))
    return pred.withColumn("predicted_tickets", F.bround(p, 0))


def model_root(spark: SparkSession) -> str:
    from salescast.session import ensure_checkpoint_dir
    return os.path.join(ensure_checkpoint_dir(spark), "models")
