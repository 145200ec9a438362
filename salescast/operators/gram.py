"""Linear models from moment matrices.

The sums of products of features and target are all that a linear model needs.  One
aggregate collects them per group of rows; the matrix of any union of groups is the sum
of theirs.  So k folds need one pass (the training set of a fold is the sum of the other
folds), and so do rolling origins (the training set of a cut is the sum of what was over
before it).  Ridge, Lasso and elastic net are then solved on matrices whose side is the
number of features, with the penalties of ``pyspark.ml`` (on standardised columns).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def moment_matrices(df: DataFrame, group: Column, features: Sequence[str], target: str) -> dict[int, np.ndarray]:
    """Per group (an integer; null is left out) the matrix of sums of products of (1, features, target).

    Products are summed inside the tasks and then per (group, matrix cell); what reaches the
    driver is one matrix per group: use it for folds, cuts and horizons, not for data keys.
    Columns are shifted by their means before and back afterwards, which keeps the digits."""
    names = [*features, target]
    rows = df.select(group.cast("long").alias("__g"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    rows = rows.where("__g IS NOT NULL")
    means = rows.agg(*[F.avg(f"c{i}") for i in range(len(names))]).first()
    shift = np.array([m or 0.0 for m in means])
    side = len(names) + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            groups = batch.column(0).to_numpy()
            z = np.column_stack([np.ones(batch.num_rows), *[
                np.nan_to_num(batch.column(i + 1).to_numpy(zero_copy_only=False)) - shift[i] for i in range(side - 1)]])
            for g in np.unique(groups):
                part = z[groups == g]
                found[int(g)] = found.get(int(g), 0) + part.T @ part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int64()), pa.array([m.ravel().tolist() for m in found.values()], pa.list_(pa.float64()))],
            names=["g", "m"])

    cells = rows.mapInArrow(sums, "g bigint, m array<double>").select("g", F.posexplode("m").alias("i", "x"))
    out: dict[int, np.ndarray] = {}
    for r in cells.groupBy("g", "i").agg(F.sum("x").alias("x")).collect():
        out.setdefault(r["g"], np.zeros(side * side))[r["i"]] = r["x"]
    back = np.eye(side)
    back[1:, 0] = shift
    return {g: back @ m.reshape(side, side) @ back.T for g, m in out.items()}


def solve(moments: np.ndarray, penalty: float = 0.0, l1_share: float = 0.0, rounds: int = 10_000) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) of the penalised least squares that ``moments`` stand for.
    Columns without spread get coefficient 0."""
    n = moments[0, 0]
    mean = moments[0, 1:] / n
    cov = moments[1:, 1:] / n - np.outer(mean, mean)
    size = np.diag(moments)[1:] / n
    sd = np.sqrt(np.where(np.diag(cov) > 1e-12 * size, np.diag(cov), 0.0))
    used = np.flatnonzero(sd[:-1] > 0)
    coef = np.zeros(len(sd) - 1)
    if len(used) and sd[-1] > 0:
        c = cov[np.ix_(used, used)] / np.outer(sd[used], sd[used])
        r = cov[used, -1] / (sd[used] * sd[-1])
        l1, l2 = l1_share * penalty / sd[-1], (1 - l1_share) * penalty / sd[-1]
        if l1 == 0:
            b = np.linalg.lstsq(c + l2 * np.eye(len(used)), r, rcond=None)[0]
        else:
            b = np.zeros(len(used))
            for _ in range(rounds):
                old = b.copy()
                for j in range(len(used)):
                    rest = r[j] - c[j] @ b + c[j, j] * b[j]
                    b[j] = np.sign(rest) * max(abs(rest) - l1, 0.0) / (c[j, j] + l2)
                if np.abs(b - old).max() < 1e-9:
                    break
        coef[used] = b * sd[-1] / sd[used]
    return coef, float(mean[-1] - coef @ mean[:-1])


def linear_score(features: Sequence[str], coefficients: Column | str, intercept: Column | str) -> Column:
    """intercept + sum of coefficient x feature, with the coefficients in an array column."""
    products = F.zip_with(F.array(*[F.col(c).cast("double") for c in features]), coefficients, lambda x, b: x * b)
    return F.aggregate(products, F.lit(0.0), lambda a, x: a + x) + (F.col(intercept) if isinstance(intercept, str) else intercept)


def model_table(spark: SparkSession, rows: Sequence[tuple], keys: str) -> DataFrame:
    """Table of solved models: ``keys`` (a schema), then coefficients and intercept."""
    return spark.createDataFrame([(*k, [float(x) for x in coef], float(b)) for *k, (coef, b) in rows],
                                 f"{keys}, coefficients array<double>, intercept double")


def fold_models(spark: SparkSession, df: DataFrame, fold: Column, features: Sequence[str], target: str,
                families: dict[str, tuple[float, float]]) -> DataFrame:
    """(model, fold, coefficients, intercept): each family (penalty, share of L1) solved
    without each fold, from one pass over the rows."""
    parts = moment_matrices(df, fold, features, target)
    rows = []
    for k in sorted(parts) if len(parts) > 1 else []:
        rest = sum(m for g, m in parts.items() if g != k)
        rows += [(name, k, solve(rest, *penalty)) for name, penalty in families.items()]
    return model_table(spark, rows, "model string, fold long")


def rolling_models(spark: SparkSession, df: DataFrame, horizons: Sequence[int], origins: Sequence[str], over: str,
                   features: Sequence[str], target: str, penalty: float = 0.0, least: int = 2) -> DataFrame:
    """(T, cut, trained_on, coefficients, intercept): the model of each horizon and each
    origin, learned only from events that were over (``over``) by then.

    ``df`` has a row per event and horizon ``T``.  Every row belongs to the first origin that
    it may teach; one pass collects the sums per (origin, horizon), running sums give the rest."""
    dates, hz = sorted(origins), sorted(horizons)
    cuts = F.array(*[F.lit(day).cast("timestamp_ntz").cast(df.schema[over].dataType) for day in dates])
    first = F.size(F.filter(cuts, lambda c: c < F.col(over)))  # origins that come too early to know the row
    first = F.when(F.col(over).isNotNull() & (first < len(dates)), first)
    place = F.nullif(F.array_position(F.array(*[F.lit(int(T)) for T in hz]), F.col("T")), F.lit(0)) - 1
    parts = moment_matrices(df, first * len(hz) + place, features, target)
    rows = []
    for j, T in enumerate(hz):
        known = 0
        for k, day in enumerate(dates):
            known = known + parts.get(k * len(hz) + j, 0)
            if isinstance(known, np.ndarray) and known[0, 0] >= least:
                rows.append((T, day, int(round(known[0, 0])), solve(known, penalty)))
    return model_table(spark, rows, "T int, cut string, trained_on long").withColumn("cut", F.to_date("cut"))


def rolling_scores(df: DataFrame, models: DataFrame, features: Sequence[str], start: str) -> DataFrame:
    """``df`` scored by the model of its horizon and the last origin on or before its own cut (start - T
    days), as ``prediction``; rows that no origin precedes are left out.  The models are few and broadcast."""
    cut = F.date_sub(F.to_date(start), F.col("T"))
    rows = df.withColumn("__cut", cut)
    days = models.groupBy("T").agg(F.array_sort(F.collect_set("cut")).alias("__cuts"))
    rows = rows.join(F.broadcast(days), "T").withColumn(
        "cut", F.array_max(F.filter("__cuts", lambda c: c <= F.col("__cut"))))
    rows = rows.join(F.broadcast(models), ["T", "cut"])
    return rows.withColumn("prediction", linear_score(features, "coefficients", "intercept")).drop(
        "__cut", "__cuts", "coefficients", "intercept")
