"""Mixing sources to target weights by iterative proportional fitting.

Token counts of (source, language, topic) cells are raked until their marginals
meet the targets; a document's inclusion probability is proportional to raked
weight over observed weight of its cell, calibrated to a token budget, and a
hash of its id draws it.  The same id is drawn alike in every run.

Only DataFrame functions touch the rows.  Cells are pre-aggregated where rows
are read; every source, language and topic has its own.  The cell table is
counted: up to ``LOCAL_CELLS`` cells and ``LOCAL_BYTES`` of names it is raked on
the driver and broadcast back.  A larger one stays a Spark table: a raked weight
is the observed one times a factor per source, language and topic, so each step
sums the cells by one axis and writes that axis' factors; calibration takes
aggregates over the cells, and cells meet rows in a shuffled join.

Targets: shares per value for any of the three marginals; without them a
marginal's shares are its observed token shares to the power ``POWER``, scaled
to one (small sources gain, large ones lose).

Topic: content words (six letters or more) fall into ``TOPICS`` classes by hash,
and a text's topic is its most frequent class.  A column named ``topic`` in the
input is used instead.

Defined results
* null source, language or topic: a value of its own, shown as null.
* texts without words have no tokens; they are drawn like others of their cell,
  and cells without any token have probability 0.
* repeated rows of a doc_id are drawn together; null doc_id draws by the text.
* given targets that the cells cannot have together are an error (``TargetsNotMet``); the softened observed
  shares, used without targets, only warn, and the last round's weights stand.
* topic ties go to the class with the smallest number; very long texts are counted whole, in one row.
* an empty table gives an empty result; other columns are passed through, and
  columns named like an added column are replaced (two leading underscores are reserved).
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import WORD, materialize, read

TOPICS = 8
AXES = {"source": "s", "lang": "l", "topic": "t"}
# Up to here the cell table goes through the driver.
LOCAL_CELLS, LOCAL_BYTES = 100_000, 16 << 20
POWER = 0.5
BUDGET = 0.5
SEED = 11
RAKE_ROUNDS, RAKE_TOLERANCE = 500, 1e-10
# A share may stay this far off its target (a fit that converges slowly); beyond it the targets count as contradictory.
DEVIATION = 0.001


def add_tokens_and_topic(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus n_tokens (words) and topic."""
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"({WORD})"), F.lit(1))
    out = df.withColumn("__w", words).withColumn("n_tokens", F.size("__w").cast("long"))
    if "topic" in df.columns:
        return out.drop("__w")
    out = out.withColumn("__votes", F.transform(F.filter("__w", lambda w: F.length(w) >= 6),
                                                lambda w: F.pmod(F.xxhash64(F.lower(w)), F.lit(TOPICS)).cast("int")))
    def votes(k: int):
        return F.struct(F.size(F.filter("__votes", lambda v: v == k)).alias("n"), F.lit(-k).alias("k"))

    counts = F.array(*[votes(k) for k in range(TOPICS)])
    topic = F.when(F.size("__votes") > 0, F.concat(F.lit("t"), (-F.array_max(counts)["k"]).cast("string")))
    return out.withColumn("topic", topic).drop("__w", "__votes")


class TargetsNotMet(ValueError):
    """The cells cannot have the wanted shares: a marginal stays further off than ``DEVIATION``."""


def checked(off: list[float], given: list[bool]) -> None:
    """Given targets that are not met are an error; softened observed shares need not fit together, so they only warn.
    ``off``, how far the final shares are from their targets, and ``given`` are by axis."""
    worst, strict = max(off), any(x > DEVIATION and g for x, g in zip(off, given))
    if worst > DEVIATION:
        text = (f"after {RAKE_ROUNDS} rounds a share is still {worst:.4f} off its target; the source, language and "
                f"topic shares contradict each other in these documents")
        if strict:
            raise TargetsNotMet(text)
        warnings.warn(text, stacklevel=2)


def rake_cells(tokens: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray],
               given: list[bool] | None = None) -> np.ndarray:
    """Iterative proportional fitting of cells (tokens and a value number per axis) to shares per axis.
    Raises :class:`TargetsNotMet` where the fit ends far from a ``given`` target (all, if not said), else warns."""
    def off(code, target):
        now = np.bincount(code, weights=w, minlength=len(target))
        return now, float(np.abs(now - target)[now > 0].max(initial=0.0))

    w, worst = tokens / tokens.sum(), 0.0
    for _ in range(RAKE_ROUNDS):
        worst = 0.0
        for code, target in zip(codes, targets):
            now, far = off(code, target)
            ratio = np.divide(target, now, out=np.ones_like(now), where=now > 0)
            worst = max(worst, far)
            w = w * ratio[code]
        if worst < RAKE_TOLERANCE:
            break
    checked([off(code, target)[1] for code, target in zip(codes, targets)], given or [True] * len(codes))
    return w


def rake(tokens: np.ndarray, targets: list[np.ndarray]) -> np.ndarray:
    """Iterative proportional fitting of a 3-way table to shares per axis."""
    codes = [c.ravel() for c in np.indices(tokens.shape)]
    return rake_cells(tokens.ravel(), codes, targets).reshape(tokens.shape)


def calibrate(ratio: np.ndarray, tokens: np.ndarray, budget: float) -> np.ndarray:
    """min(1, s * ratio) with s such that the expected tokens are ``budget`` of all."""
    used = tokens > 0
    if not used.any():
        return np.zeros_like(ratio)
    goal, r, t = budget * tokens.sum(), ratio[used], tokens[used]
    order = np.argsort(-r)
    r, t = r[order], t[order]
    full = np.concatenate([[0.0], np.cumsum(t)])[:-1]  # tokens of the cells taken whole
    rest = np.cumsum((r * t)[::-1])[::-1]
    s = np.maximum(goal - full, 0) / np.maximum(rest, 1e-300)
    i = int(np.argmax(s * r <= 1)) if (s * r <= 1).any() else len(r) - 1
    return np.where(used, np.minimum(1.0, s[i] * ratio), 0.0)


def target_shares(names: list, observed: np.ndarray, wanted: dict | None, power: float) -> np.ndarray:
    """Shares that sum to one over the values that have tokens."""
    if wanted is None:
        share = np.where(observed > 0, np.maximum(observed, 1e-300) ** power, 0.0)
    else:
        share = np.array([float(wanted.get(v, 0.0)) for v in names]) * (observed > 0)
    return share / share.sum() if share.sum() else observed / observed.sum()


SCHEMA = "__cs string, __cl string, __ct string, weight double, probability double"


def local_probabilities(cells: DataFrame, targets: dict, budget: float, power: float) -> DataFrame:
    """Weight and probability of each cell, found on the driver."""
    rows = cells.collect()
    tokens = np.array([r["n"] for r in rows], dtype=float)
    codes, wanted = [], []
    for axis, a in AXES.items():
        names = sorted({r[a] for r in rows}, key=lambda v: (v is not None, v or ""))
        place = {v: i for i, v in enumerate(names)}
        codes.append(np.array([place[r[a]] for r in rows]))
        observed = np.bincount(codes[-1], weights=tokens, minlength=len(names)) / tokens.sum()
        wanted.append(target_shares(names, observed, targets.get(axis), power))
    raked = rake_cells(tokens, codes, wanted, [axis in targets for axis in AXES])
    p = calibrate(raked / (tokens / tokens.sum()), tokens, budget)
    out = [(r["s"], r["l"], r["t"], float(w), float(x)) for r, w, x in zip(rows, raked, p)]
    return cells.sparkSession.createDataFrame(out, SCHEMA)


def key_of(value: Column) -> Column:
    """A join key that is never null."""
    return F.when(value.isNull(), "n").otherwise(F.concat(F.lit("="), value))


def discard(df: DataFrame) -> None:
    """Delete a materialised table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def table_targets(cells: DataFrame, a: str, total: int, wanted: dict | None, power: float) -> DataFrame:
    """(key, target, factor 1) of each value of an axis, as ``target_shares``."""
    shares = cells.groupBy(f"k{a}").agg((F.sum("n") / F.lit(float(total))).alias("o"))
    if wanted is None:
        shares = shares.withColumn("share", F.pow("o", F.lit(float(power))))
    else:
        given = [("n" if v is None else f"={v}", float(x)) for v, x in wanted.items() if v is None or isinstance(v, str)]
        given = cells.sparkSession.createDataFrame(given, f"k{a} string, share double")
        shares = shares.join(given, f"k{a}", "left").fillna(0.0, ["share"])
    shares = materialize(shares, "shares")
    full = shares.agg(F.sum("share").alias("x")).first()["x"]
    target = F.col("share") / F.lit(full) if full else F.col("o")
    return shares.select(f"k{a}", target.alias("target"), F.lit(1.0).alias(f"f{a}"), F.lit(0.0).alias("off"))


def table_probabilities(cells: DataFrame, total: int, targets: dict, budget: float, power: float) -> DataFrame:
    """Weight and probability of each cell, found by aggregates and joins of Spark tables."""
    cells = materialize(cells.withColumns({f"k{a}": key_of(F.col(a)) for a in AXES.values()}), "cells")
    share = F.col("n") / F.lit(float(total))
    factors = {a: table_targets(cells, a, total, targets.get(axis), power) for axis, a in AXES.items()}

    def shares_now(a: str) -> tuple[DataFrame, Column, Column]:
        """The axis with ``rest``, whether a value is in use, and how far its share is from its target."""
        x, w = cells, share
        for other in factors:
            if other != a:
                x = x.join(factors[other].select(f"k{other}", f"f{other}"), f"k{other}")
                w = w * F.col(f"f{other}")
        now = x.groupBy(f"k{a}").agg(F.sum(w).alias("rest")).withColumnRenamed(f"k{a}", "k")
        now = factors[a].drop("off").join(now, F.col(f"k{a}") == F.col("k"))
        used = F.col(f"f{a}") * F.col("rest") > 0
        return now, used, F.when(used, F.abs(F.col(f"f{a}") * F.col("rest") - F.col("target"))).otherwise(F.lit(0.0))

    written, worst = {}, 0.0
    for _ in range(RAKE_ROUNDS):
        worst = 0.0
        for a in factors:
            now, used, off = shares_now(a)
            new = F.when(used, F.col("target") / F.col("rest")).otherwise(F.col(f"f{a}"))
            factors[a] = materialize(now.select(f"k{a}", "target", new.alias(f"f{a}"), off.alias("off")), "factors")
            if a in written:
                discard(written[a])
            written[a] = factors[a]
            worst = max(worst, factors[a].agg(F.max("off").alias("x")).first()["x"])
        if worst < RAKE_TOLERANCE:
            break
    finals = [shares_now(a) for a in factors]
    checked([now.agg(F.max(off).alias("x")).first()["x"] for now, _, off in finals], [axis in targets for axis in AXES])
    ratio = F.lit(1.0)
    for a in factors:
        cells = cells.join(factors[a].select(f"k{a}", f"f{a}"), f"k{a}")
        ratio = ratio * F.col(f"f{a}")
    cells = materialize(cells.select("s", "l", "t", "n", ratio.alias("ratio")), "raked")
    # min(1, scale * ratio): the cells taken whole grow in number until the scale fits the rest.
    scale, whole = 0.0, -1
    while True:
        full = F.col("ratio") * F.lit(scale) > 1
        r = cells.agg(F.count_if(full).alias("cells"), F.sum(F.when(full, F.col("n")).otherwise(0)).alias("n"),
                      F.sum(F.when(full, 0.0).otherwise(F.col("ratio") * F.col("n"))).alias("rest")).first()
        if r["cells"] == whole:
            break
        whole = r["cells"]
        scale = max(budget * total - r["n"], 0.0) / max(r["rest"], 1e-300)
    p = F.least(F.lit(1.0), F.col("ratio") * F.lit(scale))
    return cells.select(F.col("s").alias("__cs"), F.col("l").alias("__cl"), F.col("t").alias("__ct"),
                        (share * F.col("ratio")).alias("weight"), p.alias("probability"))


def cell_probabilities(rows: DataFrame, targets: dict | None = None, budget: float = BUDGET,
                       power: float = POWER) -> tuple[DataFrame, bool]:
    """(cells with tokens, their weight and probability; whether they are few enough to broadcast)."""
    cells = (rows.groupBy(*[F.col(axis).cast("string").alias(a) for axis, a in AXES.items()])
             .agg(F.sum("n_tokens").alias("n")).filter("n > 0"))
    cells = materialize(cells, "cells")
    width = sum((F.coalesce(F.octet_length(a), F.lit(0)) for a in AXES.values()), F.lit(0))
    size = cells.agg(F.count(F.lit(1)).alias("cells"), F.sum(width).alias("bytes"), F.sum("n").alias("n")).first()
    if not size["cells"]:
        return rows.sparkSession.createDataFrame([], SCHEMA), True
    if size["cells"] <= LOCAL_CELLS and size["bytes"] <= LOCAL_BYTES:
        return local_probabilities(cells, targets or {}, budget, power), True
    return table_probabilities(cells, size["n"], targets or {}, budget, power), False


def mix(rows: DataFrame, targets: dict | None = None, budget: float = BUDGET, power: float = POWER,
        seed: int = SEED, doc_id: str = "doc_id") -> DataFrame:
    """``rows`` (with n_tokens and topic) plus weight, probability, draw and chosen."""
    rows = rows.drop("weight", "probability", "draw", "chosen")
    cells, few = cell_probabilities(rows, targets, budget, power)
    keyed = rows.withColumns({f"__{a}": F.col(axis).cast("string") for axis, a in AXES.items()})
    same = (F.col("__s").eqNullSafe(F.col("__cs")) & F.col("__l").eqNullSafe(F.col("__cl"))
            & F.col("__t").eqNullSafe(F.col("__ct")))
    out = keyed.join(F.broadcast(cells) if few else cells, same, "left")  # broadcast: LOCAL_CELLS rows at most
    other = F.col("text") if "text" in rows.columns else F.lit(None).cast("string")
    draw = F.xxhash64(F.col(doc_id), F.when(F.col(doc_id).isNull(), other), F.lit(seed))
    out = out.withColumns({
        "weight": F.coalesce("weight", F.lit(0.0)), "probability": F.coalesce("probability", F.lit(0.0)),
        "draw": F.shiftrightunsigned(draw, 11) / F.lit(float(1 << 53))})
    return out.withColumn("chosen", F.col("draw") < F.col("probability")).drop("__s", "__l", "__t", "__cs", "__cl", "__ct")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inclusion probability and draw of every document under raked source, language and topic weights."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    rows = materialize(add_tokens_and_topic(docs).drop("text"), "mixing")
    out = mix(rows)
    return out.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("weight", 9).alias("weight"),
                      F.round("probability", 9).alias("probability"), "chosen")
