"""Skew-safe exact statistics used by the fill/threshold operators.

Exact medians (trap T5: linear interpolation) normally buffer every value of a
group in one task.  Here values are first counted per (group, value) with a
combinable aggregate, and the percentile is taken over the (value, count)
pairs with Spark's ``percentile(col, p, frequency)`` -- exact, and a hot group
only costs as many rows as it has *distinct* values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Bracket rows that are sorted together at most; larger brackets are narrowed first.
BRACKET_ROWS = 50_000


def global_percentiles(df: DataFrame, wanted: Sequence[tuple[Column | str, float]], accuracy: int = 10000,
                       most: int = BRACKET_ROWS) -> list[float | None]:
    """Exact percentiles over all rows of a table, as numbers (None without values).

    ``wanted`` lists (column, p); nulls are skipped and positions interpolate
    linearly, like ``percentile``.  No group, no join, no window: every job is one
    aggregate without keys, whose state is a sketch or a few counts.

    1. A ``percentile_approx`` sketch brackets each target.
    2. Exact counts tell how many values lie below and inside each bracket; a bracket
       that misses its target is widened to the whole column.
    3. A bracket of more than ``most`` rows is narrowed by a sketch of its own values,
       around the wanted ranks, until it is small or holds a single value.
    4. The rows inside (at most ``most``) are sorted and the two neighbours picked.
    """
    cols = [(F.col(c) if isinstance(c, str) else c).cast("double") for c, _ in wanted]
    ps = [float(p) for _, p in wanted]
    eps = 3.0 / accuracy
    first = df.agg(*[x for i, (c, p) in enumerate(zip(cols, ps)) for x in (
        F.count(c).alias(f"n{i}"), F.min(c).alias(f"a{i}"), F.max(c).alias(f"b{i}"),
        F.percentile_approx(c, max(0.0, p - eps), accuracy).alias(f"lo{i}"),
        F.percentile_approx(c, min(1.0, p + eps), accuracy).alias(f"hi{i}"))]).first()
    out: list[float | None] = [None] * len(cols)
    brackets = {i: (first[f"lo{i}"], first[f"hi{i}"]) for i in range(len(cols)) if first[f"n{i}"]}
    rank = {i: ps[i] * (first[f"n{i}"] - 1) for i in brackets}

    def inside(i: int) -> Column:
        return F.when(cols[i].between(*brackets[i]), cols[i])

    while brackets:
        counts = df.agg(*[x for i, (lo, _) in brackets.items() for x in (
            F.count(F.when(cols[i] < lo, 1)).alias(f"below{i}"), F.count(inside(i)).alias(f"in{i}"))]).first()
        ready, narrow = {}, {}
        for i, (lo, hi) in list(brackets.items()):
            below, rows = counts[f"below{i}"], counts[f"in{i}"]
            low, high = math.floor(rank[i]), math.ceil(rank[i])
            if below > low or below + rows <= high:
                brackets[i] = (first[f"a{i}"], first[f"b{i}"])
            elif lo == hi:
                out[i] = lo
                del brackets[i]
            elif rows <= most:
                ready[i] = (low - below, high - below, rank[i] - low)
            else:
                narrow[i] = ((low - below) / rows, (high + 1 - below) / rows)
        if ready:
            got = df.agg(*[F.sort_array(F.collect_list(inside(i))).alias(f"v{i}") for i in ready]).select(
                *[F.array(F.get(f"v{i}", F.lit(a)), F.get(f"v{i}", F.lit(b))).alias(f"v{i}")
                  for i, (a, b, _) in ready.items()]).first()
            for i, (_, _, part) in ready.items():
                a, b = got[f"v{i}"]
                out[i] = a if a == b else (1 - part) * a + part * b
                del brackets[i]
        if narrow:
            cut = df.agg(*[x for i, (a, b) in narrow.items() for x in (
                F.percentile_approx(inside(i), max(0.0, a - eps), accuracy).alias(f"lo{i}"),
                F.percentile_approx(inside(i), min(1.0, b + eps), accuracy).alias(f"hi{i}"))]).first()
            for i in narrow:
                fresh = (cut[f"lo{i}"], cut[f"hi{i}"])
                if fresh == brackets[i]:  # a few values with many copies each: count them
                    values = df.where(inside(i).isNotNull()).groupBy(cols[i].alias("v")).agg(F.count(F.lit(1)).alias("f"))
                    out[i] = values.agg(F.percentile("v", F.lit(ps_inside(rank[i], counts[f"below{i}"], counts[f"in{i}"])),
                                                     F.col("f")).alias("x")).first()["x"]
                    del brackets[i]
                else:
                    brackets[i] = fresh
    return out


def ps_inside(rank: float, below: int, rows: int) -> float:
    """Percentile inside a bracket that stands for an overall rank."""
    return min(1.0, max(0.0, (rank - below) / max(1, rows - 1)))


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a one-row aggregate to every row (broadcast: exactly one row)."""
    return df.crossJoin(F.broadcast(one_row))


def medians_wide(df: DataFrame, cols: Sequence[str], group: str | None = None,
                 suffix: str = "__med", weight: str | None = None) -> DataFrame:
    """Exact medians of several columns, per ``group`` (or global), in two shuffles.

    Rows are counted per (group, value tuple) -- a combinable aggregate that
    collapses repeated values map-side -- and each column's median is the
    frequency-weighted ``percentile`` over those counts (nulls skipped).
    ``weight`` names an existing row-count column when ``df`` is pre-counted.
    """
    keys = [group] if group else []
    w = F.col(weight) if weight else F.lit(1)
    counted = df.groupBy(*keys, *cols).agg(F.sum(w).cast("long").alias("__freq"))
    aggs = [F.percentile(F.col(c).cast("double"), F.lit(0.5), F.col("__freq")).alias(c + suffix) for c in cols]
    return counted.groupBy(*keys).agg(*aggs) if keys else counted.agg(*aggs)


CUTS = 16


def _inside(counted: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(value, count) rows that lie in a bracket: from lo, above gt, up to hi (null: open)."""
    v = F.col("__v")
    return counted.join(brackets, list(keys)).where(
        (F.col("lo").isNull() | (v >= F.col("lo"))) & (F.col("gt").isNull() | (v > F.col("gt")))
        & (F.col("hi").isNull() | (v <= F.col("hi"))))


def _narrow(counted: DataFrame, brackets: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """Brackets of at most ``most`` distinct values around the same positions."""
    from salescast.session import materialize

    by = [*keys, "i", "pos", "lo", "hi", "gt", "below"]
    cuts = F.percentile_approx("__v", [k / CUTS for k in range(1, CUTS)], 1000).alias("cuts")
    while True:
        brackets = materialize(brackets, "brackets")
        sized = materialize(_inside(counted, brackets, keys).groupBy(*by).agg(
            F.count(F.lit(1)).alias("rows"), F.min("__v").alias("least"), F.max("__v").alias("most"), cuts), "cuts")
        wide = (F.col("rows") > most) & (F.col("least") < F.col("most"))
        if not sized.where(wide).limit(1).count():
            return brackets
        # Counts up to each cut, then the part that holds both positions around the target.
        parts = _inside(counted, sized.where(wide).drop("rows", "least", "most"), keys).groupBy(*by, "cuts").agg(
            *[F.sum(F.when(F.col("__v") <= F.get("cuts", F.lit(k)), F.col("__f")).otherwise(0)).alias(f"u{k}")
              for k in range(CUTS - 1)])
        gt, below, hi = F.col("gt"), F.col("below"), F.col("hi")
        for k in range(CUTS - 1):
            upto = F.col("below") + F.col(f"u{k}")
            gt = F.when(upto <= F.floor("pos"), F.get("cuts", F.lit(k))).otherwise(gt)
            below = F.when(upto <= F.floor("pos"), upto).otherwise(below)
            hi = F.when(F.col("below") + F.col(f"u{CUTS - 2 - k}") > F.ceil("pos"),
                        F.get("cuts", F.lit(CUTS - 2 - k))).otherwise(hi)
        cut = parts.select(*keys, "i", "pos", "lo", hi.alias("hi"), gt.alias("gt"), below.alias("below"))
        brackets = sized.where(~wide).select(*by).unionByName(cut)


def exact_percentiles(df: DataFrame, value: str, ps: Sequence[float], group_cols: Sequence[str] = (),
                      outs: Sequence[str] | None = None, accuracy: int = 10000,
                      group_bound: int | None = None, most: int = BRACKET_ROWS) -> DataFrame:
    """Exact percentiles of ``value`` per group with Spark's ``percentile``
    semantics (linear interpolation at position p * (n - 1), nulls skipped),
    without buffering a group's distinct values in one task.

    1. rows are counted per (group, value) -- combinable;
    2. a ``percentile_approx`` sketch per group (combinable, bounded memory)
       brackets each target at p -/+ 3/accuracy;
    3. exact counts verify each bracket: the values below it and up to its top
       must enclose both target positions.  A bracket that fails (the sketch
       guarantee makes this the exception) widens to the whole group, so the
       result is exact either way;
    4. brackets of more than ``most`` distinct values are cut at sixteenths and the
       parts counted, again and again, until every bracket is small;
    5. a running count over the bracket's (value, count) rows finds the two values
       around each target: no task sorts more than ``most`` rows of a group.

    Output: group columns + one column per p (``outs`` or ``<value>_p<100p>``).
    ``group_bound`` (a proven bound on the number of groups) lets the
    per-group bracket table be broadcast.
    """
    from salescast.session import broadcast_bounded, materialize

    outs = list(outs) if outs else [f"{value}_p{int(round(p * 100))}" for p in ps]
    if not group_cols:
        found = global_percentiles(df, [(value, p) for p in ps], accuracy)
        return df.sparkSession.range(1).select(*[F.lit(v).cast("double").alias(o) for o, v in zip(outs, found)])
    keys = list(group_cols)
    x = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    counted = x.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__f"))

    eps = 3.0 / accuracy
    sketch = [F.count(F.lit(1)).alias("__n")]
    for i, p in enumerate(ps):
        sketch += [F.percentile_approx("__v", max(0.0, p - eps), accuracy).alias(f"__lo{i}"),
                   F.percentile_approx("__v", min(1.0, p + eps), accuracy).alias(f"__hi{i}")]
    bounds = x.groupBy(*keys).agg(*sketch)
    # one row per (group, target): position, bracket
    targets = bounds.select(*keys, "__n", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("__n") - 1)).alias("pos"),
                 F.col(f"__lo{i}").alias("lo"), F.col(f"__hi{i}").alias("hi"))
        for i, p in enumerate(ps)])).alias("__T")).select(*keys, "__T.*")
    if group_bound is not None:
        targets = broadcast_bounded(targets, group_bound * len(ps))
    tj = counted.join(targets, keys)
    check = (tj.groupBy(*keys, "i", "pos", "lo", "hi")
             .agg(F.sum(F.when(F.col("__v") < F.col("lo"), F.col("__f")).otherwise(0)).alias("below"),
                  F.sum(F.when(F.col("__v") <= F.col("hi"), F.col("__f")).otherwise(0)).alias("upto")))
    ok = (F.col("below") <= F.floor("pos")) & (F.col("upto") > F.ceil("pos"))
    brackets = check.select(*keys, "i", "pos",
                            F.when(ok, F.col("lo")).alias("lo"), F.when(ok, F.col("hi")).alias("hi"),
                            F.when(ok, F.col("below")).otherwise(F.lit(0)).alias("below"))
    counted = materialize(counted, "counted")  # read by every narrowing step
    brackets = _narrow(counted, brackets.withColumn("gt", F.lit(None).cast("double")), keys, most)
    if group_bound is not None:
        brackets = broadcast_bounded(brackets, group_bound * len(ps))
    inside = _inside(counted, brackets, keys)
    w = (Window.partitionBy(*keys, "i").orderBy("__v")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = inside.withColumn("__c", F.col("below") + F.sum("__f").over(w))
    lo_pos, hi_pos = F.floor("pos"), F.ceil("pos")
    picked = (ranked.groupBy(*keys, "i", "pos")
              .agg(F.min(F.when(F.col("__c") > lo_pos, F.col("__v"))).alias("__a"),
                   F.min(F.when(F.col("__c") > hi_pos, F.col("__v"))).alias("__b")))
    val = F.when(hi_pos == lo_pos, F.col("__a")).otherwise(
        (hi_pos - F.col("pos")) * F.col("__a") + (F.col("pos") - lo_pos) * F.col("__b"))
    wide = picked.groupBy(*keys).agg(*[F.max(F.when(F.col("i") == i, val)).alias(o) for i, o in enumerate(outs)])
    return wide
