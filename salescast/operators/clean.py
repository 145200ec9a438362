"""Cleaning and filtering operators.

Skew notes: de-duplication is an aggregate (least packed order key, then ``min_by``
among its rows), not a window, so a barcode with millions of copies is reduced
map-side; group sizes are a combinable count joined back by the planner
(AQE splits a hot key); quantiles are exact but only sort a sketch-chosen
bracket of (value, count) pairs, never a whole group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescast.operators.stats import exact_percentiles, global_percentiles


# Sources from the most to the least trusted one (first copy of a barcode wins).
SOURCE_PRIORITY = {"shop_f": 0, "shop_o": 1}


def non_empty(c: Column) -> Column:
    """non-null and non-empty."""
    return c.isNotNull() & (c != "")


def not_contains_ci(c: Column, needle: str) -> Column:
    """negated case-insensitive substring; null values are kept."""
    return ~F.coalesce(F.lower(c).contains(needle.lower()), F.lit(False))


def in_range(c: Column, lo: str, hi: str) -> Column:
    """non-null and within [lo, hi]."""
    return c.isNotNull() & c.between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz"))


def drop_negative(c: Column) -> Column:
    """drop negative values (zero fine, null kept)."""
    return ~F.coalesce(c < 0, F.lit(False))


def both_missing(a: Column, b: Column) -> Column:
    """F11 predicate: both dates invalid."""
    return a.isNull() & b.isNull()


def dedup_keep_first(df: DataFrame, key: str, order: Sequence[Column], packed: Column | None = None,
                     dealt_by: str | None = None, same: Sequence[str] = ()) -> DataFrame:
    """Keep the first row per ``key`` under an explicit total order; rows without a
    key count as one key of their own, of which one row stays.

    ``packed`` is a number that never falls where ``order`` rises, such as its leading
    columns in one long (:func:`packed_order`).  With it the work is two-step: a hash
    aggregate of primitives finds the repeated keys and the least number of each; rows of
    other keys pass, and of repeated keys only the rows with that number are compared by
    the whole ``order``.  No step sorts all rows, and both steps share one exchange.

    Without it: ``groupBy(key).agg(min_by(struct(row), struct(order)))``.  Either way a
    key that holds a third of all rows is reduced on the map side (a window would sort
    that whole group in one task).

    ``dealt_by`` names a column that the key decides (equal keys, equal values) and by which
    the rows are already repartitioned, for a later join: then the copies of a key lie in one
    partition, each partition ranks its own rows, and nothing is moved.  ``same`` names columns that,
    with ``dealt_by``, are equal exactly where the keys are: numbers to sort by in place of a text key.
    """
    if dealt_by is not None:
        place = F.row_number().over(Window.partitionBy(dealt_by, *(same or [key])).orderBy(*order))
        return df.withColumn("__place", place).where("__place = 1").drop("__place")
    cols = [c for c in df.columns if c != key]
    best = F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(*order)).alias("__row")
    if packed is None:
        return (df.groupBy(key).agg(best)
                .select(key, *[F.col("__row").getField(c).alias(c) for c in cols]))
    rows = df.withColumns({"__key": F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")), "__packed": packed})
    several = rows.groupBy(F.col("__key").alias("__k")).agg(
        F.min("__packed").alias("__least"), F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n")
    # The repeated keys are the narrow side, one row each; the planner broadcasts them when they are few.
    several = several.hint("shuffle_hash")
    single = rows.join(several, F.col("__key") == F.col("__k"), "left_anti").select(key, *cols)
    first = rows.join(several, (F.col("__key") == F.col("__k")) & (F.col("__packed") == F.col("__least")))
    first = first.groupBy(key).agg(best).select(key, *[F.col("__row").getField(c).alias(c) for c in cols])
    return single.unionByName(first)


def packed_order(rank: Column, time: Column) -> Column:
    """A small rank, then a time, as one long; an unknown time comes first, as in a struct's order."""
    micros = F.unix_micros(time.cast("timestamp"))
    return rank.cast("long") * F.lit(1 << 57) + F.coalesce(micros + F.lit(1 << 56), F.lit(0))


def dedup_tickets(t: DataFrame, priority: dict[str, int] | None = None, dealt_by: str | None = None,
                  same: Sequence[str] = ()) -> DataFrame:
    """W02 on the canonical ticket rows: by source priority, sale time, price, event, line."""
    rank = F.lit(len(priority or SOURCE_PRIORITY))
    for source, place in (priority or SOURCE_PRIORITY).items():
        rank = F.when(F.col("data_source") == source, place).otherwise(rank)
    order = [rank, *[F.col(c) for c in ("verkoopdatum", "product_value", "event_name", "line_no")]]
    return dedup_keep_first(t, "barcode", order, packed_order(rank, F.col("verkoopdatum")), dealt_by, same)


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int, ties: Sequence[str] = ()) -> DataFrame:
    """``n`` rows by the smallest digests of (``seed``, ``keys``): a random choice that does not depend on
    partitions or file order.  ``ties`` order rows of equal keys."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *keys).cast("binary"))
    return df.orderBy(digest, *ties).limit(n)


def group_size(df: DataFrame, key: str, out: str) -> DataFrame:
    """Size of the row's group (null key -> null), as count + join back."""
    sizes = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return df.join(sizes, key, "left")


def remove_outliers(df: DataFrame, cols: Sequence[str], method: str = "IQR", factor: float = 1.5) -> DataFrame:
    """Sequential per-column outlier filters; nulls are kept.

    IQR: keep q1 - f*iqr <= x <= q3 + f*iqr.  zscore: keep |x - mean| / sd <= f
    when sd > 0 (no filtering when sd is 0 or undefined).  combined: both.
    Bounds are numbers over the *current* (already filtered) rows, found by
    aggregates without keys, so the filters are plain comparisons with constants.
    The input is written once, because the bounds read it several times.
    """
    from salescast.session import materialize

    out = materialize(df, "outliers")
    for c in cols:
        x = F.col(c)
        keep = F.lit(True)
        if method in ("IQR", "combined"):
            q1, q3 = global_percentiles(out, [(c, 0.25), (c, 0.75)])
            if q1 is not None:
                keep = keep & (x.isNull() | x.between(q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)))
        if method in ("zscore", "combined"):
            s = out.agg(F.avg(x).alias("mu"), F.stddev_samp(x).alias("sd")).first()
            if s["sd"]:
                z = (x - s["mu"]) / s["sd"]
                keep = keep & (x.isNull() | z.between(-factor, factor))
        out = out.where(keep)
    return out


def price_sanity(df: DataFrame, group: str = "event_name", price: str = "product_value",
                 qty: str = "quantity", cents_above: float = 250.0, lo: float = 0.0, hi: float = 200.0,
                 group_bound: int | None = None) -> DataFrame:
    """per-event median > 250 means cents (divide by 100); divide by the
    quantity (0 or missing -> 1); keep lo < unit price < hi."""
    from salescast.session import broadcast_bounded

    med = exact_percentiles(df, price, [0.5], [group], outs=[price + "__med"], group_bound=group_bound)
    if group_bound is not None:
        med = broadcast_bounded(med, group_bound)
    j = df.join(med, group, "left")
    v = F.when(F.col(price + "__med") > cents_above, F.col(price) / 100).otherwise(F.col(price))
    given = F.coalesce(F.col(qty).cast("double"), F.lit(1.0))
    q = F.when(given == 0, F.lit(1.0)).otherwise(given)
    unit = v / q
    return j.withColumn("unit_price", unit).where((F.col("unit_price") > lo) & (F.col("unit_price") < hi)) \
        .drop(price + "__med")
