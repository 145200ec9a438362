"""Numeric / categorical column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_units(c: Column) -> Column:
    """X04: '21°C' / '1,5mm' / '40km/u' -> double (comma decimal), null if unparsable."""
    cleaned = F.regexp_replace(F.regexp_replace(c, "°C|mm|km/u", ""), ",", ".")
    return F.trim(cleaned).try_cast("double")


def european_decimal(c: Column) -> Column:
    """X05: '12,50' -> 12.5; X06 numeric coercion (null when unparsable)."""
    return F.regexp_replace(F.trim(c.cast("string")), ",", ".").try_cast("double")


def coerce_double(c: Column) -> Column:
    """Numeric coercion, bad values become null (trap T15)."""
    return c.cast("string").try_cast("double")


# Payment-method categories of the export.
PAYMENT_CATEGORIES = {"ideal": "iDeal", "creditcard": "Card", "paypal": "PayPal"}


def payment_category(c: Column) -> Column:
    """Payment method -> iDeal / Card / PayPal / Other."""
    low = F.lower(c)
    expr = F.lit("Other")
    for raw, cat in reversed(list(PAYMENT_CATEGORIES.items())):
        expr = F.when(low == raw, F.lit(cat)).otherwise(expr)
    return expr


def gender_std(c: Column, mode: str = "batch") -> Column:
    """Gender standardisation.

    batch: lower-case, female->woman, male->man, null->'unknown' (others kept);
    live: as batch plus 'vrouw'->woman;
    clean: lower-case map of male/man->man, female/woman/vrouw->woman,
           nonbinary->nonbinary, anything else -> null.
    """
    low = F.lower(c)
    if mode == "clean":
        return (F.when(low.isin("male", "man"), "man")
                .when(low.isin("female", "woman", "vrouw"), "woman")
                .when(low == "nonbinary", "nonbinary"))
    mapped = F.when(low == "female", "woman").when(low == "male", "man")
    if mode == "live":
        mapped = mapped.when(low == "vrouw", "woman")
    return F.coalesce(mapped.otherwise(low), F.lit("unknown"))


def age_bin(age: Column) -> Column:
    """X21 export bins [0,18),[18,25),[25,35),[35,45),[45,60),[60,120); else null."""
    edges = [0, 18, 25, 35, 45, 60, 120]
    labels = ["0-17", "18-24", "25-34", "35-44", "45-59", "60+"]
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (age >= lo) & (age < hi)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return expr


def age_category(age: Column) -> Column:
    """X21 cleaner bins (0,25],(25,35],(35,45],(45,55],(55,100]; else null."""
    edges = [0, 25, 35, 45, 55, 100]
    labels = ["<25", "25-35", "35-45", "45-55", "55+"]
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (age > lo) & (age <= hi)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return expr


def venue_type(capacity: Column) -> Column:
    """Null or < 3000 -> club, else festival."""
    return F.when(capacity >= 3000, "festival").otherwise("club")


def ticket_range(y: Column) -> Column:
    """T12 / A29 ranges [400,800),[800,1200),[1200,1700),[1700,inf)."""
    return (F.when((y >= 400) & (y < 800), "400-800")
            .when((y >= 800) & (y < 1200), "800-1200")
            .when((y >= 1200) & (y < 1700), "1200-1700")
            .when(y >= 1700, "1700+"))


def safe_pct_error(y: Column, p: Column) -> Column:
    """100*|y-p|/y, null when y = 0."""
    return F.try_divide(F.lit(100.0) * F.abs(y - p), y)


def inf_to_null(c: Column) -> Column:
    """+/-inf -> null."""
    return F.when(c.isin(float("inf"), float("-inf")), F.lit(None)).otherwise(c)


def log1p0(c: Column) -> Column:
    """log1p(fillna(0))."""
    return F.log1p(F.coalesce(c.cast("double"), F.lit(0.0)))
