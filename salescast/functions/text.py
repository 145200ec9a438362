"""String column builders (X01, X02, X03, X07 helpers, X28, X30)."""

from __future__ import annotations

import functools
import json
import sys
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what Python's ``str.strip`` takes off ASCII text.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "


def _decomposed(s: str | None) -> str | None:
    return None if s is None else unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii")


@F.udf(T.StringType(), useArrow=False)
def _decomposed_text(s: str | None) -> str | None:
    """Row by row in small batches: Python holds a few whole texts at a time, however many rows there are."""
    return _decomposed(s)


@functools.cache
def _decompositions() -> tuple[dict[str, str], dict[str, str]]:
    """The characters beyond ASCII whose decomposition keeps one ASCII character, and those that keep several.
    Characters decompose one by one, so these are all that decomposing a text needs."""
    one, several = {}, {}
    for code in range(128, sys.maxunicode + 1):
        if unicodedata.decomposition(chr(code)):
            kept = _decomposed(chr(code))
            if kept:
                (one if len(kept) == 1 else several)[chr(code)] = kept
    return one, several


def _decomposed_name(c: Column) -> Column:
    """As :func:`_decomposed`, by Spark's own functions: no row goes to Python."""
    one, several = _decompositions()
    c = F.translate(c, "".join(one), "".join(one.values()))
    parts = F.from_json(F.lit(json.dumps(several)), "map<string,string>")
    spelt = F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(F.try_element_at(parts, x), x)), "")
    c = F.when(c.rlike("[" + "".join(several) + "]"), spelt).otherwise(c)
    return F.regexp_replace(c, r"[^\x00-\x7F]+", "")


def _normalized(c: Column, decomposed) -> Column:
    text = F.coalesce(c, F.lit(""))
    beyond = F.octet_length(text) != F.char_length(text)  # a character of several bytes
    return F.lower(F.btrim(F.when(beyond, decomposed(F.when(beyond, text))).otherwise(text), F.lit(WHITE)))


def normalize_text(c: Column | str) -> Column:
    """Compatibility decomposition without non-ASCII marks, lower case, no outer
    white space; null becomes ''.  For texts of any length.

    Spark has no Unicode normalisation, so values beyond ASCII go through a Python UDF;
    ASCII ones are their own decomposition and never leave Spark's columns.
    """
    return _normalized(F.col(c) if isinstance(c, str) else c, _decomposed_text)


def with_normalized(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Add ``out`` = normalize_text(``col``), for short strings such as names, without Python.

    A row-wise step: nothing is shuffled, joined or read twice, whatever the number of
    distinct names.  Null keys stay null (kept out of groups, trap T8).
    """
    return df.withColumn(out or col, F.when(F.col(col).isNotNull(), _normalized(F.col(col), _decomposed_name)))


def standardize_city(df: DataFrame, known: DataFrame, city_col: str = "city",
                     out: str = "city_standardized", bound_rows: int | None = None) -> DataFrame:
    """Cleaned city if it is in the ``known`` list (one column ``city``), else 'other'.

    ``known`` is a small reference table; it is broadcast behind ``bound_rows``.
    Null cities become 'other' (trap T8).
    """
    from salescast.session import broadcast_bounded

    k = known.select(F.col("city").alias("__known")).distinct()
    if bound_rows is not None:
        k = broadcast_bounded(k, bound_rows)
    cleaned = df.withColumn("__city_clean", clean_city(F.col(city_col)))
    joined = cleaned.join(k, F.col("__city_clean") == F.col("__known"), "left")
    return (joined.withColumn(out, F.when(F.col("__known").isNotNull(), F.col("__city_clean"))
                              .otherwise(F.lit("other")))
            .drop("__known", "__city_clean"))


def clean_city(c: Column) -> Column:
    """Lower, strip, collapse inner whitespace.  Most names have none, and patterns are slow: those skip them."""
    low = F.lower(c)
    spaced = F.lit(False)
    for white in " \t\n\x0b\f\r":
        spaced = spaced | low.contains(white)
    return F.when(spaced, F.regexp_replace(F.regexp_replace(low, r"^\s+|\s+$", ""), r"\s+", " ")).otherwise(low)


def canonical_event_name(name: Column, event_date: Column) -> Column:
    """Part of the name before the first ' - ', then ' - ' and the ISO date."""
    head = F.split_part(name, F.lit(" - "), F.lit(1))
    return F.concat(head, F.lit(" - "), F.date_format(event_date, "yyyy-MM-dd"))


def split_lineup(s: Column) -> Column:
    """Split a line-up on ';' when present, else ','; trim; keep names longer than 1."""
    parts = F.when(F.instr(s, ";") > 0, F.split(s, ";")).otherwise(F.split(s, ","))
    trimmed = F.transform(parts, lambda x: F.trim(x))
    return F.filter(trimmed, lambda x: F.length(x) > 1)


def truncate_ellipsis(s: Column, n: int) -> Column:
    """Truncate to ``n`` characters and append '...' when cut."""
    return F.when(F.length(s) > n, F.concat(F.substring(s, 1, n), F.lit("..."))).otherwise(s)


def list_to_string(arr: Column, sep: str = ", ") -> Column:
    """List -> string."""
    return F.array_join(arr, sep)


def string_to_list(s: Column, sep: str = ", ") -> Column:
    """String -> list."""
    return F.split(s, sep)
