"""Periodic runs of words by Baier grouping.

A run is a stretch of words with smallest period q (words q apart are equal)
that no neighbouring word extends.  The method:

1. Phase one of a grouping suffix sorter.  Suffixes are grouped by their first
   word; groups are taken from the highest to the lowest.  When a group with
   context u is taken, u is the longest Lyndon word at each of its members, so
   the Lyndon array is read off directly.  Every member then hands u to the
   nearest position before it whose group is lower; positions of one group that
   got the same number of copies of u form a new group just above their old
   one, with a context that much longer.
2. This is done under the order of the words and under the opposite order.  A
   run contains all its Lyndon roots under one of the two orders.
3. Roots that follow each other with equal lengths are extended to both sides
   by longest common extensions into the maximal run.

Two exact reductions keep the work small.  In a run of exponent e every word
occurs e times, so a text is cut at words that occur less often (in the text,
then in each piece, until nothing is cut): no run crosses such a word and a run
ending beside it cannot be extended over it.  Runs of exponent e hold e - 1 full
roots one after the other, so a root needs as many equal neighbours in the
Lyndon array before its extension is looked up.

Each text is handled where it is scanned: no shuffle, no state; a lost task is
simply done again.

Defined results
* null or empty text, or one without words: no runs, collapsed text is empty.
* runs are ordered by start, then period; runs of other periods may overlap.
* a word occurs in the collapsed text unless some run contains it after that
  run's first period; kept words are joined by one space.
* very long texts: all words are looked at; one task holds the words of a batch.
* repeated rows give repeated results; other columns are passed through, one
  named like the result column is replaced.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import WORD, read
from llm.words import release, slices

MIN_LENGTH = 6
MIN_EXPONENT = 4
_WORD = re.compile(WORD)

RESULT = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_RESULT = pa.struct([("n_words", pa.int64()), ("runs", _RUN), ("collapsed", pa.string())])


def lyndon_array(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each position, by grouping suffixes."""
    n = len(symbols)
    names = {s: g for g, s in enumerate(sorted(set(symbols)))}
    group_of = [names[s] for s in symbols]
    members: list[list[int]] = [[] for _ in names]
    for i, g in enumerate(group_of):
        members[g].append(i)
    context = [1] * len(names)
    lower = list(range(-1, len(names) - 1))  # neighbours in the order of the groups
    upper = [*range(1, len(names)), -1]
    taken, before, out = [False] * n, [-1] * n, [0] * n
    top = len(names) - 1
    while top >= 0:
        size = context[top]
        mine = sorted(i for i in members[top] if group_of[i] == top)
        for i in mine:
            taken[i] = True
            out[i] = size
        copies: dict[int, int] = {}
        for i in mine:
            j = i - 1
            while j >= 0 and taken[j]:
                j = before[j]
            before[i] = j
            if j >= 0:
                copies[j] = copies.get(j, 0) + 1
        moving: dict[tuple[int, int], list[int]] = {}
        for j, k in copies.items():
            moving.setdefault((k, group_of[j]), []).append(j)
        for k, g in sorted(moving, reverse=True):  # fewer copies come later, between g and the groups of more
            new, above = len(context), upper[g]
            context.append(context[g] + k * size)
            members.append(moving[k, g])
            lower.append(g)
            upper.append(above)
            upper[g] = new
            lower[above] = new  # there is one: the group just taken lies above
            for j in moving[k, g]:
                group_of[j] = new
        top = lower[top]
    return out


def common_extension(words: np.ndarray, i: int, j: int) -> int:
    """Length of the longest common stretch that starts at ``i`` and at ``j`` > ``i``."""
    done, step, end = 0, 64, len(words)
    while j + done < end:
        step = min(step, end - j - done)
        differs = words[i + done:i + done + step] != words[j + done:j + done + step]
        first = int(differs.argmax())
        if differs[first]:
            return done + first
        done, step = done + step, 2 * step
    return done


def runs_of(symbols: list[int], exponent: int = 2, least: int = 1) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) with length >= ``exponent`` periods and >= ``least``."""
    n, found = len(symbols), set()
    words = np.array(symbols, dtype=np.int64)
    back = words[::-1]
    for order in (symbols, [-s for s in symbols]):
        size = np.array(lyndon_array(order), dtype=np.int64)
        root = np.flatnonzero(np.arange(n) + 2 * size <= n) if exponent > 2 else np.arange(n)
        for k in range(1, exponent - 1):
            root = root[root + k * size[root] < n]
            root = root[size[root + k * size[root]] == size[root]]
        ends: dict[int, int] = {}  # of the last run of each period
        for i in root.tolist():
            p = int(size[i])
            if i + p <= ends.get(p, 0):
                continue  # this root lies in that run
            ahead = common_extension(words, i, i + p)
            behind = common_extension(back, n - i - p, n - i) if i else 0
            if ahead + behind >= p:
                ends[p] = i + p + ahead
                if ahead + behind + p >= max(exponent * p, least):
                    found.add((i - behind, behind + p + ahead, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def pieces(words: list[str], exponent: int, least: int) -> list[tuple[int, int]]:
    """Stretches in which every word occurs ``exponent`` times or more; all runs lie in one of them."""
    least = max(least, exponent)
    stretch = re.compile(rb"\x01{%d,}" % least)
    out, left = [], [(0, len(words))]
    while left:
        start, end = left.pop()
        if end - start < least:
            continue
        piece = words[start:end]
        counts = Counter(piece)
        if min(counts.values()) >= exponent:
            out.append((start, end))
            continue
        often = bytes(map(exponent.__le__, map(counts.__getitem__, piece)))
        left += [(start + m.start(), start + m.end()) for m in stretch.finditer(often)]
    return sorted(out)


def text_runs(words: list[str], exponent: int = MIN_EXPONENT, least: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of a text's words, by start, then period."""
    out = []
    for start, end in pieces(words, exponent, least):
        names: dict[str, int] = {}
        symbols = [names.setdefault(w, len(names) + 1) for w in words[start:end]]
        out += [(start + a, length, p) for a, length, p in runs_of(symbols, exponent, least)]
    return out


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """``words`` without those that a run contains after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    gone = np.cumsum(edge) > 0
    return [w for w, g in zip(words, gone) if not g]


def repeats(text: Column | str, exponent: int = MIN_EXPONENT, least: int = MIN_LENGTH) -> Column:
    """Struct of n_words, runs and collapsed text of a string column.  ``exponent`` (2 or more)
    and ``least`` bound the runs: length >= exponent * period and length >= least."""
    if exponent < 2:
        raise ValueError("a run holds its period twice at least")

    @F.arrow_udf(RESULT)
    def run(texts: pa.Array) -> pa.Array:
        rows = []
        for part in slices(texts):
            for text in part.to_pylist():
                words = _WORD.findall(text or "")
                runs = text_runs(words, exponent, least)
                rows.append((len(words), [{"start": a, "length": n, "period": p} for a, n, p in runs],
                             " ".join(collapse(words, runs))))
        counts, runs, texts = zip(*rows) if rows else ((), (), ())
        out = pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(runs, _RUN), pa.array(texts, pa.string())], fields=list(_RESULT))
        del rows, counts, runs, texts
        release()
        return out
    return run(F.col(text) if isinstance(text, str) else text)


def detect_runs(df: DataFrame, text: str = "text", name: str = "repeats", exponent: int = MIN_EXPONENT,
                least: int = MIN_LENGTH) -> DataFrame:
    """``df`` plus the struct of :func:`repeats` as column ``name``."""
    return df.withColumn(name, repeats(text, exponent, least))


def with_planted_period(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The query's input: in one document of ten (by checksum of its id) the words from some
    place on repeat with one period.  Rows without an id or without words stay as they are."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    df = df.withColumn("__g", F.when(h % 10 == 0, F.floor(h / 10).cast("long")))
    df = df.withColumn("__w", F.when(F.col("__g").isNotNull(), F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))))
    n = F.size("__w").cast("long")
    a = F.col("__g") % n
    df = df.withColumns({"__n": n, "__a": a, "__p": F.floor((n - a) / (3 + F.col("__g") % 8)).cast("long") + 1})
    i = F.when(F.col("__n") > 0, F.sequence(F.lit(0).cast("long"), F.col("__n") - 1))
    place = F.transform(i, lambda i: F.when(i < F.col("__a"), i).otherwise(
        F.col("__a") + (i - F.col("__a")) % F.col("__p")))
    words = F.transform(place, lambda i: F.get("__w", i.cast("int")))
    df = df.withColumn(text, F.when(F.col("__n") > 0, F.array_join(words, " ")).otherwise(F.col(text)))
    return df.drop("__g", "__w", "__n", "__a", "__p")


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of four periods or more in every document, its strongest run and the text without repeats."""
    docs = with_planted_period(read(spark, sf_dir, "documents", "doc_id", "text"))
    found = detect_runs(docs).select("doc_id", "repeats.*")
    # Greatest exact length / period: fractions are compared by cross products.
    best = F.reduce(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)),
        lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listing = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                         F.sha2(listing.cast("binary"), 256).alias("runs_sha256"),
                         F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return found.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


ORACLE_SQL = r"""
WITH tab AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^ 	-]+'), []) AS w,
    xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(doc_id::VARCHAR), '..'),
      lambda h: ('0x' || h)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM documents, tab),
shaped AS (
  SELECT *, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a, coalesce(h % 10 = 0, false) AND len(w) > 0 AS planted FROM docs),
shaped2 AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM shaped),
words AS (
  SELECT r, i, w[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END] AS x, n
  FROM (SELECT r, w, n, planted, a, p, unnest(range(n)) AS i FROM shaped2)),
pairs AS (
  SELECT u.r, v.i - u.i AS q, u.i AS i
  FROM words u JOIN words v ON u.r = v.r AND u.x = v.x AND v.i > u.i AND 4 * (v.i - u.i) <= u.n),
islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs),
stretches AS (
  SELECT r, min(i) AS s, count(*) + q AS len, q FROM islands GROUP BY r, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT r, s, len, min(q) AS q FROM stretches GROUP BY r, s, len),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS listing FROM runs GROUP BY r),
best AS (
  SELECT * FROM runs x QUALIFY row_number() OVER (PARTITION BY r ORDER BY len::DECIMAL(38, 20) / q DESC, s, q) = 1),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (
  SELECT words.r, string_agg(x, ' ' ORDER BY words.i) AS t FROM words
  ANTI JOIN gone ON gone.r = words.r AND gone.i = words.i GROUP BY words.r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, len AS length, q AS period,
  1000 * len // q AS exponent_milli, sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed ON listed.r = docs.r LEFT JOIN best ON best.r = docs.r LEFT JOIN kept ON kept.r = docs.r
"""
