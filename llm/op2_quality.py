"""Quality rules: a threshold table compiled into one Spark projection.

``MEASURES`` turns a text into numbers with built-in functions only;
``RULES`` is a plain table (measure, lowest, highest); ``compile_rules`` makes
one boolean expression of it.  Nothing is shuffled: each text is read, measured
and judged where it is scanned.

Repeated words (words inside a 3-word window that occurs twice or more in the
text) need the windows of a text grouped.  That is done inside the row: windows
are hashed to 64 bits, and only texts in which a hash repeats sort
(hash, position) pairs.  The words of neighbouring pairs are then compared, so
two different windows with one hash are never counted as repeated.

Defined results
* null or empty text, or one without words: all counts 0, base_failed, not kept.
* fewer than three words: no window, so no repeated words.
* extra columns of the input are passed through by ``apply_rules``; input
  columns named like a measure are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import SPACE, WORD, read

# Frequent function words of the corpus languages.
STOP_WORDS = {
    "en": "the of and to in a is that it for was on are as with be at this by from or have an not they which you".split(),
    "fr": "le la les de des du un une et en est que qui dans pour pas sur au avec il elle ce se ne par plus".split(),
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus".split(),
    "es": "el la los las de del que y en un una por con para es se no al lo como más su sus a o".split(),
}

SYMBOLS = "[#*$%&|<>]"
# Limits of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# The threshold table: (measure, lowest kept, highest kept); None: open.
RULES: list[tuple[str, float | None, float | None]] = [
    ("mean_word_chars", 2.0, 12.0),
    ("symbol_ratio", None, 0.1),
    ("stop_word_ratio", 0.02, None),
    ("upper_ratio", None, 0.5),
    ("dup_line_ratio", None, 0.5),
    ("bare_line_ratio", None, 0.3),
]


def _stop_words() -> list[str]:
    return sorted({w for words in STOP_WORDS.values() for w in words})


def add_measures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus word counts and the measures that the rules look at."""
    added = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *[m for m, _, _ in RULES]}
    given = [c for c in df.columns if c not in added]
    df = df.withColumn("__t", F.coalesce(F.col(text), F.lit(""))).withColumns({
        "__w": F.regexp_extract_all("__t", F.lit(f"({WORD})"), F.lit(1)),
        "__lines": F.filter(F.split("__t", "\n"), lambda x: x.rlike(WORD))})
    n = F.size("__w")
    window = F.transform(
        F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)))
    df = df.withColumns({
        "n_words": n.cast("long"),
        "__h": window,
        "word_chars": F.length(F.array_join("__w", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace("__t", "[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__n_lines": F.size("__lines")})
    # Only texts with a repeated hash look for the positions of repeats.
    df = df.withColumn("__s", F.when(
        F.size(F.array_distinct("__h")) < F.size("__h"),
        F.array_sort(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def same(i: Column, j: Column) -> Column:
        x, y = F.get("__s", i), F.get("__s", j)
        out = x["h"] == y["h"]
        for k in range(3):
            out = out & (F.get("__w", x["i"] + k) == F.get("__w", y["i"] + k))
        return F.coalesce(out, F.lit(False))

    df = df.withColumn("__p", F.array_sort(F.transform(
        F.filter(F.sequence(F.lit(0), F.size("__s") - 1), lambda i: same(i, i - 1) | same(i, i + 1)),
        lambda i: F.get("__s", i)["i"])))
    # Words covered by windows at sorted positions p: each adds min(3, gap to the next).
    covered = F.aggregate(
        F.transform("__p", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("__p", i + 1) - p, F.lit(3)))),
        F.lit(0), lambda a, x: a + x)
    words = F.greatest("n_words", F.lit(1))
    chars = F.greatest("word_chars", F.lit(1))
    lines = F.greatest("__n_lines", F.lit(1))
    df = df.withColumns({
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "mean_word_chars": F.col("word_chars") / words,
        "symbol_ratio": F.col("n_symbols") / words,
        "stop_word_ratio": F.size(F.filter("__w", lambda w: w.isin(_stop_words()))) / words,
        "upper_ratio": F.length(F.regexp_replace("__t", "[^A-Z]+", "")) / chars,
        "dup_line_ratio": F.col("n_dup_lines") / lines,
        "bare_line_ratio": F.size(F.filter("__lines", lambda x: x.contains(" | "))) / lines})
    # A generator of one row: filters on measures stay above it, instead of being
    # pushed down with all the expressions they stand for written out again.
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *[m for m, _, _ in RULES]]
    return df.select(*given, F.inline_outer(F.array(F.struct(*measures))))


def compile_rules(rules=None) -> Column:
    """One boolean column: true where every measure lies within its limits."""
    verdict = F.lit(True)
    for measure, low, high in rules or RULES:
        if low is not None:
            verdict = verdict & (F.col(measure) >= low)
        if high is not None:
            verdict = verdict & (F.col(measure) <= high)
    return verdict


def apply_rules(df: DataFrame, text: str = "text", rules=None) -> DataFrame:
    """``df`` plus all measures, ``base_failed`` and ``kept``."""
    base = ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return (add_measures(df, text).withColumn("base_failed", base)
            .withColumn("kept", ~F.col("base_failed") & compile_rules(rules)))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and threshold verdict for every document."""
    out = apply_rules(read(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


def _rules_sql() -> str:
    limits = [f"{m} >= {low}" for m, low, _ in RULES if low is not None]
    return " AND ".join(limits + [f"{m} <= {high}" for m, _, high in RULES if high is not None])


ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
e AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
counted AS (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS c FROM windows),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM counted WHERE c > 1) GROUP BY r),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    len(list_filter(w, lambda x: list_contains([{", ".join(f"'{x}'" for x in _stop_words())}], x))) AS stops,
    length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS uppers,
    len(list_filter(lines, lambda x: contains(x, ' | '))) AS bare, len(lines) AS n_lines
  FROM e LEFT JOIN covered ON e.r = covered.r),
ratios AS (
  SELECT *, word_chars / greatest(n_words, 1) AS mean_word_chars, n_symbols / greatest(n_words, 1) AS symbol_ratio,
    stops / greatest(n_words, 1) AS stop_word_ratio, uppers / greatest(word_chars, 1) AS upper_ratio,
    n_dup_lines / greatest(n_lines, 1) AS dup_line_ratio, bare / greatest(n_lines, 1) AS bare_line_ratio,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {_rules_sql()} AS kept FROM ratios
"""
