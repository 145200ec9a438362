"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one training example: all preceding turns as
context, and only that reply under the loss mask.  Turns after the last
assistant turn (or a conversation without one) give one more example without a
target, so that no turn is lost.  An example is the formatted text plus the
loss span (1-based start and length in code points).

Template (fixed strings): ``[INST] user [/INST]``, ``<s>assistant</s>``,
``<<SYS>>system<</SYS>>`` and ``[ROLE=name]text[/ROLE]`` for any other role.
Escaping is reversible: a control string inside a text or role gets one more
backslash after its first character (``</s>`` becomes ``<\\/s>``), and reading
back takes one away.  So an unescaped control string is always a real marker.

Only DataFrame functions are used.  The one shuffle groups the turns of a
conversation; formatting and reading back stay in the row.

Defined results
* null text: empty text.  null role: the empty role, shown as ``[ROLE=]``.
* turns are ordered by turn (null first), then role, then text; repeated rows
  are kept as turns of their own.
* null conv_id: one conversation of its own.
* an empty table gives no examples; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import read

# The template's control strings.
OPEN = {"user": "[INST] ", "assistant": "<s>", "system": "<<SYS>>"}
CLOSE = {"user": " [/INST]", "assistant": "</s>", "system": "<</SYS>>"}
TARGET_ROLE = "assistant"
_CONTROL = r"/?s>|<?/?SYS>>|/?INST\]|/?ROLE"
# First character, backslashes already there, rest of a control string.
_ESCAPE = rf"([<\[])(\\*)({_CONTROL})"
_UNESCAPE = rf"([<\[])\\(\\*)({_CONTROL})"
# One formatted turn: opening marker, role name if any, text, closing marker.
_TURN = (r"(?s)(\[INST\] |<s>|<<SYS>>|\[ROLE=((?:[^\\\]]++|\\.)*+)\])(.*?)"
         r"( \[/INST\]|</s>|<</SYS>>|\[/ROLE\])")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPE), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_UNESCAPE), F.lit("$1$2$3"))


def _role_name(role: Column) -> Column:
    """Role inside ``[ROLE=...]``: control strings, ``]`` and backslashes are escaped."""
    out = F.regexp_replace(role, F.lit(r"\\"), F.lit(r"\\\\"))
    return escape(F.regexp_replace(out, F.lit(r"\]"), F.lit(r"\\]")))


def _role_read(name: Column) -> Column:
    return F.regexp_replace(unescape(name), F.lit(r"(?s)\\(.)"), F.lit("$1"))


def _pick(role: Column, marks: dict[str, str], other: Column) -> Column:
    out = other
    for name, mark in marks.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def format_turn(role: Column, text: Column) -> Column:
    opening = _pick(role, OPEN, F.concat(F.lit("[ROLE="), _role_name(role), F.lit("]")))
    return F.concat(opening, escape(text), _pick(role, CLOSE, F.lit("[/ROLE]")))


def collect_turns(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation with its turns in order, formatted."""
    turns = rows.select(
        F.col(conv),
        F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                 F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    return (turns.groupBy(conv).agg(F.array_sort(F.collect_list("t")).alias("turns"))
            .withColumn("pieces", F.transform("turns", lambda t: format_turn(t["role"], t["text"]))))


def expand_examples(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per example: conv, example number, formatted text, loss_start, loss_length.

    ``loss_start`` is 1-based; an example without a target has length 0 and
    ``has_target`` false.
    """
    convs = collect_turns(rows, conv)
    n = F.size("turns")
    ends = F.filter(F.sequence(F.lit(1), n),
                    lambda i: (F.get("turns", i - 1)["role"] == TARGET_ROLE) | (i == n))
    examples = convs.select(conv, "turns", "pieces", F.posexplode(ends).alias("example", "end"))
    last = F.get("turns", F.col("end") - 1)
    target = last["role"] == TARGET_ROLE
    before = F.array_join(F.slice("pieces", F.lit(1), F.col("end") - 1), "")
    return examples.select(
        conv, "example", F.array_join(F.slice("pieces", F.lit(1), F.col("end")), "").alias("formatted"),
        target.alias("has_target"),
        F.when(target, F.length(before) + len(OPEN[TARGET_ROLE]) + 1).otherwise(F.lit(0)).alias("loss_start"),
        F.when(target, F.length(escape(last["text"]))).otherwise(F.lit(0)).alias("loss_length"))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted example."""
    whole = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0))
    return F.transform(whole, lambda s: _read_turn(s))


def _read_turn(s: Column) -> Column:
    opening = F.regexp_extract(s, "^" + _TURN, 1)
    role = F.when(opening.startswith("[ROLE="), _role_read(F.regexp_extract(s, "^" + _TURN, 2)))
    for name, mark in OPEN.items():
        role = F.when(opening == mark, F.lit(name)).otherwise(role)
    return F.struct(role.alias("role"), unescape(F.regexp_extract(s, "^" + _TURN, 3)).alias("text"))


def digest(examples: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Per conversation, everything read back from its examples: the turns from the
    longest example, the trainable text from the loss spans in example order."""
    loss = F.when(F.col("has_target"),
                  unescape(F.substring("formatted", F.col("loss_start"), F.col("loss_length")))).otherwise("")
    rows = examples.select(conv, F.struct("example", loss.alias("loss"), F.length("formatted").alias("n")).alias("e"),
                           F.struct("example", "formatted").alias("f"))
    one = rows.groupBy(conv).agg(F.array_sort(F.collect_list("e")).alias("e"), F.max("f")["formatted"].alias("whole"))
    one = one.withColumns({
        "__turns": read_turns(F.col("whole")),
        "__loss": F.array_join(F.transform("e", lambda x: x["loss"]), "")})
    lines = F.array_join(F.transform("__turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return one.select(
        conv, F.size("__turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("__loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("__loss").cast("binary"), 256).alias("loss_sha256"),
        F.aggregate("e", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("formatted_chars"),
        F.size("e").cast("long").alias("n_examples"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -7 made of control strings, formatted and read back."""
    rows = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return digest(expand_examples(rows.unionByName(extra)))


ORACLE_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
pieces AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    length(regexp_replace(text, '([<\[])(\\*)(/?s>|<?/?SYS>>|/?INST\]|/?ROLE)', '\1\\\2\3', 'g'))
    + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15
      ELSE 14 + length(regexp_replace(replace(replace(role, '\', '\\'), ']', '\]'),
        '([<\[])(\\*)(/?s>|<?/?SYS>>|/?INST\]|/?ROLE)', '\1\\\2\3', 'g')) END AS len
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
ends AS (
  SELECT *, sum(len) OVER (PARTITION BY conv_id ORDER BY i) AS upto,
    role = 'assistant' OR i = n AS is_end FROM pieces)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (is_end) AS BIGINT) AS formatted_chars,
  count(*) FILTER (is_end) AS n_examples
FROM ends GROUP BY conv_id
"""
