"""Sharding: a Feistel permutation with cycle walking over global row numbers.

Every row gets its place in one reproducible total order (``number_rows``), a
keyed Feistel network permutes the numbers ``0..n-1``, and the permuted
position ``p`` alone gives ``shard = p % shards`` and ``slot = p // shards``.
So shard sizes differ by one row at most, slots have no gaps, and anyone who
knows (n, seed, row number) can compute a row's shard and slot without the data.

Only DataFrame functions are used.  The one shuffle is the range partitioning
by row order, of narrow rows; the permutation is arithmetic inside one stage.

Defined results
* no rows: an empty result with the same columns.
* null or empty ordering values sort first; rows equal in all ordering columns
  are told apart by an internal salt, so any of them may take either number
  (they are equal in everything that is ordered on).  The salt also splits a
  hot value over range partitions.
* columns of the input named like an added column are replaced by it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.common import materialize, read

SHARDS = 24
ROUNDS = 6
SEED = 20240601
# Modulus of the round function; products of two residues stay below 2**62.
PRIME = 2_147_483_647


def number_rows(df: DataFrame, order: list[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """(df with a global 0-based row number in ``order``, number of rows).

    Rows are range-partitioned and sorted by ``order``; the number is the
    partition's offset plus the place inside it.  The ordered rows are written
    to the checkpoint folder first, because offsets and rows must come from one
    and the same partitioning.  The offsets have one row per partition.
    """
    salted = df.withColumn("__salt", F.monotonically_increasing_id())
    ordered = salted.repartitionByRange(*order, "__salt").sortWithinPartitions(*order, "__salt")
    ordered = ordered.drop("__salt").withColumn("__at", F.monotonically_increasing_id())
    ordered = materialize(ordered, "numbered")
    part = F.shiftright("__at", 33)
    counts = ordered.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    n = ordered.count()
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = (ordered.withColumn("__part", part)
                .join(F.broadcast(offsets), "__part")  # at most one row per partition
                .withColumn(name, (F.col("__offset") + place).cast("long"))
                .drop("__part", "__offset", "__at"))
    return numbered, n


def grid(n: int) -> tuple[int, int]:
    """Sides (a, b) of the Feistel domain: a * b >= n, with an excess below a."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """Three constants below PRIME for each round (a linear congruential rule)."""
    x, keys = (seed % (PRIME - 1)) + 1, []
    for _ in range(rounds):
        triple = []
        for _ in range(3):
            x = x * 48271 % PRIME
            triple.append(x)
        keys.append(tuple(triple))
    return keys


def _round(x: Column, k1: Column, k2: Column, k3: Column) -> Column:
    """Round function; written as nested folds so that no operand is computed twice."""
    p = F.lit(PRIME).cast("long")
    start = (x % p * k1 + k2) % p
    return F.aggregate(F.array(k3, x % p), start, lambda t, add: (t * t + add) % p)


def network(x: Column, n: int, seed: int) -> Column:
    """One pass of the Feistel network: a permutation of 0 .. a*b-1."""
    a, b = grid(n)
    keys = F.array(*[F.struct(*[F.lit(k).cast("long").alias(f"k{j}") for j, k in enumerate(triple)],
                              F.lit(i % 2 == 0).alias("left")) for i, triple in enumerate(round_keys(seed))])
    la, lb = F.lit(a).cast("long"), F.lit(b).cast("long")
    start = F.struct(F.call_function("div", x, lb).alias("l"), (x % lb).alias("r"))

    def step(s: Column, k: Column) -> Column:
        moved = _round(F.when(k["left"], s["r"]).otherwise(s["l"]), k["k0"], k["k1"], k["k2"])
        return F.struct(F.when(k["left"], (s["l"] + moved) % la).otherwise(s["l"]).alias("l"),
                        F.when(k["left"], s["r"]).otherwise((s["r"] + moved) % lb).alias("r"))

    return F.aggregate(keys, start, step, lambda s: s["l"] * lb + s["r"])


def permute(df: DataFrame, number: str, n: int, seed: int = SEED, name: str = "position") -> DataFrame:
    """Permuted position of each row number.

    Cycle walking: a value at or above ``n`` goes through the network again.
    The domain exceeds ``n`` by less than sqrt(n), so almost no value needs a
    second pass; three passes are inlined and the rare rest is repeated until
    none is left (the walk follows a cycle of a permutation, so it ends).
    """
    x = F.col(number).cast("long")
    limit = F.lit(n).cast("long")
    out = df.withColumn(name, F.aggregate(
        F.array(*[F.lit(i) for i in range(3)]), F.lit(-1).cast("long"),
        lambda p, i: F.when((i == 0) | (p >= limit), network(F.when(i == 0, x).otherwise(p), n, seed)).otherwise(p)))
    while n > 0 and (out.agg(F.max(name).alias("m")).first()["m"] or 0) >= n:
        p = F.col(name)
        out = materialize(out.withColumn(name, F.when(p >= limit, network(p, n, seed)).otherwise(p)), "walked")
    return out


def shard_rows(df: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` plus row_number, position, shard and slot (law: equal row counts)."""
    numbered, n = number_rows(df.drop("row_number", "position", "shard", "slot"), order)
    out = permute(numbered, "row_number", n, seed)
    return out.withColumns({
        "shard": (F.col("position") % shards).cast("int"),
        "slot": F.call_function("div", F.col("position"), F.lit(shards)).cast("long")})


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to 24 shards in a reproducible random order; law ``rows``."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
    out = shard_rows(docs, ["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "row_number", "position")


def _walk_sql(source: str, n: str) -> str:
    """SQL text of one pass of the network over column ``pos`` of ``source``."""
    a = f"CAST(ceil(sqrt({n})) AS BIGINT)"
    b = f"CAST(ceil({n} / ceil(sqrt({n}))) AS BIGINT)"
    sql = f"SELECT rid, pos // {b} AS l, pos % {b} AS r FROM {source}"
    for i, (k1, k2, k3) in enumerate(round_keys(SEED)):
        x, y, m = ("r", "l", a) if i % 2 == 0 else ("l", "r", b)
        t = f"(({x} % {PRIME} * {k1} + {k2}) % {PRIME})"
        u = f"(({t} * {t} + {k3}) % {PRIME})"
        new = f"({y} + ({u} * {u} + {x} % {PRIME}) % {PRIME}) % {m} AS {y}"
        sql = f"SELECT rid, {new}, {x} FROM ({sql})"
    return f"SELECT rid, l * {b} + r AS pos FROM ({sql})"


ORACLE_SQL = f"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (
  SELECT doc_id, coalesce(strlen(text), 0) + 8 AS size,
    CASE WHEN text IS NULL THEN NULL ELSE xor(list_reduce(list_prepend(4294967295,
      list_transform(regexp_extract_all(hex(text), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) END AS text_crc32
  FROM documents, tab),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32 NULLS FIRST) - 1 AS rid FROM d),
walk AS (
  {_walk_sql("(SELECT rid, rid AS pos FROM numbered)", "(SELECT count(*) FROM documents)")}
  UNION ALL
  {_walk_sql("(SELECT rid, pos FROM walk WHERE pos >= (SELECT count(*) FROM documents))",
             "(SELECT count(*) FROM documents)")})
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law, CAST(pos % {SHARDS} AS INT) AS shard,
  pos // {SHARDS} AS slot, CAST(NULL AS INT) AS grown_shard, rid AS row_number, pos AS position
FROM numbered JOIN walk USING (rid) WHERE pos < (SELECT count(*) FROM documents)
"""
