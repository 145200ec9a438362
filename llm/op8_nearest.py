"""Nearest neighbours by a block matrix join: largest inner product, exact results.

Vectors are quantised to int8 with a scale of their own and packed into blocks of at most
about ``BLOCK`` rows: codes, scales, and the norms that bound what rounding can change.
For every pair (query block, candidate block) one task multiplies int8 tiles; with the
norms every product gets a proven lower and upper bound.  Candidates whose upper bound
reaches the query's k-th best lower bound of the tile survive; over all tiles, those that
reach the k-th best lower bound of all.  Only for these pairs the original vectors
are fetched, and the products recomputed in double precision, component by component; a heap
per query keeps the best ``k``.  No result is approximate.

The query set is every row whose vec_id is divisible by ``EVERY``.  A tile task
holds two blocks of codes, whatever the size of the table; nothing is broadcast.

Int8 products are summed as floats, which is exact: 127 * 127 * dims stays below
2**24 (single precision) or 2**53 (double, used for more than 1040 dims).

Defined results
* vectors that are null, empty, zero, or hold a null or non-finite component, and
  rows without vec_id, take no part.
* rows that repeat a vec_id count once, with the smallest of their vectors.
* vectors of different lengths are never compared.
* ties go to the smaller vec_id; fewer than k candidates: all of them.
* an empty table gives no rows; columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import materialize, read

K, EVERY = 20, 20
BLOCK, CHUNK = 8192, 256
_SLACK = 1e-9  # relative, far above the rounding of the bounds themselves
_PARTS = ("ids", "codes", "scales", "norms", "errors", "marks")
_FOUND = ("ids", "low", "high", "marks")
_BLOCK_SCHEMA = "dim int, block int, " + ", ".join(f"{c} binary" for c in _PARTS)


def usable(df: DataFrame) -> DataFrame:
    """(vec_id, v, dim) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("v", lambda x: x != 0)
    return (df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
            .filter(~F.coalesce(bad, F.lit(True)) & F.coalesce(some, F.lit(False)))
            .withColumn("dim", F.size("v")))


def once(rows: DataFrame) -> DataFrame:
    """``rows`` with one row per (vec_id, dim), the one with the smallest vector.  Repeated ids are found by a count
    and reduced by an aggregate, so copies never meet in a block; all other rows are not moved."""
    rows = materialize(rows, "vectors")
    again = materialize(rows.groupBy("vec_id", "dim").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c"), "repeated")
    if not again.limit(1).count():
        return rows
    least = rows.join(again, ["vec_id", "dim"], "left_semi").groupBy("vec_id", "dim").agg(F.min("v").alias("v"))
    return materialize(rows.join(again, ["vec_id", "dim"], "left_anti").unionByName(least), "vectors")


def pack(most: int | None):
    """Task: one block: ids, int8 codes, scales, norms, error norms and a checksum of each vector, as packed arrays.

    Of equal vectors only the ``most`` smallest ids stay: ties go to the smaller id, so later ones are no result."""
    def run(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        ids = table.column("vec_id").to_numpy()
        x = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) + 0.0  # -0 is 0
        if most is not None:
            _, same = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, 8 * dim))).ravel(), return_inverse=True)
            keep = smallest_of_each([same], ids, most)
            ids, x = ids[keep], x[keep]
        codes, scale, err = quantise(x)
        norm = np.sqrt((x ** 2).sum(axis=1))
        mark = np.array([int.from_bytes(hashlib.blake2b(v.tobytes(), digest_size=8).digest(), "little", signed=True) for v in x],
                        dtype=np.int64)
        parts = (ids, codes, scale, norm, err, mark)
        return pa.table({"dim": pa.array([dim], pa.int32()), "block": table.column("block").slice(0, 1).cast(pa.int32()),
                         **{c: pa.array([v.tobytes()], pa.binary()) for c, v in zip(_PARTS, parts)}})
    return run


def smallest_of_each(keys: list[np.ndarray], ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` smallest ids among entries that are equal in all ``keys``."""
    order = np.lexsort((ids, *keys))
    new = np.zeros(len(ids), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
    return np.sort(order[np.arange(len(ids)) - first < most])


def pack_blocks(rows: DataFrame, n: int, most: int | None = None) -> DataFrame:
    """Blocks of about BLOCK rows."""
    blocks = max(1, -(-n // BLOCK))
    keyed = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    return keyed.groupBy("dim", "block").applyInArrow(pack(most), _BLOCK_SCHEMA)


def unpack(row: pa.Table) -> tuple[np.ndarray, ...]:
    ids, codes, *rest, mark = (row.column(c)[0].as_py() for c in _PARTS)
    ids = np.frombuffer(ids, dtype=np.int64)
    return (ids, np.frombuffer(codes, dtype=np.int8).reshape(len(ids), -1), *(np.frombuffer(r) for r in rest),
            np.frombuffer(mark, dtype=np.int64))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scales, norms of the rounding errors)."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = np.finfo(float).tiny
    codes = np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8)
    return codes, scale, np.sqrt(((x - codes * scale[:, None]) ** 2).sum(axis=1))


def search_tile(queries, candidates, k: int) -> Iterator[tuple]:
    """(query id, ids, lower and upper bounds, checksums) of the candidates of a tile that may be among each query's best k."""
    q_ids, codes_q, scale_q, norm_q, err_q, _ = queries
    c_ids, codes_c, scale_c, norm_c, err_c, marks = candidates
    kind = np.float32 if codes_q.shape[1] * 127 * 127 < 1 << 24 else np.float64
    codes_c = codes_c.astype(kind).T.copy()
    # |q.c - q'.c'| <= |q'| |c - c'| + |q - q'| |c|, and |q'| <= |q| + |q - q'|.
    decoded_q = norm_q + err_q
    for start in range(0, len(q_ids), CHUNK):
        s = slice(start, start + CHUNK)
        about = (codes_q[s].astype(kind) @ codes_c).astype(np.float64)
        about *= scale_q[s][:, None] * scale_c
        bound = decoded_q[s][:, None] * err_c + err_q[s][:, None] * norm_c
        bound += _SLACK * (decoded_q[s][:, None] + err_q[s][:, None]) * norm_c
        about[q_ids[s][:, None] == c_ids] = -np.inf
        low = about - bound
        at = min(k, low.shape[1]) - 1
        limit = -np.partition(-low, at, axis=1)[:, at] if at < low.shape[1] - 1 else low.min(axis=1)
        alive = (about + bound >= limit[:, None]) & (about > -np.inf)
        for i in range(alive.shape[0]):
            j = np.flatnonzero(alive[i])
            yield int(q_ids[start + i]), c_ids[j], low[i, j], about[i, j] + bound[i, j], marks[j]


def tile(k: int):
    """Task: one query block against one candidate block."""
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and candidates.num_rows:
            out = list(search_tile(unpack(queries), unpack(candidates), k))
        dim = queries.column("dim")[0].as_py() if queries.num_rows else 0
        return pa.table({"dim": pa.array([dim] * len(out), pa.int32()), "query_id": pa.array([r[0] for r in out], pa.int64()),
                         **{c: pa.array([r[i].tobytes() for r in out], pa.binary()) for i, c in enumerate(_FOUND, 1)}})
    return run


def survivors(k: int):
    """Task over tile rows sorted by query: the pairs whose upper bound reaches the k-th best lower bound of all tiles.
    Equal vectors have equal bounds; of them only the k smallest ids can be results."""
    def reach(*found):
        ids, low, high, marks = found
        if len(low) > k:
            may = np.flatnonzero(high >= -np.partition(-low, k - 1)[k - 1])
            may = may[smallest_of_each([marks[may], low[may], high[may]], ids[may], k)]
            return tuple(x[may] for x in found)
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None

        def pairs():
            n = len(held[0])
            return pa.RecordBatch.from_arrays([pa.array([now[0]] * n, pa.int32()), pa.array([now[1]] * n, pa.int64()),
                                               pa.array(held[0])], names=["dim", "query_id", "vec_id"])

        for batch in batches:
            for dim, query, *parts in zip(*(batch.column(c).to_pylist() for c in ("dim", "query_id", *_FOUND))):
                mine = tuple(np.frombuffer(x, dtype=t) for x, t in zip(parts, (np.int64, np.float64, np.float64, np.int64)))
                if (dim, query) != now:
                    if now is not None:
                        yield pairs()
                    now, held = (dim, query), reach(*mine)
                else:  # bounded memory whatever the number of tiles
                    held = reach(*(np.concatenate(x) for x in zip(held, mine)))
        if now is not None:
            yield pairs()
    return run


def best_heaps(k: int):
    """Task over scored pairs sorted by query: a heap of the best k of each query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, heap = None, []  # the worst of the best on top: smallest score, largest id

        def best():
            rows = sorted(((-s, -i) for s, i in heap))
            return pa.RecordBatch.from_arrays(
                [pa.array([now[1]] * len(rows), pa.int64()), pa.array(range(1, len(rows) + 1), pa.int32()),
                 pa.array([i for _, i in rows], pa.int64()), pa.array([-s for s, _ in rows], pa.float64())],
                names=["query_id", "rank", "vec_id", "score"])

        for batch in batches:
            for dim, query, vec, score in zip(*(batch.column(c).to_pylist() for c in ("dim", "query_id", "vec_id", "score"))):
                if (dim, query) != now:
                    if now is not None:
                        yield best()
                    now, heap = (dim, query), []
                item = (score, -vec)
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
        if now is not None:
            yield best()
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows of every query row."""
    rows, asked = once(usable(vectors)), once(usable(queries))
    candidates = materialize(pack_blocks(rows, rows.count(), k + 1), "blocks")  # one of them may be the query itself
    searched = materialize(pack_blocks(asked, asked.count()), "queries")
    pairs = searched.select("dim", F.col("block").alias("q")).join(
        candidates.select("dim", F.col("block").alias("c")), "dim")  # block numbers only: the list of tiles
    left = searched.withColumnRenamed("block", "q").join(pairs, ["dim", "q"])
    right = candidates.withColumnRenamed("block", "c").join(pairs, ["dim", "c"])
    found = (left.groupBy("dim", "q", "c").cogroup(right.groupBy("dim", "q", "c"))
             .applyInArrow(tile(k), "dim int, query_id long, " + ", ".join(f"{c} binary" for c in _FOUND)))
    found = (found.repartition("query_id").sortWithinPartitions("query_id", "dim")
             .mapInArrow(survivors(k), "dim int, query_id long, vec_id long"))
    found = materialize(found, "survivors")
    scored = (found.join(rows.select("dim", "vec_id", "v"), ["dim", "vec_id"])
              .join(asked.select("dim", F.col("vec_id").alias("query_id"), F.col("v").alias("q")), ["dim", "query_id"]))
    # Summed component by component, in order.
    score = F.aggregate(F.zip_with("q", "v", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    scored = scored.select("dim", "query_id", "vec_id", score.alias("score"))
    return (scored.repartition("query_id").sortWithinPartitions("query_id", "dim")
            .mapInArrow(best_heaps(k), "query_id long, rank int, vec_id long, score double"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose vec_id is divisible by 20."""
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INT) AS rank, vec_id, score FROM ranked WHERE r <= 20
"""
