"""Best-fit packing of documents into sequences of fixed capacity, with conflicts.

Items are placed by decreasing length.  Bins are kept in the order of their
residual capacity; the search starts at the smallest residual that holds the
item and goes on to the next larger ones until a bin is compatible, which is
then the tightest compatible bin.  A bin carries bitmaps of its sources (one per
allowed repetition, ``PER_SOURCE``) and of its duplicate clusters: it takes at
most that many pieces of one source, and one piece of a cluster.

Documents longer than a bin are cut into pieces of full capacity and a rest; no
token is dropped.  Pieces are dealt by hash to groups of about ``GROUP_PIECES``,
packed independently, one group in a task at a time.  Only ids and lengths are
shuffled.  A source or cluster that holds a third of all rows is spread over
all groups like any other.

Defined results
* documents without tokens take no room: one row with piece 0, null bin and place.
* null source: a source of its own.  null cluster: conflicts with nothing.
* repeated rows are packed as items of their own; ties go by id, then piece.
* an empty table gives an empty result; other columns are not carried along.
* ids may be whole numbers or strings; they come back in their own type.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import WORD, materialize, read

CAPACITY = 2048
PER_SOURCE = 4
GROUP_PIECES = 8192


def pack_items(lengths: list[int], sources: list[int], clusters: list[int], capacity: int,
               per_source: int) -> tuple[list[int], list[int]]:
    """(bin, place in the bin) of items given in packing order.

    ``clusters`` holds -1 where an item conflicts with nothing.
    """
    open_bins: list[tuple[int, int]] = []  # (residual, bin), in order
    planes: list[list[int]] = []  # per bin: source bitmaps, one per repetition
    members: list[int] = []  # per bin: bitmap of clusters
    bins, places = [], []
    for length, source, cluster in zip(lengths, sources, clusters):
        bit, own = 1 << source, (1 << cluster if cluster >= 0 else 0)
        at = bisect_left(open_bins, (length, -1))
        while at < len(open_bins):
            b = open_bins[at][1]
            if not members[b] & own and not planes[b][-1] & bit:
                break
            at += 1
        if at < len(open_bins):
            residual, b = open_bins.pop(at)
        else:
            residual, b = capacity, len(planes)
            planes.append([0] * per_source)
            members.append(0)
        members[b] |= own
        for k in range(per_source):
            if not planes[b][k] & bit:
                planes[b][k] |= bit
                break
        bins.append(b)
        places.append(capacity - residual)
        if residual > length:
            insort(open_bins, (residual - length, b))
    return bins, places


def pack_group(capacity: int, per_source: int):
    """Task: pack the pieces of one group."""
    def run(table: pa.Table) -> pa.Table:
        pdf = table.to_pandas()
        pdf = pdf.sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        sources = pdf["source"].astype(object).where(pdf["source"].notna(), None)
        codes = {v: i for i, v in enumerate(dict.fromkeys(sources))}
        again = pdf["cluster"].notna() & pdf["cluster"].duplicated(keep=False)
        cluster = np.full(len(pdf), -1)
        cluster[again.to_numpy()] = pdf.loc[again, "cluster"].factorize()[0]
        bins, places = pack_items(pdf["n_tokens"].tolist(), [codes[v] for v in sources], cluster.tolist(),
                                  capacity, per_source)
        rows = table.take(pa.array(pdf.index.to_numpy()))
        bin_id = rows.column("grp").to_numpy().astype(np.int64) * (1 << 32) + np.array(bins, dtype=np.int64)
        return pa.table({"doc_id": rows.column("doc_id"), "piece": rows.column("piece"),
                         "n_tokens": rows.column("n_tokens"), "source": rows.column("source"),
                         "cluster": rows.column("cluster"), "bin_id": pa.array(bin_id),
                         "place": pa.array(places, pa.int64())})
    return run


def pack(items: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> DataFrame:
    """Pieces with bin_id and place, of ``items`` (doc_id, n_tokens, source, cluster)."""
    rest = F.col("n_tokens") - F.col("piece") * capacity
    count = F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / capacity)).cast("int")
    pieces = (items.select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"),
                           F.col("source").cast("string").alias("source"), F.col("cluster").cast("long").alias("cluster"))
              .withColumn("piece", F.explode(F.sequence(F.lit(0), count - 1)))
              .withColumn("n_tokens", F.least(F.lit(capacity).cast("long"), rest)))
    pieces = materialize(pieces, "pieces")
    groups = max(1, -(-pieces.count() // GROUP_PIECES))
    # Repeated rows are spread too: the salt differs by row of the written pieces.
    dealt = F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups)).cast("int")
    full = pieces.filter("n_tokens > 0").withColumn("grp", dealt)
    kind = pieces.schema["doc_id"].dataType.simpleString()
    packed = full.groupBy("grp").applyInArrow(
        pack_group(capacity, per_source),
        f"doc_id {kind}, piece int, n_tokens long, source string, cluster long, bin_id long, place long")
    none = F.lit(None).cast("long")
    return packed.unionByName(pieces.filter("n_tokens = 0").withColumns({"bin_id": none, "place": none}))


def items_of(docs: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """Packing items of documents: words as tokens, equal texts as one cluster.

    ``near`` (doc_id, text_hash, component_id, as :func:`llm.op7_neardup.near_duplicates` gives them) makes
    near-duplicate groups the clusters instead, so that near copies do not meet in a sequence either."""
    items = docs.select("doc_id", F.regexp_count("text", F.lit(WORD)).alias("n_tokens"), "source",
                        F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("cluster"))
    if near is None:
        return items
    groups = near.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__th"),
                         F.col("component_id").alias("__group")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.coalesce("cluster", F.xxhash64(F.lit(""))) == F.col("__th"))
    items = items.join(groups, same, "left")
    return items.select("doc_id", "n_tokens", "source", F.when(
        F.col("__group").isNotNull(), F.xxhash64(F.lit("group"), "__group")).otherwise(F.col("cluster")).alias("cluster"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 words."""
    return pack(items_of(read(spark, sf_dir, "documents", "doc_id", "text", "source")))
