"""Ranked lexical search over range-maximum tables of posting lists.

Documents are indexed in segments.  A segment holds, for each term that the
items ask for, the posting list (documents in order of their id) with the
term's impact on the score, and a sparse table over each list that answers
"where is the largest impact among these postings" for any stretch of it.

An item is searched best first.  A stretch of documents is bounded by the sum,
over the item's terms, of the largest impact inside the stretch.  The stretch
with the best bound is split at the document with the largest single impact: that
document's score is summed exactly, and the stretches to its left and right get
bounds of their own.  Stretches that cannot reach the k-th best score found so
far are dropped unseen; the search ends when none is left, so the result is exact.
Several of the best stretches are split at once, by array operations.

On Spark: one pass over the texts counts terms and writes, per document, the
occurrences of terms that items use; aggregates over it give the corpus figures
(documents, terms, documents of each term).  A second pass over the written rows
builds the segments inside each task and searches them all; per item at most k
rows of a segment are left, which are merged in two steps.  Items are taken in
blocks of bounded size, the only data sent to all workers.

Defined results
* null or empty text, or one without terms: not counted as a document, never a result.
* items without terms, or whose terms no document has, have no rows.
* repeated documents are ranked each for itself; equal scores go by ascending
  doc_id, null ids last.  Repeated items are searched each for itself.
* very long texts: counted whole, one text is in memory at a time besides its batch.
* empty tables: no rows.  Other columns of both inputs, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import materialize, partitions_for, read, total_bytes
from llm.words import tidy

# Terms over UTF-8 bytes after A-Z were lower-cased: digits, letters and all bytes of non-ASCII characters.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
TOP = 50
# Items are searched in blocks of about this many bytes of text.
BLOCK_BYTES = 4 << 20
# A segment is closed when it holds this many postings (and stretches, at most this many, are split at a time).
SEGMENT_POSTINGS = 1_000_000
SPLIT_AT_ONCE = 256


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text: runs of ASCII letters, digits and non-ASCII characters; only A-Z is lower-cased."""
    return _TERM.findall(text.encode().lower()) if text else []


def count_terms(numbers: dict[bytes, int]):
    """Task: (doc_id, n, terms, tfs) of each document with a term; only terms of ``numbers`` are listed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0), []
            for i, text in enumerate(batch.column(1)):
                found = terms_of(text.as_py())
                if found:
                    counts = Counter(found)
                    mine = sorted((numbers[t], counts[t]) for t in counts.keys() & numbers.keys())
                    rows.append((i, len(found), [t for t, _ in mine], [c for _, c in mine]))
            place, n, terms, tfs = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(place, pa.int64())), pa.array(n, pa.int64()),
                 pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "tfs"])
    return run


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Contribution of a term (``weight``) that occurs ``tf`` times in a document of ``n`` terms."""
    m = 50 + (50 * n * n_docs) // n_terms
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def term_weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Segment:
    """Posting lists of a run of documents with their range-maximum tables.

    ``list_of`` maps a term to its list; postings of list t are at first[t]:first[t + 1],
    with ``doc`` (place of the document in the segment) ascending."""

    def __init__(self, n_docs: int, terms: np.ndarray, docs: np.ndarray, impact: np.ndarray):
        order = np.lexsort((docs, terms))
        names, counts = np.unique(terms, return_counts=True)
        self.n_docs = n_docs
        self.list_of = {int(t): i for i, t in enumerate(names)}
        self.first = np.r_[0, np.cumsum(counts)]
        self.doc, self.impact = docs[order], impact[order]
        # Lists one after the other in one ascending array, so that one binary search serves all.
        self.key = np.repeat(np.arange(len(names)), counts) * n_docs + self.doc
        # best[k, i]: place of the largest impact among postings i .. i + 2**k - 1, the first of equal ones.
        longest, total = int(counts.max()) if len(counts) else 1, len(order)
        self.level = np.zeros(longest + 1, dtype=np.int64)
        for k in range(1, longest.bit_length()):
            self.level[1 << k:] = k
        self.best = np.zeros((longest.bit_length(), total + 1), dtype=np.int32)
        self.best[:, :total] = np.arange(total, dtype=np.int32)
        for k in range(1, longest.bit_length()):
            half, stop = 1 << (k - 1), total - (1 << k) + 1
            a, b = self.best[k - 1, :stop], self.best[k - 1, half:half + stop]
            self.best[k, :stop] = np.where(self.impact[a] >= self.impact[b], a, b)

    def largest(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, value) of the largest impact among postings low .. high - 1 (same shape); value -1 where there are none."""
        width = np.maximum(high - low, 0)
        level = self.level[width]
        a, b = self.best[level, low], self.best[level, np.maximum(high - (1 << level), 0)]
        x, y = self.impact[a], self.impact[b]
        left = x >= y
        return np.where(left, a, b), np.where(width > 0, np.where(left, x, y), -1)

    def search(self, terms: list[int], top: int, least: int = 1, at_once: int = SPLIT_AT_ONCE) -> list[tuple[int, int]]:
        """The ``top`` best (score, document) with a score of ``least`` or more: largest first, equal scores by document."""
        lists = np.array([self.list_of[t] for t in terms if t in self.list_of], dtype=np.int64)
        if not len(lists):
            return []
        last = len(self.doc) - 1
        # Open stretches of documents: their postings low .. high - 1 in each list, and each list's largest impact there.
        low, high = self.first[lists][None, :], self.first[lists + 1][None, :]
        best, value = self.largest(low, high)
        bound = np.maximum(value, 0).sum(axis=1)
        scores, docs = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        while True:
            # Stretches that only tie with the k-th best stay: they may hold an earlier document.
            keep = bound >= least
            low, high, best, value, bound = low[keep], high[keep], best[keep], value[keep], bound[keep]
            if not len(bound):
                return list(zip(scores.tolist(), docs.tolist()))
            pick = np.ones(len(bound), dtype=bool)
            if len(bound) > at_once:
                pick[np.argpartition(bound, -at_once)[:-at_once]] = False
            chosen, rest = np.flatnonzero(pick), np.flatnonzero(~pick)
            middle = self.doc[best[chosen, value[chosen].argmax(axis=1)]]
            place = np.searchsorted(self.key, lists[None, :] * self.n_docs + middle[:, None])
            at = np.minimum(place, last)
            there = (place < high[chosen]) & (self.doc[at] == middle[:, None])
            scores = np.r_[scores, np.where(there, self.impact[at], 0).sum(axis=1)]
            docs = np.r_[docs, middle]
            good = np.flatnonzero(scores >= least)
            good = good[np.lexsort((docs[good], -scores[good]))[:top]]
            scores, docs = scores[good], docs[good]
            full = len(scores) == top
            if full:
                least = int(scores[-1])
            new_low, new_high = np.concatenate([low[chosen], place + there]), np.concatenate([place, high[chosen]])
            new_best, new_value = self.largest(new_low, new_high)
            new_bound = np.maximum(new_value, 0).sum(axis=1)
            if full:  # a stretch that can tie at most, and whose documents all come later, is of no use either
                ties = np.flatnonzero(new_bound == least)
                if len(ties):
                    first = np.where(new_value[ties] >= 0, self.doc[np.minimum(new_low[ties], last)], self.n_docs).min(axis=1)
                    new_bound[ties[first > docs[-1]]] = 0
            use = np.flatnonzero(new_bound >= least)
            low, high = np.concatenate([low[rest], new_low[use]]), np.concatenate([high[rest], new_high[use]])
            best, value = np.concatenate([best[rest], new_best[use]]), np.concatenate([value[rest], new_value[use]])
            bound = np.concatenate([bound[rest], new_bound[use]])


def search_segments(items: list[tuple[int, list[int]]], weights: dict[int, int], n_docs: int, n_terms: int, top: int,
                    at_most: int = SEGMENT_POSTINGS):
    """Task: cut its rows into segments and search each of them for all items.  What an item's k-th best score
    was in earlier segments of the task is the least that counts in the next ones."""
    floors: dict[int, int] = {}

    def search(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks().sort_by([("doc_id", "ascending")])  # nulls last
        lists, tfs = table.column("terms").combine_chunks(), table.column("tfs").combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        docs = np.repeat(np.arange(table.num_rows), lengths)
        terms, tf = lists.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy()
        known, at = np.unique(terms, return_inverse=True)
        weight = np.array([weights[int(t)] for t in known], dtype=np.int64)[at]
        segment = Segment(table.num_rows, terms, docs, impacts(weight, tf, table.column("n").to_numpy()[docs], n_docs, n_terms))
        out = []
        for number, ask in items:
            found = segment.search(ask, top, floors.get(number, 1))
            if len(found) == top:
                floors[number] = found[-1][0]
            out += [(number, score, doc) for score, doc in found]
        number, score, doc = zip(*out) if out else ((), (), ())
        ids = table.column("doc_id").combine_chunks().take(pa.array(doc, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), ids, pa.array(score, pa.int64())],
                                          names=["item", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, postings = [], 0
        for batch in batches:
            lengths = np.diff(batch.column("terms").offsets.to_numpy())
            upto, start = postings + np.cumsum(lengths), 0
            while start < batch.num_rows:
                stop = min(int(np.searchsorted(upto, at_most, side="left")) + 1, batch.num_rows)
                held.append(batch.slice(start, stop - start))
                if upto[stop - 1] >= at_most:
                    yield search(held)
                    held = []
                    upto = upto - upto[stop - 1]
                start = stop
            postings = int(upto[-1]) if held and len(upto) else 0
        if held:
            yield search(held)
    return run


def ranked(found: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search_block(docs: DataFrame, items: list[tuple[int, list[bytes]]], top: int, n_parts: int) -> DataFrame:
    """(item, rank, doc_id, score) for a bounded list of (number, terms)."""
    spark = docs.sparkSession
    numbers = {t: i for i, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    asked = [(number, [numbers[t] for t in terms]) for number, terms in items]
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = spark.sparkContext.broadcast(numbers)
    counted = docs.mapInArrow(tidy(lambda batches: count_terms(sent.value)(batches)),
                              f"doc_id {kind}, n bigint, terms array<int>, tfs array<bigint>")
    counted = materialize(counted, "terms")
    n_docs, n_terms = counted.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return spark.createDataFrame([], f"item long, doc_id {kind}, score long, rank int")
    # At most as many rows as the block has terms.
    frequency = counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect()
    weights = {r["t"]: term_weight(r["count"], n_docs) for r in frequency}
    search = spark.sparkContext.broadcast((asked, weights))
    found = counted.filter(F.size("terms") > 0).mapInArrow(
        tidy(lambda batches: search_segments(*search.value, n_docs, n_terms, top)(batches)),
        f"item bigint, doc_id {kind}, score bigint")
    # Two steps, so that no task gets the rows of an item from all segments.
    found = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(n_parts)))
    found = ranked(found, ["item", "part"], top).drop("rank", "part")
    return ranked(found, ["item"], top)


def lexical_search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", item_text: str = "text", top: int = TOP) -> DataFrame:
    """The ``top`` best documents of each item: item_id, rank, doc_id, score."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    items = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    blocks = partitions_for(total_bytes(items, "text"), BLOCK_BYTES)
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    n_parts = partitions_for(total_bytes(docs, "text"), 8 << 30)
    out = None
    for block in range(blocks):
        rows = items.filter(F.col("block") == block).select("item_id", "text").collect()  # about BLOCK_BYTES
        asked = [(i, sorted(set(terms_of(r["text"])))) for i, r in enumerate(rows)]
        found = search_block(docs, asked, top, n_parts)
        kind = items.schema["item_id"].dataType.simpleString()
        names = F.broadcast(docs.sparkSession.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)],
                                                              f"item long, item_id {kind}"))
        found = found.join(names, "item").select("item_id", F.col("rank").cast("int"), "doc_id", F.col("score").cast("long"))
        out = found if out is None else out.unionByName(found)
    return out


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    return lexical_search(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


ORACLE_SQL = rf"""
WITH terms AS (
  SELECT r, doc_id, n, t, count(*) AS tf FROM (
    SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents)) GROUP BY ALL),
corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM (SELECT DISTINCT r, n FROM terms)),
weights AS (
  SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w, n_docs, n_terms
  FROM (SELECT t, count(*) AS df FROM terms GROUP BY t), corpus),
asked AS (
  SELECT DISTINCT q, item_id, unnest(w) AS t FROM (
    SELECT row_number() OVER () AS q, item_id, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark)),
scored AS (
  SELECT q, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN terms USING (t) JOIN weights USING (t) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {TOP}
"""
