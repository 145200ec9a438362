"""Near-duplicate documents: SuperMinHash, banding, verification, union-find.

1. Every text becomes its set of distinct word shingles (64-bit hashes) and a
   SuperMinHash signature: each shingle gives the components a random
   permutation of ranks, and the steps stop as soon as no rank can improve any
   component of the document.
2. Texts with equal sets are one class; only its smallest doc_id goes on.
3. Band hashes form buckets.  Inside a bucket, signatures estimate the
   similarity, and a maximum spanning tree over pairs of different components
   is proposed, at most one pair less than the bucket has rows.  Large buckets
   are cut into blocks, and blocks are met pairwise in separate tasks.
4. Proposed pairs are verified on full shingle sets, and verified links are
   merged by union-find: forests of bounded parts of the links, then alternating
   large-star and small-star contraction over all parts.
5. Buckets that still hold several components: rows that may be linked with a row
   of another component get their full sets, and all such pairs of the bucket
   are tested inside the task, each pair in the first band that it shares.  So no
   pair of a bucket is left without a test, and only links leave the task.

Bands: with 30 bands of 5 rows, a pair of similarity 0.8 shares no band with
probability 7e-6; the estimate of a linked pair falls below ``ESTIMATE`` with
probability 2e-6.  All else is exact.

Defined results
* null or empty text, or one without words: set size 0, linked with nothing.
* fewer words than a shingle has: the whole sequence is the only element of the set.
* very long texts: whole; the steps of a signature work on slices of about 1 MB of text, or one text.
* null doc_id: never names a component that has a doc_id; a component without
  any has a null name, and its rows are kept.
* every row is judged by its own text, also where rows share a doc_id; kept means
  that doc_id equals component_id, so exact repeats of a kept row are kept with it.
* columns of the input other than doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import WORD, materialize, read, small_batches
from llm.words import Words, derive, mix64, slices, tidy
from salescast.session import broadcast_bounded

SIZE, BANDS, ROWS = 150, 30, 5
SIMILARITY_PERCENT = 80
ESTIMATE = 0.65
WIDTH = 2
BLOCK = 1024
LINKS_PER_TASK = 500_000
# Representatives whose sets are needed are broadcast to the scan up to this many ids (8 bytes each).
BROADCAST_IDS = 250_000
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(elements, first): sorted distinct shingle hashes of each text, one after another."""
    w = Words(texts)
    h, keep = w.windows(3, width, lower=True)
    out, first = [], [0]
    for i, n in enumerate(w.counts):
        a, b = w.first[i], w.first[i + 1]
        if n == 0:
            s = h[:0]
        elif n < width:  # the whole sequence is one shingle
            words = w.raw[w.start[a]:w.end[b - 1]].tobytes().split()
            s = np.array([int.from_bytes(hashlib.blake2b(b" ".join(words).lower(), digest_size=8).digest(), "little")],
                         dtype=np.uint64)
        else:
            s = np.unique(h[a:b - width + 1])
        out.append(s)
        first.append(first[-1] + len(s))
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.array(first)


def super_minhash(elements: np.ndarray, first: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Signatures (sets x size) of sets laid one after another.

    Step j gives every element a value in [j, j+1) for one component, the j-th
    of the element's own random permutation (Fisher-Yates; the swaps so far are
    traced back instead of kept as an array).  A set leaves as soon as all its
    components are below j: later steps cannot lower any of them.
    """
    n_sets = len(first) - 1
    sig = np.full((n_sets, size), _TOP, dtype=np.uint64)
    flat = sig.reshape(-1)
    owner = np.repeat(np.arange(n_sets), np.diff(first))
    e, swaps = elements, []
    consts = derive(29, 2 * size)
    with np.errstate(over="ignore"):
        for j in range(size):
            if not len(e):
                break
            r = mix64(e + consts[2 * j])
            k = (j + (mix64(r ^ consts[2 * j + 1]) >> np.uint64(32)) % np.uint64(size - j)).astype(np.int16)
            x = k.copy()
            for t in range(j - 1, -1, -1):
                kt = swaps[t]
                x = np.where(x == t, kt, np.where(x == kt, np.int16(t), x))
            swaps.append(k)
            value = (np.uint64(j) << np.uint64(48)) | (r >> np.uint64(16))
            np.minimum.at(flat, owner * size + x, value)
            sets = np.unique(owner)
            open_ = np.zeros(n_sets, dtype=bool)
            open_[sets] = sig[sets].max(axis=1) >= (np.uint64(j + 1) << np.uint64(48))
            going = open_[owner]
            if not going.all():
                e, owner = e[going], owner[going]
                swaps = [s[going] for s in swaps]
    return sig


def band_hashes(sig: np.ndarray) -> np.ndarray:
    """Band keys (sets x BANDS) of full signatures."""
    factors = derive(31, BANDS * ROWS) | np.uint64(1)
    with np.errstate(over="ignore"):
        mixed = mix64(sig[:, :BANDS * ROWS] * factors)
        return mix64(mixed.reshape(len(sig), BANDS, ROWS).sum(axis=2, dtype=np.uint64))


_FEATURES = ("doc_id long, th long, n_shingles long, key_a long, key_b long, sig binary, bands array<long>, "
             "shared binary")


def features(batches: Iterator[pa.RecordBatch], width: int = WIDTH) -> Iterator[pa.RecordBatch]:
    """Task: set size, set key, one-byte signature and band keys of each text."""
    for batch in batches:
        start = 0
        for part in slices(batch.column("text")):
            elements, first = shingle_sets(part, width)
            sig = super_minhash(elements, first)
            n = np.diff(first)
            key = set_keys(elements, first)
            small = (mix64(sig) & np.uint64(255)).astype(np.uint8)
            hashes = band_hashes(sig)
            bands = pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32) * BANDS,
                                             pa.array(hashes.astype(np.int64).reshape(-1)))
            shared = pa.array([b.tobytes() for b in hashes.astype(np.uint32)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(start, len(part)), batch.column("th").slice(start, len(part)),
                 pa.array(n, pa.int64()),
                 pa.array(key[:, 0]), pa.array(key[:, 1]), pa.array([s.tobytes() for s in small], pa.binary()), bands, shared],
                names=["doc_id", "th", "n_shingles", "key_a", "key_b", "sig", "bands", "shared"])
            start += len(part)


def set_keys(elements: np.ndarray, first: np.ndarray) -> np.ndarray:
    """128-bit key of each set as two longs (sets x 2)."""
    keys = [hashlib.blake2b(elements[a:b].tobytes(), digest_size=16).digest() for a, b in zip(first[:-1], first[1:])]
    return np.frombuffer(b"".join(keys), dtype=np.int64).reshape(-1, 2)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """(group borders, rows) of sorted batches; a group that goes on is carried over."""
    carry: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        border = _borders(batch, keys)
        if carry and len(border) == 2 and all(carry[-1].column(k)[-1].equals(batch.column(k)[0]) for k in keys):
            carry.append(batch)  # nothing but more of that group
            continue
        if carry:
            batch = _joined([*carry, batch])
            border = _borders(batch, keys)
        if len(border) > 2:
            yield border[:-1], batch.slice(0, int(border[-2]))
        carry = [batch.slice(int(border[-2]))]
    if carry:
        rows = _joined(carry)
        yield _borders(rows, keys), rows


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0] if len(batches) > 1 else batches[0]


def _borders(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    new = np.zeros(batch.num_rows, dtype=bool)
    new[0] = True
    for k in keys:
        v = batch.column(k).to_numpy(zero_copy_only=False)
        new[1:] |= v[1:] != v[:-1]
    return np.r_[np.flatnonzero(new), batch.num_rows]


def spanning_pairs(sig: np.ndarray, n: np.ndarray) -> list[tuple[int, int]]:
    """Maximum spanning forest (Prim) over estimated similarities."""
    m = len(n)
    best, source = np.full(m, -1.0), np.full(m, -1)
    waiting = np.ones(m, dtype=bool)
    out, i = [], 0
    for _ in range(m - 1):
        waiting[i] = False
        est = estimates(sig, n, i)
        better = waiting & (est > best)
        best[better], source[better] = est[better], i
        i = int(np.argmax(np.where(waiting, best, -2.0)))
        if best[i] >= ESTIMATE:
            out.append((int(source[i]), i))
    return out


def estimates(sig: np.ndarray, n: np.ndarray, i: int) -> np.ndarray:
    """Estimated similarity of row i to all rows; -1 where the sizes rule a link out."""
    est = (sig == sig[i]).mean(axis=1)
    low, high = np.minimum(n, n[i]), np.maximum(n, n[i])
    est[100 * low < SIMILARITY_PERCENT * high] = -1.0
    return est


def matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, width)


def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task over bucket rows sorted by bucket: pairs (a, b) to verify."""
    for border, rows in grouped(batches, _GROUP):
        ids = rows.column("id").to_numpy(zero_copy_only=False)
        n = rows.column("n").to_numpy(zero_copy_only=False)
        sig = matrix(rows.column("sig"), np.uint8, SIZE)
        left, right = [], []
        size = np.diff(border)
        two = border[:-1][size == 2]  # most buckets: one pair
        low, high = np.minimum(n[two], n[two + 1]), np.maximum(n[two], n[two + 1])
        good = (100 * low >= SIMILARITY_PERCENT * high) & ((sig[two] == sig[two + 1]).mean(axis=1) >= ESTIMATE)
        left.append(ids[two[good]])
        right.append(ids[two[good] + 1])
        for a, b in zip(border[:-1][size > 2], border[1:][size > 2]):
            pairs = spanning_pairs(sig[a:b], n[a:b])
            if pairs:
                p = np.array(pairs) + a
                left.append(ids[p[:, 0]])
                right.append(ids[p[:, 1]])
        x, y = np.concatenate(left), np.concatenate(right)
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y), pa.int64()), pa.array(np.maximum(x, y), pa.int64())],
                                         names=["a", "b"])


class Bucket:
    """Rows of one bucket (or pair of blocks of it) that is left with several components."""

    def __init__(self, rows: pa.RecordBatch):
        self.band = rows.column("band")[0].as_py()
        self.cross = rows.column("i")[0].as_py() != rows.column("j")[0].as_py()
        self.own, self.comp, self.n = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("own", "comp", "n"))
        self.sig = matrix(rows.column("sig"), np.uint8, SIZE)
        self.shared = matrix(rows.column("shared"), np.uint32, BANDS)

    def partners(self, i: int) -> np.ndarray:
        """Later rows of other components that may be linked with row i, where this is
        the first band that both share.  Two blocks only meet each other's rows."""
        may = (self.comp != self.comp[i]) & (np.arange(len(self.n)) > i)
        if self.cross:
            may &= self.own != self.own[i]
        j = np.flatnonzero(may)
        low, high = np.minimum(self.n[j], self.n[i]), np.maximum(self.n[j], self.n[i])
        j = j[100 * low >= SIMILARITY_PERCENT * high]
        j = j[(self.sig[j] == self.sig[i]).mean(axis=1) >= ESTIMATE]
        return j[(self.shared[j, :self.band] != self.shared[i, :self.band]).all(axis=1)]


_GROUP = ["band", "key", "i", "j"]
_ROW = "band int, key long, i int, j int, own int, id long, comp long, n long, sig binary, shared binary"


def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: rows of mixed buckets that have a possible partner in another component."""
    for border, rows in grouped(batches, _GROUP):
        marked = np.zeros(rows.num_rows, dtype=bool)
        for a, b in zip(border[:-1], border[1:]):
            bucket = Bucket(rows.slice(int(a), int(b - a)))
            for i in range(b - a):
                j = bucket.partners(i)
                if len(j):
                    marked[a + i] = True
                    marked[a + j] = True
        yield rows.filter(pa.array(marked))


def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: test all possible pairs of such rows on full sets; a link that joins two
    components of the bucket goes out, pairs it has joined already are not tested."""
    for border, rows in grouped(batches, _GROUP):
        out: list[tuple[int, int]] = []
        ids = rows.column("id").to_numpy(zero_copy_only=False)
        for a, b in zip(border[:-1], border[1:]):
            bucket = Bucket(rows.slice(int(a), int(b - a)))
            sets = [np.frombuffer(x, np.uint64) for x in rows.column("s").slice(int(a), int(b - a)).to_pylist()]
            names = bucket.comp.copy()
            for i in range(b - a):
                for j in bucket.partners(i):
                    if names[i] != names[j] and similar(sets[i], sets[j]):
                        names[names == names[j]] = names[i]
                        out.append((ids[a + i], ids[a + j]))
        x, y = (np.array(v, dtype=np.int64) for v in (zip(*out) if out else ((), ())))
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])


def similar(p: np.ndarray, q: np.ndarray) -> bool:
    """Whether two sets (sorted, distinct) are at least SIMILARITY_PERCENT alike."""
    both = len(np.intersect1d(p, q, assume_unique=True))
    return 100 * both >= SIMILARITY_PERCENT * (len(p) + len(q) - both)


def make_sets(batches: Iterator[pa.RecordBatch], width: int = WIDTH) -> Iterator[pa.RecordBatch]:
    """Task: the full shingle set of each text as packed 64-bit hashes, with its 128-bit key."""
    for batch in batches:
        for part in slices(batch.column("text")):
            elements, first = shingle_sets(part, width)
            keys = set_keys(elements, first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[:, 0]), pa.array(keys[:, 1]),
                 pa.array([elements[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())],
                names=["id", "key_b", "s"])


def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: keep the pairs whose full sets are similar enough."""
    for batch in batches:
        good = np.zeros(batch.num_rows, dtype=bool)
        for i, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"))):
            good[i] = similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64))
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(good)), batch.column("b").filter(pa.array(good))],
                                         names=["a", "b"])


def local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: union-find over the links of one part; (u, v) joins each id to the smallest of its tree."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:  # path compression
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            parent.setdefault(x, x)
            parent.setdefault(y, y)
            p, q = root(x), root(y)
            if p != q:
                parent[max(p, q)] = min(p, q)
    tree = [(x, root(x)) for x in parent]
    pairs = [t for t in tree if t[0] != t[1]]
    yield pa.RecordBatch.from_arrays([pa.array([t[0] for t in pairs], pa.int64()), pa.array([t[1] for t in pairs], pa.int64())],
                                     names=["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) for every id on an edge that is not the smallest of its component.

    Parts of at most ``LINKS_PER_TASK`` links are reduced to forests by union-find.
    With one part that is the answer; else large-star and small-star steps alternate
    until nothing changes.  Those are aggregates joined back, so a node of high
    degree is never gathered.
    """
    edges = materialize(edges.select("a", "b"), "edges")
    parts = max(1, -(-edges.count() // LINKS_PER_TASK))
    e = materialize(edges.repartition(parts).mapInArrow(tidy(local_forest), "u long, v long"), "forest")
    if parts == 1:
        return e.select(F.col("u").alias("id"), F.col("v").alias("comp"))
    mark = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "forest")
        r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (r["n"], r["s"]) == mark:
            return e.select(F.col("u").alias("id"), F.col("v").alias("comp"))
        mark = (r["n"], r["s"])


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of every row of ``df``, by shingles of ``width`` words.
    The ids must be whole numbers."""
    small_batches(df)
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    docs = docs.withColumn("th", F.xxhash64("text"))
    table = materialize(docs.mapInArrow(tidy(partial(features, width=width)), _FEATURES), "shingles")
    first = F.min_by(F.struct("doc_id", "th", "sig", "bands", "shared"), F.struct(F.col("doc_id").isNull(), "doc_id"))
    classes = (table.filter("n_shingles > 0").groupBy("key_a", "key_b")
               .agg(F.max("n_shingles").alias("n"), first.alias("f")))
    reps, clash = unique_ids(materialize(classes.select(
        F.col("key_a").alias("id"), "key_a", "key_b", "n", F.col("f.doc_id").alias("rep"),
        "f.th", "f.sig", "f.bands", "f.shared"), "classes"))
    found = named_components(reps, link(docs, reps, clash, width))
    member = table.select("doc_id", "th", "n_shingles", "key_a", "key_b").join(found, ["key_a", "key_b"], "left")
    comp = F.when(F.col("n_shingles") > 0, F.col("comp")).otherwise(F.col("doc_id"))
    return member.select("doc_id", F.col("th").alias("text_hash"), "n_shingles", comp.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def unique_ids(reps: DataFrame) -> tuple[DataFrame, bool]:
    """``reps`` with an id for each class, and whether any was changed.  The id is the first half of the class's
    key; classes that only differ in the second half (a few among 10**10) get another number each."""
    changed = False
    for salt in range(1, 100):
        same = materialize(reps.groupBy("id").agg(F.count(F.lit(1)).alias("c"), F.min("key_b").alias("stays"))
                           .filter("c > 1").select("id", "stays"), "clashes")
        if not same.limit(1).count():
            return reps, changed
        other = F.when(F.col("key_b") > F.col("stays"), F.xxhash64("key_a", "key_b", F.lit(salt))).otherwise(F.col("id"))
        reps = materialize(reps.join(same, "id", "left").withColumn("id", other).drop("stays"), "classes")
        changed = True
    raise ValueError("class ids stay ambiguous")


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``df`` with one row of each component; rows with an empty set all stay.

    The rows to drop, (doc_id, hash of the text), are written first; they are
    broadcast while their counted number fits, else joined by shuffle.
    """
    verdict = materialize(near_duplicates(df, doc_id, text, width), "verdict")
    gone = verdict.filter("NOT kept").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__th")).distinct()
    gone = broadcast_bounded(gone, verdict.filter("NOT kept").count())
    text_hash = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    left = df.join(gone, F.col(doc_id).cast("long").eqNullSafe(F.col("__id")) & (text_hash == F.col("__th")), "left_anti")
    again = verdict.filter("kept AND n_shingles > 0").groupBy("doc_id", "text_hash").count().filter("count > 1")
    if again.limit(1).count():  # a kept row that is repeated as a whole
        first = left.filter(F.coalesce(F.col(text), F.lit("")).rlike(WORD)).dropDuplicates([doc_id, text])
        left = first.unionByName(left.filter(~F.coalesce(F.col(text), F.lit("")).rlike(WORD)))
    return left


def named_components(reps: DataFrame, links: DataFrame) -> DataFrame:
    """(key_a, key_b, comp) of every class; comp is the smallest doc_id of its component."""
    labelled = reps.join(links, "id", "left").select(
        "key_a", "key_b", "rep", F.coalesce("comp", "id").alias("label"))
    names = labelled.groupBy("label").agg(F.min("rep").alias("comp"))
    return labelled.join(names, "label").select("key_a", "key_b", "comp")


def block_rows(rows: DataFrame) -> DataFrame:
    """Rows of buckets, dealt to tasks.  A bucket of c rows has ceil(c / BLOCK) blocks;
    each row goes to every pair of blocks that its own is part of."""
    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    rows = (rows.withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select("band", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    "own", "id", "comp", "n", "sig", "shared"))
    return rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "id")


def link(docs: DataFrame, reps: DataFrame, clash: bool = False, width: int = WIDTH) -> DataFrame:
    """(id, comp) of the representatives that are linked with others; ``clash``: ids are not the first half of the keys."""
    spark = docs.sparkSession
    bands = reps.select("id", F.posexplode("bands").alias("band", "key"))
    crowded = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    buckets = materialize(bands.join(crowded, ["band", "key"])
                          .join(reps.select("id", "n", "sig", "shared"), "id"), "buckets")
    first = block_rows(buckets.withColumn("comp", F.col("id")))
    pairs = materialize(first.mapInArrow(tidy(propose), "a long, b long").distinct(), "pairs")
    if not pairs.limit(1).count():
        return spark.createDataFrame([], "id long, comp long")
    # Every row that may have a partner is on a proposed pair, so these sets suffice.
    sets = fetch(docs, reps, pairs).mapInArrow(tidy(partial(make_sets, width=width)), "id long, key_b long, s binary")
    if clash:
        sets = sets.withColumnRenamed("id", "key_a").join(reps.select("key_a", "key_b", "id"), ["key_a", "key_b"])
    sets = materialize(sets.select("id", "s").dropDuplicates(["id"]), "sets")
    joined = (pairs.join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
              .join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a"))
    edges = materialize(joined.select("a", "b", "sa", "sb").mapInArrow(tidy(verify), "a long, b long"), "links")
    links = components(edges)
    rows = (buckets.join(sets.select("id"), "id", "left_semi").join(links, "id", "left")
            .withColumn("comp", F.coalesce("comp", "id")))
    mixed = (rows.groupBy("band", "key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
             .filter("x < y").select("band", "key"))
    rows = block_rows(rows.join(mixed, ["band", "key"], "left_semi"))
    left = materialize(rows.mapInArrow(tidy(suspects), _ROW), "suspects")
    late = (left.join(sets, "id").repartition(*_GROUP).sortWithinPartitions(*_GROUP, "id")
            .mapInArrow(tidy(confirm), "a long, b long"))
    late = materialize(late.distinct(), "links")
    return components(edges.unionByName(late)) if late.limit(1).count() else links


def fetch(docs: DataFrame, reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """(text) of the representatives on proposed pairs."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = materialize(reps.join(ids, "id", "left_semi").select("rep", F.col("th").alias("rep_th")), "wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    same = (docs["th"] == wanted["rep_th"]) & docs["doc_id"].eqNullSafe(wanted["rep"])
    return docs.join(wanted, same, "left_semi").select("text")


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    out = near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) END AS s FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
items AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x
  WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS r FROM sizes
  UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.r = edges.a)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""
