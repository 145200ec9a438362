"""Substring dedup: windows of 13 words, found with a count-min prefilter.

A word is removed when a window that covers it also starts in a document with a
smaller doc_id.  All windows are judged on the input texts.

1. Sketch.  Every task adds its windows (once per document and chunk) to
   count-min cells; only "none, one, two or more" is kept of a count.  Partial
   sketches travel as gap-coded cell lists, little more than one byte per window
   and sketch row, and are merged segment by segment, in parts where a segment gets many.  The merged sketch, one bit per cell
   (estimate two or more), is the only broadcast: ``SKETCH_ROWS * width / 8``
   bytes, where ``width`` follows the corpus up to ``MAX_WIDTH``.
2. Exact pass.  Windows whose estimate is two or more (an overestimate, so no
   repeated window is lost) are grouped exactly by a 96-bit key.  Each task first
   settles them within its chunk: an occurrence with a smaller document in the
   same chunk is decided at once, and only the chunk's smallest document asks
   for the rest of the corpus.  So a window that a third of all documents share
   sends one request per chunk, not one per document.
3. The decided positions meet their texts again by a hash of doc_id, in
   groups of about ``GROUP_BYTES`` of text, streamed through sorted partitions.

Beyond ``MAX_WIDTH`` cells per row the sketch fills up and lets more windows
through: results stay exact, the exact pass gets larger.

Defined results
* null text: no words; an empty text stays empty.  Texts of fewer than 13 words
  have no window and lose nothing.
* null doc_id: has no order, so the row neither loses nor removes words.
* rows that share a doc_id are one document: they remove nothing of each other.
* very long texts are handled whole; memory follows the longest single text.
* other columns of the input are passed through; columns named n_words or
  n_removed are replaced, names with two leading underscores are reserved.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import SPACE, partitions_for, read, small_batches, total_bytes
from llm.words import Words, mix64, slices, tidy, tidy_group

WINDOW = 13
SKETCH_ROWS = 2
MIN_WIDTH, MAX_WIDTH = 1 << 16, 1 << 30
# Cells of a merged segment at most, segments at least, and bytes of partial sketches that one merge task reads about.
SEGMENT_CELLS, MIN_SEGMENTS = 1 << 22, 64
MERGE_BYTES = 256 << 20
# Windows that a task settles together, text bytes a final group, bytes of requests a bucket.
CHUNK_WINDOWS = 400_000
GROUP_BYTES = 8 << 20
BUCKET_BYTES = 12 << 20
_SALT = np.uint64(0xA24BAED4963EE407)


def sketch_width(text_bytes: int) -> int:
    """Cells per sketch row: a power of two of about two cells per window."""
    width = MIN_WIDTH
    while width < text_bytes // 4 and width < MAX_WIDTH:
        width *= 2
    return width


def segments(width: int) -> int:
    """Segments of a sketch row: merge tasks grow with the sketch."""
    return max(MIN_SEGMENTS, width // SEGMENT_CELLS)


def cells(h: np.ndarray, row: int, width: int) -> np.ndarray:
    """Sketch cell of each window hash in a sketch row."""
    with np.errstate(over="ignore"):
        x = h if row == 0 else mix64(h * (_SALT + np.uint64(2 * row)))
    return (x >> np.uint64(64 - (width.bit_length() - 1))).astype(np.int64)


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted non-negative integers as gaps: low bytes as they are, high parts compressed."""
    gaps = np.diff(values, prepend=0)
    high = zlib.compress((gaps >> 8).astype(np.int32).tobytes(), 1)
    return len(gaps).to_bytes(4, "little") + (gaps & 255).astype(np.uint8).tobytes() + high


def unpack_sorted(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:4], "little")
    gaps = np.frombuffer(blob, dtype=np.uint8, count=n, offset=4).astype(np.int64)
    gaps += np.frombuffer(zlib.decompress(blob[4 + n:]), dtype=np.int32).astype(np.int64) << 8
    return np.cumsum(gaps)


def pack_ints(values: np.ndarray) -> bytes:
    """Integers as compressed differences."""
    return zlib.compress(np.diff(values, prepend=0).astype(np.int64).tobytes(), 1)


def unpack_ints(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(blob), dtype=np.int64))


def window_chunks(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple]:
    """(doc_id, tag, row index per window, position, key arrays) of about CHUNK_WINDOWS windows."""
    ids, tags, rows, places, hashes, n, base = [], [], [], [], [[] for _ in range(keys)], 0, 0

    def take():
        return (np.concatenate(ids), np.concatenate(tags), np.concatenate(rows), np.concatenate(places),
                [np.concatenate(h) for h in hashes])

    for batch in batches:
        start, text = 0, batch.column("text")
        doc = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        tag = batch.column("tag").to_numpy(zero_copy_only=False).astype(np.int64)
        for part in slices(text):
            w = Words(part)
            keep = None
            for k in range(keys):
                h, keep = w.windows(k + 1, WINDOW)
                hashes[k].append(h[keep])
            row = np.repeat(np.arange(len(part)), w.counts)[keep]
            places.append((np.arange(len(w.start)) - w.first[:-1].repeat(w.counts))[keep])
            rows.append(row + base)
            ids.append(doc[start:start + len(part)])
            tags.append(tag[start:start + len(part)])
            start += len(part)
            base += len(part)
            n += len(row)
            if n >= CHUNK_WINDOWS:
                yield take()
                ids, tags, rows, places, hashes, n, base = [], [], [], [], [[] for _ in range(keys)], 0, 0
    if base:
        yield take()


def sketch_parts(width: int):
    """Task: partial sketches as rows (row, segment, gap-coded cells)."""
    n_segments = segments(width)
    size = width // n_segments

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, rows, _, (h,) in window_chunks(batches, 1):
            order = np.argsort(h, kind="stable")  # equal windows: by row, so by document
            h, doc = h[order], ids[rows[order]]
            again = np.zeros(len(h), dtype=bool)
            again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
            h = h[~again]
            for r in range(SKETCH_ROWS):
                c = np.sort(cells(h, r, width))
                if len(c) > 2:  # more than two of a cell say nothing more
                    third = np.zeros(len(c), dtype=bool)
                    third[2:] = c[2:] == c[:-2]
                    c = c[~third]
                cuts = np.searchsorted(c, np.arange(n_segments + 1) * size)
                some = np.flatnonzero(np.diff(cuts))
                blobs = [pack_sorted(c[cuts[s]:cuts[s + 1]] - s * size) for s in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r * n_segments + some, pa.int32()), pa.array(blobs, pa.binary())],
                    names=["segment", "cells"])
    return run


def merge_parts(width: int, partly: bool):
    """Task over rows sorted by segment (and part): bits of the cells that hold two or more, or, ``partly``,
    the merged cell list, with a cell of two or more twice."""
    size = width // segments(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, one, two = None, None, None

        def done():
            if partly:
                blob = pack_sorted(np.sort(np.concatenate([np.flatnonzero(one), np.flatnonzero(two)])))
                return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([blob], pa.binary())],
                                                  names=["segment", "cells"])
            return pa.RecordBatch.from_arrays(
                [pa.array([now[0]], pa.int32()), pa.array([zlib.compress(np.packbits(two).tobytes(), 1)], pa.binary())],
                names=["segment", "bits"])

        for batch in batches:
            keys = [batch.column("segment").to_pylist(), batch.column("part").to_pylist()]
            for segment, part, blob in zip(*keys, batch.column("cells")):
                if (segment, part) != now:
                    if now is not None:
                        yield done()
                    now, one, two = (segment, part), np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
                c = unpack_sorted(blob.as_py())
                repeat = np.zeros(len(c), dtype=bool)
                repeat[1:] = c[1:] == c[:-1]
                two[c[repeat]] = True
                c = c[~repeat]
                two[c[one[c]]] = True
                one[c] = True
        if now is not None:
            yield done()
    return run


def build_sketch(docs: DataFrame, width: int, n_bytes: int) -> list[list[bytes]]:
    """Merged sketch: for each row its compressed segments, one bit per cell (estimate of two or more).

    The partial sketches (about a byte per window, a third of the text) of a segment are merged in parts of about
    ``MERGE_BYTES``, then the parts; a part is no larger than the segment, whatever the corpus."""
    n = segments(width)
    parts = docs.mapInArrow(tidy(sketch_parts(width)), "segment int, cells binary")
    ways = partitions_for(n_bytes // 3 // n, MERGE_BYTES)
    if ways > 1:
        parts = parts.withColumn("part", F.pmod(F.xxhash64("cells"), F.lit(ways)).cast("int"))
        parts = (parts.repartition(n * ways, "segment", "part").sortWithinPartitions("segment", "part")
                 .mapInArrow(tidy(merge_parts(width, True)), "segment int, cells binary"))
    parts = parts.withColumn("part", F.lit(0))
    merged = (parts.repartition(SKETCH_ROWS * n, "segment").sortWithinPartitions("segment")
              .mapInArrow(tidy(merge_parts(width, False)), "segment int, bits binary"))
    bits = {r["segment"]: bytes(r["bits"]) for r in merged.collect()}  # SKETCH_ROWS * width / 8 bytes at most
    empty = zlib.compress(bytes(width // n // 8), 1)
    return [[bits.get(r * n + s, empty) for s in range(n)] for r in range(SKETCH_ROWS)]


def open_sketch(sketch: list[list[bytes]]) -> list[np.ndarray]:
    """Bits of each sketch row, filled segment by segment so that nothing is held twice."""
    out = []
    for row in sketch:
        bits, at = None, 0
        for segment in row:
            part = np.frombuffer(zlib.decompress(segment), dtype=np.uint8)
            if bits is None:
                bits = np.empty(len(part) * len(row), dtype=np.uint8)
            bits[at:at + len(part)] = part
            at += len(part)
        out.append(bits)
    return out


def estimated_repeated(h: np.ndarray, sketch: list[np.ndarray], width: int) -> np.ndarray:
    out = np.ones(len(h), dtype=bool)
    for r, bits in enumerate(sketch):
        c = cells(h, r, width)
        byte = bits[c >> 3]
        out &= (byte >> (7 - (c & 7)).astype(np.uint8)) & 1 == 1
    return out


def later_documents(keys: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, flag): entries by key and document, and whether a smaller document has the key."""
    order = np.lexsort((doc, keys[1], keys[0]))
    a, b, d = keys[0][order], keys[1][order], doc[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order, d > d[first]


def group_of(doc: np.ndarray, groups: int) -> np.ndarray:
    """Final group of each document; ``group_column`` is the same for a column."""
    return np.mod(doc ^ (doc >> 17) ^ (doc >> 31), groups)


def group_column(doc_id, groups: int):
    folded = doc_id.bitwiseXOR(F.shiftright(doc_id, 17)).bitwiseXOR(F.shiftright(doc_id, 31))
    return F.pmod(folded, F.lit(groups).cast("long")).cast("int")


def flag_rows(doc: np.ndarray, tag: np.ndarray, place: np.ndarray, groups: int) -> list[tuple[int, bytes, bytes, bytes]]:
    """Flagged window starts as (group, documents, tags, positions) with equal-length packed arrays."""
    g = group_of(doc, groups)
    order = np.lexsort((place, tag, doc, g))
    g = g[order]
    cuts = np.flatnonzero(np.diff(g, prepend=-1))
    out = []
    for a, b in zip(cuts, np.r_[cuts[1:], len(g)]):
        o = order[a:b]
        out.append((int(g[a]), pack_ints(doc[o]), pack_ints(tag[o]), pack_ints(place[o])))
    return out


_ASK = "bucket int, grp int, doc binary, tag binary, place binary, key_a binary, key_b binary"


def ask(sketch, width: int, buckets: int, groups: int):
    """Task: settle repeated windows within the chunk; ask for the rest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = open_sketch(sketch.value)
        for ids, tags, rows, places, keys in window_chunks(batches, 2):
            hit = np.flatnonzero(estimated_repeated(keys[0], bits, width))
            keys = [keys[0][hit], keys[1][hit].astype(np.uint32)]
            rows, places = rows[hit], places[hit]
            order, later = later_documents(keys, ids[rows])
            done, open_ = order[later], np.sort(order[~later])  # open ones in text order pack best
            out = []
            for g, d, t, p in flag_rows(ids[rows[done]], tags[rows[done]], places[done], groups) if len(done) else []:
                out.append((g % buckets, g, d, t, p, None, None))
            bucket = (keys[0][open_] % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            some, first = np.unique(bucket[by], return_index=True)  # only buckets that are asked
            for k, a, b in zip(some.tolist(), first, np.r_[first[1:], len(by)]):
                o = open_[by[a:b]]
                out.append((k, None, pack_ints(ids[rows[o]]), pack_ints(tags[rows[o]]), pack_ints(places[o]),
                            keys[0][o].tobytes(), keys[1][o].tobytes()))
            if out:
                col = list(zip(*out))
                kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(col, kinds)],
                                                 names=["bucket", "grp", "doc", "tag", "place", "key_a", "key_b"])
    return run


def answer(groups: int):
    """Per bucket: which of the asked windows a smaller document has, over the whole corpus."""
    def run(table: pa.Table) -> pa.Table:
        out, asked = [], []
        for r in table.to_pylist():
            if r["key_a"] is None:
                out.append((r["grp"], r["doc"], r["tag"], r["place"]))
            else:
                asked.append((unpack_ints(r["doc"]), unpack_ints(r["tag"]), unpack_ints(r["place"]),
                              np.frombuffer(r["key_a"], np.uint64), np.frombuffer(r["key_b"], np.uint32)))
        if asked:
            doc, tag, place, a, b = (np.concatenate(x) for x in zip(*asked))
            order, later = later_documents([a, b], doc)
            o = order[later]
            if len(o):
                out += flag_rows(doc[o], tag[o], place[o], groups)
        col = list(zip(*out)) if out else [[], [], [], []]
        kinds = [pa.int32()] + [pa.binary()] * 3
        return pa.table([pa.array(c, k) for c, k in zip(col, kinds)], names=["__grp", "__doc", "__tags", "__place"])
    return run


def cut_text(text: str, starts: np.ndarray) -> tuple[str, int]:
    """(text without the words covered by windows at ``starts``, number of words cut).
    A cut word takes the white space after it along; the rest is left as it is."""
    w = Words(pa.array([text], pa.large_string()))
    n = len(w.start)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + WINDOW, n), -1)
    gone = np.cumsum(edge[:-1]) > 0
    border = np.r_[w.start, len(w.raw)]
    keep = np.ones(len(w.raw), dtype=bool)
    keep[w.start[0]:] = ~np.repeat(gone, np.diff(border))
    return w.raw[keep].tobytes().decode("utf-8"), int(gone.sum())


def apply_flags(columns: list[str], text: str, doc_id: str):
    """Task over rows sorted by group, flags before texts: cut the flagged windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = {}
        for batch in batches:
            groups = batch.column("__grp").to_numpy(zero_copy_only=False)
            is_doc = batch.column("__is_doc").to_numpy(zero_copy_only=False)
            if len(groups):  # groups come in order: earlier ones are over
                flags = {k: v for k, v in flags.items() if k[0] == groups[0]}
            for i in np.flatnonzero(~is_doc):
                doc, tag, place = (unpack_ints(batch.column(c)[int(i)].as_py()) for c in ("__doc", "__tags", "__place"))
                cuts = np.flatnonzero((np.diff(doc, prepend=doc[0] - 1) != 0) | (np.diff(tag, prepend=tag[0]) != 0))
                for a, b in zip(cuts, np.r_[cuts[1:], len(doc)]):
                    flags.setdefault((int(groups[i]), int(doc[a]), int(tag[a])), []).append(place[a:b])
            rows = batch.filter(pa.array(is_doc))
            if not rows.num_rows:
                continue
            texts, removed, counts = rows.column(text), np.zeros(rows.num_rows, dtype=np.int64), []
            for part in slices(texts):
                counts.append(Words(part).counts)
            ids, tags = rows.column(doc_id).to_pylist(), rows.column("__tag").to_pylist()
            mine, changed = rows.column("__grp").to_pylist(), {}
            for i, key in enumerate(zip(mine, ids, tags)):
                if key in flags:
                    changed[i], removed[i] = cut_text(texts[i].as_py(), np.concatenate(flags[key]))
            if changed:
                mask = np.zeros(rows.num_rows, dtype=bool)
                mask[list(changed)] = True
                texts = pa.compute.replace_with_mask(texts, pa.array(mask), pa.array(list(changed.values()), texts.type))
            arrays = [texts if c == text else rows.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                arrays + [pa.array(np.concatenate(counts), pa.int64()), pa.array(removed, pa.int64())],
                names=columns + ["n_words", "n_removed"])
    return run


def dedup_substrings(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with repeated windows cut out of ``text``, plus n_words and n_removed."""
    spark = df.sparkSession
    small_batches(df)
    df = df.drop("n_words", "n_removed")
    columns = df.columns
    n_bytes = total_bytes(df, text)
    width = sketch_width(n_bytes)
    groups = partitions_for(n_bytes, GROUP_BYTES) | 1
    # About a third of all windows (one in six bytes) may be asked for, 20 bytes each.
    buckets = partitions_for(n_bytes * 20 // 18, BUCKET_BYTES)
    docs = df.filter(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), F.col(text).alias("text"))
    sketch = spark.sparkContext.broadcast(build_sketch(docs, width, n_bytes))
    asked = docs.mapInArrow(tidy(ask(sketch, width, buckets, groups)), _ASK)
    flags = asked.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(
        tidy_group(answer(groups)), "__grp int, __doc binary, __tags binary, __place binary")
    texts = df.withColumns({"__tag": F.xxhash64(text), "__is_doc": F.lit(True)})
    # Rows without doc_id get no flags; they are spread by their text.
    texts = texts.withColumn("__grp", group_column(F.coalesce(F.col(doc_id).cast("long"), F.col("__tag")), groups))
    both = flags.withColumn("__is_doc", F.lit(False)).unionByName(texts, allowMissingColumns=True)
    both = both.repartition(groups, "__grp").sortWithinPartitions("__grp", "__is_doc")
    schema = df.schema.add("n_words", "long").add("n_removed", "long")
    return both.mapInArrow(tidy(apply_flags(columns, text, doc_id)), schema)


def dedup_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated windows cut out; n_chars follows the text where it changed."""
    out = dedup_substrings(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 13-word windows that an earlier document has."""
    out = dedup_substrings(read(spark, sf_dir, "documents", "doc_id", "text"))
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), f"{SPACE}+", " "))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(words.cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
starts AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words)),
firsts AS (SELECT win, min(doc_id) AS d FROM starts GROUP BY win HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
  FROM starts JOIN firsts USING (win) WHERE doc_id > d),
kept AS (
  SELECT u.doc_id, count(*) FILTER (g.i IS NOT NULL) AS n_removed,
    coalesce(string_agg(u.word, ' ' ORDER BY u.i) FILTER (g.i IS NULL), '') AS t
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words) u
  LEFT JOIN gone g ON g.doc_id = u.doc_id AND g.i = u.i GROUP BY u.doc_id)
SELECT words.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept ON kept.doc_id = words.doc_id
"""
