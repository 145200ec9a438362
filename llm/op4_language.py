"""Language ID: nearest centroid over normalised TF-IDF n-gram vectors.

A text becomes a vector of hashed byte 2- and 3-grams (lower case, runs of
ASCII bytes other than letters as one blank, so that markup and digits say nothing), weighted ``log(1 + count) * idf`` and scaled to
length one.  Each language has several centroids, found by spherical k-means
over its training vectors.  A text gets the language of the centroid with the
largest cosine; it is rejected when that cosine is smaller than the centroid's
own radius allows (a fraction of a low quantile of its training members' cosines,
so that a few junk or mislabelled rows do not widen it).
A short text can share little with a centroid whatever its language, so the
limit shrinks with the root of its n-gram count below ``FULL_GRAMS``.

The model is fitted on at most ``SAMPLE_PER_LANG`` different texts of each language, the
ones with the smallest hash of doc_id and text.  Vectors and clusters are made by the
executors; the driver holds document frequencies (one number per feature) and
centroids (``CLUSTERS`` x ``DIMS`` floats per language).  Prediction reads every
whole text once, where it is scanned, and shuffles nothing.

Defined results
* null text, or one without a letter: ``und``, score 0, rejected.
* no training rows (or an empty table): every text is ``und`` and rejected.
* equal cosines: the language that sorts first.
* very long texts are cut into slices only for hashing; counts cover all of it.
* columns of the input named like an added column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import materialize, read, small_batches
from llm.words import derive, mix64, release, slices, text_buffer, tidy
from salescast.session import broadcast_bounded

DIMS = 4096
CLUSTERS = 4
SAMPLE_PER_LANG = 1500
KMEANS_ROUNDS = 10
LEAST_SHARE = 0.02
# Smoothing of idf = IDF_BASE + log((1 + n) / (1 + df)): the larger, the less a short passage of
# rare n-grams (a quotation in another language) outweighs the rest of a text.
IDF_BASE = 4.0
# A text is rejected below this share of the low quantile of its centroid's training cosines,
# or when it has next to nothing in common with any language.
LOW_QUANTILE = 0.05
REJECT_SHARE = 0.5
REJECT_BELOW = 0.02
FULL_GRAMS = 400
LETTER = r"\p{L}"


def _fold() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    table[65:91] += 32
    ascii_letter = (table >= 97) & (table <= 122)
    table[(table < 128) & ~ascii_letter] = 32
    return table


def ngram_counts(texts: pa.Array, dims: int = DIMS) -> np.ndarray:
    """Matrix (texts x dims) of hashed n-gram counts."""
    raw, offsets = text_buffer(texts)
    n = len(offsets) - 1
    codes = _fold()[raw]
    # A run of blanks counts once; a blank stands before the first and after the last byte.
    keep = np.ones(len(raw), dtype=bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    doc = np.repeat(np.arange(n), np.diff(offsets))[keep]
    codes = codes[keep]
    cells = []
    for width in (2, 3):
        m = len(codes) - width + 1
        if m <= 0:
            continue
        gram = np.zeros(m, dtype=np.uint64)
        for k in range(width):
            gram = gram * np.uint64(256) + codes[k:k + m]
        gram += np.uint64(width << 24)
        inside = doc[:m] == doc[width - 1:]
        with np.errstate(over="ignore"):
            feature = (mix64(gram[inside] * derive(17, 1)[0]) & np.uint64(dims - 1)).astype(np.int64)
        cells.append(doc[:m][inside] * dims + feature)
    if not cells:
        return np.zeros((n, dims), dtype=np.float32)
    return np.bincount(np.concatenate(cells), minlength=n * dims).reshape(n, dims).astype(np.float32)


def term_weights(texts: pa.Array, dims: int = DIMS) -> np.ndarray:
    return np.log1p(ngram_counts(texts, dims))


def reject_limit(low: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Smallest cosine that is accepted, by the centroid's low member cosine and the n-gram count."""
    return np.maximum(low * REJECT_SHARE, REJECT_BELOW) * np.sqrt(np.minimum(1.0, grams / FULL_GRAMS))


def normalise(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.maximum(length, 1e-12)


def cluster(x: np.ndarray, k: int, rounds: int = KMEANS_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means; (centroids, low quantile of the member cosines of each).

    Rows come in hash order, so evenly spaced rows are a reproducible random choice of
    seeds.  A cluster with less than ``LEAST_SHARE`` of the rows describes outliers,
    not the language, and is given up; its rows tell nothing about the radii of the others.
    """
    k = min(k, len(x))
    c = x[np.arange(k) * len(x) // k].copy()
    for r in range(rounds + 1):
        own = np.argmax(x @ c.T, axis=1)
        size = np.bincount(own, minlength=len(c))
        if r == rounds:
            stays = size >= min(size.max(), LEAST_SHARE * len(x))
            c, x = c[stays], x[stays[own]]
            break
        for j in np.flatnonzero(size):
            c[j] = normalise(x[own == j].mean(axis=0, keepdims=True))[0]
    cos = x @ c.T
    own = np.argmax(cos, axis=1)
    low = np.array([np.quantile(cos[own == j, j], LOW_QUANTILE) if (own == j).any() else 1.0 for j in range(len(c))])
    return c.astype(np.float32), low.astype(np.float32)


class Model:
    """Centroids of all languages with their radii, and idf weights."""

    def __init__(self, idf: np.ndarray, langs: list[str], centroids: np.ndarray, low: np.ndarray):
        self.idf, self.langs, self.centroids, self.low = idf, langs, centroids, low

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, cosine, rejected) of each text."""
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        langs, scores, rejected = [], [], []
        for part in slices(texts, max_bytes=1 << 20, max_rows=256):
            counts = ngram_counts(part)
            cos = normalise(np.log1p(counts) * self.idf) @ self.centroids.T
            best = np.argmax(cos, axis=1)
            score = cos[np.arange(len(best)), best]
            langs += [self.langs[i] for i in best]
            scores.append(np.clip(score, 0, 1))
            rejected.append(score < reject_limit(self.low[best], counts.sum(axis=1)))
        if not langs:
            return [], np.zeros(0), np.zeros(0, dtype=bool)
        return langs, np.concatenate(scores).astype(np.float64), np.concatenate(rejected)


def fit(train: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Fit on a bounded sample of labelled rows (``per_lang`` texts of each language)."""
    spark = train.sparkSession
    small_batches(train)
    labelled = train.filter(F.col(lang).isNotNull())
    counts = materialize(labelled.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("n")), "languages")
    n_langs = counts.count()
    if not n_langs:
        return Model(np.zeros(DIMS, np.float32), [], np.zeros((0, DIMS), np.float32), np.zeros(0, np.float32))
    # Rows by hash of key and text (so that null or repeated keys are drawn like others).  About 1.2 x per_lang
    # pass the hash; of equal rows one stays; the per_lang smallest hashes of each language reach Python.
    parts = 1_000_000
    share = F.least(F.lit(parts), F.ceil(F.lit(parts * 1.2 * per_lang) / F.col("n")))
    drawn = (labelled.select(F.col(lang).alias("lang"), F.xxhash64(F.col(key), F.col(text)).alias("h"), F.lower(text).alias("text"))
             .join(broadcast_bounded(counts, n_langs), "lang").filter(F.pmod("h", F.lit(parts)) < share).filter(F.col("text").rlike(LETTER)).drop("n"))
    least = Window.partitionBy("lang").orderBy("h")  # about 1.2 x per_lang hashes a language
    chosen = drawn.select("lang", "h").distinct().withColumn("place", F.row_number().over(least))
    chosen = chosen.filter(F.col("place") <= per_lang).select("lang", "h")
    chosen = broadcast_bounded(chosen, n_langs * per_lang)
    drawn = drawn.join(chosen, ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            start = 0
            for part in slices(b.column("text"), max_bytes=1 << 20, max_rows=256):
                x = term_weights(part)
                rows = b.slice(start, len(part))
                start += len(part)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("lang"), rows.column("h"), pa.array([v.tobytes() for v in x], pa.binary())],
                    names=["lang", "h", "v"])

    sample = materialize(drawn.mapInArrow(tidy(vectors), "lang string, h long, v binary"), "langsample")

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(DIMS, dtype=np.int64), 0
        for b in batches:
            for v in b["v"]:
                total += np.frombuffer(v, dtype=np.float32) > 0
                n += 1
        yield pd.DataFrame({"n": [n], "df": [total.tobytes()]})

    seen = sample.select("v").mapInPandas(frequencies, "n long, df binary").collect()  # a row per part of a bounded sample
    n = sum(r["n"] for r in seen)
    df = np.sum([np.frombuffer(r["df"], dtype=np.int64) for r in seen], axis=0) if seen else np.zeros(DIMS)
    idf = (np.log((1 + n) / (1 + df)) + IDF_BASE).astype(np.float32)

    def centroids(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "v"]).head(per_lang)
        x = normalise(np.stack([np.frombuffer(v, dtype=np.float32) for v in pdf["v"]]) * idf)
        c, low = cluster(x, CLUSTERS)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "c": [r.tobytes() for r in c], "low": low.astype(float)})

    rows = sample.groupBy("lang").applyInPandas(centroids, "lang string, c binary, low double").collect()
    rows.sort(key=lambda r: (r["lang"], r["c"]))
    c = np.stack([np.frombuffer(r["c"], dtype=np.float32) for r in rows]) if rows else np.zeros((0, DIMS), np.float32)
    return Model(idf, [r["lang"] for r in rows], c, np.array([r["low"] for r in rows], dtype=np.float32))


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` plus lang_pred, score (cosine) and rejected."""
    small_batches(df)

    @F.arrow_udf("struct<lang:string,score:double,rejected:boolean>")
    def classify(t: pa.Array) -> pa.Array:
        langs, scores, rejected = model.predict(t)
        release()
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
            names=["lang", "score", "rejected"])

    usable = F.coalesce(F.col(text).rlike(LETTER), F.lit(False)) & F.lit(bool(model.langs))
    out = df.withColumn("__p", classify(F.lower(F.coalesce(F.col(text), F.lit("")))))
    return out.withColumns({
        "lang_pred": F.when(usable, F.col("__p.lang")).otherwise("und"),
        "score": F.when(usable, F.round("__p.score", 6)).otherwise(F.lit(0.0)),
        "rejected": ~usable | F.col("__p.rejected")}).drop("__p")


def held_out(key: str = "doc_id"):
    """True for the quarter of documents that no model may learn from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the documents not held out."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = fit(docs.filter(~held_out()))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
