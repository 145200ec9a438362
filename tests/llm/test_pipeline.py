"""The pipeline against brute-force versions of its stages, stage by stage."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from llm import op3_mixing as mixing
from llm import op4_language as language
from llm import op5_packing as packing
from llm import op7_neardup as neardup
from llm import op10_substrings as substrings
from test_ops_b import brute_components, brute_substrings

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        out.append(docs.collect())
    return out


def test_language_stage_drops_the_rejected_only(spark, results):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs.filter(~language.held_out()))
    rows = docs.collect()
    import pyarrow as pa
    _, _, rejected = model.predict(pa.array([(r["text"] or "").lower() for r in rows], pa.string()))
    kept = {r["doc_id"] for r, no in zip(rows, rejected) if not no and re.search(r"[^\W\d_]", r["text"] or "")}
    assert {r["doc_id"] for r in results[1]} == kept


def test_near_duplicate_stage_keeps_the_first_of_each_component(results):
    docs = [(r["doc_id"], r["text"]) for r in results[1]]
    kept = {d for d, n, c in brute_components(docs, 5) if n == 0 or d == c}
    assert {r["doc_id"] for r in results[2]} == kept and len(results[2]) == len(kept)


def test_substring_stage_cuts_what_an_earlier_document_has(results):
    docs = [(r["doc_id"], r["text"]) for r in results[2]]
    want = {d: (gone, words) for d, _, gone, words in brute_substrings(docs)}
    before = {r["doc_id"]: r for r in results[2]}
    for r in results[3]:
        gone, words = want.pop(r["doc_id"])
        assert " ".join(WORD.findall(r["text"])) == words
        assert r["n_chars"] == (len(r["text"]) if gone else before[r["doc_id"]]["n_chars"])
        if not gone:
            assert r["text"] == before[r["doc_id"]]["text"]
    assert not want


def test_mixing_stage_draws_by_calibrated_probabilities(spark, results):
    docs = spark.createDataFrame(results[3], spark.read.parquet(f"{SF}/documents.parquet").schema)
    rows = mixing.mix(mixing.add_tokens_and_topic(docs)).collect()
    tokens = sum(r["n_tokens"] for r in rows)
    assert tokens == sum(len(WORD.findall(r["text"] or "")) for r in results[3])
    assert sum(r["n_tokens"] * r["probability"] for r in rows) == pytest.approx(mixing.BUDGET * tokens, rel=1e-6)
    assert {r["doc_id"] for r in results[4]} == {r["doc_id"] for r in rows if r["draw"] < r["probability"]}


def test_packing_stage_holds_every_token_once(results):
    total = Counter()
    for r in results[5]:
        total[r["doc_id"]] += r["n_tokens"]
    assert dict(total) == {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in results[4]}
    fill = Counter()
    for r in results[5]:
        fill[r["bin_id"]] += r["n_tokens"]
    assert max(v for k, v in fill.items() if k is not None) <= packing.CAPACITY


def test_run_gives_the_last_stage(spark, results):
    got = {(r["doc_id"], r["piece"], r["n_tokens"]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {(r["doc_id"], r["piece"], r["n_tokens"]) for r in results[5]}


def test_texts_reach_python_in_small_batches(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 4000, 1, 1).selectExpr(
        "id AS doc_id", "array_join(transform(sequence(1, 200), i -> concat('word', id * 200 + i)), ' ') AS text")

    def small(column):
        if column.nbytes > 5 << 20:
            raise ValueError(f"{column.nbytes} bytes of text at once")

    def watched(task):
        def run(batches, **options):
            def seen():
                for batch in batches:
                    small(batch.column("text"))
                    yield batch
            return task(seen(), **options)
        return run

    sketch_parts = substrings.sketch_parts
    monkeypatch.setattr(neardup, "features", watched(neardup.features))
    monkeypatch.setattr(substrings, "sketch_parts", lambda width: watched(sketch_parts(width)))
    model = language.fit(spark.createDataFrame([(1, "some words", "en"), (2, "viele Wörter", "de")], "doc_id long, text string, lang string"))
    predict = model.predict
    model.predict = lambda texts: (small(texts), predict(texts))[1]
    for work in (neardup.near_duplicates, substrings.dedup_substrings, lambda d: language.predict(d, model)):
        spark.conf.unset(key)
        assert len(work(docs).collect()) == 4000
    spark.conf.set(key, "100000")
    neardup.near_duplicates(docs.limit(10))
    assert spark.conf.get(key) == "100000"  # a smaller limit stays
    spark.conf.unset(key)


@pytest.mark.parametrize("size", [1, 2, 3, 50])
def test_groups_over_many_batches_come_whole(size):
    import pyarrow as pa
    keys = [0] * 7 + [1] + [2] * 12 + [3] * 2 + [4] * 9
    rows = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(range(len(keys)))], names=["k", "v"])
    out = []
    for border, part in neardup.grouped((rows.slice(i, size) for i in range(0, len(keys), size)), ["k"]):
        ks = part.column("k").to_pylist()
        out += [ks[a:b] for a, b in zip(border[:-1], border[1:])]
    assert out == [[k] * keys.count(k) for k in range(5)]
