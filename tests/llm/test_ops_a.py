"""Sharding, quality rules, mixing, language ID and packing on small and odd inputs."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import op1_sharding as shard
from llm import op2_quality as quality
from llm import op3_mixing as mixing
from llm import op4_language as language
from llm import op5_packing as packing

ODD = [(1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (2, None, None, None, None), (3, "", "en", "s", 0),
       (4, " \n\t ", "fr", None, 4), (None, "x y", "en", "s", 3), (5, "word " * 20000, "en", "s", 100000),
       (6, "¡é! ß", "de", "t", 5)]


# ---- sharding

def feistel(n, seed):
    """The permutation computed step by step in plain Python."""
    a, b = shard.grid(n)
    p = shard.PRIME

    def once(x):
        left, right = divmod(x, b)
        for i, (k1, k2, k3) in enumerate(shard.round_keys(seed)):
            v = right if i % 2 == 0 else left
            t = (v % p * k1 + k2) % p
            t = (t * t + k3) % p
            t = (t * t + v % p) % p
            if i % 2 == 0:
                left = (left + t) % a
            else:
                right = (right + t) % b
        return left * b + right

    out = []
    for x in range(n):
        y = once(x)
        while y >= n:
            y = once(y)
        out.append(y)
    return out


@pytest.mark.parametrize("n", [1, 2, 5, 26, 1000])
def test_permutation_equals_plain_python(spark, n):
    want = feistel(n, 7)
    assert sorted(want) == list(range(n))
    got = shard.permute(spark.range(n), "id", n, seed=7).orderBy("id").collect()
    assert [r["position"] for r in got] == want


def test_shards_are_even_gapless_and_reproducible(spark, docs_schema):
    df = spark.createDataFrame(ODD * 20, docs_schema)
    rows = shard.shard_rows(df.repartition(5), ["doc_id", "text"], shards=7).collect()
    again = shard.shard_rows(df.repartition(3), ["doc_id", "text"], shards=7).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))


def test_sharding_empty_table_and_clashing_columns(spark):
    out = shard.shard_rows(spark.createDataFrame([], "doc_id long, shard string"), ["doc_id"])
    assert out.count() == 0 and dict(out.dtypes)["shard"] == "int"


# ---- quality rules

def measure(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


def test_measures_equal_plain_python(spark):
    texts = [t for _, t, *_ in ODD] + ["a b c a b c a b", "x\nx\n\n \nx #*$%&|<>", "é ü ß " * 7, "a a a a", "a b\x0bc\x0cd\re",
                                       "p q r s t p q r z z z z s t p"]
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "i int, text string, n_words string")
    rows = quality.apply_rules(df).orderBy("i").collect()
    for r, t in zip(rows, texts):
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == measure(t)
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_quality_separates_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = quality.op2_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = rows.filter("NOT base_failed").groupBy("quality", "kept").count().collect()
    assert {(r["quality"], r["kept"]) for r in rows} == {(0, False), (1, True)}


def test_quality_plan_has_no_python_and_no_shuffle(spark):
    plan = quality.op2_quality(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# ---- mixing

def test_raked_marginals_meet_targets():
    rng = np.random.default_rng(3)
    tokens = rng.integers(1, 100, (4, 3, 2)).astype(float)
    targets = [np.array([.1, .2, .3, .4]), np.array([.5, .25, .25]), np.array([.7, .3])]
    w = mixing.rake(tokens, targets)
    for axis, t in enumerate(targets):
        others = tuple(i for i in range(3) if i != axis)
        assert np.allclose(w.sum(axis=others), t, atol=1e-8)


def test_targets_that_contradict_each_other_are_an_error(spark):
    rows = [(i, "w", "en" if i % 2 else "fr", f"s{i % 2}", 10, "t") for i in range(100)]  # each source has one language
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens long, topic string")
    with pytest.raises(mixing.TargetsNotMet):
        mixing.mix(df, {"source": {"s0": 0.9, "s1": 0.1}, "lang": {"en": 0.9, "fr": 0.1}})
    assert mixing.mix(df, {"source": {"s0": 0.9, "s1": 0.1}, "lang": {"fr": 0.9, "en": 0.1}}).count() == 100
    rows.append((100, "w", "de", "s0", 10, "t"))  # softened shares that do not fit together only warn
    with pytest.warns(UserWarning):
        mixing.mix(spark.createDataFrame(rows, df.schema)).count()


def test_raking_equals_a_plain_reference():
    """Every cell against a loop over dicts."""
    rng = np.random.default_rng(6)
    cells = {(s, l, t): float(rng.integers(1, 50)) for s in "abc" for l in "xy" for t in "uv" if rng.random() < 0.9 or s == "a"}
    wanted = [{"a": .5, "b": .3, "c": .2}, {"x": .6, "y": .4}, {"u": .3, "v": .7}]
    w = {k: v / sum(cells.values()) for k, v in cells.items()}
    for _ in range(2000):
        for axis, target in enumerate(wanted):
            total = Counter()
            for k, v in w.items():
                total[k[axis]] += v
            w = {k: v * target[k[axis]] / total[k[axis]] for k, v in w.items()}
    keys = sorted(cells)
    codes = [np.array([sorted(target).index(k[axis]) for k in keys]) for axis, target in enumerate(wanted)]
    got = mixing.rake_cells(np.array([cells[k] for k in keys]), codes, [np.array([t[v] for v in sorted(t)]) for t in wanted])
    assert np.allclose(got, [w[k] for k in keys], atol=1e-7)


def test_calibrated_probabilities_meet_the_budget():
    rng = np.random.default_rng(4)
    tokens, ratio = rng.integers(1, 100, 50).astype(float), rng.random(50) * 5
    for budget in (0.05, 0.5, 0.95):
        p = mixing.calibrate(ratio, tokens, budget)
        assert abs((p * tokens).sum() - budget * tokens.sum()) < 1e-6 * tokens.sum() and p.max() <= 1


def test_mixing_odd_rows(spark, docs_schema):
    df = mixing.add_tokens_and_topic(spark.createDataFrame(ODD, docs_schema))
    rows = mixing.mix(df).collect()
    assert len(rows) == len(ODD)
    same = [r["chosen"] for r in rows if r["doc_id"] == 1]
    assert same[0] == same[1]
    assert mixing.mix(mixing.add_tokens_and_topic(spark.createDataFrame([], docs_schema))).count() == 0


def test_mixing_follows_given_targets(spark):
    rows = [(i, "w", "en" if i % 4 else "fr", f"s{i % 2}", 10, "t") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens long, topic string")
    out = mixing.mix(df, targets={"source": {"s0": .8, "s1": .2}, "lang": {"en": .6, "fr": .4}}, budget=0.3)
    total = out.agg(F.sum(F.col("probability") * F.col("n_tokens")).alias("x")).first()["x"]
    part = out.filter("source = 's0'").agg(F.sum(F.col("probability") * F.col("n_tokens")).alias("x")).first()["x"]
    assert abs(total - 0.3 * 40000) < 1 and abs(part / total - 0.8) < 0.01


def many_sources(spark):
    """100 small sources and a large one; 40 languages, one of them null."""
    rows = [(i, f"s{i % 100}", f"l{i // 100 % 40}" if i // 100 % 40 else None, 10, "t") for i in range(12000)]
    rows += [(20000 + i, "big", f"l{i % 40}" if i % 40 else None, 1000, "t") for i in range(1200)]
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_tokens long, topic string")


def test_mixing_gives_every_source_its_own_share(spark):
    df = many_sources(spark)
    p = {r["source"]: r["p"] for r in mixing.mix(df).groupBy("source").agg(F.avg("probability").alias("p")).collect()}
    assert len(p) == 101 and all(p[f"s{i}"] == pytest.approx(1.0) for i in range(100)) and p["big"] < 0.5
    targets = {"source": {f"s{i}": 0.01 for i in range(100)}, "lang": {**{f"l{i}": 0.02 for i in range(1, 40)}, None: 0.22}}
    out = mixing.mix(df, targets=targets, budget=0.002)
    expected = F.sum(F.col("probability") * F.col("n_tokens")).alias("x")
    total = 0.002 * (12000 * 10 + 1200 * 1000)
    for axis in ("source", "lang"):
        got = {r[axis]: r["x"] / total for r in out.groupBy(axis).agg(expected).collect()}
        got = {k: v for k, v in got.items() if v > 0}
        assert got == pytest.approx(targets[axis], abs=1e-6)


def test_mixing_of_cell_tables_agrees_with_the_driver(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, f"s{s}" if s else None, f"l{l}", int(n), f"t{t}") for i, (s, l, t, n) in
            enumerate(zip(*[rng.integers(0, k, 300) for k in (6, 3, 2)], rng.integers(0, 50, 300)))]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_tokens long, topic string")
    got = []
    monkeypatch.setattr(mixing, "RAKE_ROUNDS", 2)  # the same steps on both ways
    for cells in (10 ** 6, 0):
        monkeypatch.setattr(mixing, "LOCAL_CELLS", cells)
        out = mixing.mix(df, targets={"topic": {"t0": 0.7, "t1": 0.3}}, budget=0.8)
        got.append(sorted((r["doc_id"], r["weight"], r["probability"]) for r in out.collect()))
    assert np.allclose(got[0], got[1], rtol=0, atol=1e-8) and len(got[0]) == 300


# ---- language ID

def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = language.op4_language(spark, sf).join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out")
    right = out.filter("lang = lang_pred").count() / out.count()
    assert right > 0.98
    assert out.filter("score < 0 OR score > 1").count() == 0


def test_language_odd_rows(spark, docs_schema):
    df = spark.createDataFrame(ODD, docs_schema).withColumn("score", F.lit("old"))
    model = language.fit(df.filter(~language.held_out()))
    rows = language.predict(df, model).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        usable = bool(r["text"]) and bool(re.search(r"[^\W\d_]", r["text"]))
        assert (r["lang_pred"] == "und") == (not usable)
        assert usable or (r["rejected"] and r["score"] == 0)
    empty = language.fit(spark.createDataFrame([], docs_schema))
    assert {r["lang_pred"] for r in language.predict(df, empty).collect()} == {"und"}


def test_language_rejects_what_no_language_resembles(spark):
    sf = "/root/testdata/sf0.01"
    model = language.fit(spark.read.parquet(f"{sf}/documents.parquet").filter(~language.held_out()))
    strange = spark.createDataFrame([(1, "жзик полт врат кушн блен " * 40), (2, "漢字仮名交文章例示" * 60)], "doc_id long, text string")
    assert [r["rejected"] for r in language.predict(strange, model).collect()] == [True, True]


def test_language_rejects_latin_script_not_learned_whatever_a_junk_row_holds(spark):
    rng = np.random.default_rng(6)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    noise = ["".join(rng.choice(letters, 1000)) for _ in range(5)]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    junk = spark.createDataFrame([(10 ** 9 + i, noise[i], ("en", "de", "es", "fr")[i % 4]) for i in range(4)], docs.schema)
    model = language.fit(docs.filter(~language.held_out()).union(junk))
    texts = ["kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan " * 8,
             "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw " * 8,
             "bütün insanlar hür haysiyet ve haklar bakımından eşit doğarlar akıl ve vicdana " * 8, noise[4]]
    strange = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["rejected"] for r in language.predict(strange, model).collect()] == [True] * 4
    clean = docs.filter(language.held_out() & F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull())
    assert language.predict(clean, model).filter("rejected").count() == 0 < clean.count()


# ---- packing

def brute_pack(lengths, sources, clusters, capacity, per_source):
    """Tightest compatible bin by looking at every bin; ties by bin number."""
    bins, out = [], []
    for n, s, c in zip(lengths, sources, clusters):
        fits = [(b["left"], i) for i, b in enumerate(bins)
                if b["left"] >= n and b["left"] > 0 and b["s"][s] < per_source and (c < 0 or c not in b["c"])]
        if fits:
            i = min(fits)[1]
        else:
            bins.append({"left": capacity, "s": Counter(), "c": set()})
            i = len(bins) - 1
        b = bins[i]
        out.append((i, capacity - b["left"]))
        b["left"] -= n
        b["s"][s] += 1
        b["c"].add(c)
    return out


def test_packing_equals_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(5):
        lengths = sorted(rng.integers(1, 60, 300).tolist(), reverse=True)
        sources = np.where(rng.random(300) < .4, 0, rng.integers(1, 9, 300)).tolist()
        clusters = np.where(rng.random(300) < .3, 0, rng.integers(-1, 20, 300)).tolist()
        got = list(zip(*packing.pack_items(lengths, sources, clusters, 64, 2)))
        assert got == brute_pack(lengths, sources, clusters, 64, 2)


def test_packing_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = packing.op5_packing(spark, sf).collect()
    docs = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in
            spark.read.parquet(f"{sf}/documents.parquet").collect()}
    total = Counter()
    bins = {}
    for r in rows:
        total[r["doc_id"]] += r["n_tokens"]
        if r["bin_id"] is not None:
            bins.setdefault(r["bin_id"], []).append(r)
    assert dict(total) == docs
    for b in bins.values():
        b.sort(key=lambda r: r["place"])
        at = 0
        for r in b:
            assert r["place"] == at
            at += r["n_tokens"]
        assert at <= packing.CAPACITY
        assert max(Counter(r["source"] for r in b).values()) <= packing.PER_SOURCE
        assert max(Counter(r["cluster"] for r in b).values()) == 1


def test_packing_odd_rows(spark, docs_schema):
    rows = packing.pack(packing.items_of(spark.createDataFrame(ODD, docs_schema))).collect()
    assert sum(r["n_tokens"] for r in rows if r["doc_id"] == 5) == 20000
    assert all((r["bin_id"] is None) == (r["n_tokens"] == 0) for r in rows)
    assert packing.pack(packing.items_of(spark.createDataFrame([], docs_schema))).count() == 0


def test_language_sample_is_bounded_for_null_and_repeated_ids(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "materialize", lambda df, label: seen.append((label, df)) or df)
    rows = [(None, f"some english words number {i} here", "en") for i in range(600)] + [(7, f"quelques mots {i} de plus", "fr") for i in range(600)]
    rows += [(8, "the same text", "en")] * 200
    language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_lang=50)
    sample = dict(seen)["langsample"].groupBy("lang").count().collect()
    assert {r["lang"] for r in sample} == {"en", "fr"} and all(25 <= r["count"] <= 50 for r in sample)


def test_nearest_centroid_equals_a_plain_reference(spark):
    """Predictions of a fitted model against cosines computed n-gram by n-gram."""
    import math

    import pyarrow as pa
    texts = ["the cat and the dog", "le chat et le chien", "der hund und die katze"] * 4
    rows = [(i, f"{t} {i}", ("en", "fr", "de")[i % 3]) for i, t in enumerate(texts)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    ask = ["the dog and a cat", "un chien et un chat", "hund und katze", "x"]
    langs, scores, _ = model.predict(pa.array(ask))
    counts = language.ngram_counts(pa.array(ask))
    for text, row, lang, score in zip(ask, counts, langs, scores):
        v = [math.log1p(c) * i for c, i in zip(row.tolist(), model.idf.tolist())]
        size = math.sqrt(sum(x * x for x in v)) or 1.0
        cos = [sum(a * b for a, b in zip(v, c.tolist())) / size for c in model.centroids]
        best = max(range(len(cos)), key=lambda j: cos[j])
        assert abs(max(cos) - score) < 1e-4 and model.langs[best] == lang


@pytest.mark.parametrize("kind", ["int", "long", "string"])
def test_packing_takes_ids_of_any_type(spark, kind):
    df = spark.createDataFrame([(i, 5, "s", i) for i in range(20)], "doc_id long, n_tokens long, source string, cluster long")
    out = packing.pack(df.withColumn("doc_id", F.col("doc_id").cast(kind)))
    assert out.schema["doc_id"].dataType == df.withColumn("doc_id", F.col("doc_id").cast(kind)).schema["doc_id"].dataType
    assert out.select("doc_id").distinct().count() == 20


def test_near_copies_do_not_share_a_sequence(spark):
    from llm.op7_neardup import near_duplicates
    base = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"{base} more{i}", f"s{i}") for i in range(6)] + [(9, "another text", "z"), (10, None, "y")],
                                 "doc_id long, text string, source string")
    items = packing.items_of(docs, near_duplicates(docs))
    assert items.count() == 8
    rows = packing.pack(items).filter("n_tokens > 10").collect()
    assert len({r["bin_id"] for r in rows}) == 6
    assert len({r["bin_id"] for r in packing.pack(packing.items_of(docs)).filter("n_tokens > 10").collect()}) < 6
