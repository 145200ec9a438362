"""Runs, license scans and ranked search against brute force, and on small and odd inputs."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm import op11_runs as runs
from llm import op12_license as lic
from llm import op13_search as find


# ---- runs

def brute_lyndon(s):
    out = []
    for i in range(len(s)):
        out.append(max(j - i for j in range(i + 1, len(s) + 1) if all(s[i:j] < s[k:j] for k in range(i + 1, j))))
    return out


def brute_runs(s, exponent, least):
    found = {}
    for q in range(1, len(s) // exponent + 1):
        i = 0
        while i + q < len(s):
            k = i
            while k + q < len(s) and s[k] == s[k + q]:
                k += 1
            if k > i and k - i + q >= max(exponent * q, least):
                found.setdefault((i, k - i + q), q)
            i = max(k, i + 1)
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def odd_words(rng):
    n, k = rng.randrange(1, 60), rng.randrange(1, 4)
    s = [rng.randrange(k) for _ in range(n)]
    a, p = rng.randrange(n), rng.randrange(1, 6)
    return [s[i] if i < a else s[min(a + (i - a) % p, n - 1)] for i in range(n)] if rng.random() < 0.5 else s


def test_grouping_gives_the_lyndon_array():
    rng = random.Random(4)
    for _ in range(300):
        s = odd_words(rng)[:14]
        assert runs.lyndon_array(s) == brute_lyndon(s)
    assert runs.lyndon_array([]) == []


@pytest.mark.parametrize("exponent, least", [(2, 1), (3, 5), (4, 6)])
def test_runs_equal_brute_force(exponent, least):
    rng = random.Random(5)
    for _ in range(400):
        s = odd_words(rng)
        assert runs.runs_of(s, exponent, least) == brute_runs(s, exponent, least)
        # rare words between the pieces
        t = [str(x) for x in s] + ["rare", "words"] + [str(x) for x in s]
        assert runs.text_runs(t, exponent, least) == brute_runs(t, exponent, least)


def test_runs_on_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (3, " \n\t", 1), (4, "a b " * 4, 1), (4, "a b " * 4, 1), (None, "x " * 7 + "y", 1),
            (5, "a b c " * 30000, 1), (6, "one two", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, repeats int")
    got = sorted((r["doc_id"] or 0, r["text"] or "", r["repeats"]) for r in runs.detect_runs(df).collect())
    assert len(got) == len(rows)
    for d, text, out in got:
        words = text.split()
        assert out["n_words"] == len(words)
        want = [(0, 90000, 3)] if d == 5 else brute_runs(words, 4, 6)
        assert [(r["start"], r["length"], r["period"]) for r in out["runs"]] == want
        assert out["collapsed"] == {4: "a b", 0: "x y", 5: "a b c"}.get(d, " ".join(words))
    assert runs.detect_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.repeats("text", exponent=1)


def test_runs_query_digests(spark, tmp_path):
    docs = [(i, " ".join(f"w{(i * j) % 7}" for j in range(i * 3))) for i in range(40)] + [(None, "a " * 9), (41, None), (42, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    import zlib
    want = []
    for d, text in docs:
        w = (text or "").split()
        h = zlib.crc32(str(d).encode()) if d is not None else 1
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        r = brute_runs(w, 4, 6)
        best = max(r, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None, None, None))
        gone = {i for s, n, q in r for i in range(s + q, s + n)}
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (
            "".join(f"{s},{n},{q}\n" for s, n, q in r), " ".join(x for i, x in enumerate(w) if i not in gone))]
        want.append((d, len(r), *best, 1000 * best[1] // best[2] if r else None, *sha))
    got = [tuple(r) for r in runs.op11_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


# ---- licenses

def test_phrases_equal_brute_force(spark):
    rng = random.Random(6)
    pool = "mit MIT License license, general Public apache x Änd 7 mit-license general public license \x01 é".split(" ")
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randrange(0, 80)))) for i in range(60)]
    rows += [(60, None), (61, ""), (3, rows[3][1]), (None, "MIT license"), (None, "MIT license"), (62, "the mit license " * 4000)]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, labels string, place int").repartition(5)
    got = lic.scan_licenses(df).collect()
    want = []
    for d, t in rows:
        w = re.findall(r"[a-z0-9\u0080-￿]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        starts, labels = [], set()
        for label, phrase in lic.PHRASES:
            p = phrase.split()
            mine = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            starts += mine
            labels |= {label} if mine else set()
        joined = ",".join(sorted(labels))
        want.append((d, len(w), len(starts), min(starts, default=None), max(starts, default=None), joined, joined, 1.0 if starts else 0.0))
    assert sorted((tuple(r)[:8] for r in got), key=str) == sorted(want, key=str)
    assert lic.scan_licenses(df.limit(0)).count() == 0


def test_notices_with_words_put_in_and_left_out(spark):
    notice = dict(lic.NOTICES)["bsd"].split()
    more, less = notice[:9] + ["really", "truly"] + notice[9:], notice[:9] + notice[11:]
    rows = [(1, "x y " + " ".join(more) + " z"), (2, " ".join(less)), (3, " ".join(notice[:8])), (4, " ".join(reversed(notice))),
            (5, " ".join(notice + ["a"] * 30 + notice)), (6, " ".join(notice[:8] + ["a"] * 30 + notice[8:]))]
    got = {r["doc_id"]: r for r in lic.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["labels"] for i in range(1, 7)] == ["bsd", "bsd", "", "", "bsd", ""]
    assert got[1]["spans"][0]["start"] == 2 and got[1]["spans"][0]["length"] == len(more)
    assert got[1]["score"] == (len(notice) / len(more)) and got[1]["n_base"] == 0 and got[1]["base_labels"] == ""
    assert len(got[5]["spans"]) == 2 and got[5]["score"] == 1.0


def test_equal_hashes_need_equal_words(spark, monkeypatch):
    monkeypatch.setattr(lic, "gram_hash", lambda words, start, k: F.lit(k).cast("long"))
    rows = [(1, "the mit license and a general public license"), (2, "nothing here")]
    got = {r["doc_id"]: r for r in lic.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1]["labels"], got[1]["n_base"], got[1]["score"]) == ("gpl,mit", 2, 1.0) and got[2]["labels"] == ""


# ---- search

def brute_search(docs, items, top):
    def terms(t):
        return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    rows = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, n_terms = len(rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in rows:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def odd_docs():
    rng = random.Random(7)
    docs = [(i, " ".join(rng.choice("the of Ein é a1 b2 c3 d4 e5 f6 g7 h8".split()) + rng.choice(["", ",", " x\x00y"])
                         for _ in range(rng.randrange(0, 40)))) for i in range(300)]
    docs += [(1000 + i, "copy of the same text") for i in range(120)]  # ties
    return docs + [(None, "the b2"), (None, None), (5, "the b2 b2"), (5, "the b2 b2"), (2000, ""), (2001, "the " * 30000)]


@pytest.mark.parametrize("postings", [10, 200, 10 ** 6])
def test_search_equals_brute_force(spark, monkeypatch, postings):
    monkeypatch.setattr(find.search_segments, "__defaults__", (postings,))
    monkeypatch.setattr(find, "BLOCK_BYTES", 60)  # several blocks of items
    docs = odd_docs()
    items = [(1, "The copy of b2"), (2, "g7 É é a1, A1"), (3, None), (4, "nowhere"), (None, "x f6"), (1, "h8 the"), (1, "h8 the")]
    df = spark.createDataFrame([(d, t, 0, "z") for d, t in docs], "doc_id long, text string, score int, item_id string").repartition(4)
    asked = spark.createDataFrame(items, "item_id int, text string")
    got = sorted((tuple(r) for r in find.lexical_search(df, asked, top=7).collect()), key=str)
    assert got == brute_search(docs, items, 7)


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert find.lexical_search(docs, items).count() == 1
    assert find.lexical_search(docs.limit(0), items).count() == 0
    assert find.lexical_search(docs, items.limit(0)).count() == 0


def test_largest_among_postings():
    import numpy as np
    rng = np.random.default_rng(1)
    terms, docs = np.repeat([3, 5, 9], [1, 37, 100]), np.r_[[4], rng.permutation(100)[:37], np.arange(100)]
    seg = find.Segment(100, terms, docs, rng.integers(0, 9, 138))
    for t in range(3):
        a, b = seg.first[t], seg.first[t + 1]
        for low in range(a, b + 1):
            for high in range(low, b + 1):
                place, value = seg.largest(np.array([low]), np.array([high]))
                if high > low:
                    assert place[0] == low + int(seg.impact[low:high].argmax()) and value[0] == seg.impact[place[0]]
                else:
                    assert value[0] == -1
