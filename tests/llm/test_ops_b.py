"""Chat formatting, near duplicates, neighbours, HTML, substrings and the pipeline on small and odd inputs."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import op6_chat as chat
from llm import op7_neardup as near
from llm import op8_nearest as ann
from llm import op9_html as html
from llm import op10_substrings as subs
from llm.words import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def long_text(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# ---- words

def test_word_hashes_follow_the_pattern():
    texts = ["a b", "", None, " b  a\n\tc ", "é\x85ß b", "x" * 2000 + " a", "A b\x0bc", "b", "x" * 2000]
    w = Words(pa.array(texts, pa.string()))
    raw = w.raw.tobytes()
    got = [[raw[w.start[k]:w.end[k]].decode() for k in range(w.first[i], w.first[i + 1])] for i in range(len(texts))]
    assert got == [WORD.findall(t or "") for t in texts]
    h, flat = w.hashes(1), [x for words in got for x in words]
    by_word = {}
    for x, v in zip(flat, h):
        assert by_word.setdefault(x, v) == v
    assert len(set(by_word.values())) == len(by_word)
    low = w.hashes(1, lower=True)
    assert low[flat.index("A")] == low[flat.index("a")]


# ---- chat

ODD_CHATS = [
    (1, 0, "user", "</s>[INST] x <\\s> <\\\\/s> [[INST] <<SYS>><</SYS>> [/ROLE] [ROLE=a] $1 \\ é\n"),
    (1, 1, "assistant", "<s></s> [/INST]"), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, "user", "end"),
    (2, 0, None, "no role"), (2, 1, "to]ol\\", "t"), (2, 1, "to]ol\\", "t"), (2, 2, "<s>[INST] ]\n", "u"), (3, None, "assistant", "a"),
    (3, 0, "assistant", "b"), (None, 0, "user", "q"), (4, 0, "system", "s"), (4, 1, "user", "u"),
    (4, 2, "assistant", "word " * 20000)]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame(ODD_CHATS, "conv_id long, turn long, role string, text string").withColumn("x", F.lit(1))
    got = {r["conv_id"]: r for r in chat.digest(chat.expand_examples(rows)).collect()}
    convs = {}
    for c, t, r, x in ODD_CHATS:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        whole = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert got[c]["loss_chars"] == len(loss)
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_one_example_per_reply_and_only_it_is_trained(spark):
    rows = spark.createDataFrame(ODD_CHATS, "conv_id long, turn long, role string, text string")
    for r in chat.expand_examples(rows).collect():
        span = r["formatted"][r["loss_start"] - 1:r["loss_start"] - 1 + r["loss_length"]] if r["has_target"] else ""
        assert "</s>" not in span and "[INST]" not in span
        if r["has_target"]:
            assert r["formatted"][:r["loss_start"] - 1].endswith("<s>")
            assert r["formatted"][r["loss_start"] - 1 + r["loss_length"]:] == "</s>"
    assert chat.digest(chat.expand_examples(rows.limit(0))).count() == 0


# ---- near duplicates

def brute_components(docs, width=2):
    def fold(t):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    sets = []
    for _, t in docs:
        w = WORD.findall(fold(t or ""))
        sets.append(set(zip(*[w[k:] for k in range(width)])) if len(w) >= width else {tuple(w)} if w else set())
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    names = {}
    for i, (d, _) in enumerate(docs):
        if sets[i] and d is not None:
            names[find(i)] = min(d, names.get(find(i), d))
    return sorted(((d, len(s), names.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=str)


def near_docs():
    rng = random.Random(2)
    docs = [(i, long_text(rng.choice([1, 2, 5, 60, 200]), i)) for i in range(60)]
    base = long_text(120, 999).split()
    for i in range(80):  # a group in which many pairs lie close to the limit
        w = list(base)
        for _ in range(rng.randrange(0, 14)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10 ** 6)}"
        docs.append((100 + i, " ".join(w)))
    docs += [(300 + i, docs[3][1].upper()) for i in range(30)]
    docs += [(400, None), (401, ""), (402, " \n"), (403, "one"), (404, "ONE"), (None, docs[5][1]), (None, "nobody knows me"),
             (5, docs[5][1]), (405, "word " * 20000), (406, "word " * 19000)]
    return docs


@pytest.mark.parametrize("links", [40, 10 ** 6])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, links):
    monkeypatch.setattr(near, "BLOCK", 16)  # small blocks, so that buckets are cut
    monkeypatch.setattr(near, "LINKS_PER_TASK", links)  # one part, and several
    docs = near_docs()
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, kept string").repartition(7)
    rows = near.near_duplicates(df).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str)
    assert got == brute_components(docs)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


@pytest.mark.parametrize("width", [3, 5])
def test_near_duplicates_of_wider_shingles(spark, width):
    docs = near_docs()
    rows = near.near_duplicates(spark.createDataFrame(docs, "doc_id int, text string"), width=width).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str)
    assert got == brute_components(docs, width)


def test_classes_with_equal_first_key_halves_stay_apart(spark, monkeypatch):
    keys = near.set_keys

    def clashing(elements, first):
        out = keys(elements, first).copy()
        out[:, 0] %= 7  # few first halves for many sets
        return out
    monkeypatch.setattr(near, "set_keys", clashing)
    monkeypatch.setattr(near, "features", near_features(clashing))
    monkeypatch.setattr(near, "make_sets", near_sets(clashing))
    docs = near_docs()[:150]
    rows = near.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str)
    assert got == brute_components(docs)


def near_features(clashing):
    """The module's tasks with other keys, also inside the workers."""
    real = near.features

    def run(batches, width):
        near.set_keys = clashing
        yield from real(batches, width)
    return run


def near_sets(clashing):
    real = near.make_sets

    def run(batches, width):
        near.set_keys = clashing
        yield from real(batches, width)
    return run


def test_drop_near_duplicates_keeps_one_of_each(spark):
    docs = near_docs()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    left = near.drop_near_duplicates(df).collect()
    components = {c for _, n, c in brute_components(docs) if n}
    assert len([r for r in left if WORD.search(r["text"] or "")]) == len(components)
    assert len([r for r in left if not WORD.search(r["text"] or "")]) == 3
    assert near.near_duplicates(df.limit(0)).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        a = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
        b = np.concatenate([a[:240], rng.integers(0, 2 ** 63, 60, dtype=np.uint64)])
        sig = near.super_minhash(np.concatenate([a, b]), np.array([0, 300, 600]))
        errors.append((sig[0] == sig[1]).mean() - 240 / 360)
    j = 240 / 360
    assert abs(np.mean(errors)) < 0.02
    assert np.std(errors) < (j * (1 - j) / near.SIZE) ** 0.5 * 1.1


# ---- neighbours

def test_neighbours_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 64)
    rng = np.random.default_rng(6)
    vectors = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    vectors += [(300 + i, vectors[40][1]) for i in range(100)]  # a third share one vector
    vectors += [(1000, None), (1020, []), (1040, [0.0] * 8), (1060, [None] * 8), (1080, [float("nan")] * 8),
                (1100, [float("inf")] + [1.0] * 7), (1120, [1.0, 2.0]), (None, [1.0] * 8), (20, vectors[20][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<float>, rank string")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in
           ann.nearest(df, df.filter("vec_id % 20 = 0")).collect()}
    good = {i: np.array(v, dtype=np.float64) for i, v in vectors[:400]}
    want = {}
    for q in good:
        if q % 20 == 0:
            scored = sorted((-float(sum(x * y for x, y in zip(good[q], good[c]))), c) for c in good if c != q)
            for rank, (s, c) in enumerate(scored[:20], 1):
                want[(q, rank)] = (c, -s)
    assert got == want
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_bounds_hold_for_every_pair():
    rng = np.random.default_rng(5)
    q, c = rng.normal(size=(30, 12)) * 10.0 ** rng.integers(-3, 4, (30, 1)), rng.normal(size=(200, 12)) * 10.0 ** rng.integers(-3, 4, (200, 1))

    def block(x, first):
        codes, scale, err = ann.quantise(x)
        return np.arange(first, first + len(x)), codes, scale, np.sqrt((x ** 2).sum(axis=1)), err, np.zeros(len(x))
    for query, ids, low, high, _ in ann.search_tile(block(q, 1000), block(c, 0), 5):
        exact = c @ q[query - 1000]
        assert (low <= exact[ids]).all() and (exact[ids] <= high).all()
        assert set(np.argsort(-exact)[:5]) <= set(ids)


def test_repeated_ids_keep_their_smallest_vector(spark):
    rows = [(1, [3.0, 0.0]), (1, [2.0, 9.0]), (1, [2.0, 1.0]), (2, [1.0, 1.0]), (1, [5.0, 1.0, 1.0])]
    df = ann.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = sorted((r["vec_id"], r["dim"], tuple(r["v"])) for r in ann.once(df).collect())
    assert got == [(1, 2, (2.0, 1.0)), (1, 3, (5.0, 1.0, 1.0)), (2, 2, (1.0, 1.0))]


# ---- html

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<nav><ul><li><a href="/">Home</a></li></ul></nav><header><h2>Site</h2></header><div class="cookie-notice">We use cookies.</div>
<article><h1>Head &amp; line</h1><p>First <b>bold</b>   text, with\n breaks &copy; 2 &lt; 3.<br>Next line.<p>Second &am
<aside>Aside text here, long enough.</aside><div id="comments"><p>Great post! Thanks, really.</p></div>
<form><label>Mail</label></form><p>Third.</p></article><div class="sidebar">Links, more links.</div><footer>&copy; me.</footer>"""


def test_main_text_of_a_page():
    assert html.main_text(PAGE) == "Head & line\nFirst bold text, with breaks © 2 < 3. Next line.\nSecond &am\nThird."


def test_main_text_without_an_article_element():
    body = " ".join(f"Sentence number {i}, with a clause." for i in range(20))
    page = f"<div><a href=x>One</a></div><div><p>{body}</p><p>{body}</p></div><div><span>x</span></div>"
    assert html.main_text(page) == f"{body}\n{body}"


LONG = "Many words of a paragraph, with a clause. " * 12


@pytest.mark.parametrize("around", [("<article>", "</article>"), ("<div>", "</div>"), ("<body>", "</body>")])
@pytest.mark.parametrize("part, want", [
    ("<ul><li>Salt<li>Pepper<li>Flour</ul>", ["Salt", "Pepper", "Flour"]),
    ("<table><tr><th>Name<th>Age<tr><td>Ann<td>7</table>", ["Name", "Age", "Ann", "7"]),
    ("<h1>A title of about forty characters here</h1><p class=byline>By some author on a day</p>",
     ["A title of about forty characters here", "By some author on a day"]),
    (f"<pre>{LONG * 12}</pre><p>Short one.</p>", [(LONG * 12).strip(), "Short one."]),
    (f"<div class=code><pre>{LONG * 12}</pre></div><p>Short one.</p>", [(LONG * 12).strip(), "Short one."]),
    (f"<blockquote><p>{LONG * 12}</p></blockquote><p>Short one.</p>", [(LONG * 12).strip(), "Short one."]),
])
def test_short_blocks_of_the_content_stay(around, part, want):
    page = f"<nav>Home, sweet home.</nav>{around[0]}{part}<p>{LONG}</p>{part}<p>{LONG}</p>{around[1]}<footer>Me.</footer>"
    assert html.main_text(page).split("\n") == [*want, LONG.strip()] * 2


@pytest.mark.parametrize("page", [
    "<html class=no-sidebar><body class='has-sidebar modal'><article>{}</article><div class=sidebar>Side, side.</div>",
    "<body class=no-comments><div>{}</div><div class=comment-list><p>Great, thanks.</p></div>",
    "<main class='content with-sidebar'>{}<div class='ad-slot'>Buy, now.</div></main><div id=sidebar-left>Side.</div>",
    "<article class='post share-enabled'>{}<div class=share-buttons>Share.</div></article>",
    "<article class=comment><span class=ad>Ad.</span>{}</article>",
    "<div class='post widget'>{}<div class=related-posts>More, more.</div></div>",
    "<div class='wrapper has-sidebar'><div class=post__body>{}</div><div class=sidebar-content>Side.</div></div>",
    "<div class=entry-content>{}</div><div class=cookie-notice>Cookies.</div><div class=related-post>More, more.</div>",
    "<div class=footer><article>Old, old.</article></div><div itemprop=articleBody>{}</div>",
])
def test_names_of_page_parts(page):
    assert html.main_text(page.format(f"<p>{LONG}</p><p>Short.</p>")) == f"{LONG.strip()}\nShort."


@pytest.mark.parametrize("page", [
    "<article><div class=article-header><h1>Title</h1></div><p>{}</p></article>",
    "<div class=article-header><h1>Title</h1></div><div class=article-body><p>{}</p></div>",
    "<header class=entry-header><h1>Title</h1></header><div class=entry-content><p>{}</p></div>",
])
def test_title_in_an_article_header(page):
    assert html.main_text(page.format(LONG)) == f"Title\n{LONG.strip()}"


@pytest.mark.parametrize("page, want", [
    ("<html><head><title>T</title><body><p>{}</p>", "{}"),
    ("<html><head><title>T</title><p>{}</p>", "{}"),
    ("<head><meta charset=x><title>T</title>Plain text, yes.<p>{}", "Plain text, yes.\n{}"),
    ("<form id=aspnet><article><h1>A</h1><p>{}</p></article><div>x</div></form>", "A\n{}"),
    ("<div class=story-alert><article><p>{}</p></article></div>", "{}"),
    ("<form><label>Mail, please.</label></form><article><p>{}</p></article>", "{}"),
    ("<article><p>One <math><mi>x</mi><mo>=</mo><mn>2</mn></math> two <svg><title>no</title><text>lab</text></svg> end.</p><p>{}</p>",
     "One x=2 two lab end.\n{}"),
    ("<article><p>Open <svg><path d=x><p>{}</p></article>", "Open\n{}"),
    ("<article><header><h1>Title</h1></header><p>{}</p></article>", "Title\n{}"),
    ("<article><p>{}</p><footer>Foot, foot.</footer></article><header>Site, site.</header>", "{}"),
    ("<div id=page><h1>Head</h1><div class=x><p>{}</p></div></div>", "Head\n{}"),
    ("<div class=top><h1>Site</h1></div><div class=x><h1>Head</h1><p>{}</p></div>", "Head\n{}"),
    ("<article><div class=entry-meta>By x</div><p>{}</p><div class=post-tags>a b</div></article>", "{}"),
    ("<article><p>{}</p></article><section class=comments><article><p>Great, thanks, really.</p></article></section>", "{}"),
])
def test_less_common_pages(page, want):
    assert html.main_text(page.format(LONG)) == want.format(LONG.strip())


def test_path_values_equal_brute_force():
    import math
    rng = random.Random(9)
    for _ in range(50):
        blocks = [(p, (0.0, 1.0, 5.0)[p % 3], "x, y. " * rng.randrange(1, 30), 0, 0) for p in
                  (rng.randrange(6) for _ in range(rng.randrange(1, 20)))]
        ratio = {p: (sum(len(b[2]) for b in blocks if b[0] == p) / sum(b[0] == p for b in blocks),
                     sum(b[2].count(",") + b[2].count(".") for b in blocks if b[0] == p) / sum(b[0] == p for b in blocks))
                 for p in {b[0] for b in blocks}}
        line = [(p, w, sum(math.log1p(x) for x in ratio[p])) for p, w, *_ in blocks if w]
        want = {p: [] for p in ratio}
        for i, (p, w, v) in enumerate(line):
            near = [(html.KERNEL[k + 1], line[i + k][2]) for k in (-1, 0, 1) if 0 <= i + k < len(line)]
            want[p].append(w * sum(a * b for a, b in near) / sum(a for a, _ in near))
        got = html.path_values(blocks)
        assert all(abs(got[p] - (sum(v) / len(v) if v else 0.0)) < 1e-9 for p, v in want.items())


def test_main_text_odd_pages(spark):
    pages = [(1, None), (2, ""), (3, "plain text"), (4, "<p>"), (5, "<<<>>><p>ok"), (6, "<div>" * 3000 + "deep"),
             (7, "<script>x"), (8, "<article>" + "long " * 200000)]
    df = spark.createDataFrame(pages, "page_id long, html string").withColumn("text", F.lit("old"))
    got = {r["page_id"]: r["text"] for r in html.extract(df).collect()}
    assert got[1] == got[2] == got[4] == got[7] == ""
    assert got[3] == "plain text" and got[6] == "deep" and len(got[8]) == 999999
    assert html.extract(df.limit(0)).count() == 0


def test_main_text_of_the_test_pages(spark):
    for r in html.op9_html(spark, "/root/testdata/sf0.001").collect():
        assert r["n_chars"] == len(r["text"]) > 0


# ---- substrings

def brute_substrings(docs):
    first = {}
    words = [WORD.findall(t or "") for _, t in docs]
    for (d, _), w in zip(docs, words):
        if d is not None:
            for i in range(len(w) - 12):
                k = tuple(w[i:i + 13])
                first[k] = min(d, first.get(k, d))
    out = []
    for (d, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - 12 if d is not None else 0):
            if first[tuple(w[i:i + 13])] < d:
                gone.update(range(i, i + 13))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk, merge", [(50, 100), (10 ** 6, 1 << 28)])
def test_substrings_equal_brute_force(spark, monkeypatch, chunk, merge):
    monkeypatch.setattr(subs, "CHUNK_WINDOWS", chunk)
    monkeypatch.setattr(subs, "MERGE_BYTES", merge)  # partial sketches merged in several parts, and at once
    monkeypatch.setattr(subs, "GROUP_BYTES", 2000)
    shared = long_text(60, 77, 10 ** 6)
    docs = [(i, f"{long_text(40, i)}\n {shared if i % 3 == 0 else ''} {long_text(9, i + 500)} ") for i in range(60)]
    docs += [(100 + i, docs[4][1]) for i in range(5)]
    docs += [(4, docs[4][1]), (4, shared), (None, shared), (200, None), (201, ""), (202, " \t"), (203, "é " * 3000), (204, "é " * 20),
             (-5, shared[:200])]
    df = spark.createDataFrame([(d, t, "y") for d, t in docs], "doc_id long, text string, n_words string").repartition(6)
    rows = subs.dedup_substrings(df.withColumn("extra", F.lit(3))).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], " ".join(WORD.findall(r["text"] or ""))) for r in rows), key=str)
    assert got == brute_substrings(docs)
    assert {r["extra"] for r in rows} == {3}
    untouched = {r["doc_id"]: r["text"] for r in rows if r["n_removed"] == 0 and r["doc_id"] in range(60)}
    assert all(t == dict(docs)[d] or d == 4 for d, t in untouched.items())


def test_substrings_empty_table(spark):
    assert subs.dedup_substrings(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sketch_loses_no_repeated_window():
    rng = np.random.default_rng(8)
    h = rng.integers(0, 2 ** 63, 5000, dtype=np.uint64)
    c = np.sort(subs.cells(h, 1, 1 << 16))
    assert (subs.unpack_sorted(subs.pack_sorted(c)) == c).all()
    v = rng.integers(-2 ** 62, 2 ** 62, 100)
    assert (subs.unpack_ints(subs.pack_ints(v)) == v).all()
