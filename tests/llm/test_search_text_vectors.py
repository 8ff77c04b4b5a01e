"""Whitening, main text and lexical search against brute force and by hand."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cases import EDGES, prose
from tessera.llm import html_text, html_tree, lexical, whitening
from tessera.llm.labelled_pages import LAYOUTS, SEEDS, labelled_pages

VECTORS = "vec_id bigint, embedding array<float>, n string, v string, component string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], VECTORS)


# ------------------------------------------------------------------ whitening

@pytest.mark.parametrize("dims", [1, 2, 3, 40, 90])
def test_slices_hold_all_eigenpairs(dims):
    r = np.random.default_rng(dims)
    cov = np.cov(r.standard_normal((200, dims)) @ np.diag(np.geomspace(1, 30, dims)), rowvar=False).reshape(dims, dims)
    slices = whitening.intervals(cov, min(32, dims))
    assert sum(c for *_, c in slices) == min(32, dims)
    values, axes = whitening.refined(cov, np.hstack([whitening.feast(cov, *s)[1] for s in slices]))
    expected = np.linalg.eigvalsh(cov)[::-1][:len(values)]
    assert np.abs(values - expected).max() <= 1e-12 * expected[0]
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12
    assert np.abs(cov @ axes - axes * values).max() <= 1e-12 * expected[0]


def test_clusters_are_not_cut():
    cov = np.diag([5.0] + [2.0] * 12 + [1.0] * 30)
    slices = whitening.intervals(cov, 8)
    assert slices[0][2] in (1, 13) and sum(c for *_, c in slices) == 13
    assert all(len(whitening.feast(cov, *s)[0]) == s[2] for s in slices)


def test_missing_components_are_an_error():
    with pytest.raises(RuntimeError, match="inertia"):
        whitening.feast(np.diag([4.0, 3.0, 1.0]), 2.0, 5.0, 3)


def test_inertia_counts():
    a = np.random.default_rng(3).standard_normal((30, 30))
    a = a + a.T
    t, values = whitening.tridiagonal(a), np.linalg.eigvalsh(a)
    for shift in (-5.0, -0.1, 0.0, 2.5, 100.0):
        assert whitening.count_above(t, shift) == (values > shift).sum()


@pytest.mark.parametrize("partitions", [1, 7])
def test_whitening_equals_numpy(spark, partitions):
    r = np.random.default_rng(0)
    data = (r.standard_normal((120, 6)) @ r.standard_normal((6, 6))).astype(np.float32)
    data[5] = data[4]
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    bad = [(200, None), (201, [None] * 6), (202, [float("nan")] + [0.0] * 5), (203, [float("inf")] + [0.0] * 5), (204, []), (205, [1.0, 2.0])]
    got = whitening.whiten(vectors(spark, rows + bad + [(None, rows[0][1]), (7, rows[7][1])]).repartition(partitions), components=4).toPandas()
    data = np.vstack([data, data[:1], data[7:8]])
    x = np.floor(64 * data.astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    z = (x * n - sums) / n
    values, axes = np.linalg.eigh(z.T @ z / n)
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    assert len(got) == 4 * n and set(got.n) == {n} and got.vec_id.isna().sum() == 4
    assert got.identity_error.max() < 1e-12
    for i in (0, 4, 7, 100):
        mine = got[got.vec_id == i].sort_values("component")
        mine = mine.iloc[:8:2] if i == 7 else mine
        assert set(mine.deviation) == {int(((n * x[i] - sums) ** 2).sum())}
        assert np.abs(np.abs(mine.whitened.to_numpy()) - np.abs(z[i] @ axes / np.sqrt(values))).max() < 1e-9
        assert np.abs(mine.explained.to_numpy() - values / (z ** 2).sum() * n).max() < 1e-12


def test_whitening_of_nothing_and_of_equal_vectors(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [0.5, 0.25]) for i in range(5)]):
        out = whitening.whiten(vectors(spark, rows))
        assert out.count() == 0 and out.columns[-1] == "identity_error"
    flat = whitening.whiten(vectors(spark, [(i, [float(i), 1.0, 2.0 * i]) for i in range(9)]))  # rank one
    assert flat.count() == 9 and flat.agg({"identity_error": "max"}).first()[0] < 1e-9


def test_entries_too_large_for_a_long(spark):
    out = whitening.whiten(vectors(spark, [(1, [3e38]), (2, [-3e38]), (3, [0.0])])).collect()
    assert {r.vec_id: r.deviation for r in out} == {1: None, 2: None, 3: 0}  # the third is the mean
    assert all(math.isfinite(r.whitened) for r in out)


# ------------------------------------------------------------------ main text

def by_enumeration(parents, kinds, x, weights, tables):
    """Marginals of one tree by summing over all states."""
    n, total = len(parents), 0.0
    one = np.zeros(n)
    for state in range(2 ** n):
        y = [(state >> k) & 1 for k in range(n)]
        score = sum(y[k] * (x[k] @ weights) for k in range(n)) + sum(tables[kinds[k]][y[parents[k]]][y[k]] for k in range(1, n))
        total += math.exp(score)
        one += math.exp(score) * np.array(y)
    return one / total, math.log(total)


def test_messages_are_exact():
    sources = ["<article><h1>a</h1><p>b <a>c</a></p><div><p>d.</p></div></article><nav>e</nav>", "<p>x", ""]
    pages = [html_tree.Page(s) for s in sources]
    r = np.random.default_rng(1)
    weights, tables = r.standard_normal(html_tree.N_FEATURES), r.standard_normal((html_tree.N_KINDS, 2, 2))
    forest = html_text.Forest(pages)
    one, pairs, log_z = forest.messages(weights, tables)
    first, logs = 0, 0.0
    for page, size in zip(pages, forest.sizes):
        at = slice(first, first + size)
        expected, log_sum = by_enumeration(page.parents, forest.kind[at], forest.x[at], weights, tables)
        assert np.abs(one[at, 1] - expected).max() < 1e-9
        first, logs = first + size, logs + log_sum
    assert abs(logs - log_z) < 1e-9
    inner = ~forest.root
    assert np.abs(pairs[inner].sum(axis=1)[:, 1] - one[inner, 1]).max() < 1e-9
    assert np.abs(pairs[inner].sum(axis=2)[:, 1] - one[forest.parent[inner], 1]).max() < 1e-9


def wanted(page):
    y = html_text.labels_of(page)
    return "\n".join(t for node, t in page.blocks if y[node])


def test_layouts_held_out_of_training():
    """Models that have not seen a page of a layout still read most of it."""
    every = labelled_pages()
    right = total = 0
    for k in range(0, len(LAYOUTS), 9):
        out = set(range(k * SEEDS, min(k + 9, len(LAYOUTS)) * SEEDS))
        model = html_text.fit([s for i, s in enumerate(every) if i not in out])
        pages = [html_tree.Page(every[i]) for i in sorted(out)]
        for page, text in zip(pages, model.kept(pages)):
            a, b = Counter(wanted(page).split("\n")), Counter(text.split("\n"))
            right += 2 * (a & b).total()
            total += a.total() + b.total()
    assert right / total > 0.8


PAGES = [
    ("<html><head><title>x</title></head><body><div class=cookie>We use cookies.</div><nav><a href='/'>Home</a></nav><header>Welcome</header>"
     "<aside>Side text</aside><article><h1>Head</h1><p>A&nbsp;b  c &lt;d&gt;\n</p><script>var p = '</p>';</script><p>e<br>f</p>"
     "<form><input><label>Name</label></form></article><section id=comments><p>I liked this article a lot.</p></section><footer>foot</footer></body></html>",
     "Head\nA b c <d>\ne f"),
    ("<article><p>one<p>two <b>bold</b> &amp; more</article><!-- <p>not</p> --><style>p{}</style>", "one\ntwo bold & more"),
    ("", ""), (None, ""), ("<p></p><nav></nav>", ""), ("<article><p>text in an unclosed tag <a href='x", "text in an unclosed tag <a href='x"),
    ("<article>" + "<p>Long words stand here, again and again.</p>" * 20000 + "</article>", "\n".join(["Long words stand here, again and again."] * 20000)),
    ("<article>" + "<div>" * 3000 + "<p>Deep text stands here.</p>", "Deep text stands here."),
    ("<article><p>" + "x" * 300000 + "</p></article>", "x" * 300000),
]


def test_main_text(spark):
    rows = [(i, f"http://h/{i}", s) for i, (s, _) in enumerate(PAGES)] + [(1, None, PAGES[1][0]), (None, None, PAGES[1][0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, text string, n_chars int")
    out = html_text.main_text(df.repartition(3)).collect()
    assert len(out) == len(rows)
    for r in out:
        expected = PAGES[1][1] if r.page_id is None else PAGES[r.page_id][1]
        assert r.text == expected and r.n_chars == len(expected)
    assert html_text.main_text(df.limit(0)).count() == 0


def test_training_from_a_table(spark):
    model = html_text.train(html_text.as_table(spark, labelled_pages()[::3]))
    page = html_tree.Page(PAGES[0][0])
    assert model.kept([page]) == [PAGES[0][1]]
    with pytest.raises(ValueError):
        html_text.train(html_text.as_table(spark, ["<p>x"]).limit(0))


def test_driver_pages_give_their_article(spark):
    """The tables' pages have one <article>; it is the whole of the text."""
    import html
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in html_text.main_text(pages).collect()}
    for r in pages.collect():
        inside = r.html.split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inside)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


# ------------------------------------------------------------- lexical search

def brute(docs, items, k=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    found = [(i, Counter(cut(t))) for i, t in docs]
    sizes = [c.total() for _, c in found]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        wanted, scored = Counter(cut(text)), []
        for (doc, c), n in zip(found, sizes):
            score = 0
            for t, times in wanted.items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * (1000000000 * c[t] // (1000 * c[t] + 8 * (25 + 75 * n * n_docs // n_terms)))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return out


def ranked(spark, make_docs, docs, items, **how):
    items = spark.createDataFrame([(i, t, "x", 0) for i, t in items], "item_id bigint, text string, doc_id string, rank int")
    return [tuple(r) for r in lexical.ranked(make_docs(docs, extra=("score", "query")), items, **how).collect()]


ITEMS = [(1, prose(6)), (2, None), (3, ""), (4, "one WORD 日本語 é"), (5, "the the the of"), (6, prose(13) + " " + prose(14)), (7, "-- !!"),
         (None, "one"), (4, "one WORD"), (9, "absentterm")]


def same(a, b):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(a, key=key) == sorted(b, key=key)


@pytest.mark.parametrize("k", [1, 3, 10])
def test_ranked_edges(spark, make_docs, k):
    same(ranked(spark, make_docs, EDGES, ITEMS, k=k), brute(EDGES, ITEMS, k))


def test_ranked_of_nothing(spark, make_docs):
    assert ranked(spark, make_docs, [], ITEMS) == []
    assert ranked(spark, make_docs, EDGES, []) == []
    assert ranked(spark, make_docs, [(1, None), (2, "--")], ITEMS) == []


def test_ranked_over_many_shards_and_blocks(spark, make_docs, monkeypatch):
    """Copies that tie, shards of a few rows, blocks of a few queries."""
    r = random.Random(5)
    docs = [(i, prose(r.randint(0, 60), n=r.choice([1, 5, 40, 200]))) for i in range(300)] + [(1000 + i, prose(7, 40)) for i in range(200)]
    items = [(i, prose(i, 20)) for i in range(12)]
    expected = brute(docs, items)
    same(ranked(spark, make_docs, docs, items), expected)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 50)
    same(ranked(spark, make_docs, docs, items), expected)


@pytest.mark.parametrize("docs, postings", [(1, 1), (3, 1 << 20), (1 << 15, 7), (50, 90)])
def test_shards_hold_all_rows(monkeypatch, docs, postings):
    import pyarrow as pa
    monkeypatch.setattr(lexical, "SHARD_DOCS", docs)
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", postings)
    r = random.Random(docs)
    sizes = [r.choice([0, 1, 3, 20]) for _ in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array([s + 1 for s in sizes]), pa.array([list(range(s)) for s in sizes], pa.list_(pa.int32())),
                                        pa.array([[1] * s for s in sizes], pa.list_(pa.int64()))], ["doc_id", "n", "terms", "counts"])
    shards = list(lexical._shards(iter([batch.slice(0, 70), batch.slice(70)]), 200, 2000))
    assert [i for s in shards for i in s.ids.tolist()] == list(range(200))
    assert sum(len(s.doc) for s in shards) == sum(sizes)
    assert all(len(s.ids) <= docs and (len(s.doc) <= postings or np.count_nonzero(np.bincount(s.doc)) == 1) for s in shards)


def test_reading_stops_early_and_is_exact():
    """With one clear winner, the tail of the lists isn't needed for it."""
    r = np.random.default_rng(2)
    n = 5000
    term, doc = np.repeat(np.arange(3), n), np.tile(np.arange(n), 3)
    impact = r.integers(1, 1000, 3 * n)
    impact[doc == 17] = 900_000
    s = lexical.Shard(np.arange(n), doc, term, impact)
    full = sum(w * impact[term == t] for t, w in ((0, 2), (1, 5), (2, 1)))
    for k in (1, 10, 6000):
        scores, ids = s.best([(0, 2), (1, 5), (2, 1), (9, 4)], k, 1)
        order = np.lexsort((np.arange(n), -full))[:k]
        assert (ids == order).all() and (scores == full[order]).all()
    assert len(s.best([(0, 2)], 10, 10 ** 9)[0]) == 0
