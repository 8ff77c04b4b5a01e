"""Quality rules, language model, URL filter, mixing and the pipeline."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from cases import EDGES, prose
from tessera.llm import lm, mixing, quality, url_filter

SF = "/root/testdata/sf0.001"


# -- quality rules ---------------------------------------------------------

def base_metrics(text):
    text = text or ""
    w = text.encode().split()
    windows = list(zip(w, w[1:], w[2:]))
    times = Counter(windows)
    covered = {k + j for k, x in enumerate(windows) if times[x] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def junk(seed, kind):
    w = prose(seed, 100).split()
    return {"symbols": " ".join(x + "###" for x in w), "capitals": "!! ".join(w).upper() + "!!", "repeats": " ".join(x for x in w[:6] for _ in range(20))}[kind]


def test_quality_metrics_and_verdicts(spark, make_docs):
    good = [(100 + i, prose(i, 120)) for i in range(60)]
    bad = [(200 + i, junk(i, k)) for i, k in enumerate(["symbols", "capitals", "repeats"] * 3)]
    rows = EDGES + good + bad + [(300, "a b c a b c a b c"), (301, "a a a a"), (302, "a b"), (303, "x\n\nx\n y\nx")]
    got = quality.quality_rules(make_docs(rows, extra=["quality", "votes", "_words"])).collect()
    assert sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got], key=repr) == \
        sorted([(i, *base_metrics(t)) for i, t in rows], key=repr)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got)
    assert all(not r.kept for r in got if r.base_failed)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[i] for i, _ in good) and not any(kept[i] for i, _ in bad)
    df = make_docs(rows, extra=["row", "quality", "n_words"])
    out = quality.drop_low_quality(df)
    assert out.columns == df.columns and out.count() == sum(r.kept for r in got)
    assert quality.quality_rules(df.limit(0)).count() == 0


def test_em_finds_the_accuracies(spark):
    """Votes drawn with known accuracies: EM must find them."""
    rng = np.random.default_rng(3)
    right = [0.95, 0.9, 0.8, 0.7, 0.85]
    truth = rng.random(4000) < 0.5
    votes = np.stack([np.where(rng.random(4000) < r, truth, ~truth) * 2 - 1 for r in right], 1)
    votes[rng.random(votes.shape) < 0.2] = 0
    names = [f"v{k}" for k in range(5)]
    found = quality.fit(spark.createDataFrame(votes.tolist(), names), names)
    # brute force: the same estimate by numpy
    p = np.where((votes < 0).any(1), 1 - quality.START_SURE, quality.START_SURE)
    for _ in range(quality.ITERATIONS + 1):
        agree = np.where(votes == 1, p[:, None], 1 - p[:, None]) * (votes != 0)
        want = (agree.sum(0) + quality.PRIOR_RIGHT) / ((votes != 0).sum(0) + quality.PRIOR_RIGHT + quality.PRIOR_WRONG)
        p = 1 / (1 + np.exp(-(votes * np.log(want / (1 - want))).sum(1)))
    assert np.allclose(found, want, atol=0.01)
    assert np.allclose(found, right, atol=0.06)


# -- language model --------------------------------------------------------

def test_lm_base_scores_and_gain(spark, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN", 2000)  # most words take the join
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in lm.score_documents(docs).collect()}
    rows = [(r.doc_id, (r.text or "").encode().lower().split() + [b""]) for r in docs.collect()]
    counts = Counter()
    for i, w in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    base = model = 0.0
    for i, w in rows:
        r = got[i]
        want = sum(math.log10((counts.get(x, 0) + 1) / (n + v + 1)) for x in w)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(x in counts for x in w), n)
        assert r.base_score == pytest.approx(want, rel=1e-9)
        if r.held_out:
            base, model = base + want, model + r.score
    assert model > base  # held-out texts are likelier than under the unigram base


def test_lm_probabilities_add_up():
    rng = np.random.default_rng(0)
    counts = {f"w{k}".encode(): int(n) for k, n in enumerate(rng.integers(1, 50, 1200))}
    tokens_of, words_of = np.zeros(lm.CLASSES), np.zeros(lm.CLASSES)
    v = lm.Vocabulary(counts, sum(counts.values()), len(counts), tokens_of, words_of)
    for w, c in counts.items():
        if w not in v.unit:
            tokens_of[lm.word_class(w)] += c
            words_of[lm.word_class(w)] += 1
    model = lm.LogBilinear.new(lm.unigram(v))
    model.target += rng.normal(0, 0.5, model.target.shape).astype(np.float32)
    norm = model.normalisers()
    one, two = np.array([0, 5, v.start]), np.array([3, v.start, v.start])
    p = np.exp(model.predicted(one, two) @ model.target.T + model.bias - norm[two, one][:, None])
    assert np.allclose(p.sum(1), 1, atol=1e-4)
    # within a shared unit: its words and one unseen word
    for k in range(3):
        inside = [c for w, c in counts.items() if w not in v.unit and lm.word_class(w) == k]
        assert sum(c + 1 for c in inside) + 1 == tokens_of[k] + words_of[k] + 1


def test_lm_edges(spark, make_docs):
    got = lm.score_documents(make_docs(EDGES, extra=["rid", "score", "word"])).collect()
    assert len(got) == len(EDGES)
    assert all(r.n_tokens == len((dict(EDGES)[r.doc_id] or "").split()) + 1 for r in got if r.doc_id in (2, 4, 6))
    assert all(math.isfinite(r.score) and r.score <= 0 and math.isfinite(r.base_score) for r in got)
    assert lm.score_documents(make_docs([]).limit(0)).count() == 0
    only = [i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2]
    assert all(r.held_out and r.n_known == 0 for r in lm.score_documents(make_docs([(i, "a b") for i in only])).collect())


# -- URL filter ------------------------------------------------------------

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def brute_urls(rows):
    def split(url):
        if not url or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        return "".join(c.lower() if c.isascii() else c for c in host), path

    def rule(host, path):
        fits = [(len(r), r, says) for r, says in RULES for h, p in [(r[:r.index("/")], r[r.index("/"):])]
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[1:] if fits else (None, None)
    pages = [(i, *split(u), html) for i, u, html in rows]
    judged = [(i, h, p, *rule(h, p)) for i, h, p, _ in pages]
    edges = Counter()
    for _, h, _, html in pages:
        for to in set(re.findall(url_filter.LINK, html or "")):
            if split(to)[0] not in ("", h) and h:
                edges[h, split(to)[0]] += 1
    tree = set()
    for _, h, _, _ in pages:
        labels = h.split(".")
        while len(labels) > 2:
            up = labels[1:]
            tree |= {(".".join(labels), ".".join(up)), (".".join(up), ".".join(labels))}
            labels = up
    edges.update(tree)
    ranks = []
    for says, flip in (("allow", False), ("block", True)):
        seeds = Counter(h for _, h, _, _, v in judged if v == says)
        total = sum(seeds.values()) or 1
        e = {((b, a) if flip else (a, b)): n for (a, b), n in edges.items()}
        out = Counter()
        for (a, _), n in e.items():
            out[a] += n
        now = {h: n / total for h, n in seeds.items()}
        seed = dict(now)
        for _ in range(200):
            new = Counter({h: s * (1 - url_filter.DAMPING) for h, s in seed.items()})
            for (a, b), n in e.items():
                new[b] += url_filter.DAMPING * now.get(a, 0) * n / out[a]
            now = new
        ranks.append(now)
    return {i: (h, p, r, v or ("block" if ranks[1].get(h, 0) > ranks[0].get(h, 0) else "allow")) for i, h, p, r, v in judged}


def test_urls_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "ITERATIONS", 40)
    link = lambda u: f"<a href='{u}'>x</a><img src={u}>"
    rows = [
        (1, "https://A.Example.ORG/en/2?x#y", link("http://good.net/")), (2, "http://a.example.org/en/17", None),
        (3, "http://example.org/es/", ""), (4, "http://b.com/fr/1", link("http://good.net/p") + link("http://fair.net/")),
        (5, "http://b.com/de/1", "no links"), (6, "http://good.net/", link("http://b.com/")), (7, "http://bad.net/x", link("http://evil.com/de/")),
        (8, "http://evil.com/de/x", None), (9, "http://evil.com/en/x", link("http://evil.com/de/x")), (10, None, None), (11, "no scheme", "x"),
        (12, "http://org", None), (13, "http://notorg/a", None), (14, "http://x.y.bad.net/", None), (15, "://", None), (16, "a://b://c/d", None),
        (17, "http://good.net/", link("http://b.com/")), (18, "http://b.com?q=/fr/", None), (19, "http://ÄB.com/fr/é", None),
    ]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "page_id bigint, url string, html string, host string, rank int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(df, RULES).collect()}
    assert got == brute_urls(rows)
    assert got[7][3] == "block" and got[6][3] == "allow" and got[14][3] == "block"
    assert url_filter.filter_urls(df.limit(0), RULES).count() == 0


def test_urls_far_from_every_seed(spark):
    """With the constants of the query: a chain longer than one block of
    rounds, a cycle that keeps its rank, and links without a scheme."""
    link = lambda u: f"<a href='{u}'>x</a>"
    rows = [(0, "http://evil.com/de/", None), (1, "http://c1.net/", link("http://evil.com/")), (90, "http://ok.com/fr/", link("http://a.s.net/"))]
    rows += [(k, f"http://c{k}.net/", link(f"http://c{k - 1}.net/")) for k in range(2, 31)]
    rows += [(60, "http://a.s.net/", link("//q.net/")), (61, "http://s.net/", None), (62, "http://p.net/", link("//EVIL.com/x?u=http://ok.com/"))]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    out = {r.page_id: r for r in url_filter.filter_urls(df, RULES).collect()}
    absolute = [(i, u, h and h.replace("'//", "'http://")) for i, u, h in rows]
    assert {i: (r.host, r.path, r.rule, r.verdict) for i, r in out.items()} == brute_urls(absolute)
    assert all(out[k].verdict == "block" and out[k].distrust > 0 for k in [*range(1, 31), 62])
    # the cycle a.s.net - s.net: t(a) = d * (0.15 s + t(s)), t(s) = d * t(a) / 2 (the other half goes to q.net)
    d = url_filter.DAMPING
    assert out[60].trust == pytest.approx(d * (1 - d) / (1 - d * d / 2), rel=1e-3)


# -- mixing and the pipeline -----------------------------------------------

def test_rates_meet_the_targets(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([2, 0.4, 0.4], 800)
    tokens = rng.integers(1, 1000, 800)
    table = spark.createDataFrame([(i, int(t), *map(float, x)) for i, (t, x) in enumerate(zip(tokens, p))],
                                  ["id", "n_tokens", *[f"p_{d}" for d in mixing.DOMAINS]])
    now = (tokens[:, None] * p).sum(0)
    want = now * np.array([1.1, 0.6, 0.5])
    rate = np.array([r.rate for r in mixing.with_rates(table, targets=dict(zip(mixing.DOMAINS, want))).orderBy("id").collect()])
    assert (rate >= 0).all()
    assert np.allclose((rate[:, None] * tokens[:, None] * p).sum(0), want, rtol=0.05)
    # brute force: long projected gradient in numpy, drawn to 1 a little, reaches the same rates
    total, gram = tokens.sum(), (tokens / tokens.sum()) @ p ** 2
    r = np.ones(800)
    for _ in range(3000):
        off = ((r[:, None] * tokens[:, None] * p).sum(0) - want) / total / gram
        r = np.maximum(0, r - 0.3 * (p @ off + 0.01 * (r - 1)))
    assert np.abs(rate - r).mean() < 0.08
    bounded = mixing.with_rates(table, targets=dict(zip(mixing.DOMAINS, want)), max_rate=1.0).agg({"rate": "max"}).first()[0]
    assert bounded <= 1


@pytest.mark.parametrize("sharpness", [0.8, 4.0])
def test_rates_meet_weights_of_a_rare_domain(spark, sharpness):
    rng = np.random.default_rng(7)
    shares = np.array([0.80, 0.15, 0.05])
    truth = rng.choice(3, 2000, p=shares)
    logits = sharpness * (np.eye(3)[truth] * 2 + rng.normal(0, 1, (2000, 3))) + np.log(shares)
    p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    tokens = rng.integers(1, 1000, 2000)
    table = spark.createDataFrame([(i, int(t), *map(float, x)) for i, (t, x) in enumerate(zip(tokens, p))],
                                  ["id", "n_tokens", *[f"p_{d}" for d in mixing.DOMAINS]])
    mass = tokens[:, None] * p
    want = mass.sum(0) * [mixing.WEIGHTS[d] for d in mixing.DOMAINS]
    rate = np.array([r.rate for r in mixing.with_rates(table).orderBy("id").collect()])
    assert (rate >= 0).all() and np.allclose(rate @ mass, want, rtol=1e-3)
    # bounded: no row's rate can move and lower the squares
    rate = np.array([r.rate for r in mixing.with_rates(table, max_rate=1.0).orderBy("id").collect()])
    off = p @ ((rate @ mass - want) / (tokens @ p ** 2))
    assert rate.min() >= 0 and rate.max() <= 1
    assert (off[rate > 0] < 1e-3).all() and (off[rate < 1] > -1e-3).all()


def test_mixing_edges(spark, make_docs, labels):
    df = make_docs(EDGES + [(i, prose(i) + (" awful" if i % 5 == 0 else "")) for i in range(20, 40)], extra=["rate", "rid", "p_clean", "copies"])
    got = mixing.mix(df, labels).collect()
    assert len(got) == df.count()
    assert all(r.rate >= 0 and abs(r.p_clean + r.p_low + r.p_toxic - 1) < 1e-6 and r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in got)
    assert mixing.mixed(df, labels).columns == df.columns
    assert mixing.mix(df.limit(0), labels).count() == 0
    assert mixing.mixed(df.limit(0), labels).count() == 0
    assert mixing.mix(df, labels.limit(0)).count() == df.count()


def test_pipeline(spark, make_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True)
    texts = [r.text for r in docs.collect()]
    squeezed = ["".join(t.split()) for t in texts]
    assert len(set(squeezed)) == len(squeezed)  # no exact copy is left
    sets = [frozenset(zip(*[t.encode().lower().split()[k:] for k in range(5)])) for t in texts]
    assert not any(len(a & b) >= 0.8 * len(a | b) for k, a in enumerate(sets) for b in sets[:k] if a and b)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.count() == sizes[-1] and "text" not in out.columns
    empty = make_docs([]).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name
