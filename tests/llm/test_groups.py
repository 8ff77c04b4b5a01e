"""N-gram Jaccard join, line dedup and components against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from cases import EDGES, prose
from tessera.llm import line_dedup, ngram_join, shingles
from tessera.llm.components import components


def shingle_set(text, size=5):
    w = (text or "").encode().lower().split()
    n = min(size, len(w))
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if n else frozenset()


def brute_join(texts, similarity=0.8):
    """Per row: links and the least row of its connected class."""
    sets = [shingle_set(t) for t in texts]
    links = defaultdict(set)
    at = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in at[x])
        for j, n in shared.items():
            if n >= similarity * (len(s) + len(sets[j]) - n) - 1e-9:
                links[i].add(j)
                links[j].add(i)
        for x in s:
            at[x].append(i)
    root = {}
    for i in range(len(texts)):
        todo = [i]
        while todo:
            k = todo.pop()
            if k not in root:
                root[k] = i
                todo += links[k]
    return [len(links[i]) for i in range(len(texts))], [root[i] for i in range(len(texts))]


def edited(text, seed, edits):
    r, w = random.Random(seed), text.split(" ")
    for _ in range(edits):
        w[r.randrange(len(w))] = f"new{r.randrange(10 ** 6)}"
    return " ".join(w)


def check_join(spark, make_docs, rows):
    got = {r.doc_id: r for r in ngram_join.jaccard_join(make_docs(rows)).collect()}
    links, root = brute_join([t for _, t in rows])
    assert len(got) == len(rows)
    for k, (i, _) in enumerate(rows):
        assert (got[i].n_links, got[i].class_id) == (links[k], rows[root[k]][0]), i
        assert got[i].kept == (root[k] == k)
        assert got[i].class_size == root.count(root[k])


def test_shingles_are_word_ngrams():
    for text in ("", " ", "a", "A b", "a b c d e", "a b c d e f a b c d e", "É é x  y\tz\nw", " lead and  trail "):
        assert len(shingles.shingles(text)) == len(shingle_set(text)), text
    assert (shingles.shingles("A B c\td  e\nf") == shingles.shingles("a b c d e f")).all()
    assert set(shingles.shingles("a b c d e f")) != set(shingles.shingles("f e d c b a"))


def test_minhashes_estimate_the_similarity():
    base = prose(1, 400)
    a, b = shingles.shingles(base), shingles.shingles(edited(base, 2, 8))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((shingles.minhashes(a, 512) == shingles.minhashes(b, 512)).mean() - true) < 0.08


def test_join_against_brute_force(spark, make_docs, monkeypatch):
    """Random copies, one large group of near copies that is cut into blocks,
    and a passage that many documents share without being similar."""
    for name, value in (("SMALL", 16), ("BLOCK", 16)):
        monkeypatch.setattr(ngram_join, name, value)
    r = random.Random(5)
    rows = []
    for i in range(200):
        if rows and r.random() < 0.4:
            rows.append((i, edited(r.choice(rows)[1], i, r.randrange(0, 5))))
        else:
            rows.append((i, prose(i, r.choice([3, 4, 5, 30, 120]))))
    base, passage = prose(303, 150), prose(777, 30)
    rows += [(i, edited(base, i, i % 4)) for i in range(200, 300)]
    rows += [(i, passage + " " + prose(i, 60)) for i in range(300, 400)]
    r.shuffle(rows)
    check_join(spark, make_docs, sorted(rows))


def test_join_edges(spark, make_docs):
    df = make_docs(EDGES, extra=["rep", "rid", "tokens", "row"])
    got = ngram_join.jaccard_join(df).collect()
    links, root = brute_join([t for _, t in EDGES])
    assert sorted(r.n_links for r in got) == sorted(links)
    kept = ngram_join.drop_near_copies(df)
    assert kept.columns == df.columns and kept.count() == len(set(root))
    assert ngram_join.jaccard_join(df.limit(0)).count() == 0
    assert ngram_join.drop_near_copies(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 300)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in linked}


def brute_lines(rows, least=8):
    """Cleaned texts: a line goes when an earlier one, dropped or not, is equal
    or one word edit away."""
    def near(a, b):
        if min(len(a), len(b)) < least or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        a, b = sorted((a, b), key=len)
        return any(b[:k] + b[k + 1:] == a for k in range(len(b)))
    earlier, out = [], {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        stay = []
        for line in (text or "").split("\n"):
            w = tuple(line.encode().split())
            if w and any(w == e or near(w, e) for e in earlier):
                earlier.append(w)
                continue
            if w:
                earlier.append(w)
            stay.append(line)
        out[i] = "\n".join(stay)
    return out


def test_lines_against_brute_force(spark, make_docs):
    r, lines, rows = random.Random(9), [], []
    for i in range(60):
        mine = []
        for k in range(r.randrange(1, 7)):
            if lines and r.random() < 0.6:
                w = r.choice(lines).split()
                at = r.randrange(len(w))
                kind = r.randrange(4)
                if kind == 0:
                    w[at] = "other"
                elif kind == 1 and len(w) > 1:
                    del w[at]
                elif kind == 2:
                    w.insert(at, r.choice(["other", w[at]]))
                line = "  ".join(w)
            else:
                line = prose(i * 10 + k, r.choice([2, 7, 8, 9, 20]))
            lines.append(line)
            mine.append(line)
        rows.append((i, "\n".join(mine)))
    got = {x.doc_id: x.cleaned for x in line_dedup.line_dedup(make_docs(rows)).collect()}
    assert got == brute_lines(rows)


def test_line_edges(spark, make_docs):
    df = make_docs(EDGES, extra=["k1", "line", "places", "cleaned"])
    out = line_dedup.without_copied_lines(df)
    assert out.columns == df.columns and out.count() == len(EDGES)
    got = {r.doc_id: r.text for r in out.collect()}
    assert (got[1], got[2], got[3]) == ("", "", EDGES[2][1])
    assert got[7] == "" and got[6] == prose(6) and got[8] == "\n".join([""])
    assert got[13] == prose(13) + "\n" + prose(14)
    assert line_dedup.line_dedup(df.limit(0)).count() == 0


def test_one_line_in_most_documents(spark, make_docs):
    hot = "this very line of ten words stands in all documents"
    rows = [(i, f"{hot}\n{prose(i, 20)}") for i in range(400)]
    got = {r.doc_id: (r.n_dropped, hashlib.sha256(r.cleaned.encode()).hexdigest()) for r in line_dedup.line_dedup(make_docs(rows)).collect()}
    assert got[0][0] == 0 and all(got[i] == (1, hashlib.sha256(prose(i, 20).encode()).hexdigest()) for i in range(1, 400))
