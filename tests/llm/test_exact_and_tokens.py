"""Exact dedup, SentencePiece ids, token counts and language ID."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from cases import EDGES, prose
from tessera.llm import exact_dedup, language, piece_bpe, token_counts
from tessera.llm.common import scratch_path

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_JSON = public_tokenizers.path("word_bpe_49k.json")


def norm(text):
    return "".join(c for c in (text or "") if c not in " \t\n\x0b\x0c\r")


def brute_dedup(rows):
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        groups[norm(text)].append((-len(text or ""), doc_id is None, doc_id or 0, i))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        g = groups[norm(text)]
        best = min(g)
        out.append((doc_id, rows[best[3]][0], len(g), hashlib.sha256(norm(text).encode()).hexdigest()))
    return sorted(out, key=repr), sorted(repr(min(g)[:3]) for g in groups.values())


def test_exact_dedup_edges(spark, make_docs):
    df = make_docs(EDGES, extra=["keep_id", "digest", "rid", "row"])
    got = exact_dedup.exact_dedup(df).collect()
    want, keepers = brute_dedup([r[:2] for r in EDGES])
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == want
    assert sum(r.kept for r in got) == len(keepers)
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    assert kept.count() == len(keepers)


def test_exact_dedup_one_group_holds_most_rows(spark, make_docs):
    rows = [(i, "same text " + " " * (i % 3)) for i in range(3000)] + [(i, prose(i, 20)) for i in range(3000, 3600)]
    got = exact_dedup.exact_dedup(make_docs(rows)).collect()
    assert len(got) == 3600 and sum(r.kept for r in got) == 601
    assert {r.keep_id for r in got if r.doc_id < 3000} == {2}


def test_exact_dedup_small_filter_gives_the_same(spark, make_docs, monkeypatch):
    rows = [(i, prose(i % 150, 20)) for i in range(400)]
    full = sorted(map(tuple, exact_dedup.exact_dedup(make_docs(rows)).collect()))
    monkeypatch.setattr(exact_dedup, "MIN_BITS", 6)
    monkeypatch.setattr(exact_dedup, "MAX_BITS", 6)
    assert sorted(map(tuple, exact_dedup.exact_dedup(make_docs(rows)).collect())) == full


def test_empty_tables(spark, make_docs):
    empty = make_docs([]).limit(0)
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert exact_dedup.drop_copies(empty).count() == 0
    assert piece_bpe.round_trip_digests(empty, MODEL).count() == 0
    assert token_counts.count_tokens(empty, WORD_JSON, scratch_path(spark, "cache")).count() == 0
    assert language.identify(empty, language.train(empty)).count() == 0


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_ids_match_the_library_on_edges(spark, make_docs, lib):
    got = piece_bpe.round_trip_digests(make_docs(EDGES, extra=["ids", "n_tokens"]), MODEL).collect()
    want = []
    for doc_id, text in EDGES:
        ids = lib.encode(text or "", add_bos=True, add_eos=True)
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_ids_match_the_library_on_the_documents(spark, lib):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    out = piece_bpe.decode(piece_bpe.encode(docs, MODEL), MODEL, out="back").collect()
    for r in out:
        ids = lib.encode(r.text or "", add_bos=True, add_eos=True)
        assert r.ids == ids and r.back == lib.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab cdeé▁\n\t日😀 ​the"), max_size=80))
def test_ids_match_the_library_on_any_text(text):
    bpe = piece_bpe.tokenizer(piece_bpe.read_model(MODEL))
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = lib.encode(text, add_bos=True, add_eos=True)
    assert np.frombuffer(bpe.encode(text), "<u4").tolist() == ids
    assert bpe.decode(ids) == lib.decode(ids)
    marked = text.replace(" ", "▁")
    assert [s for s in bpe._merged_short(marked) if s] == bpe._merged_long(marked)


def test_remembered_segments_are_bounded(monkeypatch):
    monkeypatch.setattr(piece_bpe, "REMEMBERED", 10)
    bpe = piece_bpe.PieceBpe(piece_bpe.read_model(MODEL))
    text = " ".join(f"w{i % 37}" for i in range(500))
    assert bpe.encode(text) == piece_bpe.tokenizer(piece_bpe.read_model(MODEL)).encode(text)
    assert len(bpe.segments) <= 11 and len(bpe.segments.older) <= 11


def test_token_counts(spark, make_docs):
    tok = Tokenizer.from_file(WORD_JSON)
    rows = EDGES + [(20, "a<|endoftext|>b <|STARTOFTEXT|> ΑΣ İstanbul don't it's 10²"), (21, " a\t\tb ")]
    cache = scratch_path(spark, "cache")
    df = make_docs(rows, extra=["digest", "size"])
    got = token_counts.count_tokens(df, WORD_JSON, cache, limit=50).collect()
    want = [(i, len((t or "").encode()), n, n > 50) for i, t in rows for n in [len(tok.encode(t or "", add_special_tokens=False))]]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    stored = spark.read.parquet(cache).count()
    again = token_counts.count_tokens(df, WORD_JSON, cache, limit=50).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(want, key=repr)
    assert spark.read.parquet(cache).count() == stored  # nothing was a miss


def test_token_counts_match_the_library_on_the_documents(spark):
    tok = Tokenizer.from_file(WORD_JSON)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, WORD_JSON, scratch_path(spark, "cache")).collect()}
    assert got == {r.doc_id: len(tok.encode(r.text or "", add_special_tokens=False)) for r in docs.collect()}


def test_other_tokenizers_are_counted_whole():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        counter = token_counts.WordCounter(f.read())
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert not counter.by_word
    for text in ("a  b\n\nc", "", " x "):
        assert counter.count(text) == len(tok.encode(text, add_special_tokens=False))


def test_language(spark, make_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    trained = language.train(docs)
    got = {r.doc_id: r for r in language.identify(docs, trained).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (i in set(held)) for i in truth)
    right = sum(got[i].lang_pred == truth[i] for i in held) / len(held)
    assert right > 0.97
    assert all(0 <= r.score <= 1 and r.lang_pred in trained for r in got.values())
    edges = {(r.doc_id, r.lang_pred == "und") for r in language.identify(make_docs(EDGES, extra=["lang_pred"]), trained).collect()}
    assert {(1, True), (2, True), (3, True), (14, True), (6, False), (12, False)} <= edges
    # without training rows nothing is learned
    nothing = make_docs([(1, "abc", None)])
    assert [r.lang_pred for r in language.identify(nothing, language.train(nothing)).collect()] == ["und"]


def test_language_of_a_training_set_does_not_see_held_out_rows(spark, make_docs):
    rows = [(i, prose(i), "en" if zlib.crc32(str(i).encode()) % 4 != 2 else "xx") for i in range(60)]
    assert set(language.train(make_docs(rows))) == {"en"}
