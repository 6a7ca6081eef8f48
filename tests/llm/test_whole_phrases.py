"""op12: tiles against a counter, whole results against plain counting, hot words, odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_helpers import CLASHING, EDGES, LOWER, documents
from citeflow.llm import phrases as P
from citeflow.llm.common import stored


def brute(rows, least=10, nested=50, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(w)
            f.update(("und" if lang is None else lang, *w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    longer = Counter()
    for p, a in f.items():
        if len(p) == 4 and a >= least:
            for q in (p[:3], (p[0], *p[2:])):
                longer[q] = max(longer[q], a)
    out = {}
    for p, a in f.items():
        if len(p) < 3 or a < least or 100 * longer[p] >= nested * a and longer[p]:
            continue
        lang, *w = p
        score, k = min((10**6 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return {(lang, i): (p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items()
            for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)}


def whole(df, *more):
    return stored(P.candidates(df, *more), "t")


def result(df):
    rows = df.collect()
    out = {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in rows}
    assert len(out) == len(rows)
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(2, 40), st.sampled_from([1, 3000, 10**9]), st.sampled_from([7, 500]))
def test_tiles_count_every_pair(seed, most, step, waiting):
    old = P.WAITING, P.FILLED
    P.WAITING, P.FILLED = waiting, 1e-4
    try:
        rng = np.random.default_rng(seed)
        tiles, want = P.PairTiles(), Counter()
        for _ in range(4):
            ids = np.minimum(rng.integers(-1, most, int(rng.integers(0, 400))) * (step if seed % 2 else 1), 2**31 - 1).astype(np.int32)
            ids[ids < 0] = -1
            tiles.add(ids)
            want.update((a, b) for a, b in zip(ids.tolist(), ids[1:].tolist()) if a >= 0 and b >= 0)
        keys, counts = tiles.found()
        assert keys.tolist() == sorted(keys.tolist())
        assert {(k >> 32, k & 0xFFFFFFFF): c for k, c in zip(keys.tolist(), counts.tolist())} == want
    finally:
        P.WAITING, P.FILLED = old


def test_dense_tiles():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.3, 300_000), 3000).astype(np.int32) - 1
    tiles = P.PairTiles()
    tiles.add(ids)
    keys, counts = tiles.found()
    want = Counter(zip(ids.tolist(), ids[1:].tolist()))
    assert {(k >> 32, k & 0xFFFFFFFF): c for k, c in zip(keys.tolist(), counts.tolist())} == want


def test_words_of_pieces():
    words, joined = P.piece_words(["A b.c\td\v".encode(), b"", b"\xc3\x89 \r\n e  f,", b"g"])
    assert words.to_pylist() == [b"a", b"b", b"c", b"d", b"\xc3\x89", b"e", b"f", b"g"]
    assert joined.tolist() == [True, False, True, False, False, True, False, False]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = ["the", "of", "New", "york", "Äpfel", "x1", "état", "\xa0", "…", "汉字"] + [f"w{i}" for i in range(60)]
    out = []
    for i in range(400):
        n = rng.choice([0, 1, 3, 40, 200])
        text = "".join(rng.choice(words[:6] if rng.random() < 0.6 else words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(n))
        if rng.random() < 0.3:
            text += " New York stock exchange " * rng.randrange(3)
        out.append((i, text, rng.choice(["en", "en", "en", "de", None, ""]), "s"))
    return [*out, *out[:20], (None, "the of", "en", "s"), (1, None, None, None), (2, "a b " * 50_000, "long", "s"), (3, "y" * 300_000, "long", "s")]


@pytest.mark.parametrize("tokens", [500, 4_000_000])
def test_whole_results(spark, monkeypatch, rows, tokens):
    monkeypatch.setattr(P, "PART_TOKENS", tokens)
    df = documents(spark, rows).withColumns({c: F.lit("x") for c in CLASHING}).repartition(3)
    got = result(P.best_phrases(whole(df)))
    assert got == brute([(r[1], r[2]) for r in rows])
    assert any(len(v[0].split(" ")) == 3 for v in got.values())


def test_limits_and_ties(spark, rows):
    got = result(P.best_phrases(whole(documents(spark, rows), 3, 80), 7))
    assert got == brute([(r[1], r[2]) for r in rows], 3, 80, 7)


def test_edges_and_nothing(spark):
    assert P.best_phrases(whole(documents(spark, EDGES))).count() == 1  # "word word word ..." nests its pairs
    assert P.best_phrases(whole(documents(spark, EDGES).where("doc_id < 0"))).count() == 0


def test_scores_past_64_bits(spark):
    a, left, right = 3_000_000_000_000_000, 3_000_000_000_000_001, 4_000_000_000_000_000
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(P._score("a", "l", "r")).first()[0] == 10**6 * a * a // (left * right)


def test_query_equals_plain_counting(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang").collect()
    assert result(P.op12_phrase_tiles(spark, sf)) == brute([tuple(r) for r in docs])
