"""op13: optimal limited lengths, exact round trips, partial reads, whole results against the library."""

import heapq
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_helpers import CLASHING, EDGES, documents, prose
from citeflow.llm import huffman_ids as H
from citeflow.llm.common import stored
from citeflow.session import scratch_path


def huffman_cost(counts):
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    return cost


def limited_cost(counts, limit):
    """The least cost of any prefix code with lengths up to ``limit``: all multisets of lengths that fit."""
    n, best = len(counts), None
    ordered = sorted(counts, reverse=True)

    def walk(i, least, room, cost):
        nonlocal best
        if best is not None and cost >= best:
            return
        if i == n:
            best = cost
            return
        for bits in range(least, limit + 1):
            if room >= 2 ** (limit - bits) * 1 and room - 2 ** (limit - bits) >= 0:
                walk(i + 1, bits, room - 2 ** (limit - bits), cost + bits * ordered[i])

    walk(0, 1, 2**limit, 0)
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=2, max_size=300))
def test_lengths_are_optimal_without_a_limit(counts):
    lengths = H.code_lengths(np.array(counts), 40)
    assert int((lengths.astype(int) * counts).sum()) == huffman_cost(counts)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=2, max_size=7), st.integers(3, 4))
def test_lengths_are_optimal_under_a_limit(counts, limit):
    lengths = H.code_lengths(np.array(counts), limit).astype(int)
    assert lengths.max() <= limit and sum(2.0 ** -lengths) <= 1
    assert int((lengths * counts).sum()) == limited_cost(counts, limit)


def test_canonical_codes():
    book = H.Codebook(H.code_lengths(np.array([5, 0, 1, 1, 9, 3])))
    codes = sorted((int(book.lengths[i]), i, format(int(book.codes[i]), f"0{int(book.lengths[i])}b")) for i in (0, 2, 3, 4, 5))
    texts = [c for *_, c in codes]
    assert texts == sorted(texts) and not any(a != b and b.startswith(a) for a in texts for b in texts)
    with pytest.raises(ValueError):
        book.encode(np.array([1]))
    with pytest.raises(ValueError):
        H.code_lengths(np.ones(9), 3)
    assert H.code_lengths(np.array([0, 7])).tolist() == [0, 1] and len(H.code_lengths(np.zeros(0, int))) == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 1000), st.integers(1, 3000))
def test_round_trip_from_any_checkpoint(seed, vocabulary, n):
    rng = np.random.default_rng(seed)
    ids = np.minimum(rng.zipf(1.2, n), vocabulary) - 1
    book = H.Codebook(H.code_lengths(np.bincount(ids)))
    bits, at = book.encode(ids)
    again = H.unpack_checkpoints(H.pack_checkpoints(at), n)
    assert book.decode(bits, again, n).tolist() == ids.tolist()
    k = int(rng.integers(0, len(at)))
    assert book.decode(bits, again[k:], n - k * H.STEP).tolist() == ids[k * H.STEP:].tolist()
    assert len(bits) == -(-int(book.lengths[ids].sum()) // 8)


def public():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def library(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public())
    return [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    odd = ["'s 're don't", "a  b   c \n\n d", "x<|endoftext|>y <|endoftext|>", "　wide　space", "é \U0001f600‍", "\x00\x1c\x85 z"]
    found = [(i, rng.choice(odd) * rng.randrange(3) + prose(rng, rng.choice([0, 1, 5, 300, 3000]))) for i in rng.sample(range(10**6), 150)]
    return [*found, *EDGES, *[(None, "none")] * 5, (-4, "below"), found[0]]


def test_whole_files(spark, monkeypatch, rows):
    monkeypatch.setattr(H, "BLOCK_IDS", 2000)
    df = documents(spark, rows).withColumns({c: F.lit(1) for c in CLASHING}).repartition(5)
    path = H.write_ids(stored(H.token_ids(df, public()), "t"), H.id_type(public()), scratch_path(spark, "t-ids"))
    assert spark.read.parquet(f"{path}/blocks").count() > 20
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"], list(r["ids"])) for r in H.read_ids(spark, path).collect()))
    ids = dict(zip((t for _, t in rows), library([t for _, t in rows])))
    assert sorted(str((r[1], r[3])) for r in got) == sorted(str((d, ids[t])) for d, t in rows)
    order = [(r[1] is not None, r[1] or 0) for r in got]
    assert order == sorted(order)
    at, whole = 0, []
    for start, _, n, some in got:
        assert start == at and n == len(some)
        at += n
        whole += some
    digest = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in H.read_ids(spark, path, digest=True).collect())
    assert digest == [(a, d, n, crc(some)) for a, d, n, some in got]
    for lo, hi in [(0, 1), (0, at), (1999, 2001), (at - 1, at + 9), (12345, 23456), (7, 7)]:
        runs = sorted((r["position"], list(r["ids"])) for r in H.read_range(spark, path, lo, hi).collect())
        assert [i for _, some in runs for i in some] == whole[lo:hi]


def test_nothing(spark):
    none = documents(spark, [(1, "a")]).where("doc_id < 0")
    path = H.write_ids(stored(H.token_ids(none, public()), "t"), H.id_type(public()), scratch_path(spark, "t-ids"))
    assert H.read_ids(spark, path).count() == 0 and H.read_range(spark, path, 0, 9).count() == 0


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.01"
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    want, at = [], 0
    for (doc, _), ids in zip(docs, library([t for _, t in docs])):
        want.append((doc, at, len(ids), crc(ids)))
        at += len(ids)
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in H.op13_huffman_ids(spark, sf).collect())
    assert got == want


ODD = ["a", "Z", "é", "1", "²", ".", ",", "'", "'s", "'t", "'ll", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", " ",
       "<|", "|>", "<|endoftext|>", "漢", "\U0001f600", "́", "‍", "\x00", "—", "word", " the", "_", "-", "#", "١"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD), max_size=25).map("".join), min_size=1, max_size=12))
def test_ids_of_odd_texts(texts):
    encoder = H.library_ids(public())
    encoder.cache.clear()
    ids, bounds = encoder.ids([t.encode() for t in texts])
    assert [ids[a:b].tolist() + [0] for a, b in zip(bounds, bounds[1:])] == library(texts)
