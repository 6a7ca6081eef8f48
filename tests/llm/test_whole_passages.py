"""The pipeline's passages of over 50 short words, clashing names in every stage, long runs in op10."""

import random
import time

from pyspark.sql import functions as F

import corpus_pipeline
from llm_helpers import documents
from citeflow.llm import suffix_dedup
from citeflow.llm.forced_bpe import ForcedBoundaryBpe


def short_words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.choice([3, 4, 4, 5]))) for _ in range(n))


def covered(texts, length):
    """Bytes covered by a string of ``length`` that starts anywhere else too."""
    seen, out = {}, [bytearray(len(t)) for t in texts]
    for i, t in enumerate(texts):
        for a in range(len(t) - length + 1):
            seen.setdefault(t[a:a + length], []).append((i, a))
    for places in seen.values():
        if len(places) > 1:
            for i, a in places:
                out[i][a:a + length] = b"\1" * length
    return [bytes(c for c, gone in zip(t, o) if not gone) for t, o in zip(texts, out)]


def test_passages_of_51_short_words_go(spark):
    rng = random.Random(3)
    passages = [short_words(rng, rng.choice([51, 55, 60])) for _ in range(12)]
    assert min(map(len, passages)) < 260
    rows = []
    for i in range(120):
        own = [short_words(rng, rng.randrange(20, 200)) for _ in range(3)]
        own[1:1] = [passages[i % 12]] if i % 2 else []
        rows.append((i, " ".join(own)))
    docs = documents(spark, rows)
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.suffix_dedup(spark, docs, "").collect()}
    want = covered([t.encode() for _, t in rows], corpus_pipeline.PASSAGE)
    assert [got[i].encode() for i in range(120)] == want
    assert all(passages[i % 12] not in got[i] for i in range(1, 120, 2))
    assert all(got[i] == rows[i][1] for i in range(0, 120, 2))


def test_shorter_passages_in_very_many_documents(spark):
    rng = random.Random(4)
    hot = short_words(rng, 58)
    rows = [(i, short_words(rng, rng.randrange(5, 60)) + " " + hot + " " + short_words(rng, rng.randrange(5, 60))) for i in range(900)]
    got = suffix_dedup.without_repeats(documents(spark, rows), corpus_pipeline.PASSAGE, corpus_pipeline.PASSAGE_GRAM)
    assert got.where(F.contains("text", F.lit(hot))).count() == 0 and got.count() == 900


def test_names_of_the_stage_itself(spark):
    docs = documents(spark, [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "other words in here"), (3, "other words in here")])
    odd = docs.withColumns({c: F.lit("x") for c in ("gone_key", "again_key", "row_key", "_gone_key", "component", "id", "copies", "first")})
    got = corpus_pipeline.jaccard_join(spark, odd, "")
    assert got.columns == odd.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 3]


def test_long_runs_equal_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    ours, theirs = ForcedBoundaryBpe(path), Tokenizer.from_file(path)
    rng = random.Random(5)
    texts = ["".join(rng.choice(a) for _ in range(n)) for a in ("acgt", "ab", "ie", "xyzé漢") for n in (63, 64, 65, 66, 300, 5000)] + ["a" * 4000]
    ids, bounds = ours.encode([t.encode() for t in texts])
    for t, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == theirs.encode(t, add_special_tokens=False).ids
    began = time.process_time()
    ours.encode([("acgt" * 250_000)[:1_000_000].encode()])
    assert time.process_time() - began < 60
