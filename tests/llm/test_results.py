"""Whole results of each operator against plain brute force on small tables."""

import base64
import hashlib
import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_helpers import documents, prose, words
from citeflow.llm import (brown_lm, forced_bpe, language_id, licenses, line_templates, multi_index, packing, partenum,
                          suffix_dedup, syncmers)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def public(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def test_class_model(docs, texts):
    got = {r["doc_id"]: r for r in brown_lm.class_model_scores(docs).collect()}
    tokens = {d: [*words(t), "\n"] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    counts = Counter(w for d, own in tokens.items() if not held[d] for w in own)
    n, v = sum(counts.values()), len(counts)
    for d, own in tokens.items():
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[d], len(own), sum(counts[w] > 0 for w in own), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
        assert r["score"] < 0
    out = [r for d, r in got.items() if held[d]]
    assert sum(r["score"] for r in out) > 0.95 * sum(r["base_score"] for r in out)


def test_class_model_is_a_distribution():
    """Known words, the end and one unknown word share a probability of 1 after every class."""
    rng = np.random.default_rng(3)
    c = brown_lm.CLASSES
    mass, once = np.zeros(c + 2), np.zeros(c + 2)
    words_of = rng.integers(0, 30, c)
    counts = [rng.integers(1, 9, n) for n in words_of]
    mass[:c], once[:c] = [x.sum() for x in counts], [(x == 1).sum() for x in counts]
    mass[brown_lm.STOP] = 50
    joint = rng.integers(0, 20, (c + 2, c + 2)).astype(float)
    total = int(mass.sum())
    known, unknown, _ = brown_lm._tables(joint, mass, once, total, int(once.sum()))
    for before in (0, 7, brown_lm.STOP):
        p = sum((x * 10 ** known[before, k]).sum() for k, x in enumerate(counts)) + 50 * 10 ** known[before, brown_lm.STOP]
        assert math.isclose(p + 10 ** unknown[before], 1.0, rel_tol=1e-9)


def test_exchange_separates_two_languages(spark):
    rng = random.Random(4)
    a, b = [f"a{i}" for i in range(12)], [f"b{i}" for i in range(12)]
    rows = [(i, " ".join(rng.choices(a if i % 2 else b, k=40))) for i in range(200)]
    mixed = [(1000 + i, " ".join(rng.choices(a + b, k=40))) for i in range(20)]
    got = brown_lm.class_model_scores(documents(spark, rows + mixed)).collect()
    per = lambda lo, hi: np.mean([r["score"] / r["n_tokens"] for r in got if lo <= r["doc_id"] < hi])
    assert per(0, 1000) > per(1000, 2000) + 0.1


def test_language_accuracy(docs):
    fitted = language_id.fit_text_model(docs.where("doc_id % 2 = 0"))
    rows = docs.where("doc_id % 2 = 1").select(F.col("doc_id").alias("key"), "text", F.lit(None).cast("string").alias("declared"), F.col("source").alias("host"))
    got = language_id.identify(rows, fitted).join(docs, F.col("key") == F.col("doc_id")).select("text_lang", docs["lang"].alias("true")).collect()
    assert np.mean([r["text_lang"] == r["true"] for r in got]) > 0.95
    assert language_id.known_language(docs, fitted).count() == docs.count()


def test_host_prior_decides_without_text(spark):
    fitted = language_id.fit_text_model(documents(spark, [(1, "the and of the to in", "en", "a"), (2, "der und die das ein zu", "de", "b")]))
    rows = [(i, "der und die", None, "h.one.de") for i in range(20)] + [(50 + i, "the of and", None, "h.two.com") for i in range(20)]
    rows += [(100, "123", "de", "h.one.de"), (101, "123", "en", "h.two.com"), (102, "??", None, "x.one.de")]
    got = {r["key"]: r for r in language_id.identify(spark.createDataFrame(rows, "key long, text string, declared string, host string"), fitted).collect()}
    assert got[0]["lang"] == "de" and got[50]["lang"] == "en"
    assert got[100]["lang"] == "de" and got[101]["lang"] == "en" and got[102]["rejected"]


def test_licence_findings(docs, texts):
    found = {r["doc_id"]: set(r["families"]) for r in licenses.scan(docs.select("doc_id", "text"), licenses.train(docs)).collect()}
    marks = {"apache": "Apache License", "mit": "MIT License", "gpl": "GNU General Public", "cc_by_nc": "CC BY-NC", "reserved": "All rights reserved"}
    wrong = [d for d, t in texts.items() if {k for k, m in marks.items() if m in t} != found[d]]
    assert len(wrong) <= len(texts) // 100


def test_packing(docs, texts):
    from tokenizers import Tokenizer

    rows = packing.packed_documents(docs, public("word_bpe_49k.json")).collect()
    tokenizer = Tokenizer.from_file(public("word_bpe_49k.json"))
    pieces = {}
    for d, t in texts.items():
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            cut = np.array(ids[a:a + 2048], "<u4")
            pieces[d, k] = (a, len(cut), zlib.crc32(cut.tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == pieces and len(rows) == len(pieces)
    fill = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill[r["sequence_id"]]
        fill[r["sequence_id"]] += r["length"]
    least = -(-sum(p[1] for p in pieces.values()) // 2048)
    assert max(fill.values()) <= 2048 and len(fill) <= least + max(1, least // 50)


@pytest.mark.parametrize("low, high, n", [(1, 2048, 5000), (500, 1200, 5000), (1, 40, 7), (1025, 2048, 300), (3, 3, 10_000)])
def test_packing_plan(low, high, n):
    counts = np.bincount(np.random.default_rng(n).integers(low, high + 1, n), minlength=2049)
    runs = packing.plan(counts)
    got, fill = np.zeros_like(counts), np.zeros(max(f + m for _, f, m, _ in runs), np.int64)
    for length, first, m, offset in sorted(runs, key=lambda r: r[3]):
        got[length] += m
        assert (fill[first:first + m] == offset).all()
        fill[first:first + m] += length
    assert (got == counts).all() and fill.max() <= 2048
    least = max(-(-int((counts * np.arange(2049)).sum()) // 2048), int(counts[1025:].sum()))
    assert len(fill) <= math.ceil(1.03 * least)


def brute_components(texts):
    sets = {}
    for d, t in texts.items():
        w = words(t)
        sets[d] = frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    ids, up = sorted(sets), {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


@pytest.mark.parametrize("limits", [{}, {"SMALL_BUCKET": 3, "PAGE_ITEMS": 900, "BLOCK_FREQUENT": 2, "PAGED_LEVEL": 2}])
def test_near_duplicates(spark, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(partenum, k, v)
    rng = random.Random(9)
    line, rows = prose(rng, 14), []
    for g in range(6):  # groups of copies with more and more edits, and texts that share a line
        base = prose(rng, 60 * (g + 1)).split()
        for c in range(25):
            own = list(base)
            for _ in range(int(len(base) * 0.004 * c)):
                own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    rows += [(len(rows) + i, f"{prose(rng, rng.choice((3, 9, 40)))}\n{line}") for i in range(60)]
    rows += [(len(rows) + i, t) for i, t in enumerate(["a b c d e", "A b  c d e", "a b c d", "a b c d e f", "a", "", None] * 2)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in partenum.near_duplicates(documents(spark, rows)).collect()}
    assert got == brute_components(dict(rows))


def test_pages_of_one_component_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(partenum, "PAGE_ITEMS", 1000)
    rows = [(1, i, 7, 100) for i in range(300)] + [(1, 1000 + i, 1000 + i, 100) for i in range(12)]  # a large component and 12 classes apart
    rows += [(2, i, 7, 100) for i in range(50)]  # one component only
    rows += [(3, i, i % 2, 100) for i in range(6)]  # small: one page
    sized = spark.createDataFrame(rows, "center long, class long, component long, n long")
    met = {}
    for r in partenum.page_pairs(sized).collect():
        met.setdefault((r["center"], r["lo"], r["hi"]), []).append((r["page"], r["class"], r["component"]))
    assert {c for c, _, _ in met} == {1, 3}
    pairs = set()
    for (c, lo, hi), own in met.items():
        for p, x, a in own:
            for q, y, b in own:
                if x < y and a != b and {p, q} == {lo, hi}:
                    pairs.add((c, x, y))
    want = {(c, x, y) for c, x, a, _ in rows for d, y, b, _ in rows if c == d and x < y and a != b}
    assert pairs == want
    # 30 + 2 pages: all pairs of pages would have held every class 32 times
    assert sum(len(own) for (c, _, _), own in met.items() if c == 1) <= 300 * 2 + 12 * 32


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 16))
    x[100:160] = x[99]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in multi_index.nearest_neighbours(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 900, 20))
    hit = 0
    for q, own in got.items():
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, 21))
        score = (x * x[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(900), -score)).tolist() if i != q][:20]
        assert np.allclose([s for _, _, s in own], score[[i for _, i, _ in own]], rtol=0, atol=1e-12)
        hit += len(set(order) & {i for _, i, _ in own})
    assert hit >= 0.9 * 20 * len(got)
    assert [i for _, i, _ in got[100]] == [99, *range(101, 120)]


def brute_repeats(texts, length=400):
    seen = Counter(t[i:i + length] for t in texts.values() for i in range(len(t) - length + 1))
    out = {}
    for d, t in texts.items():
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out[d] = (len(t), sum(gone), sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1])), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("group", [256, 2])
def test_repeats(spark, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rng = random.Random(2)
    passage, other = prose(rng, 120), prose(rng, 90)
    rows = [(i, f"{prose(rng, rng.randrange(5, 60))} {passage[rng.randrange(40):len(passage) - rng.randrange(40)]} {prose(rng, 20)}") for i in range(20)]
    rows += [(30 + i, prose(rng, 30) + other[:380 + i] + prose(rng, 10)) for i in range(40)]
    rows += [(90, "ab" * 600), (91, other + other), (92, prose(rng, 50)), (93, rows[0][1]), (94, "é" * 300), (95, "é" * 200 + "x"), (96, None)]
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.repeat_digest(documents(spark, rows)).collect()}
    assert got == brute_repeats({d: (t or "").encode() for d, t in rows})


def test_deep_shallow_order():
    rng = random.Random(1)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 90))) for _ in range(400)]
    strings += [b"a" * 60 + bytes([rng.choice(b"ab")]) * rng.randrange(5) for _ in range(60)] + [strings[3]] * 4
    order, lcp = suffix_dedup.deep_shallow(strings)
    assert [strings[i] for i in order] == sorted(strings)
    for k in range(1, len(order)):
        a, b = strings[order[k - 1]], strings[order[k]]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert lcp[k] == n


def test_fingerprints(docs, texts, monkeypatch):
    monkeypatch.setattr(syncmers, "RANGE_ROWS", 20)
    got = {r["doc_id"]: r for r in syncmers.fingerprints(docs).collect()}
    ids = sorted(texts)
    edited = {}
    for i, d in enumerate(ids):
        own, after = texts[d], texts[ids[(i + 1) % len(ids)]]
        edited[d] = own[:len(own) - len(own) // 2] + after[:len(own) // 2]
        assert got[d]["n_chars"] == len(own) and got[d]["edited_sha256"] == hashlib.sha256(edited[d].encode()).hexdigest()

    def alike(a, b):
        a, b = (list(dict.fromkeys(struct.unpack(f">{len(x) // 8}q", x))) for x in map(base64.b64decode, (a, b)))
        common = [x for x in a if x in set(b)]
        place = {x: i for i, x in enumerate(x for x in b if x in set(a))}
        moved = sum(abs(i - place[x]) * syncmers.DRIFT > max(len(common), syncmers.DRIFT) for i, x in enumerate(common))
        return 1.0 if not a and not b else (len(common) - moved / 2) / len(set(a) | set(b))

    for i, d in enumerate(ids):
        after = got[ids[(i + 1) % len(ids)]]
        assert math.isclose(got[d]["near_edited"], alike(got[d]["fingerprint"], got[d]["edited_fingerprint"]))
        assert math.isclose(got[d]["near_next"], alike(got[d]["fingerprint"], after["fingerprint"]))
    same = {}
    for d in ids:
        assert same.setdefault(texts[d], got[d]["fingerprint"]) == got[d]["fingerprint"]
    long = [got[d] for d in ids if len(texts[d]) > 400]
    assert np.mean([r["near_edited"] > r["near_next"] for r in long]) > 0.95


def test_fingerprints_see_edits_order_and_small_shares(spark):
    rng = random.Random(61)
    w = prose(rng, 8000, 10**6).split()
    edited = list(w)
    for i in range(500, 8000, 1300):
        edited[i] = f"edit{i}"
    blocks = [w[i:i + 400] for i in range(0, 8000, 400)]
    rng.shuffle(blocks)
    one = prose(rng, 4000, 10**6).split()
    other = prose(rng, 2000, 10**6).split() + one[1000:1200] + prose(rng, 2000, 10**6).split()
    inserted = w[:3000] + prose(rng, 300, 10**6).split() + w[3000:]
    texts = [w, edited, w, sum(blocks, []), w, inserted, one, other]
    got = {r["doc_id"]: r for r in syncmers.fingerprints(documents(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])).collect()}
    assert got[0]["fingerprint"] == got[2]["fingerprint"] == got[4]["fingerprint"] != got[1]["fingerprint"]
    assert 0.98 < got[0]["near_next"] < 1  # six edits in 8,000 words
    assert got[2]["near_next"] < 0.75  # the same words, 20 blocks in another order
    assert 0.9 < got[4]["near_next"] < 1  # nothing moved but 300 words came in between
    assert 0.01 < got[6]["near_next"] < 0.05  # 200 words of 4,200 in common


def test_syncmers_are_chosen_by_their_own_words(spark):
    rng = random.Random(6)
    passage = prose(rng, 80)
    df = documents(spark, [(0, passage), (1, prose(rng, 37) + " " + passage + " " + prose(rng, 9)), (2, "a b c"), (3, "")])
    got = {r["doc_id"]: {a["pos"]: a["hash"] for a in r["anchors"]} for r in syncmers.closed_syncmers(df).collect()}
    inside = {p - 37: h for p, h in got[1].items() if 37 <= p <= 37 + 80 - syncmers.K}
    assert inside == got[0] and len(got[2]) == 1 and not got[3]
    # brute force over the hashes of neighbouring words
    w = passage.split()
    pairs = spark.createDataFrame([(i, w[i], w[i + 1]) for i in range(len(w) - 1)], "i int, a string, b string")
    g = [r["g"] for r in pairs.select("i", F.xxhash64(F.xxhash64("a"), F.xxhash64("b")).alias("g")).orderBy("i").collect()]
    inner = syncmers.K - syncmers.S + 1
    assert set(got[0]) == {i for i in range(len(w) - syncmers.K + 1) if min(g[i:i + inner]) in (g[i], g[i + inner - 1])}


def test_line_templates(spark):
    rng = random.Random(8)
    names = ["anna", "bo", "carl", "dora", "emil", "fay", "gus", "hal", "ida", "jo"]
    rows = []
    for i in range(40):
        lines = [prose(rng, rng.randrange(5, 60)) for _ in range(rng.randrange(2, 9))]
        lines.insert(rng.randrange(len(lines)), f"Page {i} of {rng.randrange(90)} was printed")
        lines.append(f"This post was written by {rng.choice(names)}{rng.choice('abcdefgh')} and reviewed by the whole team")
        rows.append((i, "\n".join([*lines, ""])))
    copied = [prose(rng, 30) for _ in range(5)]
    rows += [(100 + i, "\n".join(copied)) for i in range(50)]
    rows += [(200 + i, f"{i} {i + 1}\n" + prose(rng, 20 + i)) for i in range(20)]
    df = documents(spark, rows)
    kept = {r["doc_id"]: r["text"] for r in line_templates.without_recurring_lines(df).collect()}
    for d, t in rows:
        want = [l for l in t.split("\n") if not l.startswith(("Page ", "This post was"))]
        assert kept[d] == "\n".join(want)
    report = {r["doc_id"]: r for r in line_templates.line_report(df).collect()}
    assert all(report[d]["n_dropped"] == t.count("Page ") + t.count("This post was") for d, t in rows)
    assert all(report[d]["kept_sha256"] == hashlib.sha256(kept[d].encode()).hexdigest() for d, _ in rows)


def test_native_operators_run_no_python(docs):
    for df in (syncmers.fingerprints(docs), line_templates.line_report(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(k in plan for k in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_bpe_equals_the_library(spark, docs, texts):
    from tokenizers import Tokenizer

    rng = random.Random(3)
    odd = [" ", "  ", "\n", "\t", "'s", "'t", "!'s", "a", "Z", "é", "9", "漢", "<|endoftext|>", "\x1c", "\x85", "...", "́", "😀", "\r\n", "_", "\xa0"]
    rows = [(1000 + i, "".join(rng.choice(odd) for _ in range(rng.randrange(30)))) for i in range(400)] + list(texts.items())
    df = documents(spark, rows + [(5000, None)])
    library = Tokenizer.from_file(public("byte_bpe_50k.json"))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = {r["doc_id"]: tuple(r)[1:] for r in forced_bpe.bpe_digest(df, public("byte_bpe_50k.json")).collect()}
    for d, t in [*rows, (5000, "")]:
        ids = library.encode(t, add_special_tokens=False).ids
        assert got[d] == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode()))
    small = {r["doc_id"]: r for r in forced_bpe.bpe_tokens(df.where("doc_id < 20"), public("byte_bpe_50k.json")).collect()}
    assert all(small[d]["decoded"] == texts[d] and small[d]["ids"] == library.encode(texts[d], add_special_tokens=False).ids for d in small)


def test_pipeline_stages(spark, docs, texts):
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language_id"](spark, docs, SF)
    assert known.count() == docs.count()
    one = {r["doc_id"] for r in stages["jaccard_join"](spark, docs, SF).collect()}
    assert one == {d for d, (_, c) in brute_components(texts).items() if c == d}
    cut = {r["doc_id"]: r for r in stages["suffix_dedup"](spark, docs, SF).collect()}
    for d, (_, gone, _, sha) in brute_repeats({d: t.encode() for d, t in texts.items()}, corpus_pipeline.PASSAGE).items():
        assert cut[d]["n_chars"] == len(cut[d]["text"])
        if texts[d].isascii() or not gone:
            assert hashlib.sha256(cut[d]["text"].encode()).hexdigest() == sha
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == len({r["doc_id"] for r in packed.collect()}) > 100
