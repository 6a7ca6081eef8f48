"""Language ID: what no labelled language explains is rejected; the fusion against plain sums over all rows."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from citeflow.llm import language_id as li

SF = "/root/testdata/sf0.001"
FINNISH = ("kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja "
           "omatunto ja heidän on toimittava toisiaan kohtaan veljeyden hengessä").split()
ROWS = "key long, text string, declared string, host string"


def _strange(rng):
    letters = "abcdefghijklmnopqrstuvwxyz"
    gibberish = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(2000)]
    return [" ".join(rng.choice(w) for _ in range(50)) for w in [gibberish] * 30 + [FINNISH] * 10]


def test_unknown_languages_are_rejected_and_unseen_documents_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fitted, unseen = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    model = li.fit_text_model(fitted)
    strange = spark.createDataFrame([(-1 - i, t, None, None) for i, t in enumerate(_strange(random.Random(3)))], ROWS)
    rows = unseen.select(F.col("doc_id").alias("key"), "text", F.lit(None).cast("string").alias("declared"), F.col("source").alias("host"))
    got = {r["key"]: r for r in li.identify(rows.unionByName(strange), model).collect()}
    truth = {r["doc_id"]: r["lang"] for r in unseen.collect()}
    assert all(got[k]["rejected"] and got[k]["lang"] is None and got[k]["text_lang"] is None for k in got if k < 0)
    assert np.mean([got[k]["lang"] == truth[k] for k in truth]) >= 0.95


def test_fusion_equals_plain_sums(spark):
    rng = random.Random(4)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = li.fit_text_model(docs)
    langs, tri, two, single = model
    n = len(langs)
    rows = [(r["doc_id"], (r["text"] or "")[:rng.choice([4, 12, 60])], rng.choice([r["lang"], r["lang"].upper(), rng.choice(langs), "xx", None]),
             rng.choice(["a.example.org", "b.example.org", "WWW.Site.net", "x.de", None])) for r in docs.limit(120).collect()]
    rows += [(-1, "", "en", None), (-2, "123", None, "x.de"), (-3, None, None, None), (-4, "123", "en", "x.de")]
    got = {r["key"]: r for r in li.identify(spark.createDataFrame(rows, ROWS), model).collect()}

    def soft(x):
        raised = np.exp(np.array(x) - max(x))
        return raised / raised.sum()

    seen = []
    for key, text, declared, host in rows:
        b = b"  " + "".join(c.lower() if c.isascii() else c for c in text or "").encode()
        ll = np.zeros(n + 1)
        for i in range(len(b) - 2):
            pair = b[i] << 8 | b[i + 1]
            slot = ((pair * 0x9E3779B1 & 0xFFFFFFFF) ^ (b[i + 2] * 0x85EBCA77 & 0xFFFFFFFF)) >> 14
            ll += np.append(tri[:, slot].astype(float) - two[:, pair], single[b[i + 2]])
        ll *= li.TEMPER
        ll[n] += math.log(li.UNKNOWN)
        letters = any(chr(x).isalpha() or x > 127 for x in b)
        host = host and host.lower()
        side = {"declared": declared.lower() if declared and declared.lower() in langs else None, "host": host,
                "domain": host and ".".join(host.split(".")[-2:]), "suffix": host and host.split(".")[-1]}
        seen.append((key, letters, ll, side, soft(ll)[:n] if letters else np.full(n, 1 / n)))
    total = sum(s[4] for s in seen)
    sums = {}
    for _, _, _, side, post in seen:
        for k, v in side.items():
            if v is not None:
                sums[k, v] = sums.get((k, v), 0) + post
    for key, letters, ll, side, post in seen:
        prior = (total + 1) / (total.sum() + n)
        for k in ("suffix", "domain", "host"):
            if side[k] is not None:
                others = np.maximum(sums[k, side[k]] - post, 0)
                prior = (others + li.STRENGTH * prior) / (others.sum() + li.STRENGTH)
        fused = np.append((ll[:n] if letters else 0) + np.log(prior), ll[n] if letters else math.log(li.UNKNOWN))
        for k in ("declared", "suffix"):
            if side[k] is not None:
                fused[:n] += np.log((np.maximum(sums[k, side[k]] - post, 0) + li.SMOOTH) / (total + 1))
                fused[n] += math.log((sums[k, side[k]].sum() + li.SMOOTH) / (total.sum() + 1))
        fused = soft(fused)[:n]
        assert math.isclose(got[key]["probability"], fused.max(), rel_tol=1e-6, abs_tol=1e-9)
        rejected = (not letters and side["declared"] is None) or fused.max() < li.LEAST
        assert got[key]["rejected"] == rejected
        assert got[key]["lang"] == (None if rejected else langs[int(fused.argmax())])


def test_documents_of_a_known_language_stay_and_marked_gibberish_goes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = li.fit_text_model(docs.where("doc_id % 2 = 0"))  # an odd one has marks after each word
    strange = [(-1 - i, t.replace(" ", "!! "), None, None, len(t)) for i, t in enumerate(_strange(random.Random(3)))]
    got = li.known_language(docs.unionByName(spark.createDataFrame(strange, docs.schema)), model).select("doc_id").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
