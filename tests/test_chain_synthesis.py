"""The conditional chain: marginals, contexts, back-off, layout, nulls, the validator's rounds."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from citeflow.operators.chain_synthesis import chain_counts, pair_validator, synthesize_valid, unseen_share

BATCHES = [["a", "b", "c", "d"], ["e", "f"]]
N = 1500


@pytest.fixture(scope="module")
def source(spark):
    rng = random.Random(8)
    out = []
    for _ in range(4000):
        a = rng.choice("xxyz")
        b = a + rng.choice("pq")
        c = rng.choice([b[1], None, "t"])
        out.append((a, b, c, float(rng.randrange(3)), rng.randrange(4), rng.choice("uv")))
    return spark.createDataFrame(out, "a string, b string, c string, d double, e int, f string").cache()


@pytest.fixture(scope="module")
def made(source):
    rows, status = synthesize_valid(source, batches=BATCHES, n=N, seed=5)
    return rows.collect(), status.collect()


def test_rows_types_and_marginals(source, made):
    rows, status = made
    assert sorted(r["draw_id"] for r in rows) == list(range(N))
    assert [tuple(r) for r in status] == [(0, N, N, N, 0, 0), (1, N, N, N, 0, 0)]
    own = source.collect()
    assert isinstance(rows[0]["d"], float) and isinstance(rows[0]["e"], int)
    for cols in (["a"], ["d"], ["a", "b"], ["b", "c"], ["e", "f"]):
        ours, theirs = (Counter(tuple(r[c] for c in cols) for r in t) for t in (rows, own))
        assert set(ours) <= set(theirs)  # each column is drawn given the one before it
        assert all(abs(ours[k] / N - v / len(own)) < 0.05 for k, v in theirs.items()), cols


def test_same_rows_on_any_layout(source, made):
    again, _ = synthesize_valid(source.repartition(7), batches=BATCHES, n=N, seed=5)
    assert sorted(map(str, again.collect())) == sorted(map(str, made[0]))


def test_ranges_cover_each_context(source):
    rows = chain_counts(source, BATCHES).collect()
    by = {}
    for r in rows:
        by.setdefault((r["level"], r["batch"], r["place"], r["c2"], r["c1"]), []).append((r["lo"], r["n"], r["total"]))
    for ranges in by.values():
        at = 0
        for lo, n, total in sorted(ranges):
            assert lo == at
            at += n
        assert {t for *_, t in ranges} == {at}


def test_lines_that_no_row_holds(spark):
    src = spark.createDataFrame([(f"{i % 7}", f"{i % 5}", f"{i % 3}", f"{(i * i) % 11}") for i in range(300)], "a string, b string, c string, d string")
    rows, _ = synthesize_valid(src, batches=[["a", "b", "c", "d"]], n=500)
    got = unseen_share(rows, src, [["a", "b", "c", "d"]]).first()
    own = {tuple(r) for r in src.collect()}
    assert (got["generated"], got["unseen"]) == (500, sum(tuple(r)[1:] not in own for r in rows.collect())) and got["unseen"] > 0


def test_invalid_lines_are_drawn_again(source):
    batch = [["a", "d", "e", "f"]]
    own = source.where("NOT (a = 'x' AND f = 'v')")  # the pair that no row of these holds
    check = pair_validator(own, [("a", "f")])
    rows, status = synthesize_valid(source, check, batch, n=400, rounds=3)
    _, requested, generated, valid, redrawn, short = status.first()
    assert rows.count() == valid and valid + short == requested == 400 and generated == 400 + redrawn and redrawn > 100
    assert rows.where("a = 'x' AND f = 'v'").count() == 0 and short > 0
    none, status = synthesize_valid(source, lambda lines: lines.where("false"), batch, n=50, rounds=2)
    assert none.count() == 0 and tuple(status.first()) == (0, 50, 100, 0, 50, 50)


def test_an_empty_source(spark, source):
    rows, status = synthesize_valid(source.where("a = 'none'"), batches=BATCHES, n=10)
    assert rows.count() == 0 and [r["short"] for r in status.collect()] == [10, 10]
