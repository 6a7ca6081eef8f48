"""op6 over vectors of one component, and of none."""

import random

from pyspark.sql import functions as F

from citeflow.llm.multi_index import nearest_neighbours


def test_one_component(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-2, 2)]) for i in range(300)] + [(300, [0.0]), (301, [1.0, 2.0]), (302, None), (303, [float("nan")]), (320, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in sorted(nearest_neighbours(df, F.col("vec_id") % 20 == 0, 5).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    valid = {i: v[0] for i, v in rows if v and len(v) == 1 and v[0] == v[0] and v[0]}
    want = {q: [(i, x * valid[q]) for i, x in sorted(((i, x) for i, x in valid.items() if i != q), key=lambda e: (-e[1] * valid[q], e[0]))[:5]]
            for q in valid if q % 20 == 0}
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert set(got) == set(want) and hits >= 0.9 * sum(map(len, want.values()))


def test_no_component(spark):
    df = spark.createDataFrame([(0, []), (20, [])], "vec_id long, embedding array<double>")
    assert nearest_neighbours(df, F.col("vec_id") % 20 == 0).count() == 0
