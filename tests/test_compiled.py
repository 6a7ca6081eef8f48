"""Compiled trees equal the model: votes, probabilities and predictions, bit for bit."""

import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from citeflow.operators.compiled import Branch, CompiledModel, compiled

SLOTS = ["x", "y", "c_index", "d_index"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    out = []
    for i in range(1500):
        c, d = f"c{int(rng.paretovariate(0.6)) % 90}", rng.choice("abc")
        x, y = rng.gauss(0, 1), float(rng.randrange(6))
        label = float((hash(c) % 3 + (x > 0.3) + (y > 2) + (d == "a")) % 4) if rng.random() < 0.8 else float(rng.randrange(4))
        out.append((i, x, y, c, d, label))
    df = spark.createDataFrame(out, "id long, x double, y double, c string, d string, label double")
    for name in "cd":
        df = StringIndexer(inputCol=name, outputCol=f"{name}_index", handleInvalid="keep").fit(df).transform(df)
    return df.cache()


def both(model, rows):
    theirs = PipelineModel(stages=[VectorAssembler(inputCols=SLOTS, outputCol="features", handleInvalid="keep"), model]).transform(rows)
    theirs = theirs.select("id", vector_to_array("rawPrediction").alias("raw"), vector_to_array("probability").alias("p"), "prediction")
    ours = CompiledModel(model, SLOTS).transform(rows).select("id", "raw_votes", "probabilities", "prediction")
    return sorted(map(tuple, theirs.collect())), sorted((r[0], list(r[1]), list(r[2]), r[3]) for r in ours.collect())


@pytest.mark.parametrize("depth,trees", [(0, 0), (3, 0), (9, 0), (5, 7), (12, 3)])
def test_equal_to_the_model(spark, rows, depth, trees):
    kind = RandomForestClassifier(numTrees=trees, seed=3) if trees else DecisionTreeClassifier(seed=3)
    fit = VectorAssembler(inputCols=SLOTS, outputCol="features").transform(rows)
    model = kind.setParams(maxDepth=depth, maxBins=128, labelCol="label").fit(fit)
    theirs, ours = both(model, rows)
    assert [(a, list(b), list(c), d) for a, b, c, d in theirs] == ours
    # indices and numbers that no training row had
    n = spark.range(400)
    odd = n.select("id", ((F.col("id") % 7) - 3).cast("double").alias("x"), (F.col("id") % 11 - 2).cast("double").alias("y"),
                   (F.col("id") % 140).cast("double").alias("c_index"), (F.col("id") % 9).cast("double").alias("d_index"))
    odd = odd.unionByName(spark.createDataFrame([(1000, float("nan"), float("inf"), 1.5, 2.0), (1001, -float("inf"), -0.0, 0.0, 1e18), (1002, 0.0, 0.0, -1.0, 0.0)], odd.schema))
    theirs, ours = both(model, odd)
    assert [(a, list(b), list(c), d) for a, b, c, d in theirs] == ours


def test_nulls_and_wrong_slots(spark, rows):
    fit = VectorAssembler(inputCols=SLOTS, outputCol="features").transform(rows)
    model = DecisionTreeClassifier(maxDepth=2, maxBins=128, seed=1).fit(fit)
    one = rows.limit(1).select("id", "x", F.lit(None).cast("double").alias("y"), "c_index", "d_index")
    got = CompiledModel(model, SLOTS).transform(one).first()
    assert (got["raw_votes"], got["probabilities"], got["prediction"]) == (None, None, None)
    with pytest.raises(ValueError):
        CompiledModel(model, SLOTS[:3])
    assert compiled(model, SLOTS) is compiled(model, SLOTS)


def test_plan_has_no_udf(rows):
    fit = VectorAssembler(inputCols=SLOTS, outputCol="features").transform(rows)
    model = RandomForestClassifier(maxDepth=4, maxBins=128, numTrees=3, seed=1).fit(fit)
    c = CompiledModel(model, SLOTS)
    assert any(isinstance(t.root, Branch) and t.root.split.values for t in c.trees) or c.words
    plan = c.transform(rows.sparkSession.range(9).select(*[F.col("id").cast("double").alias(f) for f in SLOTS]))._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "if (" in plan.lower() and "Exchange" not in plan
