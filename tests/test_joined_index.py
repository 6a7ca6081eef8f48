"""Joined nominal indices: the same forest as with fitted label lists, no label on the driver, saved and loaded."""

import time

from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from citeflow import constants as K
from citeflow.operators.joined_index import JoinedIndexer
from citeflow.operators.models import fit_feature_model, forest, max_bins, most_subsets, score, train_model, tree
from citeflow.plans.batch_job import train_test
from citeflow.session import scratch_path
from citeflow.sources.models import load_model, save_model


def test_same_forest_saved_and_loaded(spark, sf_small):
    train, test = train_test(spark, sf_small)
    by_labels = fit_feature_model(train)
    by_joins = fit_feature_model(train, joined=K.CATEGORY_COLUMNS)
    assert max_bins(by_labels) == max_bins(by_joins)
    one, two = (train_model(train, f, forest(f, num_trees=4)) for f in (by_labels, by_joins))
    assert one.stages[-1].toDebugString.split("\n", 1)[1] == two.stages[-1].toDebugString.split("\n", 1)[1]
    odd = test.limit(50).withColumn("vehicle_make", F.lit("never seen")).withColumn("plate_type", F.lit(None).cast("string"))
    rows = test.unionByName(odd)
    path = save_model(two, scratch_path(spark, "t-joined"))
    keys = ["summons_number", "prediction", "p_target", "predicted_label"]
    want = sorted(score(one, rows, compile_trees=True).select(*keys).collect())
    assert want == sorted(score(two, rows, compile_trees=True).select(*keys).collect())
    loaded = load_model(path)
    assert want == sorted(score(loaded, rows, compile_trees=True).select(*keys).collect())
    assert want == sorted(score(loaded, rows, compile_trees=False).select(*keys).collect())
    assert all("-tables/" in s.getOrDefault("table") for s in loaded.stages if isinstance(s, JoinedIndexer))


def test_many_labels_cost_the_driver_nothing(spark, sf_small, monkeypatch):
    train, _ = train_test(spark, sf_small)
    one = train.select(*K.CLEANED_COLUMNS).first()
    many = spark.range(13_398).select(*[F.lit(one[c]).alias(c) for c in K.CLEANED_COLUMNS if c != "vehicle_make"],
                                      F.concat(F.lit("m"), (F.col("id") % 6699).cast("string")).alias("vehicle_make"))
    table = scratch_path(spark, "t-many")
    seen = []
    whole = type(many).collect

    def noted(self):
        rows = whole(self)
        seen.append(len(rows))
        return rows

    monkeypatch.setattr(type(many), "collect", noted)
    model = fit_feature_model(many, joined=K.CATEGORY_COLUMNS, index_path=table)
    assert max(seen) <= len(K.CATEGORY_COLUMNS) + 1  # sizes and the target's labels
    assert max_bins(model) == 6700
    began = time.time()
    out = model.transform(many)
    slots = out.schema["features"].metadata["ml_attr"]["attrs"]["nominal"]
    assert time.time() - began < 5 and {a["num_vals"] for a in slots if a["name"] == "vehicle_make_index"} == {6700}
    place = K.FEATURES.index("vehicle_make_index")
    got = out.select(F.col("vehicle_make"), vector_to_array("features")[place].alias("idx")).distinct().collect()
    names = sorted(f"m{i}" for i in range(6699))
    assert {r["vehicle_make"]: r["idx"] for r in got} == {v: float(i) for i, v in enumerate(names)}


def test_a_column_of_more_categories_than_the_original_trains(spark, sf_small):
    train, _ = train_test(spark, sf_small)
    one = train.where(F.col(K.TARGET).isNotNull()).first()
    county = F.when(F.col("id") % 7000 % 2 == 0, F.lit("NY")).otherwise(F.lit("K"))
    many = spark.range(14_000).select(*[F.lit(one[c]).alias(c) for c in K.CLEANED_COLUMNS if c not in ("street_code1", K.TARGET)],
                                      (F.col("id") % 7000).cast("int").alias("street_code1"), county.alias(K.TARGET))
    features = fit_feature_model(many)
    joined = [s for s in features.stages if isinstance(s, JoinedIndexer)]
    assert [s.categories() for s in joined] == [{"street_code1_index": 7000}] and max_bins(features) == 7001
    model = train_model(many, features, tree(features))
    odd = many.limit(20).withColumn("street_code1", F.lit(-1))
    rows = many.unionByName(odd)
    path = save_model(model, scratch_path(spark, "t-many-trained"))
    keys = ["street_code1", "label", "prediction", "p_target"]
    want = sorted(score(model, rows, compile_trees=False).select(*keys).collect())
    assert want == sorted(score(load_model(path), rows, compile_trees=True).select(*keys).collect())
    # the index that Spark's own indexer gives, and an unseen value's
    ref = StringIndexer(inputCol="street_code1", outputCol="street_code1_index", handleInvalid="keep").fit(many)
    assert sorted(features.transform(rows).select("street_code1", "street_code1_index").collect()) == sorted(
        ref.transform(rows).select("street_code1", "street_code1_index").collect())


def test_more_bins_try_no_more_subsets(spark, sf_small):
    train, _ = train_test(spark, sf_small)
    one = train.where(F.col(K.TARGET).isNotNull()).first()
    many = spark.range(24_000).select(*[F.lit(one[c]).alias(c) for c in K.CLEANED_COLUMNS if c not in ("street_code1", "issuer_command")],
                                      F.col("id").cast("int").alias("street_code1"), F.concat(F.lit("T"), F.col("id") % 12).alias("issuer_command"))
    features = fit_feature_model(many)
    out = features.transform(many)
    marked = {a["name"]: a["num_vals"] for a in out.schema["features"].metadata["ml_attr"]["attrs"]["nominal"] if "num_vals" in a}
    # 13 categories would be 4,095 subsets with 24,001 bins: marked as one more than the learner tries subsets of
    assert marked == {"street_code1_index": 24_001, "issuer_command_index": most_subsets(24_001) + 1} and max_bins(features) == 24_001
    assert most_subsets(K.MAX_BINS) == 12 and out.agg(F.max("issuer_command_index")).first()[0] == 11.0
